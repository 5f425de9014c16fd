"""Against plain Python: token by token, and against whole texts given to both libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from chartloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


@pytest.fixture(scope="module", params=[None, public_tokenizers.PATTERN])
def pair(request):
    with open(A, "rb") as x, open(B, "rb") as y:
        return alignment._Pair(x.read(), y.read(), request.param)


def plain(libraries, text):
    """(id, first byte, byte behind the last) of all tokens; none if they do not spell a space and the text."""
    a, b = libraries
    byte = alignment._byte_of()
    whole = " " + (text or "")
    entries = [(k, a.id_to_token(k)) for k in a.encode(whole, add_special_tokens=False).ids] if text else []
    pieces = [(k, b.id_to_piece(k)) for k in b.encode(text)] if text else []
    of_a = [(k, bytes(byte[c] for c in t)) for k, t in entries]
    of_b = [(k, bytes([int(t[3:5], 16)]) if b.is_byte(k) else t.replace("▁", " ").encode()) for k, t in pieces]
    if not text or any(b"".join(t for _, t in side) != whole.encode() for side in (of_a, of_b)):
        return [], []
    out = []
    for side in (of_a, of_b):
        place, spans = 0, []
        for k, t in side:
            spans.append((k, place, place + len(t)))
            place += len(t)
        out.append(spans)
    return out


def grouped(of_a, of_b):
    cuts = sorted({e for _, _, e in of_a} & {e for _, _, e in of_b})
    out, low = [], 0
    for cut in cuts:
        out.append("|".join(",".join(str(k) for k, s, _ in side if low <= s < cut) for side in (of_a, of_b)))
        low = cut
    return ";".join(out), len(cuts)


def overlapping(of_a, of_b):
    return [(i, j) for i, s, e in of_a for j, t, f in of_b if s < f and t < e]


def brute(libraries, rows):
    found = [(i, *plain(libraries, t)) for i, t in rows]
    links = [overlapping(a, b) for _, a, b in found]
    count = Counter(x for one in links for x in one)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for (i, a, b), own in zip(found, links, strict=True):
        text, n = grouped(a, b)
        out.append((i, len(a), len(b), n, len(own), sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own), text))
    return out


def texts():
    rng = random.Random(11)
    parts = ["a", "B", "ing", " the", " ", "  ", "\n", "\n\n", " \n ", "\t", "\r\n", "é", "é", "ß", "中文", "日本 語", "😀", "'s", "don't", "12", "½", "\x00"]
    parts += ["\x1c", "\x85", "\xa0", " ", "　", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", ");\r", "_", "qzx", "​", "﻿", "ﬁ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(150)]


def odd():
    return [None, "", " ", "   ", "\n", "a▁b", "▁", "word " * 300, "ab" * 300, "a\nb\nc", "\nfirst", " lead", "trail  ", "ﬁne \x00 x"]


def test_words_give_what_whole_texts_give(libraries, pair):
    assert pair.safe
    rows = texts() + [t for t in odd() if t]
    for text, (of_a, of_b, size) in zip(rows, pair.texts(rows), strict=True):
        want_a, want_b = plain(libraries, text)
        assert np.frombuffer(of_a, np.int32).tolist() == [k for k, _, _ in want_a]
        assert np.frombuffer(of_b, np.int32).tolist() == [k for k, _, _ in want_b]
        assert size == (len(text.encode()) + 1 if want_a else 0)


def test_pointers_rest_at_the_end_of_components():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.union1d(rng.choice(n, int(rng.integers(0, n + 1)), replace=False), [n - 1]) for _ in range(2)]
        g = alignment.groups(*ends)
        spans = [list(zip([0, *(e[:-1] + 1).tolist()], (e + 1).tolist(), strict=True)) for e in ends]
        pairs = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        assert list(zip(g["link_a"].tolist(), g["link_b"].tolist(), strict=True)) == pairs
        # Components by spreading the least number.
        label = {("a", i): i for i in range(len(spans[0]))} | {("b", j): 1000 for j in range(len(spans[1]))}
        for _ in range(n):
            for i, j in pairs:
                label["a", i] = label["b", j] = min(label["a", i], label["b", j])
        names = sorted({label["a", i] for i in range(len(spans[0]))})
        assert g["of_a"].tolist() == [names.index(label["a", i]) for i in range(len(spans[0]))]
        assert g["of_b"].tolist() == [names.index(label["b", j]) for j in range(len(spans[1]))]


@pytest.mark.parametrize("block", [1, 700, alignment.BLOCK_BYTES])
def test_frames(documents, libraries, block):
    rows = [*enumerate(texts()[:60] + odd()), (3, "again"), (3, "again"), (None, "null id"), (200, "the the the the")]
    want = brute(libraries, rows)
    got = [tuple(r) for r in alignment.align(documents(*rows), A, B, public_tokenizers.PATTERN, block_bytes=block).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_digest_and_empty_table(documents, libraries):
    rows = [(1, "some words"), (2, None)]
    got = {r.doc_id: r for r in alignment.align(documents(*rows), A, B, digest=True).collect()}
    text = brute(libraries, rows)[0][-1]
    assert got[1].groups == hashlib.sha256(text.encode()).hexdigest() and got[2].groups == "" and got[2].n_links == 0
    assert alignment.align(documents((1, "x")).limit(0), A, B).collect() == []


def test_very_long_text(documents, libraries):
    text = "a few words that come again and again, \n" * 20000
    (row,) = alignment.align(documents((1, text)), A, B, digest=True).collect()
    a, b = libraries
    assert row.n_a == len(a.encode(" " + text, add_special_tokens=False).ids) and row.n_b == len(b.encode(text))
    assert row.n_links == row.n_a + row.n_b - row.n_groups
