import random

import numpy as np
import pytest

from chartloom.llm import suffix_dedup


def brute(docs, keep):
    rank = lambda i: float("inf") if i is None else i
    texts = sorted([(i, (t or "").encode()) for i, t in docs], key=lambda r: rank(r[0]))
    seen = {}
    for k, (_, b) in enumerate(texts):
        for j in range(len(b) - 199):
            seen.setdefault(b[j : j + 200], []).append((k, j))
    out = []
    for k, (i, b) in enumerate(texts):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 199):
            places = seen[b[j : j + 200]]
            if len(places) > 1 and (keep == "none" or places[0] != (k, j)):
                gone[j : j + 200] = True
        spans = sum(bool(gone[j]) and (j == 0 or not gone[j - 1]) for j in range(len(b)))
        out.append((i, len(b), int(gone.sum()), spans, b"".join(bytes([x]) for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    passages = [prose(n) for n in (180, 199, 200, 201, 260, 700)]
    docs = []
    for i in range(50):
        text = prose(rng.randint(0, 400))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        docs.append((i, text))
    base = prose(1500)
    for i in range(50, 62):
        at = rng.randint(0, 1499)
        docs.append((i, base[:at] + "#" + base[at + 1 :]))
    docs += [(70, "a" * 900), (71, "ab" * 300), (72, "b" * 230), (73, None), (74, ""), (None, docs[9][1] + "!"), (75, docs[3][1]), (76, prose(40000) + passages[-1])]
    return docs


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 4])
def test_same_as_brute_force(documents, keep, crowd):
    docs = corpus(3)
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in suffix_dedup.remove_copies(documents(*docs), keep, crowd=crowd).collect()), key=repr)
    want = brute(docs, keep)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert got == want
    assert sum(g[2] for g in got) > 1000


@pytest.mark.parametrize("keep", ["none", "first"])
def test_crowded_windows_that_are_sorted_apart(documents, keep):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = prose(230)
    docs = [(i, prose(60) + passage + prose(60)) for i in range(60)]
    found = suffix_dedup.remove_copies(documents(*docs), keep, crowd=4, sorted_bytes=0).collect()
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in found), key=repr)
    assert got == brute(docs, keep)


def test_repeated_rows(documents):
    text = "".join(random.Random(5).choice("abcdefgh ") for _ in range(500))
    rows = suffix_dedup.remove_copies(documents((1, text), (1, text), (2, "x")), "none").collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in rows) == [(1, 500, 1), (1, 500, 1), (2, 0, 0)]


def test_previous_factors():
    rng = random.Random(1)
    for _ in range(30):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 40)))
        order = sorted(range(len(text)), key=lambda k: text[k:])
        shared = lambda a, b: next((k for k in range(len(text)) if a + k >= len(text) or b + k >= len(text) or text[a + k] != text[b + k]), len(text))
        common = np.array([0] + [shared(a, b) for a, b in zip(order, order[1:])])
        got = suffix_dedup.previous_factors(np.array(order), common)
        want = [max((shared(i, j) for j in range(i)), default=0) for i in order]
        assert got.tolist() == want


def test_empty_table(documents):
    assert suffix_dedup.remove_copies(documents((1, "x")).limit(0)).collect() == []


def test_suffix_order():
    """Texts of one batch: whole suffixes, equal ones by place, with the prefixes that neighbours share."""
    rng = random.Random(4)
    for turn in range(60):
        texts = [bytes(rng.choice(b"\0a\xff") if turn % 2 else rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        texts += [texts[0], b"a" * rng.randint(1, 90)]
        sizes = np.array([rng.randint(1, len(t)) for t in texts])
        suffixes = [t[k:] for t, size in zip(texts, sizes) for k in range(size)]
        place = np.array(rng.sample(range(len(suffixes)), len(suffixes)))
        order, common = suffix_dedup.suffix_order(texts, sizes, place)
        want = sorted(range(len(suffixes)), key=lambda k: (suffixes[k], place[k]))
        assert order.tolist() == want
        shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common.tolist() == [0] + [shared(suffixes[a], suffixes[b]) for a, b in zip(want, want[1:])]
