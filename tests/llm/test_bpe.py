import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from chartloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def texts():
    rng = random.Random(8)
    parts = ["a", "b", "ing", " the", " ", "\n", "  ", "\t", "é", "ß", "中文", "😀", "'s", "'", "1", "２", "½", "\x00", "\x1c", "\x85", "\xa0", " ", "Z", "$$", "_", "×"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    return [*out, "ab" * 2000, "a" * 3000, "", " " * 500, "word " * 30000]


def test_same_as_library(reference):
    vocabulary, split = bpe.Vocabulary(bpe.load_ranks(PATH)), bpe.splitter(public_tokenizers.PATTERN)
    for text in texts():
        ids = vocabulary.encode(split(text))
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_small_tables(reference, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE", 3)
    vocabulary = bpe.Vocabulary(bpe.load_ranks(PATH))
    text = "several different words in a row, several words again"
    assert np.frombuffer(vocabulary.encode(regex.findall(public_tokenizers.PATTERN, text)), "<u4").tolist() == reference.encode_ordinary(text)


def test_frames(documents, spark, reference):
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    rows = [*enumerate(texts()[-40:]), (None, "null id"), (90, None), (3, "again")]
    got = tokenizer.decode(tokenizer.encode(documents(*rows))).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), reference.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got) == want
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in got) == sorted((str(i), (t or "").encode()) for i, t in rows)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert sorted(map(repr, tokenizer.round_trip(documents(*rows)).collect())) == sorted(map(repr, got))
    assert tokenizer.encode(documents((1, "x")).limit(0)).collect() == []
