import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from chartloom.llm import quality_lm
from chartloom.llm.texts import pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    three = collections.Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
    inside = {k + j for k in range(len(ws) - 2) if three[tuple(ws[k : k + 3])] > 1 for j in range(3)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def corpus():
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice("house thing étude water stone|").strip() + rng.choice(["", "s", "ing", "#"]) for _ in range(n))
    words = "house thing étude water stone river mountain".split()
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ing", "er"]) for _ in range(n))
    docs = [(i, "\n".join(prose(rng.randint(4, 30)) for _ in range(6)), "aa" if i % 2 else None) for i in range(80)]
    docs += [(100, "x#q$ %z&k <w>| " * 3 + " ".join("".join(rng.choice("#$%&xzqw") for _ in range(9)) for _ in range(90)), "aa")]
    docs += [(101, None, "aa"), (102, "", None), (103, "\n\n", "bb"), (104, "a b c\n\na b c\n \n a b c", "bb"), (None, prose(60), "aa"), (105, prose(9000), "aa"), (5, docs[5][1], "aa")]
    return docs


def test_counts(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, lang string, n_words double").repartition(3)
    rows = quality_lm.judge(frame).collect()
    names = [*quality_lm.BASE]
    assert sorted(repr((r.doc_id, *[r[c] for c in names])) for r in rows) == sorted(repr((i, *brute(t))) for i, t, _ in docs)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept <= (not r.base_failed)
    by_id = {r.doc_id: r for r in rows}
    assert not by_id[100].kept
    assert not by_id[100].base_failed
    fit = [r for r in rows if r.doc_id != 100 and not r.base_failed]
    assert len(fit) > 20
    assert np.mean([r.kept for r in fit]) > 0.97


def test_probabilities_sum_to_one_and_follow_counts(spark):
    docs = spark.createDataFrame([(1, "abab abc abd ab " * 3, "x"), (2, "zz zz zy", "y")], "doc_id long, text string, lang string")
    model = quality_lm.fit(docs)
    for before in (b"\0\0\0\0", b"\0\0ab", b"\0\0\0z", b"qqqq"):
        for lang in (0, 1):
            context = (lang << 32) | int.from_bytes(before, "big")
            grams = np.array([(context << 8) | b for b in range(256)], np.uint64)
            assert math.isclose(model.chance(grams).sum(), 1, abs_tol=1e-6)
    one = lambda lang, b: model.chance(np.array([(lang << 40) | b], np.uint64))[0]
    assert one(0, ord("a")) > one(0, ord("z"))
    assert one(1, ord("z")) > one(1, ord("a"))


def test_counts_of_grams_are_whole(spark):
    text = "aa ab aa"
    batch = pa.RecordBatch.from_arrays([pa.array([text, text])], ["text"])
    packed, owner, times, _, _ = quality_lm.word_grams(next(pieces(iter([batch]))), np.array([0, 0]))
    total = collections.Counter()
    for gram, k in zip(packed.tolist(), owner.tolist()):
        total[gram.to_bytes(5, "big").lstrip(b"\0")] += int(times[k])
    assert total == {b"a": 6, b"aa": 4, b"ab": 2, b"aa ": 4, b"ab ": 2}


def test_few_grams_are_kept_when_there_are_more(spark):
    docs = spark.createDataFrame([(1, "common common common rare words", "x")], "doc_id long, text string, lang string")
    model = quality_lm.fit(docs, grams=8)
    assert all(len(level.grams) <= 8 for level in model.levels)
    assert np.isclose(model.chance(np.arange(256, dtype=np.uint64)).sum(), 1)


def test_lines_and_words_that_differ_are_told_apart(spark, alike_words):
    one, two = alike_words
    docs = spark.createDataFrame([(1, f"{one}\n{two}\n{one}", "en"), (2, f"{one} x y {two} x y {one} x y", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.n_words, r.n_dup_lines, r.n_repeat_words) for r in quality_lm.measure(docs).collect()}
    assert got == {1: (3, 1, 0), 2: (9, 0, 6)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality_lm.judge(docs).collect() == []


def test_all_grams_are_scored_as_by_the_model_in_memory(spark):
    rows = [(i, t, lang) for i, t, lang in corpus() if i != 105] + [(200, " a  b\tc ", "aa"), (201, "\u00e9", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = quality_lm.fit(docs)
    number = {name: k for k, name in enumerate(model.languages)}
    want = []
    for i, text, lang in rows:
        whole = b"".join(w.lower().encode() + b" " for w in WORD.findall((text or "").replace("\u00c9", "\u00e9")))
        padded = b"\0" * 4 + whole
        grams = np.array([number[lang] << 40 | int.from_bytes(padded[k : k + 5], "big") for k in range(len(whole))], np.uint64)
        want.append((str(i), len(text or ""), -np.log(model.chance(grams)).mean() if len(grams) else None))
    got = {(str(r.doc_id), r.n_words, r.word_chars): r.log_perplexity for r in quality_lm.measure(docs).collect()}
    for (i, _, value), (_, text, _) in zip(want, rows):
        ws = WORD.findall(text or "")
        own = got[i, len(ws), sum(map(len, ws))]
        assert own is None and value is None or math.isclose(own, value, rel_tol=1e-9)


def test_grams_of_moved_documents_are_found_in_the_whole_table(tmp_path):
    spare = [tmp_path / "a.parquet", tmp_path / "b.parquet"]
    for k, path in enumerate(spare):
        pq.write_table(pa.table({"gram": pa.array([2 + k, 10 + k], pa.int64()), "loss": [0.2 + k, 0.1 + k]}), path)
    own = [(np.array([5, 7], np.uint64), np.array([0.5, 0.7]))]
    assert quality_lm._losses(np.array([2, 5, 11], np.uint64), own, str(tmp_path)).tolist() == [0.2, 0.5, 1.1]
    with pytest.raises(ValueError):
        quality_lm._losses(np.array([99], np.uint64), own, str(tmp_path))


def chains(rng, words, n):
    """Words of several kinds in turn; those of a kind begin and end alike."""
    return [rng.choice(words[k % len(words)]) for k in range(n)]


def test_shuffled_words_and_garbled_texts_go(spark):
    rng = random.Random(4)
    words = [[a + "".join(rng.choice("aeiou") for _ in range(3)) + b for _ in range(30)] for a, b in ("bc", "df", "gh", "jk", "lm")]
    docs = [(i, " ".join(chains(rng, words, rng.randint(150, 250))), "en") for i in range(150)]
    salad = chains(rng, words, 200)
    rng.shuffle(salad)
    docs += [(500, " ".join(salad), "en"), (501, " ".join(w + rng.choice(["%%%", "***", "$$$"]) for w in chains(rng, words, 200)), "en")]
    rows = {r.doc_id: r for r in quality_lm.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)).collect()}
    fair = [r for i, r in rows.items() if i < 500 and not r.base_failed]
    assert sum(r.kept for r in fair) > 0.95 * len(fair) > 0
    for i in (500, 501):
        assert rows[i].log_perplexity > max(r.log_perplexity for r in fair)
        assert rows[i].base_failed or not rows[i].kept
    assert not rows[501].base_failed
    assert not rows[500].base_failed
