import random
import re

import pytest

from chartloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items):
    wins = {}
    for i, t in items:
        ws = WORD.findall(low(t))
        for k in range(max(1, len(ws) - 12) if ws else 0):
            wins.setdefault(tuple(ws[k : k + 13]), set()).add(i)
    out = []
    for i, t in docs:
        ws = WORD.findall(low(t))
        hit, found = set(), set()
        for w, ids in wins.items():
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k : k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    found |= ids
        out.append((i, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    vocabulary = "Alpha beta été gamma 7 x中 delta's end".split()
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 13, 14, 30])))) for k in range(12)]
    items += [(20, items[3][1]), (21, None), (22, "!!!"), (23, "Überall")]
    docs = []
    for i in range(60):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            ws[3:3] = re.split(r"\s", rng.choice(items[:12])[1].upper().replace("É", "é").replace(" ", rng.choice(["  ", "\n", " -- "])))
        docs.append((i, rng.choice([" ", ", "]).join(ws)))
    docs += [(70, None), (71, ""), (72, "..."), (None, items[2][1]), (5, docs[5][1]), (73, "überall Überall"), (74, "a " * 30000 + items[4][1])]
    return docs, items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_same_as_brute_force(documents, spark, block):
    docs, items = corpus()
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(documents(*docs), tests, block_bytes=block).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=repr)
    assert got == brute(docs, items)
    assert sum(g[2] > 0 for g in got) > 10
    texts = dict(docs)
    for r in rows:
        marked = [w for s in r.spans for w in WORD.findall(low((texts[r.doc_id] or "")[s.start : s.end]))]
        assert len(marked) == r.n_hit


def test_long_items_are_cut_without_losing_windows(documents, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", 3)
    docs, items = corpus()
    rng = random.Random(7)
    items += [(90 + n, " ".join(f"w{rng.randint(0, 9)}" for _ in range(n))) for n in range(12, 21)] + [(99, "Z" * 300_000)]
    docs += [(100 + n, f"x {items[-5][1][n:]} y") for n in range(0, 12, 3)] + [(120, "a " + "z" * 300_000)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(documents(*docs), tests, block_bytes=200).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=repr) == brute(docs, items)


def test_blocks_are_bounded(spark):
    items = [(k, f"{'word ' * (k % 40)}end{k}") for k in range(500)] + [(1, "again")] * 300 + [(2, None), (None, "a b")]
    path = decontaminate.item_blocks(spark.createDataFrame(items, "item_id long, text string"), block_bytes=1_000)
    rows = spark.read.parquet(path).collect()
    sizes = {}
    for r in rows:
        sizes[r.part, r.block] = sizes.get((r.part, r.block), 0) + len(r.text)
    assert sorted((r.id, r.text) for r in rows) == sorted({(i, t) for i, t in items if t and i is not None})
    assert len(sizes) > 10 and max(sizes.values()) < 1_000 + 210


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_clean_documents_stay(documents, spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (*decontaminate.item_blocks.__defaults__[:-1], block))
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 1)
    docs, items = corpus()
    frame = documents(*docs)
    kept = decontaminate.clean(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.schema == frame.schema
    want = [i for i, n, hit, _ in brute(docs, items) if not (hit and 20 * hit >= n)]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(documents((1, "a b")), none).first().n_hit == 0
    assert decontaminate.find(documents((1, "x")).limit(0), none).collect() == []
