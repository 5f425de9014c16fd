import random
import re

import numpy as np
import pyarrow as pa
import pytest

from chartloom.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} or ({tuple(ws)} if ws else set())


def brute(docs, size, percent):
    rank = lambda i: jj.LAST_ID if i is None else i
    sets = [shingles(t, size) for _, t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, docs):
        least[g] = min(least.get(g, jj.LAST_ID), rank(i))
    return sorted(((i, len(s), None if least[g] == jj.LAST_ID else least[g]) for (i, _), s, g in zip(docs, sets, group)), key=repr)


def corpus(seed, percent):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(60)]
    docs = []
    for base in range(14):
        ws = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 20, 60, 150, 400, 900]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(ws)
            for _ in range(rng.randint(0, max(1, len(ws) * (100 - percent) // 400))):
                copy[rng.randrange(len(copy))] = rng.choice([*vocabulary, f"new{rng.random()}"])
            docs.append((len(docs) * 3 % 97 + base, " ".join(copy)))
            if rng.random() < 0.4:
                ws = copy  # a chain of small changes
    docs += [(500, None), (501, ""), (502, " \n"), (503, "One"), (504, "one"), (505, "one two"), (None, docs[3][1]), (None, "lonely text of its own"), docs[5], (docs[5][0], "other text under an old id")]
    return docs


@pytest.mark.parametrize(("seed", "percent", "crowd"), [(1, 90, 1000), (2, 80, 1000), (3, 90, 3), (4, 80, 3)])
def test_same_as_brute_force(documents, seed, percent, crowd):
    docs = corpus(seed, percent)
    got = sorted((tuple(r) for r in jj.link(documents(*docs), 3, percent, crowd=crowd).collect()), key=repr)
    assert got == brute(docs, 3, percent)


def test_similar_sets_share_a_part():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 1500))
        t = rng.choice([0.8, 0.9])
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut = int(rng.integers(0, n * (1 - t) + 1))
        more = int(rng.integers(0, max(1, n * (1 - t) - cut) + 1))
        other = np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, more).astype(np.uint64)]))
        base = np.unique(base)
        if jj.similar(base, other, (int(t * 100), 100)):
            assert np.intersect1d(jj.signatures(base, t), jj.signatures(other, t)).size
            assert np.minimum(jj.counts(base), jj.counts(other)).sum() >= jj.needed(len(base), len(other), t)


def test_representatives(documents):
    text = " ".join(f"word{k}" for k in range(100))
    docs = documents((5, text), (3, text + " end"), (3, text + " end"), (9, "else"), (10, None), (10, None))
    rows = jj.representatives(docs, 5, 80).collect()
    assert sorted((r.doc_id, r.version) for r in rows) == [(3, "x"), (9, "x"), (10, "x"), (10, "x")]


def test_empty_table(documents):
    assert jj.link(documents((1, "x")).limit(0), 3, 90).collect() == []


def test_buckets_over_batches(monkeypatch):
    """Groups that go over several batches, some beyond the limit: every pair of names with one part stays connected."""
    rng = np.random.default_rng(1)
    for limit in (2, 5, 100):
        monkeypatch.setattr(jj, "BUCKET", limit)
        rows = np.unique(rng.integers(0, [12, 60], (150, 2)), axis=0)
        cuts = np.sort(rng.integers(0, len(rows), 6))
        batches = [pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["part", "name"]) for x in np.split(rows, cuts) if len(x)]
        out = [r for b in jj._buckets(iter(batches)) for r in b.to_pylist()]
        held = {}
        for r in out:
            if r["bucket"] is not None:
                held.setdefault(r["bucket"], set()).add(r["name"])
        stars = {(r["name"], r["low"]) for r in out if r["bucket"] is None}
        for part in range(12):
            names = set(rows[rows[:, 0] == part, 1].tolist())
            if 1 < len(names) <= limit:
                assert names in held.values() or all((n, min(names)) in stars for n in names - {min(names)})
            elif len(names) > limit:
                assert all((n, min(names)) in stars for n in names - {min(names)})


def test_words_that_differ_are_told_apart(documents, alike_words):
    docs = [*enumerate(alike_words), (5, alike_words[0]), (6, "a b c"), (7, f"{alike_words[1]} x y"), (8, f"{alike_words[0]} x y")]
    got = jj.link(documents(*docs), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(docs, 3, 90)


def test_sets_that_would_share_a_name(documents):
    """Names of five bits, which many different sets have."""
    docs = corpus(6, 90)
    got = jj.link(documents(*docs), 3, 90, bits=5).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, 3, 90)


def test_helper_names_of_the_table(documents):
    text = " ".join(f"word{k}" for k in range(100))
    docs = documents((5, text), (3, text + " end"), (9, "else")).selectExpr("*", "'a' AS __id", "'b' AS __VERSION")
    rows = jj.representatives(docs, 5, 80).collect()
    assert sorted((r.doc_id, r["__id"], r["__VERSION"]) for r in rows) == [(3, "a", "b"), (9, "a", "b")]


def test_blocks_give_all_parts_in_order(monkeypatch):
    """Blocks of several tasks, too many to sort at once, one part of very many sets: nothing is lost, parts come in order."""
    monkeypatch.setattr(jj, "BLOCK_PARTS", 50)
    monkeypatch.setattr(jj.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 7})()))
    rng = np.random.default_rng(5)
    blocks, want, rows = jj._Blocks(), [], []
    for k in range(300):
        parts = np.unique(np.append(rng.integers(0, 1 << 63, 4), 12345 << 30).astype(np.uint64))
        if blocks.full():
            rows.append(blocks.rows())
        number = blocks.add(parts)
        want += [(int(p) >> 20, number) for p in parts]
    rows.append(blocks.rows())
    assert len(rows) > 20 and len({n for _, n in want}) == 300 and all(n >> 40 == 7 for _, n in want)
    table = pa.concat_tables([pa.table(r) for r in rows]).sort_by("route")
    assert all(len(b) % 6 == 0 for b in table.column("block").to_pylist())
    got = [(r["part"], r["name"]) for b in jj._unpacked(iter(table.to_batches(max_chunksize=9))) for r in b.to_pylist()]
    assert sorted(got) == sorted(want)
    assert [p for p, _ in got] == sorted(p for p, _ in want)


def test_texts_are_not_shuffled(spark, documents, monkeypatch):
    """Of texts without a copy, neither the join nor the choice of representatives writes any to a shuffle."""
    seen = []
    monkeypatch.setattr(jj, "written", lambda df, label, keep=jj.written: seen.append((label, df)) or keep(df, label))
    rng = random.Random(8)
    alone = [(k, " ".join(f"w{rng.random()}" for _ in range(40))) for k in range(300)]
    docs = documents(*alone, (900, alone[0][1]), (901, alone[1][1] + " end"))
    kept = jj.representatives(docs, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    texts = [label for label, df in seen if "text" in df.columns]
    assert not texts
    plan = dict(seen)["cluster-sets"]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan[plan.index("Exchange") :]
    known = jj.members(spark.createDataFrame([(1, 5), (2, 6)], "id long, version long"), ["id", "version"])
    rows = spark.createDataFrame([(k, k + 4) for k in range(20_000)], "id long, version long").coalesce(1)
    found = rows.mapInArrow(jj._found(known), rows.schema).collect()
    assert {(1, 5), (2, 6)} <= {tuple(r) for r in found} and len(found) < 200
    assert rows.mapInArrow(jj._found(known, False), rows.schema).count() == 20_000 - len(found)
