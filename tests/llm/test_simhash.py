"""Against plain Python: bit by bit, and all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from chartloom.llm import simhash


def plain(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    size = min(size, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + size]).encode(), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, linked):
    low = list(range(len(nodes)))
    for _ in nodes:
        for i in range(len(nodes)):
            for j in range(i):
                if linked(nodes[i], nodes[j]):
                    low[i] = low[j] = min(low[i], low[j])
    return low


def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["É", "Ab", "aB", "中"]
    out = [None, "", " \t\n", "one", "one two", "One TWO", "one two three", "a b c a b c a b c", "x\x00y z\x85w"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(rng.choice([" ", "\n", "  "]).join(copy))
    return out


def test_fingerprints():
    for text in [*texts(), "word " * 70000 + "end"]:
        assert simhash.fingerprint((text or "").encode()) == plain(text)


def test_bit_of_exactly_half_is_zero():
    text = "a b c d"
    h = [xxhash.xxh64_intdigest(x, 42) for x in (b"a b c", b"b c d")]
    assert simhash.fingerprint(text.encode()) == h[0] & h[1]


def test_same_as_spark_hash(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] % (1 << 64) == plain("one two three")


def near(rng, n, bits):
    """Fingerprints around a few centres."""
    centres = rng.integers(0, 1 << 64, 4, dtype=np.uint64, endpoint=False)
    out = set()
    while len(out) < n:
        x = int(rng.choice(centres))
        for b in rng.integers(0, 64, int(rng.integers(0, bits + 1))).tolist():
            x ^= 1 << b
        out.add(x)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("bits", [1, 3, 5])
def test_no_near_pair_is_dealt_apart(bits):
    rng = np.random.default_rng(bits)
    fp = near(rng, 120, 6)
    found = simhash.routes(fp, bits)
    table = simhash.distances(fp, simhash.pivots())
    row, cell = simhash.cells(table, bits, 4)
    of = [set(cell[row == k].tolist()) for k in range(len(fp))]
    for i in range(len(fp)):
        for j in range(i):
            if int(np.bitwise_count(fp[i] ^ fp[j])) <= bits:
                assert (found[i] == found[j]).any() and of[i] & of[j]
                assert np.abs(table[i] - table[j]).max() <= bits


@pytest.mark.parametrize("step", [1, 50, 1 << 17])
def test_linked_in_one_cell(step):
    fp = near(np.random.default_rng(9), 150, 5)
    low = simhash.linked(fp, simhash.distances(fp, simhash.pivots()), 3, step)
    assert low.tolist() == components(fp.tolist(), lambda x, y: (x ^ y).bit_count() <= 3)


@pytest.mark.parametrize("crowd", [1, 3, simhash.CROWD])
def test_frames(documents, spark, crowd):
    rows = [*enumerate(texts(), 10), (7, "one"), (7, "one"), (None, "null id alone here")]
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.link(documents(*rows), crowd=crowd).collect()), key=repr)
    prints = [plain(t) for _, t in rows]
    low = components(prints, lambda x, y: (x ^ y).bit_count() <= 3)
    ids = [i if i is not None else 1 << 70 for i, _ in rows]
    least = {c: min(ids[k] for k in range(len(rows)) if low[k] == c) for c in low}
    want = [(i, prints[k], least[low[k]] if least[low[k]] < 1 << 70 else None) for k, (i, _) in enumerate(rows)]
    assert got == sorted(want, key=repr)
    assert len({c for _, _, c in got}) < len(rows)


@pytest.mark.parametrize("crowd", [2, 40])
def test_crowded_buckets_lose_no_link(spark, crowd):
    fp = near(np.random.default_rng(2), 400, 4)
    frame = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long").repartition(3)
    got = {r.fp % (1 << 64): r.component for r in simhash.groups(frame, 3, crowd).collect()}
    low = components(fp.tolist(), lambda x, y: (x ^ y).bit_count() <= 3)
    for i in range(len(fp)):
        alone = low.count(low[i]) == 1
        assert (int(fp[i]) not in got) == alone
        if not alone:
            assert all((got[int(fp[i])] == got.get(int(fp[j]))) == (low[i] == low[j]) for j in range(len(fp)))


def test_empty_table(documents):
    assert simhash.link(documents((1, "x")).limit(0)).collect() == []
