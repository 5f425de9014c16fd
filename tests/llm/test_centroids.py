"""Against plain Python with numbers of any size."""

import hashlib
import math
import random

import numpy as np
import pytest

from chartloom.llm import centroids


def plain(rows, k, rounds, dimension, scale):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dimension and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(scale * c) for c in x]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [list(v) for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
        return [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, of, strict=True) if c == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    of = assign()
    total = sum(d for d, _ in of)
    return [(i, v, c, d, centres[c], sum(x for x, y in of if y == c), total) for (i, v), (d, c) in zip(kept, of, strict=True)]


def frame(spark, rows):
    data = [(x, i, "c", [1.5]) for i, x in rows]
    return spark.createDataFrame(data, "embedding array<float>, vec_id long, cluster string, products array<double>").repartition(3)


def compared(spark, rows, k=4, rounds=3, dimension=3, scale=64.0):
    got = [tuple(r) for r in centroids.cluster(frame(spark, rows), k, rounds, dimension, scale).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows, k, rounds, dimension, scale)))
    return got


def single(x):
    return float(np.float32(x))


def test_rounds(spark):
    rng = random.Random(1)
    rows = [(i, [single(rng.gauss(i % 5 - 2, 0.3)) for _ in range(3)]) for i in range(200)]
    for rounds in (0, 1, 3):
        compared(spark, rows, rounds=rounds)


def test_odd_rows(spark):
    good = [(i, [0.25 * i, -0.5, 1.0]) for i in range(8)]
    bad = [(50, None), (51, []), (52, [1.0, 2.0]), (53, [1.0] * 4), (54, [1.0, None, 2.0]), (55, [1.0, math.nan, 2.0]), (56, [1.0, math.inf, 2.0])]
    got = compared(spark, [*good, *bad, (3, [9.0, 9.0, 9.0]), (3, [9.0, 9.0, 9.0]), (None, [0.0, 0.0, 0.0])])
    assert len(got) == 11


def test_ties_and_empty_clusters(spark):
    compared(spark, [(i, [1.0, 1.0, 1.0]) for i in range(30)])
    compared(spark, [(i, [float(i % 2), 0.0, 0.0]) for i in range(30)])


def test_fewer_vectors_than_centroids(spark):
    assert len(compared(spark, [(1, [1.0, 2.0, 3.0]), (2, [-1.0, 2.0, 3.0])], k=16)) == 2


def test_no_vector(spark):
    assert centroids.cluster(frame(spark, [(1, None)]), 4, 3, 3).collect() == []
    assert centroids.cluster(frame(spark, [(1, [1.0])]).limit(0), 4, 3, 3).collect() == []


def test_large_components(spark):
    rng = random.Random(4)
    rows = [(i, [single(rng.uniform(-8e6, 8e6)) for _ in range(3)]) for i in range(40)]
    compared(spark, rows)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(frame(spark, [*rows, (99, [1e30, 0.0, 0.0])]), 4, 3, 3).collect()


def test_only_changes_are_applied():
    before, after = np.zeros((2, 3), np.int64), np.array([[0, 0, 0], [0, 5, 0]])
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([[1, 2, 3]], pa.list_(pa.int32()))], ["vec_id", "vector"])
    (out,) = centroids._moved(before, after)(iter([batch]))
    assert out.column("products").to_pylist() == [[0, 10]]
    (out,) = centroids._moved(after, after)(iter([out]))
    assert out.column("products").to_pylist() == [[0, 10]] and out.column("distance").to_pylist() == [14]
