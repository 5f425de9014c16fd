"""Centroid clustering of integer vectors with an incremental distance matrix.

Each vector keeps its exact dot products with all centroids. In a round only the centroids change, in some components; the
products are corrected by those changes times the vector's components, and unchanged centroids cost nothing. The squared
distance is the vector's norm, less twice the product, plus the centroid's norm, and the nearest centroid is its argmin. The
matrix is a table in the shared folder, written once a round, so that a lost executor costs no earlier round.

All numbers are integers: vectors are quantised to ``floor(scale * x)``, centroids are floors of exact means. Sums over vectors
are decimals, so their number does not matter; only centroids (``k`` times the dimension) pass through the driver.

Vectors that are null, have another dimension, or a null or non-finite component are left out. A component beyond 2**27 (for 64 of
them) is an error, since squared distances would no longer be exact numbers of 64 bits. A null id is the empty text in the seed. Repeated rows count as
often as they are there. With fewer vectors than centroids each vector begins one; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import written

_TABLE = "vec_id long, vector array<int>, norm long, products array<long>, cluster int, distance long"


def quantised(vectors: DataFrame, dimension: int, scale: float, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector``: the vectors that are whole, as integers."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    whole = (F.size(x) == dimension) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    kept = vectors.where(whole).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("vector")
    )
    wide = F.exists("vector", lambda c: ~c.between(-_largest(dimension), _largest(dimension)))
    error = F.raise_error(F.lit("a component is too large for exact squared distances"))
    return kept.select("vec_id", F.when(wide, error).otherwise(F.col("vector")).cast("array<int>").alias("vector"))


def _largest(dimension: int) -> int:
    """Components up to this size keep squared distances below 2**62."""
    return min(isqrt((1 << 60) // max(dimension, 1)), (1 << 31) - 1)


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the least SHA-256 of seed and id; rows of one id by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    picked = kept.select(F.sha2(name, 256).alias("name"), "vector").orderBy("name", "vector").limit(k).collect()
    return np.array([r.vector for r in sorted(picked)], np.int64)


def _matrix(column: pa.ListArray, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _moved(before: np.ndarray, after: np.ndarray):
    """The matrix after centroids moved: products corrected by what changed, and the nearest centroid of each vector."""
    changes = []
    for j, step in enumerate(after - before):
        at = np.flatnonzero(step)
        if len(at):
            changes.append((j, at, step[at]))
    k, width = after.shape
    norms = (after * after).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), width)
            if "products" in batch.schema.names:
                norm, products = batch.column("norm").to_numpy(), _matrix(batch.column("products"), k).copy()
            else:
                norm, products = (vectors * vectors).sum(axis=1), np.zeros((len(vectors), k), np.int64)
            for j, at, step in changes:
                products[:, j] += vectors[:, at] @ step
            distance = norm[:, None] - 2 * products + norms[None, :]
            nearest = distance.argmin(axis=1)  # of equal ones the smallest number
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("vector"),
                    pa.array(norm),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * k), pa.array(products.ravel())),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distance[np.arange(len(vectors)), nearest]),
                ],
                [c.split()[0] for c in _TABLE.split(", ")],
            )

    return run


def _sums(width: int):
    """Sums of the vectors of each cluster in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cluster = _matrix(batch.column("vector"), width), batch.column("cluster").to_numpy()
            here, n = np.unique(cluster, return_counts=True)
            sums = [vectors[cluster == c].sum(axis=0) for c in here]
            yield pa.RecordBatch.from_arrays(
                [pa.array(here, pa.int32()), pa.array(n, pa.int64()), pa.array([s.tolist() for s in sums], pa.list_(pa.int64()))], ["cluster", "n", "sums"]
            )

    return run


def _means(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the exact means of each cluster's vectors; a cluster without vectors keeps its centroid."""
    parts = table.select("cluster", "vector").mapInArrow(_sums(centroids.shape[1]), "cluster int, n long, sums array<long>")
    exact = "decimal(38,0)"
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("j", "part"))
        .groupBy("cluster", "j")
        .agg(F.sum(F.col("part").cast(exact)).alias("total"), F.sum(F.col("n").cast(exact)).alias("n"))
    )
    after = centroids.copy()
    for r in totals.collect():  # a row for each component of each centroid
        after[r.cluster, r.j] = int(r.total) // int(r.n)
    return after


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dimension: int = 64,
    scale: float = 64.0,
    seed: str = "1",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, vector, cluster, distance, centroid, cluster_inertia, inertia`` of every vector that is kept.

    Vectors are assigned and centroids replaced ``rounds`` times, then vectors are assigned once more; ``centroid`` is the final
    one, ``distance`` is squared, and the inertias are its sums over the cluster and over all vectors.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors, dimension, scale, vec_id, embedding)
    after = first_centroids(kept, k, seed)
    out = "vec_id long, vector array<int>, cluster int, distance long, centroid array<int>, cluster_inertia long, inertia long"
    if not len(after):
        return spark.createDataFrame([], out)
    table, before = kept, np.zeros_like(after)
    for step in range(rounds + 1):
        table = written(table.mapInArrow(_moved(before, after), _TABLE), "distance-matrix")
        if step < rounds:
            before, after = after, _means(table, after)
    spread = table.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row for each centroid
    total = sum(int(r.s) for r in spread)
    rows = [(r.cluster, after[r.cluster].tolist(), int(r.s), total) for r in spread]
    ends = spark.createDataFrame(rows, "cluster int, centroid array<int>, cluster_inertia long, inertia long")
    return table.select("vec_id", "vector", "cluster", "distance").join(F.broadcast(ends), "cluster").select(*[c.split()[0] for c in out.split(", ")])
