"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the multiset of its byte 2-, 3- and 4-grams after lower-casing, with runs of anything but
letters as one space; each is hashed to one of ``BUCKETS`` embeddings. The mean embedding goes
through a linear softmax. Both are trained by stochastic gradient descent in numpy. Rows of the
training sample that the descent does not see calibrate the model: a temperature for the
probabilities, and the probability below which a prediction is rejected.

Fitting takes a bounded sample: about ``PER_LANGUAGE`` rows of each language, chosen by a hash of
the id, each as its n-gram counts (at most ``BUCKETS`` numbers whatever the length of the text).
Prediction takes every whole text. A null text or one without a letter is ``und`` with score 0 and
rejected. Ties go to the language first in alphabetical order. Repeated rows are predicted alike.
Without any labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.rows import texts
from chartloom.llm.texts import Piece, pieces

BUCKETS = 1 << 15
DIMENSIONS = 16
ORDERS = (2, 3, 4)
PER_LANGUAGE = 600
EPOCHS = 6
BATCH = 16
RATE = 0.5
# Share of the right predictions in calibration that rejection may cost, and the highest threshold.
LOSS = 0.001
THRESHOLD = 0.5

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.array([b if b >= 128 or 97 <= b < 123 else 32 for b in range(256)], np.uint8)


def _lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("text")
        lowered = pc.utf8_lower(pc.fill_null(batch.column(place).cast(pa.string()), ""))
        yield batch.set_column(place, "text", lowered)


def grams(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a piece, order by order, the row of each text's first one, and how many it has."""
    data = _FOLD[piece.data]
    begins = np.zeros(len(data), bool)
    begins[piece.offsets[:-1][np.diff(piece.offsets) > 0]] = True
    keep = (data != 32) | begins  # one space for a run, and one where a text begins with something else
    keep[1:] |= (data[1:] == 32) & (data[:-1] != 32)
    places = np.concatenate([[0], np.cumsum(keep)])[piece.offsets]
    data = data[keep].astype(np.uint32)
    n = len(data)
    out, counts = [], np.zeros(len(piece), np.int64)
    packed = data.copy()
    for order in range(2, max(ORDERS) + 1):
        packed = (packed[:-1] << np.uint32(8)) | data[order - 1 :] if n >= order else packed[:0]
        if order not in ORDERS:
            continue
        bucket = ((packed ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(17)
        inside = np.ones(len(bucket), bool)
        for k in range(1, order):
            cut = places[1:-1] - k
            inside[cut[(cut >= 0) & (cut < len(bucket))]] = False
        out.append(np.where(inside, bucket, BUCKETS).astype(np.int32))
        counts += np.maximum(np.diff(places) - order + 1, 0)
    return out, places, counts


@dataclass
class Model:
    """A logit of each language for each bucket: the embedding times the softmax weights."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, piece: Piece) -> np.ndarray:
        table = np.vstack([self.logits, np.zeros((1, len(self.languages)), np.float32)])
        orders, places, counts = grams(piece)
        total = np.zeros((len(piece), len(self.languages)))
        filled = np.flatnonzero(np.diff(places) > 0)
        for buckets in orders:
            values = table[np.concatenate([buckets, np.full(places[-1] - len(buckets), BUCKETS, np.int32)])]
            if len(filled):
                total[filled] += np.add.reduceat(values, places[filled], axis=0)
        return softmax((total / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(_lower(batches)):
        orders, places, _ = grams(piece)
        used, shares = [], []
        for k in range(len(piece)):
            own = np.concatenate([o[places[k] : places[k + 1]] for o in orders])
            bucket, count = np.unique(own[own < BUCKETS], return_counts=True)
            used.append(bucket.astype(np.int32))
            shares.append((count / max(count.sum(), 1)).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [piece.batch.column("id"), piece.batch.column("lang"), pa.array(used, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
            ["id", "lang", "buckets", "shares"],
        )


def train(languages: list[str], labels: np.ndarray, used: list[np.ndarray], shares: list[np.ndarray], seed: int = 7) -> Model:
    """Descent on four fifths of the rows, calibration on the rest; rows of one language weigh as much as those of another."""
    rng = np.random.default_rng(seed)
    n, classes = len(labels), len(languages)
    held = np.arange(n) % 5 == 4 if n >= 20 * classes else np.zeros(n, bool)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, classes)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    fit = np.flatnonzero(~held)
    worth = len(fit) / (classes * np.maximum(np.bincount(labels[fit], minlength=classes), 1))
    steps = EPOCHS * -(-len(fit) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            means = np.stack([shares[r] @ embedding[used[r]] for r in rows])
            error = softmax(means @ weights + bias).astype(np.float32)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= worth[labels[rows]][:, None].astype(np.float32)
            back = error @ weights.T
            weights -= rate * means.T @ error
            bias -= rate * error.sum(axis=0) / len(rows)
            for k, r in enumerate(rows):
                # The gradient of a mean is thin; embeddings take a larger step than the softmax.
                embedding[used[r]] -= (rate * 40) * shares[r][:, None] * back[k]
    check = np.flatnonzero(held) if held.any() else fit
    scores = np.stack([shares[r] @ embedding[used[r]] for r in check]) @ weights + bias
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(scores / t)[np.arange(len(check)), labels[check]] + 1e-12).mean() for t in grid]
    temperature = float(max(grid[int(np.argmin(loss))], 0.05))
    sure = softmax(scores / temperature)
    right = sure.argmax(axis=1) == labels[check]
    best = sure.max(axis=1)[right]
    threshold = float(min(THRESHOLD, np.quantile(best, LOSS))) if len(best) else 0.0
    return Model(languages, (embedding @ weights).astype(np.float32), bias, temperature, threshold)


def fit(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the labelled rows for which ``training`` holds; None if there are none."""
    labelled = docs.where(training & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(doc_id).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    sizes = dict(labelled.groupBy("lang").count().collect())  # one row a language
    if not sizes:
        return None
    chance = F.lit(0.0)
    for name, rows in sizes.items():
        chance = F.when(F.col("lang") == name, F.lit(min(1.0, per_language / rows))).otherwise(chance)
    place = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.where(place < chance).mapInArrow(_count, "id string, lang string, buckets array<int>, shares array<float>")
    table = sample.orderBy("id", "lang", F.size("buckets")).toArrow()
    languages = sorted(sizes)
    number = {name: k for k, name in enumerate(languages)}
    labels = np.array([number[x] for x in table.column("lang").to_pylist()])
    arrays = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in table.column(c)]
    if len(labels) == 0:
        return None
    return train(languages, labels, arrays("buckets"), arrays("shares"))


def _predictions(model: Model | None, piece: Piece) -> tuple[list[str], np.ndarray, np.ndarray]:
    letters = np.array([bool(_LETTER.search(piece.text(k).decode())) for k in range(len(piece))], bool)
    if model is None:
        return ["und"] * len(piece), np.zeros(len(piece)), np.ones(len(piece), bool)
    sure = model.probabilities(piece)
    best = sure.argmax(axis=1)
    names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
    score = np.where(letters, sure.max(axis=1), 0.0)
    return names, score, ~letters | (score < model.threshold)


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(_lower(batches)):
            names, score, rejected = _predictions(shared.value, piece)
            yield pa.RecordBatch.from_arrays(
                [piece.batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, all columns kept as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            bare = pa.RecordBatch.from_arrays([piece.batch.column(text)], ["text"])
            rejected = np.concatenate([_predictions(shared.value, p)[2] for p in pieces(_lower(iter([bare])))])
            yield piece.batch.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)


