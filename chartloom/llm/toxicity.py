"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer maps each word to a class: insult, threat, target, negation, report or other. The
insults are learned: words and word beginnings that labelled toxic texts have and others have not, each
weighted by its log odds; a short list of common ones counts with the least such weight where labels say nothing of them. Three more transducers rewrite the classes of a clause from left to right: an
insult or threat within ``SCOPE`` words after a negation is negated, one after a word of reporting in the
same clause is reported, one in a clause that has named a target before is aimed. They are composed
into one machine once, whose arcs carry the weights of what they let pass. A clause is worth what its
matches weigh, so a word alone decides nothing that its clause takes back. A logistic
curve over the sum and the largest of a text's clauses, fitted to texts that the lexicon was not
learned from, gives the score.

Fitting takes a bounded sample of the labelled rows, about ``PER_LABEL`` for each label, by a hash of
the id. Scoring reads whole texts. Null, empty and wordless texts have no matches and get the score
of that. Without labels of both kinds every score is 0. Several labels of one id count as the largest; rows with one id
are scored each by its own text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.rows import texts

PER_LABEL = 5000
SHORTEST, LONGEST = 4, 7  # letters of a word beginning
TIMES = 4  # texts that an entry must be in to be looked at
ODDS = 3.0  # log odds from which an entry is an insult
SURE, CERTAIN = 1.645, 2.0  # standard errors below the log odds, and what is left must reach this
LEARN = 0.7  # share of the sample for the lexicon; the rest fits the curve
SCOPE = 3
NEGATED, REPORTED, AIMED = 0.5, 0.7, 1.2
THREAT_WEIGHT = 1.5

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]+")

# Fixed lists, in English, German, French and Spanish.
THREATS = frozenset("kill destroy hurt burn beat crush töten vernichten verbrennen tuer détruire brûler matar destruir quemar".split())
TARGETS = frozenset("you your yours yourself du dich dir dein ihr euch tu te toi ton vous votre tú ti tuyo usted vosotros".split())
NEGATIONS = frozenset("not no never neither without nicht kein keine nie ohne pas jamais sans aucun nunca sin ningún jamás".split())
INSULTS = frozenset(
    "dumb fool jerk coward "
    "dumm blödmann trottel abschaum arschloch idiotin versager feigling "
    "imbécile crétin débile ordure connard minable salaud "
    "idiota estúpido imbécil escoria basura cobarde patético".split()
)
REPORTS = frozenset("said says called quoted claimed wrote sagte sagt nannte schrieb behauptete dit appelé écrit affirmé dijo dice llamó escribió".split())


class Transducer:
    """Arcs from a state and a symbol to a state, a symbol and a weight; a symbol without an arc passes and leads to ``other``."""

    def __init__(self, arcs: dict, other: dict | None = None, start=0):
        self.arcs, self.other, self.start = arcs, other or {}, start

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.other.get(state, state), symbol, 1.0)


def compose(first: Transducer, second: Transducer, alphabet: Iterable[str]) -> Transducer:
    """The machine that gives the output of the first to the second, over the states that can be reached."""
    arcs, start = {}, (first.start, second.start)
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            to, middle, weight = first.step(state[0], symbol)
            to2, out, weight2 = second.step(state[1], middle)
            arcs[state, symbol] = ((to, to2), out, weight * weight2)
            if (to, to2) not in seen:
                seen.add((to, to2))
                todo.append((to, to2))
    return Transducer(arcs, start=start)


def grammar() -> Transducer:
    """Negation, report and target, composed; matches keep their symbol and take a weight."""
    negation = Transducer(
        {(k, s): (1, s, 1.0) for k in range(SCOPE + 1) for s in "N"}
        | {(k, s): ((k + 1) % (SCOPE + 1), s, NEGATED) for k in range(1, SCOPE + 1) for s in "IH"},
        {k: (k + 1) % (SCOPE + 1) for k in range(1, SCOPE + 1)},
    )
    report = Transducer({(k, "R"): (1, "R", 1.0) for k in (0, 1)} | {(1, s): (1, s, REPORTED) for s in "IH"})
    target = Transducer({(k, "T"): (1, "T", 1.0) for k in (0, 1)} | {(1, s): (1, s, AIMED) for s in "IH"})
    return compose(compose(negation, report, "IHTNRO"), target, "IHTNRO")


@dataclass
class Model:
    """The learned part of the lexical transducer, and the curve."""

    whole: dict[str, float]
    begins: dict[str, float]
    curve: np.ndarray | None = None
    machine: Transducer = field(default_factory=grammar)
    known: dict[str, float] = field(default_factory=dict)

    def insult(self, word: str) -> float:
        weight = self.known.get(word)
        if weight is None:
            weight = self.whole.get(word)
            for k in range(LONGEST, SHORTEST - 1, -1):
                if weight is not None:
                    break
                weight = self.begins.get(word[:k]) if len(word) >= k else None
            if weight is None and word in INSULTS:
                weight = ODDS
            if len(self.known) > 300_000:
                self.known.clear()
            weight = self.known[word] = weight or 0.0
        return weight

    def classify(self, word: str) -> tuple[str, float]:
        if weight := self.insult(word):
            return "I", weight
        for symbol, words in (("H", THREATS), ("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            if word in words:
                return symbol, THREAT_WEIGHT if symbol == "H" else 0.0
        return "O", 0.0

    def clause(self, words: list[str]) -> float:
        """What the matches of a clause weigh."""
        state, total = self.machine.start, 0.0
        for word in words:
            symbol, weight = self.classify(word)
            state, out, factor = self.machine.step(state, symbol)
            if out in "IH":
                total += weight * factor
        return total

    def features(self, text: str) -> tuple[float, float]:
        """Logarithms of the sum and the largest of the clauses; clauses without an insult or a threat aimed at anybody are worth nothing."""
        lowered = text.lower()
        insult = self.insult
        found = {w for w in set(_WORD.findall(lowered)) if insult(w) or w in THREATS}
        if not found:
            return 0.0, 0.0
        worth = []
        for part in _CLAUSE.split(lowered):
            words = _WORD.findall(part)
            if not found.isdisjoint(words) and (any(insult(w) for w in words) or not TARGETS.isdisjoint(words)):
                worth.append(self.clause(words))
        return (math.log1p(sum(worth)), math.log1p(max(worth))) if worth else (0.0, 0.0)

    def score(self, text: str) -> float:
        if self.curve is None:
            return 0.0
        return float(1 / (1 + math.exp(-float(np.clip(np.dot(self.curve, [1.0, *self.features(text)]), -40, 40)))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Weighted logistic regression by Newton's steps, with a small penalty on all but the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([0.01] + [ridge] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, and beginnings of words with a star, of each text once."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            entries, labels = [], []
            for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                own = words | {w[:k] + "*" for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}
                entries += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(labels, pa.int64())], ["entry", "toxic"])


def lexicon(rows: list[tuple[str, int, int]], toxic: int, other: int) -> Model:
    """Entries (with their numbers of toxic and of all texts) that mark toxic texts; beginnings that add nothing to a shorter one are left out."""
    odds = {e: math.log((p + 0.5) / (toxic + 1)) - math.log((n - p + 0.5) / (other + 1)) for e, p, n in rows}
    begins: dict[str, float] = {}
    whole: dict[str, float] = {}

    def above(entry: str) -> float | None:
        return next((begins[entry[:k]] for k in range(min(len(entry), LONGEST), SHORTEST - 1, -1) if entry[:k] in begins), None)

    for entry in sorted(odds, key=lambda e: (not e.endswith("*"), len(e), e)):
        name = entry.removesuffix("*")
        before = above(name)
        if before:
            if odds[entry] < ODDS / 2:
                (begins if entry.endswith("*") else whole)[name] = 0.0  # an exception below an insulting beginning
        elif odds[entry] >= ODDS:
            (begins if entry.endswith("*") else whole)[name] = odds[entry]
    return Model(whole, begins)


def sample(docs: DataFrame, labels: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", per_label: int = PER_LABEL) -> DataFrame | None:
    """``text, toxic, weight, learn`` of the chosen labelled rows; None if a label is missing."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("long").alias("toxic"))
    marked = marked.withColumn("doc_id", F.col("id")).where(training)
    sizes = dict(marked.groupBy("toxic").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return None
    chance = F.when(F.col("toxic") == 1, F.lit(min(1.0, per_label / sizes[1]))).otherwise(F.lit(min(1.0, per_label / sizes[0])))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = marked.where(place < chance).select("id", "toxic", (1 / chance).alias("weight"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) < int(LEARN * 1000)).alias("learn"))
    body = texts(docs, doc_id, text).withColumnRenamed("doc_id", "id")
    # About 2 * per_label narrow rows, whatever the size of the tables.
    return body.join(F.broadcast(chosen), "id").select("text", "toxic", "weight", "learn")


def fit(docs: DataFrame, labels: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", per_label: int = PER_LABEL) -> Model:
    """``training`` is a condition on ``doc_id``."""
    rows = sample(docs, labels, training, doc_id, text, per_label)
    if rows is None:
        return Model({}, {})
    # Copies of a text say nothing new about its words.
    learn = rows.where("learn").select("text", "toxic").distinct()
    sizes = dict(learn.groupBy("toxic").count().collect())
    counted = learn.mapInArrow(_entries, "entry string, toxic long").groupBy("entry").agg(F.sum("toxic").alias("p"), F.count("*").alias("n"))
    toxic, other = F.lit(sizes.get(1, 0)), F.lit(sizes.get(0, 0))
    clean = F.col("n") - F.col("p")
    odds = F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((clean + 0.5) / (other + 1))
    error = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (clean + 0.5))
    frequent = counted.where(F.col("n") >= TIMES).withColumns({"odds": odds, "sure": odds - SURE * error})
    # Words of a sample of about 2 * per_label texts: what is collected does not grow with the tables.
    marking = frequent.where((F.col("odds") >= ODDS) & (F.col("sure") >= CERTAIN))
    found = [(r.entry, r.p, r.n) for r in marking.collect()]
    # Exceptions are only looked for below the entries found.
    heads = {e.removesuffix("*")[:SHORTEST] for e, _, _ in found if e.endswith("*")}
    plain = frequent.where((F.col("odds") < ODDS / 2) & F.substring("entry", 1, SHORTEST).isin(sorted(heads))) if heads else None
    model = lexicon(found + ([(r.entry, r.p, r.n) for r in plain.collect()] if plain is not None else []), sizes.get(1, 0), sizes.get(0, 0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shared.value.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([v[c] for v in values], pa.float64()) for c in (0, 1)), batch.column("toxic"), batch.column("weight")], ["sum", "most", "toxic", "weight"])

    table = rows.where("NOT learn").select("text", "toxic", "weight").mapInArrow(measure, "sum double, most double, toxic long, weight double").orderBy("toxic", "sum", "most").toArrow()
    x = np.column_stack([table.column("sum").to_numpy(), table.column("most").to_numpy()])
    y = table.column("toxic").to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        model.curve = logistic(x, y, table.column("weight").to_numpy())
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores = [shared.value.score(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    return texts(docs, doc_id, text).mapInArrow(run, "doc_id long, score double, predicted int")
