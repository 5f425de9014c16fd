"""Quality rules: simple counts of a text, and bands of its perplexity in its language.

The language model is a modified Kneser-Ney model of bytes: for each language, 5-grams of the lower-cased
words of every text, joined by single spaces, are counted by Spark over all documents, and so are the
numbers of different left neighbours that the lower orders need. N-grams cross the borders of words, so the
order of words counts. All of them are kept, packed into 64 bits with the number of the language; discounts,
context totals and probabilities are aggregations and joins of Spark.

What is scored is looked up where it was counted: each task that reads documents counts its different
n-grams once, these are joined with the probabilities, and the task that reads the same documents again finds
them in one sorted table of its own in the shared folder. If documents have come to another task meanwhile, what its
table lacks is read from the whole table. So a task holds no more than the n-grams of its own documents.

The bands lie ``BELOW`` and ``ABOVE`` times the distance from the median to the lower and to the upper quartile (each at
least ``WIDTH``) from the median of the logarithm of the perplexity, over all documents of a language that pass the
counts and have as many words to the power of two, since short texts vary more; the fewer these are, the more their
band is drawn towards that of the language (half way at ``ALIKE`` documents). Texts outside are rejected, above as garbled, below as repetitive.

Null languages are one language of their own. Null and empty texts have no words and fail the counts.
Equal rows are judged alike, each on its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.texts import LOWER, WORD_BYTE, Piece, long_hash, long_sums, mix, pieces, words
from chartloom.session import work_dir, written

ORDER = 5
HELD = 1_000_000  # different n-grams that a task gathers before it passes them on
BELOW, ABOVE = 4.0, 3.5
WIDTH = 0.02
ALIKE = 50  # documents of a language and size at which their own band and that of the language count alike
LEAST_WORDS = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ROW = np.uint64(0x9E6C63D0876A9A47)
_NO = np.zeros(0, np.uint64)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def base_counts(piece: Piece) -> dict[str, np.ndarray]:
    """Words, code points in words, symbols, repeated lines and words in repeated 3-word windows, by text."""
    data, offsets, n = piece.data, piece.offsets, len(piece)
    found = words(data, offsets)
    sums = long_sums(data)
    names = long_hash(sums, found.start, found.end)
    row = found.row()
    first_bytes = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = np.bincount(row, first_bytes[found.end] - first_bytes[found.start], n).astype(np.int64)
    # Lines: begun by a text or a line break.
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([offsets[1:], breaks]))
    # A text's last line ends where the next text begins, so both lists are in the same order.
    line_row = np.repeat(np.arange(n), np.diff(np.searchsorted(breaks, offsets)) + 1)
    has_word = np.searchsorted(found.start, end) > np.searchsorted(found.start, start)
    key = mix(long_hash(sums, start, end) + line_row.astype(np.uint64) * _ROW)[has_word]
    _, once = np.unique(key, return_index=True)
    owner = line_row[has_word]
    repeated = np.bincount(owner, minlength=n) - np.bincount(owner[once], minlength=n)
    covered = np.zeros(len(names) + 1, np.int64)
    if len(names) >= 3:
        at = np.flatnonzero(row[2:] == row[:-2])
        three = mix(names[at] * np.uint64(3) + mix(names[at + 1]) * np.uint64(5) + mix(names[at + 2] + _ROW) + row[at].astype(np.uint64) * _ROW)
        _, which, count = np.unique(three, return_inverse=True, return_counts=True)
        twice = at[count[which] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + 3, -1)
    inside = (np.cumsum(covered[:-1]) > 0).astype(np.int64)
    return {
        "n_words": found.count(), "word_chars": chars, "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": repeated, "n_repeat_words": _sums(inside, found.first),
    }


def word_grams(piece: Piece, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed 5-grams of the different words (language, bytes) of a piece, the word of each, the times of each word, the number of each word of the piece, and rows."""
    data = LOWER[piece.data]
    found = words(data, piece.offsets)
    row = found.row()
    own = lang[row]
    names = mix(long_hash(long_sums(data), found.start, found.end) + own.astype(np.uint64) * _ROW)
    _, first, which, times = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
    begin, size = found.start[first], (found.end - found.start)[first]
    # Each word: four empty bytes, its bytes, a space.
    wide = size + ORDER
    at = np.cumsum(wide) - wide
    letters = np.repeat(np.arange(len(first)), size)
    inner = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
    buffer = np.zeros(int(wide.sum()), np.uint64)
    buffer[at[letters] + ORDER - 1 + inner] = data[begin[letters] + inner]
    buffer[at + wide - 1] = 32
    ends = np.repeat(at + ORDER - 1, size + 1) + np.arange(len(letters) + len(first)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    owner = np.repeat(np.arange(len(first)), size + 1)
    packed = own[first][owner].astype(np.uint64) << np.uint64(8 * ORDER) if len(first) else _NO
    for k in range(ORDER):
        packed = packed | buffer[ends - k] << np.uint64(8 * k)
    return packed, owner, times, which, row


def text_grams(piece: Piece, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed 5-grams (language, bytes) of each text, four empty bytes, then each word and a space; and the row of each."""
    data = LOWER[piece.data]
    found = words(data, piece.offsets)
    size, row = found.end - found.start, found.row()
    at = np.cumsum(size + 1) - size - 1 + (ORDER - 1) * (row + 1)
    buffer = np.zeros(int(size.sum()) + len(size) + (ORDER - 1) * len(piece), np.uint64)
    shift = np.repeat(at - found.start, size)
    inside = np.flatnonzero(WORD_BYTE[data])
    buffer[inside + shift] = data[inside]
    buffer[at + size] = 32
    live = np.ones(len(buffer), bool)
    chars = np.concatenate([[0], np.cumsum(size + 1)])[found.first[:-1]]
    for k in range(ORDER - 1):
        live[chars + (ORDER - 1) * np.arange(len(piece)) + k] = False
    packed = buffer.copy()
    for k in range(1, ORDER):
        packed[k:] |= buffer[:-k] << np.uint64(8 * k)
    owner = np.repeat(row, size + 1)
    return packed[live] | lang.astype(np.uint64)[owner] << np.uint64(8 * ORDER), owner


def _codes(batch: pa.RecordBatch, languages: list[str | None]) -> np.ndarray:
    number = {name: k for k, name in enumerate(languages)}
    return np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)


def _counter(languages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        keys, times = [], []
        held = 0
        for piece in pieces(batches):
            key, count = np.unique(text_grams(piece, _codes(piece.batch, languages.value))[0], return_counts=True)
            keys.append(key)
            times.append(count)
            held += len(key)
            if held > 2 * HELD:
                key, number = _folded(keys, times)
                keys, times, held = [key], [number], len(key)
                if held > HELD:
                    yield _gram_rows(part, key, number)
                    keys, times, held = [], [], 0
        if keys:
            yield _gram_rows(part, *_folded(keys, times))

    return run


def _folded(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(which, np.concatenate(times), len(key)).astype(np.int64)


def _gram_rows(part: int, key: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), part, np.int32)), pa.array(key.view(np.int64)), pa.array(number)], ["part", "gram", "n"])


@dataclass
class Level:
    """One order: n-grams with probabilities, contexts with the weight of the next lower order."""

    grams: np.ndarray
    chance: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray


@dataclass
class Model:
    languages: list[str | None]
    levels: list[Level]  # by order, the lowest first

    def chance(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Probability of the last byte of each n-gram after the others."""
        if order == 0:
            return np.full(len(grams), 1 / 256)
        level = self.levels[order - 1]
        out = np.empty(len(grams))
        at, seen = _look(level.grams, grams)
        out[seen] = level.chance[at[seen]]
        rest = np.flatnonzero(~seen)
        if len(rest):
            where, known = _look(level.contexts, grams[rest] >> np.uint64(8))
            weight = np.ones(len(rest))
            weight[known] = level.rest[where[known]]
            out[rest] = weight * self.chance(shorter(grams[rest], order), order - 1)
        return out


def shorter(grams: np.ndarray, order: int) -> np.ndarray:
    """The n-grams without their first byte; the language stays in front."""
    lang = grams >> np.uint64(8 * order)
    return (lang << np.uint64(8 * (order - 1))) | (grams & np.uint64((1 << 8 * (order - 1)) - 1))


def _look(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, and 3 or more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.clip(np.array(d), [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


def level(grams: np.ndarray, counts: np.ndarray, spread: list[int], lower: Model, order: int) -> Level:
    """Probabilities of sorted n-grams, interpolated with the orders below."""
    discount = discounts(spread)
    contexts, first, which = np.unique(grams >> np.uint64(8), return_index=True, return_inverse=True)
    total = np.bincount(which, counts, len(contexts))
    off = discount[np.minimum(counts, 3)]
    rest = np.bincount(which, off, len(contexts)) / total
    below = lower.chance(shorter(grams, order), order - 1) if len(grams) else np.zeros(0)
    return Level(grams, (counts - off) / total[which] + rest[which] * below, contexts, rest)


def _rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))


def _languages(rows: DataFrame) -> list[str | None]:
    return [r.lang for r in rows.select("lang").distinct().orderBy("lang").collect()]


def _seen(rows: DataFrame, languages) -> DataFrame:
    """``part, gram, n``: the n-grams of each task's documents."""
    return written(rows.mapInArrow(_counter(languages), "part int, gram long, n long"), "seen")


def _shorter(order: int) -> Column:
    """The n-gram without its first byte, as ``shorter``."""
    body = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1))
    return F.shiftleft(F.shiftright("gram", 8 * order), 8 * (order - 1)).bitwiseOR(body)


def _orders(seen: DataFrame) -> dict[int, DataFrame]:
    """``gram, n`` by order: the times of the longest, the numbers of left neighbours of the others."""
    tables = {ORDER: written(seen.groupBy("gram").agg(F.sum("n").alias("n")), f"grams-{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = written(tables[order + 1].groupBy(_shorter(order + 1).alias("gram")).agg(F.count("*").alias("n")), f"grams-{order}")
    return tables


def chances(tables: dict[int, DataFrame]) -> DataFrame:
    """``gram, chance`` of all n-grams of the highest order, interpolated with the orders below as ``level`` does."""
    below = None
    for order in range(1, ORDER + 1):
        table = tables[order]
        spread = dict(table.where("n <= 4").groupBy("n").count().collect())
        _, one, two, more = (float(x) for x in discounts([spread.get(k, 0) for k in (1, 2, 3, 4)]))
        off = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
        number = lambda which: F.count(F.when(which, 1))
        contexts = table.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), (one * number(F.col("n") == 1) + two * number(F.col("n") == 2) + more * number(F.col("n") > 2)).alias("rest")
        )
        own = table.withColumn("context", F.shiftright("gram", 8)).join(contexts, "context")
        if below is None:
            own = own.withColumn("below", F.lit(1 / 256))
        else:
            own = own.withColumn("shorter", _shorter(order)).join(below.select(F.col("gram").alias("shorter"), F.col("chance").alias("below")), "shorter")
        below = written(own.select("gram", ((F.col("n") - off) / F.col("total") + F.col("rest") / F.col("total") * F.col("below")).alias("chance")), f"chances-{order}")
    return below


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", grams: int | None = None) -> Model:
    """The same model in the memory of the caller, for small corpora; on request with at most ``grams`` n-grams of an order. ``judge`` does without."""
    rows = _rows(docs.withColumn("__none", F.lit(None)), "__none", text, lang)
    languages = _languages(rows)
    tables = _orders(_seen(rows, docs.sparkSession.sparkContext.broadcast(languages)))
    model = Model(languages, [])
    for order in range(1, ORDER + 1):
        sizes = dict(tables[order].where("n <= 4").groupBy("n").count().collect())
        chosen = tables[order] if grams is None else tables[order].orderBy(F.desc("n"), "gram").limit(grams)
        table = chosen.toArrow()
        key = table.column("gram").to_numpy().view(np.uint64)
        by_key = np.argsort(key)
        model.levels.append(level(key[by_key], table.column("n").to_numpy()[by_key], [sizes.get(k, 0) for k in (1, 2, 3, 4)], model, order))
    return model


def _tables(path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams, sorted, and their losses, of each file in a folder of the work folder; none if there is no folder."""
    system, folder = fs.FileSystem.from_uri(path)
    if system.get_file_info(folder).type == fs.FileType.NotFound:
        return
    for found in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda x: x.path):
        if found.base_name.endswith(".parquet"):
            table = pq.ParquetFile(system.open_input_file(found.path)).read()
            gram = table.column("gram").to_numpy().view(np.uint64)
            order = np.argsort(gram)
            yield gram[order], table.column("loss").to_numpy()[order]


def _losses(grams: np.ndarray, own: list[tuple[np.ndarray, np.ndarray]], whole: str) -> np.ndarray:
    """Losses of different n-grams, from the tables of a task, and what they lack from the whole table."""
    out = np.full(len(grams), np.nan)

    def fill(table: tuple[np.ndarray, np.ndarray]) -> None:
        open_ = np.flatnonzero(np.isnan(out))
        at, known = _look(table[0], grams[open_])
        out[open_[known]] = table[1][at[known]]

    for table in own:
        fill(table)
    if np.isnan(out).any():
        for table in _tables(whole):
            fill(table)
    if np.isnan(out).any():
        raise ValueError("documents changed while they were read")
    return out


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, lang``, the counts, and ``log_perplexity`` (null without words) of every row, in a model of all rows."""
    spark = docs.sparkSession
    rows = _rows(docs, doc_id, text, lang)
    languages = spark.sparkContext.broadcast(_languages(rows))
    seen = _seen(rows, languages)
    whole, own = work_dir(spark, "losses"), work_dir(spark, "losses-by-part")
    losses = chances(_orders(seen)).select("gram", (-F.log("chance")).alias("loss"))
    losses.write.parquet(whole)
    losses = spark.read.schema("gram long, loss double").parquet(whole)
    by_part = seen.select("part", "gram").join(losses, "gram").select("part", "gram", "loss")
    by_part.repartition("part").sortWithinPartitions("part", "gram").write.partitionBy("part").parquet(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for piece in pieces(batches):
            if tables is None:
                tables = list(_tables(f"{own}/part={TaskContext.get().partitionId()}"))
            base = base_counts(piece)
            packed, row = text_grams(piece, _codes(piece.batch, languages.value))
            grams, which = np.unique(packed, return_inverse=True)
            loss = np.bincount(row, _losses(grams, tables, whole)[which], len(piece))
            total = np.bincount(row, minlength=len(piece))
            value = pa.array(loss / np.maximum(total, 1), mask=total == 0)
            yield pa.RecordBatch.from_arrays(
                [piece.batch.column("doc_id"), piece.batch.column("lang"), *(pa.array(base[c].astype(np.int64)) for c in BASE), value], ["doc_id", "lang", *BASE, "log_perplexity"]
            )

    return rows.mapInArrow(run, f"doc_id long, lang string, {', '.join(f'{c} long' for c in BASE)}, log_perplexity double")


def _bands(fit: DataFrame, *keys: str) -> DataFrame:
    quarters = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000)
    found = fit.groupBy(*(F.col(k).alias(f"own_{k}") for k in keys)).agg(quarters.alias("q"), F.count("*").alias("n"))
    q = [F.col("q")[k] for k in range(3)]
    lowest = q[1] - F.greatest(F.lit(BELOW) * (q[1] - q[0]), F.lit(WIDTH))
    highest = q[1] + F.greatest(F.lit(ABOVE) * (q[2] - q[1]), F.lit(WIDTH))
    return found.select(*(f"own_{k}" for k in keys), "n", F.struct(lowest.alias("lowest"), highest.alias("highest")).alias("band"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id``, the counts, ``log_perplexity``, ``base_failed`` and ``kept`` of every row."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = written(measure(docs, doc_id, text, lang).withColumn("base_failed", failed), "measured")
    rows = rows.withColumn("size", F.floor(F.log2("n_words")))
    fit = rows.where("NOT base_failed")
    same = F.col("lang").eqNullSafe(F.col("own_lang"))
    # One row a language, and some twenty a language.
    judged = rows.join(F.broadcast(_bands(fit, "lang").drop("n")), same, "left").drop("own_lang")
    sized = _bands(fit, "lang", "size").withColumnRenamed("band", "own_band")
    judged = judged.join(F.broadcast(sized), same & (F.col("size") == F.col("own_size")), "left")
    # The band of few documents is drawn towards that of their language, without a jump at any number.
    weight = F.coalesce(F.col("n") / (F.col("n") + ALIKE), F.lit(0.0))

    def drawn(side: str) -> Column:
        whole = F.col("band")[side]
        return whole + weight * (F.coalesce(F.col("own_band")[side], whole) - whole)

    inside = F.col("log_perplexity").between(drawn("lowest"), drawn("highest"))
    return judged.select("doc_id", *BASE, "log_perplexity", "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
