"""Document quality by a factorisation machine.

A document is a list of active features: its distinct words, hashed, each with weight
1/sqrt(number of distinct words); structure statistics of the text and its stated length, each
in a bin of its own with weight 1. Every feature has a weight and a short factor vector, and
two features interact by the product of their vectors. The sum over all pairs needs one pass,
as half of (sum of v x)^2 - sum of (v x)^2.

The model is fitted by gradient descent on a sample of at most ``max_rows`` labelled documents,
chosen by a hash of their id. The sample bounds what the driver holds and nothing else: every
document is scored, and with fewer labels all of them are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import batch_of, text_of, utf8_values, word_blocks
from fleetpulse.session import cut_lineage

BUCKETS = 1 << 14
BINS = 48
FACTORS = 6
MAX_ROWS = 8_000
THRESHOLD = 0.3
_SYMBOLS = b"#$%&*+<=>@^_`{|}~/\\"
_SENTENCE = b".,;:!?"
_STATISTICS = 12
FEATURES = BUCKETS + _STATISTICS * BINS
_KEPT = 500_000


class WordBuckets(dict):
    """Buckets of words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT:
            self.clear()
        self[word] = value = xxhash.xxh32_intdigest(word) % BUCKETS
        return value


def _share(part: float, whole: float) -> int:
    return int(20 * part / whole) if whole else 0


def _log(value: float) -> int:
    return int(2 * np.log2(1 + max(0, value)))


_CLASSES = np.zeros((256, 6))
for _n in range(256):
    _c = bytes([_n])
    _CLASSES[_n] = (
        _c.isspace(), _c.isdigit(), _c.isupper(), _c in _SYMBOLS, _c in _SENTENCE,
        _c.isalpha() or _n > 127,
    )


def features(data: bytes, stated: int | None, buckets: WordBuckets) -> np.ndarray:
    """The active features of a text: statistics first, then its distinct words."""
    distinct: set[bytes] = set()
    total, letters, marked = 0, 0, 0
    counts = np.zeros(256, np.int64)
    for start in range(0, len(data), 1 << 22):
        part = np.frombuffer(data, np.uint8, min(1 << 22, len(data) - start), start)
        counts += np.bincount(part, minlength=256)
    for block in word_blocks(data.lower()):
        distinct.update(block)
        total += len(block)
        letters += sum(map(len, block))
    space, digit, upper, symbol, sentence, alpha = counts @ _CLASSES
    size = len(data) - space
    lines = int(counts[10]) + 1
    repeated = lines - len(set(data.split(b"\n"))) if lines > 1 else 0
    statistics = (
        _share(symbol, size), _share(digit, size), _share(upper, size), _share(alpha, size),
        _share(sentence, size), _share(len(distinct), total), _log(total), _log(len(data)),
        _log(4 * letters / total) if total else 0, _share(repeated, lines),
        _log(8 * total / lines), BINS - 1 if stated is None else _log(stated),
    )
    fixed = BUCKETS + BINS * np.arange(_STATISTICS) + np.minimum(statistics, BINS - 1)
    words = np.fromiter(map(buckets.__getitem__, distinct), np.int32, len(distinct))
    words.sort()  # the order of a set of bytes differs between processes
    return np.concatenate([fixed.astype(np.int32), words])


def weights_of(sizes: np.ndarray) -> np.ndarray:
    """The value of each active feature, for documents with these numbers of them."""
    ends = np.cumsum(sizes)
    values = np.repeat(1 / np.sqrt(np.maximum(1.0, sizes - _STATISTICS)), sizes)
    for n in range(_STATISTICS):
        values[ends - sizes + n] = 1.0
    return values.astype(np.float32)


@dataclass
class Machine:
    """A factorisation machine with logistic output."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, active: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self._forward(active, weights_of(sizes), sizes)[0]

    def scores(self, active: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.zeros(0)
        logits = np.clip(self.logits(active, sizes), -30, 30).astype(np.float64)
        return 1 / (1 + np.exp(-logits))

    def _forward(self, active, values, sizes):
        starts = np.cumsum(sizes) - sizes
        scaled = self.factors[active] * values[:, None]
        summed = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(np.einsum("ij,ij->i", scaled, scaled), starts)
        line = np.add.reduceat(self.linear[active] * values, starts)
        pairs = 0.5 * (np.einsum("ij,ij->i", summed, summed) - squares)
        return self.bias + line + pairs, summed, scaled


def fit(
    active: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 14,
    least_steps: int = 220, batch: int = 512, rate: float = 0.03, shrink: float = 2e-4,
    seed: int = 7,
) -> Machine:
    """Fit by Adam on mini-batches, with more epochs where ``least_steps`` asks for them.

    Without both labels the result is a constant: their rate, or 1/2 without any.
    """
    rng = np.random.default_rng(seed)
    start = float(np.clip(labels.mean(), 0.02, 0.98)) if len(labels) else 0.5
    model = Machine(
        float(np.log(start / (1 - start))), np.zeros(FEATURES, np.float32),
        (0.02 * rng.standard_normal((FEATURES, FACTORS))).astype(np.float32),
    )
    if not len(labels) or labels.min() == labels.max():
        model.factors[:] = 0
        return model
    ends = np.cumsum(sizes)
    state = [np.zeros_like(model.linear), np.zeros_like(model.linear),
             np.zeros_like(model.factors), np.zeros_like(model.factors)]
    step = 0
    for _ in range(max(epochs, -(-least_steps * batch // len(sizes)) if len(sizes) > batch else least_steps)):
        order = rng.permutation(len(sizes))
        for low in range(0, len(order), batch):
            rows = order[low : low + batch]
            some = np.concatenate([active[ends[r] - sizes[r] : ends[r]] for r in rows])
            counts = sizes[rows]
            values = weights_of(counts)
            logits, summed, scaled = model._forward(some, values, counts)
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[rows]) / len(rows)
            each = np.repeat(error, counts) * values
            pull = each[:, None] * (np.repeat(summed, counts, axis=0) - scaled)
            flat = np.bincount(some, each, FEATURES)
            deep = np.stack(
                [np.bincount(some, pull[:, f], FEATURES) for f in range(FACTORS)], axis=1
            )
            step += 1
            model.bias -= rate * float(error.sum())
            for n, (part, slope) in enumerate(((model.linear, flat), (model.factors, deep))):
                slope = (slope + shrink * part).astype(np.float32)
                mean, spread = state[2 * n], state[2 * n + 1]
                mean += 0.1 * (slope - mean)
                spread += 0.01 * (slope * slope - spread)
                part -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return model


def held_out(ident: Column) -> Column:
    """Ids whose labels are never learned from."""
    return F.crc32(ident.cast("string").cast("binary")) % 5 == 0


def _feature_rows(docs: DataFrame) -> DataFrame:
    """(id, active) from (id, text, stated)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        schema = pa.schema([("id", pa.int64()), ("active", pa.list_(pa.int32()))])
        for batch in batches:
            stated = batch.column(2).to_pylist()
            rows = [features(t, s, buckets) for t, s in zip(utf8_values(batch.column(1)), stated, strict=True)]
            yield batch_of(schema, [batch.column(0), rows])

    return docs.mapInArrow(kernel, "id long, active array<int>")


def _inputs(docs: DataFrame, id_col: str, text_col: str, length_col: str) -> DataFrame:
    stated = F.col(length_col).cast("long") if length_col in docs.columns else F.lit(None).cast("long")
    return docs.select(
        F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), stated.alias("stated")
    )


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    length_col: str = "n_chars", label_col: str = "quality", max_rows: int = MAX_ROWS,
) -> Machine:
    """Learn from labelled documents that are not held out.

    An id with several labels counts as their smallest; NULL ids and labels are left out. The
    ids of the sample are at most ``max_rows``, so their broadcast is bounded.
    """
    chosen = cut_lineage(
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    rows = _inputs(docs, id_col, text_col, length_col).join(F.broadcast(chosen.select("id")), "id")
    found = _feature_rows(rows.select("id", "text", "stated")).join(F.broadcast(chosen), "id")
    table = found.select("id", "active", "y").toArrow().combine_chunks()
    lists = table["active"].combine_chunks() if table.num_rows else None
    if lists is None:
        return fit(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0))
    sizes = np.asarray(lists.value_lengths(), np.int64)
    flat = np.asarray(lists.flatten(), np.int32)
    ids, y = np.asarray(table["id"]), np.asarray(table["y"], np.float64)
    starts = np.cumsum(sizes) - sizes
    marks = [xxhash.xxh32_intdigest(flat[a : a + s].tobytes()) for a, s in zip(starts, sizes, strict=True)]
    order = np.lexsort((marks, ids))  # the same order in each run
    flat = np.concatenate([flat[starts[n] : starts[n] + sizes[n]] for n in order])
    return fit(flat, sizes[order], (y[order] > 0).astype(np.float64))


def score(
    docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text",
    length_col: str = "n_chars",
) -> DataFrame:
    """(id, score) per row; scores lie in 0 to 1, NULL and empty texts are scored as empty.

    The model that is broadcast has a size fixed by its parameters.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        machine = Machine(*shared.value)
        for batch in batches:
            stated = batch.column(2).to_pylist()
            found = _scores(machine, buckets, utf8_values(batch.column(1)), stated)
            columns = [batch.column(0), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score"])

    rows = _inputs(docs, id_col, text_col, length_col)
    return rows.mapInArrow(kernel, "id long, score double").withColumnRenamed("id", id_col)


def _scores(machine: Machine, buckets: WordBuckets, texts, lengths) -> np.ndarray:
    scores: list[np.ndarray] = []
    held: list[np.ndarray] = []
    size = 0
    for text, length in zip(texts, lengths, strict=True):
        held.append(features(text, length, buckets))
        size += len(held[-1])
        if size > 200_000:
            scores.append(machine.scores(*_stacked(held)))
            held, size = [], 0
    scores.append(machine.scores(*_stacked(held)))
    return np.concatenate(scores)


def _stacked(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    length_col: str = "n_chars", label_col: str = "quality", max_rows: int = MAX_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, held_out, score, predicted) per row, from a model learned on ``labels``.

    ``held_out`` is NULL where the id is; such rows are scored like any other.
    """
    model = train(docs, labels, id_col, text_col, length_col, label_col, max_rows)
    return score(docs, model, id_col, text_col, length_col).select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, model: Machine, text_col: str = "text", length_col: str = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns.

    A task scores its rows as they come, so the scorer's words are shared by all its batches.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))
    stated = F.col(length_col).cast("long") if length_col in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.struct("*").alias("row"), stated.alias("stated"))
    place = docs.columns.index(text_col)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        machine = Machine(*shared.value)
        for batch in batches:
            texts = utf8_values(batch.column(0).field(place))
            found = _scores(machine, buckets, texts, batch.column(1).to_pylist())
            yield batch.select(["row"]).filter(pa.array(found >= threshold))

    kept = rows.mapInArrow(kernel, T.StructType([rows.schema["row"]]))
    return kept.select("row.*")
