"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct hash of a five-word shingle that lies below a fixed fraction of
the hash space, so its size follows the text and sketches merge by union. A text with few hashes
there also keeps the next ones, up to ``LEAST`` in all, so a short text keeps every hash it has.
A sketch knows up to where it is complete, and two are compared below the lower of both bounds.
That gives estimates of Jaccard likeness and of the containment of either text in the other,
however unequal their lengths; for two texts of less than ``LEAST`` shingles they are exact.

Words are what stands between ASCII white space, A-Z lower-cased. Fewer than five words form
one shingle; a text without words has the empty sketch, which is like other empty ones only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import batch_of, shuffle_partitions, text_of, utf8_values, word_blocks

WIDTH = 5
FRACTION = 1 / 8
LEAST = 64
_ALL = np.uint64(2**64 - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_WORDS_KEPT = 500_000
_NONE = -(2**63)
BUCKET_BYTES = 128 << 20


class WordHashes(dict):
    """64-bit hashes of words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _combine(words: np.ndarray, width: int) -> np.ndarray:
    """One mixed hash for each run of ``width`` word hashes."""
    count = len(words) - width + 1
    total = np.zeros(count, np.uint64)
    for n in range(width):
        total = total * _BASE + words[n : n + count]
    total ^= total >> np.uint64(30)
    total *= _MIX[0]
    total ^= total >> np.uint64(27)
    total *= _MIX[1]
    return total ^ (total >> np.uint64(31))


def sketch(
    data: bytes, words: WordHashes, fraction: float = FRACTION, width: int = WIDTH
) -> np.ndarray:
    """The sorted hashes kept of a text."""
    bound = _bound(fraction)
    carry = np.zeros(0, np.uint64)
    kept: list[np.ndarray] = []
    lowest = np.zeros(0, np.uint64)
    below = 0
    whole = True
    for block in word_blocks(data.lower()):
        hashes = np.fromiter(map(words.__getitem__, block), np.uint64, len(block))
        run = np.concatenate([carry, hashes])
        if len(run) >= width:
            whole = False
            shingles = _combine(run, width)
            kept.append(np.unique(shingles[shingles < bound]))
            if below < LEAST:
                lowest = np.union1d(lowest, shingles)[:LEAST]
                below = int((lowest < bound).sum())
        carry = run[len(run) - min(len(run), width - 1) :]
    if whole and len(carry):
        lowest = _combine(carry, len(carry))
    return lowest if below < LEAST else np.unique(np.concatenate(kept))


def _bound(fraction: float) -> np.uint64:
    return np.uint64(min(int(fraction * 2.0**64), 2**64 - 1))


def complete_to(hashes: np.ndarray, fraction: float = FRACTION) -> np.uint64:
    """The highest hash up to which a sketch has all of its text's."""
    if len(hashes) < LEAST:
        return _ALL
    return max(_bound(fraction) - np.uint64(1), hashes[-1])


def _comparable(a: np.ndarray, b: np.ndarray, fraction: float) -> tuple[np.ndarray, np.ndarray]:
    """What both sketches have below the lower of their bounds."""
    top = min(complete_to(a, fraction), complete_to(b, fraction))
    return a[a <= top], b[b <= top]


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    both = np.union1d(*_comparable(a, b, fraction))
    below = int((both < _bound(fraction)).sum())
    return both[: max(below, LEAST)]


def likeness(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Estimated share of common shingles among all; 1 for two empty sketches."""
    if not len(a) and not len(b):
        return 1.0
    a, b = _comparable(a, b, fraction)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def containment(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``.

    A few shingles that all lie above the bound of a long ``b`` say nothing, which gives 0.
    """
    if not len(a):
        return 1.0
    a, b = _comparable(a, b, fraction)
    if not len(a):
        return 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def encode(hashes: np.ndarray) -> str:
    """A sketch as text: base64 of its hashes, eight big-endian bytes each, ascending."""
    return base64.b64encode(hashes.astype(">u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fraction: float = FRACTION
) -> DataFrame:
    """(id, fingerprint) per row, without a shuffle. NULL texts are empty ones."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        schema = pa.schema([("id", pa.int64()), ("fingerprint", pa.string())])
        for batch in batches:
            prints = [encode(sketch(t, words, fraction)) for t in utf8_values(batch.column(1))]
            yield batch_of(schema, [batch.column(0), prints])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(kernel, "id long, fingerprint string").withColumnRenamed("id", id_col)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double,"
    " contained_edited double, contained_next double"
)


def compare_with_next(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fraction: float = FRACTION,
    buckets: int | None = None,
) -> DataFrame:
    """Each document beside its edited text and the next document by ascending id.

    The edited text has the last floor(n/2) code points replaced by the first as many of the
    next document; the first document follows the last. ``contained_*`` is the share of the
    document's shingles found in the other text.

    Texts move once: ids are cut into ranges of about equal counts, each range is one sorted
    partition, and the first document of a range travels to the range before it as well. The
    driver holds one id per range. A NULL id sorts first, rows with the same id follow each
    other by a hash of their text, and a single row is its own next document. An empty table
    gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NONE)).alias("place"),
        text_of(text_col).alias("text"),
    )
    if buckets is None:
        bytes_ = docs.select(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
        buckets = max(shuffle_partitions(docs.sparkSession), -(-bytes_ // BUCKET_BYTES))
    bounds = _bounds(rows, buckets)

    @F.pandas_udf("int")
    def bucket_of(place):
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, place.to_numpy(), side="right").astype(np.int32))

    heads = {
        r.bucket: r.head
        for r in rows.select(bucket_of("place").alias("bucket"), "place")
        .groupBy("bucket")
        .agg(F.min("place").alias("head"))
        .collect()
    }
    order = sorted(heads)
    before = {heads[b]: order[n - 1] for n, b in enumerate(order)}  # the first goes to the last

    @F.pandas_udf("int")
    def also_in(place):
        return place.map(before).astype("Int32")

    own = F.struct(F.col("bucket"), F.lit(False).alias("tail"))
    guest = F.struct(F.col("also").alias("bucket"), F.lit(True).alias("tail"))
    placed = (
        rows.withColumns({"bucket": bucket_of("place"), "also": also_in("place")})
        .withColumn(
            "at", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, guest)))
        )
        .select("doc_id", "place", "text", F.xxhash64("text").alias("tie"), "at.bucket", "at.tail")
        .repartitionById(len(bounds) + 1, F.col("bucket"))
        .sortWithinPartitions("bucket", "tail", "place", "tie")
        .select("doc_id", "text", "tail")
    )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        held = None
        for batch in batches:
            done: list[tuple] = []
            for n in range(batch.num_rows):
                tail = batch.column(2)[n].as_py()
                if tail and held is None:
                    continue  # only the first of several rows with the head's id follows
                text = batch.column(1)[n].as_py()
                row = (batch.column(0)[n].as_py(), text, sketch(text.encode(), words, fraction))
                if held is not None:
                    done.append(_judge(held, row, words, fraction))
                held = None if tail else row
            yield from _packed(done)

    return placed.mapInArrow(kernel, _RESULT)


def _bounds(rows: DataFrame, buckets: int) -> np.ndarray:
    """Ids that cut the table into ranges; equal ones collapse."""
    if buckets < 2:
        return np.zeros(0, np.int64)
    shares = [n / buckets for n in range(1, buckets)]
    found = rows.agg(
        F.percentile_approx("place", shares, max(10_000, 20 * buckets)).alias("cuts")
    ).first()
    return np.unique(np.array(found.cuts or [], np.int64))


def _judge(row: tuple, following: tuple, words: WordHashes, fraction: float) -> tuple:
    ident, text, own = row
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[1][:half]).encode()
    changed = sketch(edited, words, fraction)
    return (
        ident,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        encode(own),
        encode(changed),
        likeness(own, changed, fraction),
        likeness(own, following[2], fraction),
        containment(own, changed, fraction),
        containment(own, following[2], fraction),
    )


def _packed(done: list[tuple]) -> Iterator[pa.RecordBatch]:
    if done:
        kinds = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [pa.float64()] * 4
        names = [part.split()[0] for part in _RESULT.split(",")]
        columns = zip(*done, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
        )
