"""Toxicity by averaged subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its character n-grams, with marks at both ends, and a text
is the mean of its words, repeats included. N-grams are hashed to a fixed number of vectors, so a
misspelling never seen before shares most of its vectors with the word it comes from. A linear
softmax over the text's vector gives the two classes. Vectors and softmax are trained together
in numpy.

Training keeps a sum of each vector's slopes. A vector stays zero until the slopes of its steps
agree: until their sum's length passes ``agree`` times what slopes of one sign would reach. So
n-grams that only noisy labels speak for have no say. A random share of n-grams is left out of
each step, which makes the ones of a word stand in for each other, as a misspelling needs it.

The softmax is linear, so the difference of a text's two logits is also the mean of its words'
differences. Scoring uses that: a worker remembers one number for each word it has met.

The model is fitted on a sample of at most ``max_rows`` labelled documents, chosen by a hash of
their id; equal bags among them count once. The sample bounds what the driver holds and nothing
else: every document is scored over its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import batch_of, text_of, utf8_values, word_blocks
from fleetpulse.session import cut_lineage

BUCKETS = 1 << 17
LENGTHS = (3, 4, 5)
WIDTH = 4
MAX_ROWS = 4_000
THRESHOLD = 0.7
ROWS_A_STEP = 256
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KEPT = 300_000  # words that a worker remembers
_CODES_AT_ONCE = 1 << 16  # of new words


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word's n-grams, one word after the other, and their numbers.

    A word has at least one: with its marks, an n-gram too short is the whole of it.
    """
    marked = [f"<{w}>" if w else "<<>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes))
    owners, hashes = [], []
    for length in LENGTHS:
        starts = place[place + length <= ends]
        value = np.full(len(starts), length, np.uint64)
        for n in range(length):
            value = (value ^ codes[starts + n]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        owners.append(owner[starts])
        hashes.append((value % np.uint64(BUCKETS)).astype(np.int32))
    together = np.concatenate(owners)
    order = np.argsort(together, kind="stable")
    return np.concatenate(hashes)[order], np.bincount(together, minlength=len(words))


def bare(word: bytes) -> str:
    """A word as it is cut into n-grams: lower case, without marks at its ends."""
    text = word.decode("utf-8", "replace").lower()
    return text.strip(_MARKS) or text


def _in_turn(words: Iterable[bytes]) -> Iterator[list[bytes]]:
    """The words in lists of bounded length."""
    some: list[bytes] = []
    size = 0
    for word in words:
        some.append(word)
        size += len(word) + 2
        if size > _CODES_AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


def bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text, ascending, and the share each has in its mean."""
    counts: Counter = Counter()
    for block in word_blocks(data.lower()):
        counts.update(block)
    total = sum(counts.values())
    held = np.zeros(BUCKETS)
    for words in _in_turn(sorted(counts)):
        buckets, sizes = grams([bare(w) for w in words])
        shares = np.fromiter((counts[w] for w in words), np.float64, len(words)) / (total * sizes)
        held += np.bincount(buckets, np.repeat(shares, sizes), BUCKETS)
    found = np.flatnonzero(held)
    return found.astype(np.int32), held[found].astype(np.float32)


@dataclass
class Bags:
    """N-gram vectors and a linear softmax over two classes."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def lean(self) -> tuple[np.ndarray, float]:
        """How far each vector, and the bias, lean to the second class."""
        side = self.softmax[:, 1] - self.softmax[:, 0]
        return (self.vectors @ side).astype(np.float32), float(self.bias[1] - self.bias[0])


def fit(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12,
    least_steps: int = 160, rate: float = 100.0, agree: float = 0.5, left_out: float = 0.85,
    least_share: float = 0.003, seed: int = 11,
) -> Bags:
    """Vectors and softmax together, on mini-batches.

    N-grams in less than ``least_share`` of the bags, or in one alone, keep zero vectors. Without
    both labels the result is a constant: their rate, or 1/2 without any.
    """
    rng = np.random.default_rng(seed)
    start = float(np.clip(labels.mean(), 0.02, 0.98)) if len(labels) else 0.5
    side = rng.standard_normal(WIDTH).astype(np.float32)
    model = Bags(
        np.zeros((BUCKETS, WIDTH), np.float32), np.stack([-side, side], 1), np.log([1 - start, start])
    )
    if not len(labels) or labels.min() == labels.max():
        return model
    labels = labels.astype(int)
    held_by = np.bincount(np.concatenate([b for b, _ in bags]), minlength=BUCKETS)
    known = held_by >= max(2, least_share * len(bags))
    number = np.cumsum(known) - 1
    count = int(known.sum())
    # A last column without weight, so that no bag is empty.
    some = [(np.append(number[b[known[b]]], count), np.append(s[known[b]], 0)) for b, s in bags]
    sizes = np.fromiter((len(b) for b, _ in some), np.int64, len(some))
    ends = np.cumsum(sizes)
    columns = np.concatenate([b for b, _ in some])
    shares = np.concatenate([s for _, s in some]).astype(np.float32)
    del some

    vectors = np.zeros((count + 1, WIDTH), np.float32)
    slopes, squares = np.zeros_like(vectors), np.full(count + 1, 1e-20, np.float32)
    mean, spread = np.zeros_like(model.softmax), np.zeros_like(model.softmax)
    step = 0
    for _ in range(max(epochs, -(-least_steps * ROWS_A_STEP // len(bags)) if len(bags) > ROWS_A_STEP else least_steps)):
        order = rng.permutation(len(bags))
        for low in range(0, len(order), ROWS_A_STEP):
            rows = order[low : low + ROWS_A_STEP]
            places = np.concatenate([np.arange(ends[r] - sizes[r], ends[r]) for r in rows])
            used = columns[places]
            weight = shares[places] * (rng.random(len(places)) >= left_out)
            starts = np.cumsum(sizes[rows]) - sizes[rows]
            text = np.add.reduceat(vectors[used] * weight[:, None], starts, axis=0)
            logits = text @ model.softmax + model.bias
            error = np.exp(logits - logits.max(1, keepdims=True))
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(rows)), labels[rows]] -= 1
            pull = np.repeat(error @ model.softmax.T, sizes[rows], axis=0) * weight[:, None]
            slope = np.stack(
                [np.bincount(used, pull[:, n], count + 1) for n in range(WIDTH)], 1
            ).astype(np.float32)
            step += 1
            slopes += slope
            squares += np.einsum("ij,ij->i", slope, slope)
            length, root = np.sqrt(np.einsum("ij,ij->i", slopes, slopes)), np.sqrt(squares)
            over = np.maximum(0, length - agree * np.sqrt(step) * root)
            vectors = -(rate * over / np.maximum(length * root, 1e-20))[:, None] * slopes
            model.bias -= 0.5 * error.mean(0)
            top = (text.T @ error / len(rows)).astype(np.float32)
            mean = 0.9 * mean + 0.1 * top
            spread = 0.99 * spread + 0.01 * top * top
            model.softmax -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    model.vectors[known] = vectors[:count]
    return model


class WordLeans(dict):
    """How far each word met leans to the second class; emptied when it has grown large."""

    def __init__(self, of_vectors: np.ndarray):
        super().__init__()
        self.of_vectors = of_vectors

    def learn(self, words: Iterable[bytes]) -> None:
        missing = [w for w in words if w not in self]
        if len(self) + len(missing) > _KEPT:
            self.clear()
            missing = list(words)
        for some in _in_turn(missing):
            buckets, sizes = grams([bare(w) for w in some])
            sums = np.add.reduceat(self.of_vectors[buckets].astype(np.float64), np.cumsum(sizes) - sizes)
            self.update(zip(some, (sums / sizes).tolist(), strict=True))


def score_of(data: bytes, words: WordLeans, bias: float) -> float:
    """The score of a text; without words it is that of the bias alone."""
    total, count = 0.0, 0
    for block in word_blocks(data.lower()):
        found = Counter(block)
        words.learn(found.keys())
        total += sum(sorted(n * words[w] for w, n in found.items()))  # the same sum in each run
        count += len(block)
    lean = bias + (total / count if count else 0.0)
    return float(1 / (1 + np.exp(-np.clip(lean, -30, 30))))


def held_out(ident: Column) -> Column:
    """Ids whose labels are never learned from."""
    return F.crc32(ident.cast("string").cast("binary")) % 3 == 1


def _inputs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_rows: int = MAX_ROWS,
) -> Bags:
    """Learn from labelled documents that are not held out.

    An id with several labels counts as their largest; NULL ids and labels are left out. The
    ids of the sample are at most ``max_rows``, so their broadcast is bounded.
    """
    chosen = cut_lineage(
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("id", pa.int64()), ("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))]
        )
        for batch in batches:
            found = [bag(t) for t in utf8_values(batch.column(1))]
            yield batch_of(schema, [batch.column(0), [b for b, _ in found], [s for _, s in found]])

    rows = _inputs(docs, id_col, text_col).join(F.broadcast(chosen.select("id")), "id")
    bags = rows.select("id", "text").mapInArrow(kernel, "id long, buckets array<int>, shares array<float>")
    table = bags.join(F.broadcast(chosen), "id").select("id", "buckets", "shares", "y").toArrow()
    # Equal bags count once, with the label most of them have; in the same order in each run.
    votes: dict[bytes, list] = {}
    for batch in table.to_batches():
        of_id, of_y = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        for n in range(batch.num_rows):
            found = batch.column(1)[n].values.to_numpy(), batch.column(2)[n].values.to_numpy()
            key = xxhash.xxh128_digest(found[0].tobytes() + found[1].tobytes())
            vote = votes.setdefault(key, [of_id[n], found, 0, 0])
            vote[0] = min(vote[0], of_id[n])
            vote[2 + (of_y[n] > 0)] += 1
    held = sorted(votes.values(), key=lambda v: v[0])
    return fit([v[1] for v in held], np.array([v[3] > v[2] for v in held], np.float64))


def score(docs: DataFrame, model: Bags, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row; scores lie in 0 to 1, NULL and empty texts are scored as empty.

    What is broadcast has a size fixed by ``BUCKETS``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.lean())

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_vectors, bias = shared.value
        words = WordLeans(of_vectors)
        for batch in batches:
            found = [score_of(t, words, bias) for t in utf8_values(batch.column(1))]
            columns = [batch.column(0), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score"])

    rows = _inputs(docs, id_col, text_col)
    return rows.mapInArrow(kernel, "id long, score double").withColumnRenamed("id", id_col)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", max_rows: int = MAX_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, held_out, score, predicted) per row, from a model learned on ``labels``.

    ``held_out`` is NULL where the id is; such rows are scored like any other. Rows with the same
    id are taken apart; no other column of ``docs`` is read.
    """
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    return score(docs, model, id_col, text_col).select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
