"""Byte-level BPE by rank files: encoding with a segment tree, and decoding.

The pieces that the pattern cuts from a text are merged separately. A segment tree stands over
a piece's byte positions. Leaf ``i`` holds the rank of the pair that starts at the live
position ``i``, combined with ``i``, so the root is the leftmost pair of minimum rank. A merge
changes at most three leaves (the pair's, its right half's and its left neighbour's) and
renews their paths to the root.

Pieces of common length are merged side by side: row ``k`` of the arrays is the tree of piece
``k``, and one step merges the best pair of every unfinished row. Long pieces have a tree of
their own. Encoded pieces are remembered in two generations up to a bound of bytes.

One pass in Python does all: ids leave it as arrays, packed or decoded again, in batches of
bounded bytes. A worker holds the vocabulary, the remembered pieces and one batch.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import batch_of, text_of

KEPT_BYTES = 12 << 20  # about what a generation of remembered pieces takes
PIECE_BYTES = 220  # of which a piece takes so many beside its own
BATCH_BYTES = 4 << 20
ROWS_AT_ONCE = 4_096
SEGMENT_CHARS = 1 << 18
SEGMENT_PIECES = 1 << 16
_WIDTHS = (4, 8, 16, 32, 64)  # a tree has a guard position at either end


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file: a base64 token and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_tables(ranks: dict[bytes, int]) -> dict:
    """What the encoder needs, as plain arrays; its size follows the vocabulary alone."""
    size = max(ranks.values()) + 1
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * (size + 1) + right] = rank
    keys = np.array(sorted(pairs), np.int64)
    return {
        "size": size,
        "tokens": {rank: token for token, rank in ranks.items()},
        "bytes": np.array([ranks.get(bytes([n]), size) for n in range(256)], np.int32),
        "keys": keys,
        "ranks": np.array([pairs[k] for k in keys.tolist()], np.int32),
    }


class Encoder:
    """Encodes and decodes texts; ids are handled as packed little-endian 32-bit integers."""

    def __init__(self, tables: dict, pattern: str):
        self.tables = tables
        self.size = tables["size"]
        self.none = np.int32(2**31 - 1)
        self.pattern = regex.compile(pattern)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0  # bytes of ``kept``
        self.whole = {t: np.array(r, "<u4").tobytes() for r, t in tables["tokens"].items()}
        self.pairs: dict[int, int] | None = None
        if self.size * max(_WIDTHS) >= 2**31 or int(tables["bytes"].max()) >= self.size:
            raise ValueError("the vocabulary is too large, or lacks single bytes")

    def segments(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches, for long texts in lists of bounded length.

        The text is never cut, so this holds for any pattern.
        """
        if len(text) <= SEGMENT_CHARS:
            yield [m.group() for m in self.pattern.finditer(text)] if self.pattern.groups else (
                self.pattern.findall(text)
            )
            return
        matches = self.pattern.finditer(text)
        while some := [m.group() for m in islice(matches, SEGMENT_PIECES)]:
            yield some

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The packed ids of each text."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            parts = []
            for pieces in self.segments(text):
                if len(text) > SEGMENT_CHARS:
                    self._learn([pieces])
                    parts.append(b"".join(map(self.kept.__getitem__, pieces)))
                else:
                    parts.append(pieces)
            if len(text) > SEGMENT_CHARS:
                yield from self._flush(held)
                held, size = [], 0
                yield b"".join(parts)
                continue
            held.append(parts[0] if parts else [])
            size += len(text)
            if size > SEGMENT_CHARS:
                yield from self._flush(held)
                held, size = [], 0
        yield from self._flush(held)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tables["tokens"].__getitem__, ids))

    def _flush(self, held: list[list[str]]) -> Iterator[bytes]:
        self._learn(held)
        for pieces in held:
            yield b"".join(map(self.kept.__getitem__, pieces))

    def _learn(self, lists: list[list[str]]) -> None:
        """Make sure that every piece of these lists is known.

        A full generation becomes the older one, from which pieces that are met again return.
        """
        if self.held > KEPT_BYTES:
            self.kept, self.older, self.held = {}, self.kept, 0
        kept, older = self.kept, self.older
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in set().union(*lists) - kept.keys():
            self.held += PIECE_BYTES + 2 * len(piece)
            known = older.get(piece)
            if known is None:
                data = piece.encode()
                known = self.whole.get(data)
            if known is not None:
                kept[piece] = known
                continue
            width = next((w for w in _WIDTHS if len(data) + 2 <= w), 0)
            if width:
                by_width.setdefault(width, []).append((piece, data))
            else:
                kept[piece] = self.merge_one(data)
        for width, items in by_width.items():
            for start in range(0, len(items), ROWS_AT_ONCE):
                some = items[start : start + ROWS_AT_ONCE]
                packed = self.merge_many([data for _, data in some], width)
                kept.update(zip((piece for piece, _ in some), packed, strict=True))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``none`` where they don't merge."""
        keys = self.tables["keys"]
        wanted = left.astype(np.int64) * (self.size + 1) + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, self.tables["ranks"][at], self.none)

    def merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of at most ``width - 2`` bytes, with one tree for each."""
        count = len(pieces)
        if not len(self.tables["keys"]):
            return [self.tables["bytes"][list(p)].astype("<u4").tobytes() for p in pieces]
        raw = np.frombuffer(b"".join(p.ljust(width - 2, b"\0") for p in pieces), np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int32, count)
        places = np.arange(width, dtype=np.int32)
        ids = np.full((count, width), self.size, np.int32)  # the guards' id pairs with nothing
        ids[:, 1:-1] = self.tables["bytes"][raw.reshape(count, width - 2)]
        ids[places[None, :] > lengths[:, None]] = self.size
        after = np.tile(places + 1, (count, 1))
        before = np.tile(places - 1, (count, 1))
        tree = np.full((count, 2 * width), self.none, np.int32)
        first = self._ranks(ids[:, :-1], ids[:, 1:])
        tree[:, width:-1] = np.where(first < self.none, first * np.int32(width) + places[:-1], self.none)
        node = width
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2])
            node //= 2
        flat = tree.reshape(-1)
        rows = np.flatnonzero(tree[:, 1] < self.none)
        while len(rows):
            best = tree[rows, 1]
            at, merged = best % width, best // width
            gone = after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            ids[rows, at] = merged
            ids[rows, gone] = self.size
            after[rows, at] = right
            before[rows, right] = at
            base = rows * (2 * width)
            flat[base + width + gone] = self.none
            for place, rank in (
                (at, self._ranks(merged, ids[rows, right])),
                (left, self._ranks(ids[rows, left], merged)),
            ):
                flat[base + width + place] = np.where(rank < self.none, rank * np.int32(width) + place, self.none)
            nodes = [(width + place) >> 1 for place in (at, gone, left)]
            level = width
            while level > 1:
                for n in nodes:
                    flat[base + n] = np.minimum(flat[base + 2 * n], flat[base + 2 * n + 1])
                nodes = [n >> 1 for n in nodes]
                level //= 2
            rows = rows[tree[rows, 1] < self.none]
        live = ids < self.size
        packed = ids[live].astype("<u4").tobytes()
        stops = (4 * np.cumsum(live.sum(1))).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]  # noqa: B905

    def merge_one(self, piece: bytes) -> bytes:
        """Packed ids of a piece of any length."""
        if self.pairs is None:
            self.pairs = dict(zip(self.tables["keys"].tolist(), self.tables["ranks"].tolist(), strict=True))
        pairs, step = self.pairs, self.size + 1
        count = len(piece)
        width = 1 << (count + 1).bit_length()
        none = 2**62
        ids = array("q", [self.size]) * (count + 2)
        ids[1:-1] = array("q", self.tables["bytes"][np.frombuffer(piece, np.uint8)].tolist())
        after = array("q", range(1, count + 3))
        before = array("q", range(-1, count + 1))
        tree = array("q", [none]) * (2 * width)
        for n in range(1, count):
            rank = pairs.get(ids[n] * step + ids[n + 1])
            if rank is not None:
                tree[width + n] = rank * width + n
        for n in range(width - 1, 0, -1):
            tree[n] = min(tree[2 * n], tree[2 * n + 1])
        while tree[1] < none:
            merged, at = divmod(tree[1], width)
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone] = merged, self.size
            after[at], before[right] = right, at
            tree[width + gone] = none
            for place, key in ((at, merged * step + ids[right]), (left, ids[left] * step + merged)):
                rank = pairs.get(key)
                tree[width + place] = none if rank is None else rank * width + place
            for place in (gone, at, left):
                n = (width + place) >> 1
                while n:
                    low = min(tree[2 * n], tree[2 * n + 1])
                    if tree[n] == low and place is not left:
                        break
                    tree[n] = low
                    n >>= 1
        return np.array([i for i in ids if i != self.size], "<u4").tobytes()


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    with_packed: bool = False,
    with_decoded: bool = False,
) -> DataFrame:
    """(id, n_tokens), and as asked for: ``ids`` as an array, ``packed`` as little-endian unsigned
    32-bit integers, and ``decoded``, the bytes that the ids stand for.

    No special tokens; NULL texts are empty ones and have no tokens. The rank file is read by
    the driver; its tables, which follow the vocabulary alone, are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(merge_tables(read_ranks(ranks_path)))
    fields = [("id", pa.int64(), "long"), ("n_tokens", pa.int64(), "long")]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32()), "array<int>"))
    if with_packed:
        fields.append(("packed", pa.binary(), "binary"))
    if with_decoded:
        fields.append(("decoded", pa.binary(), "binary"))
    schema = pa.schema([(name, kind) for name, kind, _ in fields])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)  # its memory goes with the task
        for batch in batches:
            columns: list[list] = [[] for _ in fields[1:]]
            start, size = 0, 0
            texts = (value.as_py() for value in batch.column(1))
            for row, packed in enumerate(encoder.encode(texts), 1):
                found: list = [len(packed) // 4]
                if with_ids:
                    found.append(np.frombuffer(packed, "<i4"))
                if with_packed:
                    found.append(packed)
                if with_decoded:
                    found.append(encoder.decode(packed))
                for column, value in zip(columns, found, strict=True):
                    column.append(value)
                size += 3 * len(packed) + 100
                if size > BATCH_BYTES:
                    yield batch_of(schema, [batch.column(0)[start:row], *columns])
                    columns, start, size = [[] for _ in fields[1:]], row, 0
            yield batch_of(schema, [batch.column(0)[start:], *columns])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    kinds = ", ".join(f"{name} {kind}" for name, _, kind in fields)
    return rows.mapInArrow(kernel, kinds).withColumnRenamed("id", id_col)


def digests() -> tuple[Column, Column]:
    """ids_sha256 and decoded_sha256 of ``packed`` and ``decoded``."""
    return (
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def decode_ids(rows: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """Adds the text of an array of ids; bytes that are no UTF-8 become replacement characters.

    A NULL array gives NULL; an id outside the vocabulary fails the job.
    """
    tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
    shared = rows.sparkSession.sparkContext.broadcast(tokens)

    @F.pandas_udf("string")
    def text_from(ids):
        known = shared.value
        return ids.map(
            lambda v: None if v is None else b"".join(known[int(i)] for i in v).decode("utf-8", "replace")
        )

    return rows.withColumn(out_col, text_from(F.col(ids_col)))
