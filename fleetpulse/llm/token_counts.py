"""Token counts of whole documents by a tokenizer library, huge ones by overlapping chunks.

A document longer than a chunk is encoded chunk by chunk, each chunk starting some way before
the end of the one before. The two encodings are spliced where both begin a pre-token at the
same place. That place is proven stable: pre-tokens are cut from left to right and none
depends on text before its start, so from there on the later chunk yields what an encoding of
the whole would, and up to there the earlier chunk does, as its cuts have seen the character
after them. Places closer to either chunk's open end than the longest special token are not
used, for a special token may lie across it. When no common place is found, the overlap is
widened, at last to the whole earlier chunk, and then the earlier chunk grows.

That holds for tokenizers that cut pre-tokens as byte-level BPE does; others are refused.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import batch_of, text_of

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
BATCH_CHARS = 262_144
LIMIT = 1024
_PROBED = 1_024  # longer overlaps are searched by listing all places


class Cuts:
    """The encoding of text[begin:end], asked for the places where pre-tokens begin."""

    def __init__(self, tokenizer, text: str, begin: int, end: int):
        self.begin, self.end = begin, end
        self.encoding = tokenizer.encode(text[begin:end], add_special_tokens=False)
        self.tokens = len(self.encoding)

    def token_at(self, place: int) -> int | None:
        """The token with which a pre-token begins at this place, None if none does."""
        if place == self.end:
            return self.tokens
        token = self.encoding.char_to_token(place - self.begin)
        if token is None or self.encoding.token_to_chars(token)[0] + self.begin != place:
            return None
        word = self.encoding.token_to_word(token)
        same = token > 0 and word is not None and word == self.encoding.token_to_word(token - 1)
        return None if same else token

    def places(self) -> np.ndarray:
        """All places where a pre-token begins."""
        words = np.array([-1 if w is None else w for w in self.encoding.word_ids], np.int64)
        first = np.ones(len(words), bool)
        first[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
        offsets = self.encoding.offsets
        return np.array([offsets[n][0] for n in np.flatnonzero(first)], np.int64) + self.begin


def _common_place(left: Cuts, right: Cuts, low: int, high: int) -> int | None:
    """The last place from ``low`` to ``high`` where pre-tokens of both begin."""
    if high - low <= _PROBED:
        for place in range(high, low - 1, -1):
            if left.token_at(place) is not None and right.token_at(place) is not None:
                return place
        return None
    common = np.intersect1d(left.places(), right.places())
    common = common[(common >= low) & (common <= high)]
    return int(common[-1]) if len(common) else None


def count_long(
    tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, margin: int = 32
) -> int:
    """The number of tokens of a text, encoded in chunks."""
    total, start, first, end = 0, 0, 0, min(chunk, len(text))
    left = Cuts(tokenizer, text, 0, end)
    while end < len(text):
        width = overlap
        while True:
            begin = max(start, end - width)
            right = Cuts(tokenizer, text, begin, min(begin + width + chunk, len(text)))
            low = begin + 1 if begin == start else begin + margin
            place = _common_place(left, right, low, end - margin)
            if place is not None:
                total += left.token_at(place) - first
                left, start, end = right, place, right.end
                first = left.token_at(place)
                break
            if begin == start:  # one pre-token fills the chunk
                end = min(end + (end - start), len(text))
                left, first = Cuts(tokenizer, text, start, end), 0
                if end == len(text):
                    break
            width *= 2
    return total + left.tokens - first


def load(data: str):
    """A tokenizer from its JSON text, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallel part
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def margin_for(data: str) -> int:
    """How far a special token can reach across an end; raises if chunks cannot be spliced."""
    spec = json.loads(data)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    if spec.get("normalizer") or not plain:
        raise ValueError("chunks can be spliced for plain byte-level pre-tokenizers only")
    added = spec.get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError("added tokens that look beyond their own text cannot be spliced")
    return max([8, *(len(t["content"]) + 1 for t in added)])


def _counts(
    tokenizer, texts: Iterator[str], long_count: Callable[[str], int], chunk: int
) -> Iterator[int]:
    """Counts in order; short texts are encoded together."""
    held: list[str] = []
    size = 0
    for text in texts:
        if len(text) > chunk or size > BATCH_CHARS:
            for e in tokenizer.encode_batch_fast(held, add_special_tokens=False):
                yield len(e)
            held, size = [], 0
        if len(text) > chunk:
            yield long_count(text)
        else:
            held.append(text)
            size += len(text)
    for e in tokenizer.encode_batch_fast(held, add_special_tokens=False):
        yield len(e)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row, without a shuffle.

    No begin or end tokens are added; special strings inside a text count as the library's
    default has it. NULL and empty texts have no bytes and no tokens. The driver reads the
    tokenizer file; its text is broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        data = file.read()
    margin = margin_for(data)
    shared = docs.sparkSession.sparkContext.broadcast({"json": data})
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        tokenizer = kept.get("tokenizer")  # a worker keeps it beside the text it came from
        if tokenizer is None:
            tokenizer = kept["tokenizer"] = load(kept["json"])

        def long_count(text: str) -> int:
            return count_long(tokenizer, text, chunk, overlap, margin)

        for batch in batches:
            texts = (value.as_py() for value in batch.column(2))
            counts = list(_counts(tokenizer, texts, long_count, chunk))
            yield batch_of(schema, [batch.column(0), batch.column(1), counts])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"),
        text_of(text_col).alias("text"),
    )
    return rows.mapInArrow(kernel, "id long, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
