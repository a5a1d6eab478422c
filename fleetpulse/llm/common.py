"""Reading, words and shingles that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GAP = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_values(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each string, one at a time; NULL gives none."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def word_blocks(data: bytes, limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Words between ASCII white space, in lists cut from about ``limit`` bytes each.

    A long text never lies in memory as one list of words.
    """
    start = 0
    while start < len(data):
        if len(data) - start <= limit:
            yield data[start:].split()
            return
        gap = _GAP.search(data, start + limit)
        end = gap.start() if gap else len(data)
        yield data[start:end].split()
        start = end


def shingle_hashes(data: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``width`` words joined by one space, repeats included.

    A text with fewer words gives the hash of all of them; one without words gives nothing.
    """
    digest = xxhash.xxh64_intdigest
    carry: list[bytes] = []
    whole = True
    for block in word_blocks(data):
        words = carry + block
        count = len(words) - width + 1
        if count > 0:
            whole = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:count - 1]]).tolist()
            stops = (ends[width - 1 :] - 1).tolist()
            yield np.array(
                [digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64
            )
        carry = words[len(words) - min(len(words), width - 1) :]
    if whole and carry:
        yield np.array([digest(b" ".join(carry), seed)], np.uint64)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
         for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
