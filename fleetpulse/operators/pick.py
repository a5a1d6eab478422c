"""One whole row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.schema import CYCLE, FRAME_KEY, TS, UNIT


def lowest_row(df: DataFrame, keys: tuple[str, ...], by: Column) -> DataFrame:
    """The row with the lowest ``by`` for each key.

    ``min_by`` per column over a fixed-width ``by`` keeps a hash aggregate, and rows of a key
    collapse before the shuffle. All columns come from one row because each of them sees the
    same rows in the same order. Rows with a NULL ``by`` never win.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = df.withColumn("_by", by)
    picked = [F.min_by(F.col(c), F.col("_by")).alias(c) for c in rest]
    return ranked.groupBy(*keys).agg(*picked).select(*df.columns)


def content_hash(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """A hash of all columns but the keys, by which copies are ranked."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    return F.xxhash64(*rest) if rest else F.lit(0)


def drop_duplicate_frames(df: DataFrame, keys: tuple[str, ...] = FRAME_KEY) -> DataFrame:
    """Keep one frame per key. Which of several different copies stays does not depend on
    partitioning or retries: it is the one whose content hashes lowest."""
    return lowest_row(df, keys, content_hash(df, keys))


def drop_duplicates_by_unit(df: DataFrame) -> DataFrame:
    """The same choice, for frames that then go through windows along a unit.

    Frames move once, by unit, and the sort that finds copies is the one the windows need.
    Copies are not collapsed before the shuffle, so use it only when no unit is long.
    """
    # The key in run order, so that the windows after it find their sort done.
    copies = Window.partitionBy(UNIT, TS, CYCLE).orderBy("_by")
    return (
        df.withColumn("_by", content_hash(df, FRAME_KEY))
        .repartition(UNIT)
        .withColumn("_place", F.row_number().over(copies))
        .filter(F.col("_place") == 1)
        .drop("_by", "_place")
    )


def top_rows(df: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first ``count`` rows in this order; each task keeps that many at most."""
    return df.orderBy(*order).limit(count)
