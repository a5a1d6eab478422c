"""Remaining useful life: training labels, and truth given per test unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.operators.joins import join_checked
from fleetpulse.schema import CYCLE, UNIT


def last_cycles(df: DataFrame) -> DataFrame:
    return df.groupBy(UNIT).agg(F.max(CYCLE).alias("last_cycle"))


def label_training(df: DataFrame) -> DataFrame:
    """Cycles left until the unit's last one, at which it failed.

    The maximum is aggregated map-side and joined back, so no task holds a whole unit.
    """
    labelled = join_checked(df, last_cycles(df), [UNIT], "inner")
    return labelled.select(*df.columns, (F.col("last_cycle") - F.col(CYCLE)).alias("rul"))


def join_truth(df: DataFrame, truth: DataFrame) -> DataFrame:
    """Label test rows from ``truth(unit_number, rul)``, which counts from each unit's last
    observed cycle. Units without truth are dropped."""
    ends = last_cycles(df).join(truth.withColumnRenamed("rul", "_truth"), [UNIT])
    labelled = join_checked(df, ends, [UNIT], "inner")
    return labelled.select(
        *df.columns, (F.col("_truth") + F.col("last_cycle") - F.col(CYCLE)).alias("rul")
    )


def check_truth(df: DataFrame, truth: DataFrame) -> DataFrame:
    """Units that are in only one of the two inputs; empty when they fit together."""
    seen = df.select(UNIT).distinct().withColumn("_seen", F.lit(True))
    given = truth.select(UNIT).withColumn("_given", F.lit(True))
    return (
        seen.join(given, [UNIT], "full")
        .filter(F.col("_seen").isNull() | F.col("_given").isNull())
        .select(UNIT, F.col("_given").isNotNull().alias("has_truth"))
    )
