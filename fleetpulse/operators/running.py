"""Running totals over runs of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.operators.split_runs import Runs, plan_cuts


def running_sum(df: DataFrame, runs: Runs, value: str, name: str, max_rows: int) -> DataFrame:
    """Sum of an integer column from the start of the run to each row.

    Long runs are summed per block, block totals are summed along the run (one row per
    block), and each row adds the total before its block.
    """
    cuts = plan_cuts(df, runs, max_rows)
    if cuts is None:
        window = runs.window().rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(window))
    blocks = cuts.blocks
    tagged = cuts.tag(df).drop("_split")
    totals = tagged.groupBy(*runs.keys, *blocks).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*runs.keys).orderBy(*blocks).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(k).alias(f"_k{k}") for k in (*runs.keys, *blocks)],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy(*runs.keys, *blocks)
        .orderBy(*runs.order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = tagged.withColumn("_inside", F.sum(value).over(inside))
    same = F.lit(True)
    for key in (*runs.keys, *blocks):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{key}"))
    return summed.join(offsets, same).select(
        *df.columns, (F.col("_inside") + F.col("_offset")).alias(name)
    )
