"""Warehouse models: staging, health mart, and the trend served from it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.checks import reasons_as_text
from fleetpulse.functions.times import date_literal
from fleetpulse.operators.split_runs import (
    HOUR, MILLI, MINUTE, SECOND, Runs, over_runs, plan_cuts,
)
from fleetpulse.schema import AVERAGE, CYCLE, EVENT_TS, FLAG, REASON, TS, UNIT, mart_schema
from fleetpulse.session import cut_lineage
from fleetpulse.settings import MartSettings
from fleetpulse.sources.lake import read_mart, write_mart_days

DEFAULTS = MartSettings()

# Many ticks share a cycle, so event time settles their order.
HEALTH_RUNS = Runs(
    keys=(UNIT,),
    order=(CYCLE, EVENT_TS),
    levels=(
        (CYCLE, 16), (CYCLE, 1),
        (EVENT_TS, HOUR), (EVENT_TS, MINUTE), (EVENT_TS, SECOND), (EVENT_TS, MILLI),
    ),
)
CYCLE_RUNS = Runs(keys=(UNIT,), order=(CYCLE,), levels=((CYCLE, 16), (CYCLE, 1)))


def staging(raw: DataFrame, settings: MartSettings = DEFAULTS) -> DataFrame:
    """Clean frames with the columns the mart needs; a frame without a flag is not clean."""
    return raw.filter(F.col(FLAG) == F.lit(False)).select(
        UNIT,
        CYCLE,
        F.col(TS).alias(EVENT_TS),
        "T2", "T50", "P30", "Nf", "Nc", "phi", "htBleed",
        (F.lit(settings.egt_limit) - F.col("T50")).alias("egt_margin"),
        FLAG,
        REASON,
    )


def staging_view(raw: DataFrame, name: str = "stg_telemetry") -> DataFrame:
    """Publish staging as a view; nothing is computed until it is read."""
    staging(raw).createOrReplaceTempView(name)
    return raw.sparkSession.table(name)


def health_mart(
    stg: DataFrame, settings: MartSettings = DEFAULTS, sized_by: DataFrame | None = None
) -> DataFrame:
    """Staging plus the event date and the moving average of T50 over the last rows.

    ``sized_by`` has the key and order columns of a cheaper superset, such as the raw frames,
    to find long units by. It affects the plan only: any cut of a run gives the same result.
    """
    back = settings.frame_rows - 1

    def average(df: DataFrame, window) -> DataFrame:
        return df.withColumn(AVERAGE, F.avg("T50").over(window.rowsBetween(-back, 0)))

    dated = stg.withColumn("event_date", F.to_date(EVENT_TS))
    sized_by = stg if sized_by is None else sized_by
    cuts = plan_cuts(sized_by, HEALTH_RUNS, settings.max_run_rows)
    return over_runs(dated, HEALTH_RUNS, back, average, cuts, carry=("T50",)).select(
        *dated.columns, AVERAGE
    )


def refresh_mart_days(
    spark: SparkSession, stg: DataFrame, path: str, start: date | str, end: date | str,
    settings: MartSettings = DEFAULTS,
) -> None:
    """Bring a stored mart up to date after staging changed between two event dates.

    The result is that of a full build over ``stg``. A change of a row also changes the averages of
    up to ``frame_rows - 1`` rows of its unit after it, in the mart's order, on whatever days
    those lie. So for each unit the rows from the first changed place to the last, before or now,
    and the next few, are computed again, with the few before them as a look-back. The days they
    lie on are rewritten, with their other rows as they are, and published in one step.

    Both the old mart and ``stg`` are read once for places (two columns) and once for rows; the few
    rows before and after come from a top-n per unit that each task cuts down before the shuffle.
    """
    first, last = date_literal(start), date_literal(end)
    place = F.struct(CYCLE, EVENT_TS)
    old = read_mart(spark, path)
    inside = F.col("event_date").between(first, last)
    places = (
        stg.filter(F.to_date(EVENT_TS).between(first, last)).select(UNIT, place.alias("_place"))
        .unionByName(old.filter(inside).select(UNIT, place.alias("_place")))
    )
    reach = cut_lineage(
        places.groupBy(UNIT)
        .agg(F.min("_place").alias("_low"), F.max("_place").alias("_high"))
        .withColumnRenamed(UNIT, "_unit")
    )
    rows = stg.withColumn("_place", place).join(reach, F.col(UNIT).eqNullSafe(F.col("_unit")))
    back = settings.frame_rows - 1

    def nearest(some: DataFrame, order: Column) -> DataFrame:
        ranked = some.withColumn("_rank", F.row_number().over(Window.partitionBy(UNIT).orderBy(order)))
        return ranked.filter(F.col("_rank") <= back).drop("_rank")

    before = nearest(rows.filter(F.col("_place") < F.col("_low")), F.col("_place").desc())
    after = nearest(rows.filter(F.col("_place") > F.col("_high")), F.col("_place"))
    between = rows.filter(F.col("_place").between(F.col("_low"), F.col("_high")))
    near = cut_lineage(before.unionByName(between).unionByName(after).select(*stg.columns))
    again = cut_lineage(
        health_mart(near, settings)
        .withColumn("_place", place)
        .join(reach.drop("_high"), F.col(UNIT).eqNullSafe(F.col("_unit")))
        .filter(F.col("_place") >= F.col("_low"))
        .drop("_unit", "_low")
    )
    ends = again.groupBy(UNIT).agg(F.max("_place").alias("_last"))
    spans = (
        reach.join(ends.withColumnRenamed(UNIT, "_of"), F.col("_unit").eqNullSafe(F.col("_of")), "left")
        .select("_unit", "_low", F.greatest("_high", F.coalesce("_last", "_high")).alias("_last"))
    )
    days = {r.event_date for r in again.select("event_date").distinct().collect()}
    days |= {r.event_date for r in old.filter(inside).select("event_date").distinct().collect()}
    # A unit's rows in its span were computed again or are gone; the rest of these days stays.
    kept = read_mart(spark, path, sorted(days)).withColumn("_place", place)
    kept = kept.join(spans, F.col(UNIT).eqNullSafe(F.col("_unit")), "left").filter(
        F.col("_low").isNull() | ~F.col("_place").between(F.col("_low"), F.col("_last"))
    )
    columns = mart_schema().names
    again = again.withColumn(REASON, reasons_as_text()) if _is_array(again) else again
    write_mart_days(again.select(*columns).unionByName(kept.select(*columns)), path, days)


def _is_array(df: DataFrame) -> bool:
    return isinstance(df.schema[REASON].dataType, T.ArrayType)


def health_per_cycle(
    stg: DataFrame, settings: MartSettings = DEFAULTS, sized_by: DataFrame | None = None
) -> DataFrame:
    """One row per unit and cycle: mean T50, and the mean of all readings in the last cycles.

    Readings collapse to a sum and a count map-side, so the window sees cycles, not ticks.
    """
    back = settings.frame_rows - 1
    cycles = stg.groupBy(UNIT, CYCLE).agg(
        F.count(F.lit(1)).alias("frames"),
        F.count("T50").alias("_n"),
        F.sum("T50").alias("_total"),
    )

    def average(df: DataFrame, window) -> DataFrame:
        frame = window.rowsBetween(-back, 0)
        return df.withColumn(
            "t50_avg_10_cycles", F.sum("_total").over(frame) / _positive(F.sum("_n").over(frame))
        )

    sized_by = cycles if sized_by is None else sized_by
    cuts = plan_cuts(sized_by, CYCLE_RUNS, settings.max_run_rows)
    result = over_runs(cycles, CYCLE_RUNS, back, average, cuts, carry=("_n", "_total"))
    return result.select(
        UNIT, CYCLE, "frames",
        (F.col("_total") / _positive(F.col("_n"))).alias("t50_avg"),
        "t50_avg_10_cycles",
    )


def _positive(count):
    """Division by zero is NULL, as an average over nothing is."""
    return F.when(count > 0, count)


def sizes_of(frames: DataFrame) -> DataFrame:
    """Raw frames as something to find long units by."""
    return frames.select(UNIT, CYCLE, F.col(TS).alias(EVENT_TS))


def engine_trend(mart: DataFrame, unit: int, start: date | str, end: date | str) -> DataFrame:
    """Trend of one unit between two dates, both included, in cycle order.

    The filter names the partition column, so a stored mart reads only the days asked for.
    """
    return (
        mart.filter(
            (F.col(UNIT) == F.lit(unit))
            & F.col("event_date").between(date_literal(start), date_literal(end))
        )
        .select(CYCLE, "T50", AVERAGE, EVENT_TS)
        .orderBy(CYCLE, EVENT_TS)
    )


def trend_long(trend: DataFrame) -> DataFrame:
    """Both series of a trend on one axis, as a chart wants them."""
    return trend.unpivot([CYCLE, EVENT_TS], ["T50", AVERAGE], "variable", "value")
