"""Shapes of the plans that must hold at scale."""

from helpers import COLUMNS, START, frame
from pyspark.sql import functions as F

from fleetpulse.operators.ledger import next_pending
from fleetpulse.operators.shield import quality_shield
from fleetpulse.plans import marts as M
from fleetpulse.settings import MartSettings, ShieldSettings
from fleetpulse.sources.frames import with_ingest_columns


def stored(spark, tmp_path, count=200):
    rows = [frame(unit=1 + n % 3, cycle=n // 20, second=n) for n in range(count)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "frames"))
    return spark.read.parquet(str(tmp_path / "frames"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shield_moves_and_sorts_frames_once(spark, tmp_path):
    text = plan(quality_shield(stored(spark, tmp_path), START))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("+- Sort [") + text.count(":- Sort [") == 1
    assert "GreaterThanOrEqual(timestamp" in text  # the age filter reaches the scan


def test_long_units_are_combined_before_the_shuffle(spark, tmp_path):
    text = plan(quality_shield(stored(spark, tmp_path), START, ShieldSettings(max_run_rows=20)))
    assert "partial_min_by" in text
    assert "row_number(), 4, Partial" in text
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_mart_reads_only_its_columns_and_moves_rows_once(spark, tmp_path):
    raw = with_ingest_columns(stored(spark, tmp_path), START)
    text = plan(M.health_mart(M.staging(raw)).select("unit_number", M.AVERAGE))
    assert text.count("Exchange hashpartitioning") == 1
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "P30" not in schema and "htBleed" not in schema


def test_copies_for_the_mart_read_few_columns(spark, tmp_path):
    raw = with_ingest_columns(stored(spark, tmp_path), START)
    text = plan(M.health_mart(M.staging(raw), MartSettings(max_run_rows=20)))
    schemas = [part.split("\n")[0] for part in text.split("ReadSchema: ")[1:]]
    assert any("P30" not in s for s in schemas)


def test_trend_filter_on_unit_reaches_the_scan(spark, tmp_path):
    raw = with_ingest_columns(stored(spark, tmp_path), START)
    text = plan(M.engine_trend(M.health_mart(M.staging(raw)), 2, "2024-01-01", "2024-01-02"))
    assert "EqualTo(unit_number,2)" in text


def test_next_pending_hashes_instead_of_sorting(spark):
    df = spark.range(10).select(
        F.lit("PENDING").alias("status"), F.col("id").cast("int").alias("unit_number"),
        F.col("id").cast("int").alias("time_cycles"), F.lit(1.0).alias("T50"),
    )
    text = plan(next_pending(df))
    assert "HashAggregate" in text and "SortAggregate" not in text
