import glob
import os
import random
import shutil
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from helpers import COLUMNS, START, frame
from pyspark.sql import functions as F

from fleetpulse.operators import ticks as X
from fleetpulse.operators.shield import quality_shield
from fleetpulse.plans import marts as M
from fleetpulse.sources import frames as FR
from fleetpulse.sources import lake as K
from fleetpulse.sources import versions


def frames(spark, seconds, unit=1):
    return spark.createDataFrame([frame(unit=unit, second=s) for s in seconds], COLUMNS)


def test_loads_of_a_day_stand_side_by_side_and_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "lake")
    ingest = lambda df, day, load=None: K.write_lake(FR.with_ingest_columns(df, day), path, load)
    ingest(frames(spark, range(3)), "2024-01-01")
    ingest(frames(spark, range(5), unit=2), "2024-01-01")
    ingest(frames(spark, range(1)), "2024-01-01")
    ingest(frames(spark, range(4)), "2024-01-02", "named")
    ingest(frames(spark, range(2)), "2024-01-02", "named")
    lake = K.read_lake(spark, path)
    got = {
        (str(r.processing_date), r.unit_number): r["count"]
        for r in lake.groupBy("processing_date", "unit_number").count().collect()
    }
    assert got == {("2024-01-01", 1): 4, ("2024-01-01", 2): 5, ("2024-01-02", 1): 2}
    assert lake.first().corruption_reason == ""
    with pytest.raises(ValueError):
        ingest(frames(spark, range(2)), "2024-01-02", "compacted-by-hand")


def test_lake_scan_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "lake")
    K.write_lake(FR.with_ingest_columns(frames(spark, range(3)), "2024-01-01"), path)
    plan = (
        K.read_lake(spark, path)
        .filter((F.col("unit_number") == 1) & (F.col("processing_date") == "2024-01-01"))
        .select("T50")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "ReadSchema: struct<T50:double>" in plan
    assert "PartitionFilters: []" not in plan


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    for seconds, day in ((range(40), "2024-01-01"), (range(40, 80), "2024-01-01"), (range(4), "2024-01-02")):
        K.write_lake(FR.with_ingest_columns(frames(spark, seconds), day), path)
    K.compact_lake(spark, path, "2024-01-01")
    K.compact_lake(spark, path, "2024-01-03")
    assert K.read_lake(spark, path).count() == 84
    K.write_lake(FR.with_ingest_columns(frames(spark, range(9)), "2024-01-01"), path)
    assert K.read_lake(spark, path).count() == 93
    K.compact_lake(spark, path, "2024-01-01")
    day = K.read_lake(spark, path).filter("processing_date = DATE'2024-01-01'")
    assert day.count() == 89 and len(day.select("_metadata.file_path").distinct().collect()) == 1


def test_unpublished_compaction_is_not_read(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = K.lake_rows(FR.with_ingest_columns(frames(spark, range(5)), "2024-01-01"))
    K.write_lake(FR.with_ingest_columns(frames(spark, range(5)), "2024-01-01"), path)
    K._write_load(rows, path, "compacted-broken")
    assert K.read_lake(spark, path).count() == 5


def test_mart_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "mart")
    for seconds in ((0, 86_400), (0,)):
        clean = FR.with_ingest_columns(frames(spark, seconds), START)
        K.write_mart(M.health_mart(M.staging(clean)), path)
    assert K.read_mart(spark, path).count() == 1


def whole(mart):
    return sorted(
        (r.unit_number, r.time_cycles, str(r.event_timestamp), r.T50, r.t50_moving_avg_10)
        for r in mart.collect()
    )


@pytest.mark.parametrize("seed", range(3))
def test_refreshed_days_give_the_mart_of_a_full_build(spark, tmp_path, seed):
    """Cycles and days cross, so averages of other days, before and after, reach into the range."""
    rng, path = random.Random(seed), str(tmp_path / "mart")
    rows = [
        frame(unit=rng.randint(1, 3), cycle=rng.randint(1, 25), second=86_400 * rng.randint(0, 8) + n, T50=1400.0 + n * 7 % 31)
        for n in range(180)
    ]
    day = lambda r: (r[2] - START).days
    build = lambda some: M.staging(FR.with_ingest_columns(spark.createDataFrame(some, COLUMNS), START))
    K.write_mart(M.health_mart(build(rows)), path)
    # Of three days the middle one loses all its rows, the others some, and one gets new ones.
    newer = [r for r in rows if not 3 <= day(r) <= 5 or (day(r) != 4 and rng.random() < 0.6)]
    newer += [frame(unit=u, cycle=9, second=86_400 * 5 + 500 + u, T50=1333.0) for u in (1, 4)]
    span = [str((START + timedelta(days=d)).date()) for d in (3, 5)]
    for _ in range(2):
        M.refresh_mart_days(spark, build(newer), path, *span)
        assert whole(K.read_mart(spark, path)) == whole(M.health_mart(build(newer)))
    emptied = str((START + timedelta(days=4)).date())
    assert not K.read_mart(spark, path, [emptied]).count()


def test_a_mart_changes_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    build = lambda seconds: M.staging(FR.with_ingest_columns(frames(spark, seconds), START))
    K.write_mart(M.health_mart(build((0, 86_400))), path)
    before = whole(K.read_mart(spark, path))
    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            M.refresh_mart_days(spark, build((0,)), path, "2024-01-01", "2024-01-02")
    assert whole(K.read_mart(spark, path)) == before
    M.refresh_mart_days(spark, build((0,)), path, "2024-01-01", "2024-01-02")
    assert len(whole(K.read_mart(spark, path))) == 1
    with pytest.raises(ValueError):
        K.write_mart_days(M.health_mart(build((0, 86_400))), path, ["2024-01-01"])
    assert versions.expire_parts(spark, path, "event_date", 0) >= 1
    assert len(whole(K.read_mart(spark, path))) == 1


def test_two_writers_of_one_table_cannot_both_publish(spark, tmp_path):
    folder = versions.Folder(spark, str(tmp_path / "table"))
    versions.publish(folder, "state", 1, {"by": "one"})
    with pytest.raises(RuntimeError):
        versions.publish(folder, "state", 1, {"by": "two"})
    assert versions.latest(folder, "state") == (1, {"by": "one"})


def test_a_unit_of_a_split_day_lies_in_few_files(spark, tmp_path):
    path = str(tmp_path / "mart")
    rows = spark.range(8_000).select(
        (F.col("id") % 40 + 1).cast("int").alias("unit_number"), F.col("id").cast("int").alias("time_cycles"),
        (F.lit(START).cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("timestamp"),
        *[F.lit(1.0).alias(n) for n in ("T2", "T50", "P30", "Nf", "Nc", "phi", "htBleed")],
        F.lit(False).alias("is_corrupted"), F.array().cast("array<string>").alias("corruption_reason"),
    )
    conf = {"spark.sql.shuffle.partitions": "10", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        K.write_mart(M.health_mart(M.staging(rows)), path)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    mart = K.read_mart(spark, path).withColumn("file", F.input_file_name())
    assert mart.select("file").distinct().count() >= 8
    per_unit = mart.groupBy("unit_number").agg(F.countDistinct("file").alias("n")).collect()
    assert max(r.n for r in per_unit) <= 2
    # The statistics of the other files rule them out: their footers exclude the unit.
    ranges = []
    for file in glob.glob(f"{path}/version=*/event_date=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = [meta.schema.column(n).name for n in range(meta.num_columns)].index("unit_number")
        stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert sum(low <= 7 <= high for low, high in ranges) <= 2


def test_a_load_counts_once_its_marker_is_there(spark, tmp_path):
    path = str(tmp_path / "lake")
    ingest = lambda n, unit, load: K.write_lake(FR.with_ingest_columns(frames(spark, range(n), unit), "2024-01-01"), path, load)
    ingest(5, 1, "early")
    ingest(7, 2, "slow")
    marker = glob.glob(f"{path}/load_id=slow/attempt=*/_SUCCESS")[0]
    hidden = marker.replace("_SUCCESS", "_AWAY")
    os.rename(marker, hidden)  # as a commit that has moved some files and not yet ended
    assert K.read_lake(spark, path).count() == 5
    K.compact_lake(spark, path, "2024-01-01")
    assert K.expire_lake(spark, path, 0.01) == 0
    assert K.read_lake(spark, path).count() == 5
    os.rename(hidden, marker)
    assert K.read_lake(spark, path).count() == 12
    K.compact_lake(spark, path, "2024-01-01")
    assert K.read_lake(spark, path).count() == 12


def test_a_second_attempt_replaces_the_first_when_it_is_complete(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = lambda n, day="2024-01-01": FR.with_ingest_columns(frames(spark, range(n)), day)
    K.write_lake(rows(5), path, "named")
    bad = rows(3).withColumn("T50", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        K.write_lake(bad, path, "named")
    assert K.read_lake(spark, path).count() == 5
    K.write_lake(rows(2, "2024-01-02"), path, "named")
    assert [str(r.processing_date) for r in K.read_lake(spark, path).collect()] == ["2024-01-02"] * 2
    K.compact_lake(spark, path, "2024-01-02")
    with pytest.raises(ValueError, match="compacted"):
        K.write_lake(rows(4), path, "named")
    assert K.read_lake(spark, path).count() == 2


def test_a_load_written_again_during_a_compaction_stops_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    rows = lambda n: FR.with_ingest_columns(frames(spark, range(n)), "2024-01-01")
    K.write_lake(rows(5), path, "one")
    K.write_lake(rows(1), path, "two")
    write, again = K._write_load, []

    def meanwhile(df, where, load):
        write(df, where, load)
        if load.startswith("compacted-") and not again:
            again.append(load)
            K.write_lake(rows(3), path, "one")

    monkeypatch.setattr(K, "_write_load", meanwhile)
    with pytest.raises(RuntimeError, match="written again"):
        K.compact_lake(spark, path, "2024-01-01")
    assert K.read_lake(spark, path).count() == 4
    K.compact_lake(spark, path, "2024-01-01")
    assert K.read_lake(spark, path).count() == 4


def test_expiry_deletes_what_was_replaced_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "lake")
    for n in range(4):
        for day in ("2024-01-01", "2024-01-02"):
            K.write_lake(FR.with_ingest_columns(frames(spark, range(5), unit=n), day), path, f"s-{day}-{n}")
    K.write_lake(FR.with_ingest_columns(frames(spark, range(6), unit=0), "2024-01-02"), path, "s-2024-01-02-0")
    K.compact_lake(spark, path, "2024-01-01")
    plan = K.read_lake(spark, path)
    assert K.expire_lake(spark, path) == 0 and plan.count() == 41
    assert K.expire_lake(spark, path, 0) == 5
    assert K.read_lake(spark, path).count() == 41
    assert not glob.glob(f"{path}/load_id=s-2024-01-01-*")
    day, = glob.glob(f"{path}/_manifest/*")
    files = glob.glob(f"{day}/*.json")
    assert len(files) == 1 and '"loads": []' in open(files[0]).read()
    assert K.has_landed(spark, path, "s-2024-01-01", 3) and not K.has_landed(spark, path, "s-2024-01-01", 4)
    assert K.expire_lake(spark, path, 0) == 0


def test_the_plan_does_not_grow_with_loads(spark, tmp_path):
    path = str(tmp_path / "lake")
    plan = lambda: K.read_lake(spark, path)._jdf.queryExecution().executedPlan().toString()
    K.write_lake(FR.with_ingest_columns(frames(spark, range(2)), "2024-01-01"), path, "s-0")
    K.compact_lake(spark, path, "2024-01-01")
    short = len(plan())
    source = glob.glob(f"{path}/load_id=s-0/attempt=1")[0]
    for n in range(1, 300):
        shutil.copytree(source, f"{path}/load_id=s-{n}/attempt=1")
    K.compact_lake(spark, path, "2024-01-01")
    assert K.read_lake(spark, path).count() == 600
    assert len(plan()) < 1.2 * short


def test_stored_trend_prunes_days_and_units(spark, tmp_path):
    path = str(tmp_path / "mart")
    raw = FR.with_ingest_columns(frames(spark, range(3)), START)
    K.write_mart(M.health_mart(M.staging(raw)), path)
    trend = M.engine_trend(K.read_mart(spark, path), 1, "2024-01-01", "2024-01-02")
    text = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "EqualTo(unit_number,1)" in text
    assert "event_date" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_seed_gives_readers_a_schema(spark, tmp_path):
    path = str(tmp_path / "lake")
    K.seed_lake(spark, path, "2024-01-01 00:00:00")
    row = K.read_lake(spark, path).first()
    assert (row.unit_number, row.T50, row.Nc, row.is_corrupted) == (1, 641.82, 8138.62, False)
    assert M.staging(K.read_lake(spark, path)).count() == 1


def test_edge_files_are_snappy_without_dictionary_and_dated_by_start(spark, tmp_path):
    path = str(tmp_path / "edge")
    flights = spark.sql(
        "SELECT 7 AS unit_number, 3 AS time_cycles, 4 AS target_duration_sec, 10.0D AS T50,"
        " timestamp'2024-01-01 23:59:58' AS flight_start_time"
    )
    K.write_edge(X.edge_rows(X.expand_ticks(flights, hz=3), "run_1"), path)
    files = glob.glob(f"{path}/run_id=run_1/unit=7/date=2024-01-01/*.parquet")
    assert files and files == glob.glob(f"{path}/**/*.parquet", recursive=True)
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert column.compression == "SNAPPY" and "RLE_DICTIONARY" not in column.encodings
    back = K.read_edge(spark, path)
    assert back.count() == 12 and str(back.first().date) == "2024-01-01"
    assert {r.timestamp.microsecond % 1000 for r in back.collect()} == {0}


def test_shield_feeds_lake_staging_and_mart(spark, tmp_path):
    lake, mart = str(tmp_path / "lake"), str(tmp_path / "mart")
    rows = [frame(cycle=n, second=86_400 * (n // 3) + n, T50=1400.0 + n) for n in range(12)]
    rows.append(frame(cycle=2, second=99, T50=500.0))
    df = spark.createDataFrame(rows, COLUMNS)
    shielded = quality_shield(df, F.col("timestamp"))
    K.write_lake(FR.with_ingest_columns(shielded, START), lake)
    K.write_mart(M.health_mart(M.staging(K.read_lake(spark, lake))), mart)
    stored = K.read_mart(spark, mart)
    trend = M.engine_trend(stored, 1, "2024-01-02", "2024-01-03")
    assert [r.time_cycles for r in trend.collect()] == list(range(3, 9))
    assert "PartitionFilters: []" not in trend._jdf.queryExecution().executedPlan().toString()
    long = M.trend_long(trend)
    assert long.columns == ["time_cycles", "event_timestamp", "variable", "value"]
    assert long.count() == 12


def test_tables_are_rebuilt(spark):
    df = frames(spark, range(3))
    K.rebuild_table(df, "frames_table")
    K.rebuild_table(df, "frames_table")
    assert spark.table("frames_table").count() == 3
    K.save_mart(M.health_mart(M.staging(FR.with_ingest_columns(df, START))), "mart_table")
    assert spark.table("mart_table").count() == 3
    spark.sql("DROP TABLE frames_table")
    spark.sql("DROP TABLE mart_table")


@pytest.mark.parametrize("limit", [2_000_000, 7])
def test_moving_average_by_hand(spark, limit):
    from fleetpulse.settings import MartSettings

    values = [None if n % 6 == 5 else 1400.0 + (n * 7) % 13 for n in range(50)]
    rows = [frame(cycle=n // 12, second=n, T50=v) for n, v in enumerate(values)]
    stg = M.staging_view(
        FR.with_ingest_columns(spark.createDataFrame(rows, COLUMNS), START), "stg_for_test"
    )
    mart = M.health_mart(stg, MartSettings(max_run_rows=limit)).orderBy("event_timestamp").collect()
    for n, row in enumerate(mart):
        frame_values = [v for v in values[max(0, n - 9) : n + 1] if v is not None]
        assert row.t50_moving_avg_10 == pytest.approx(sum(frame_values) / len(frame_values))
        assert row.egt_margin == (None if values[n] is None else 1450 - values[n])
