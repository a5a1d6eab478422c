import math
from datetime import timedelta

import pytest
from helpers import (
    COLUMNS, START, as_results, frame, plain_results, random_frames, shield_by_hand,
    unique_by_key,
)
from pyspark.sql import functions as F

from fleetpulse.functions.checks import with_quality_columns
from fleetpulse.operators import shield as S
from fleetpulse.operators.pick import drop_duplicate_frames, drop_duplicates_by_unit
from fleetpulse.settings import ShieldSettings


def flags(df):
    rows = df.orderBy("timestamp", "time_cycles").collect()
    return [",".join(r.corruption_reason) for r in rows]


def make(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_age_limit_is_inclusive_and_future_stays(spark):
    ages = [3599, 3600, 3600.5, 3601, -50]
    df = make(spark, [frame(second=-a) for a in ages] + [frame(second=None)])
    kept = S.drop_stale(df, START).collect()
    assert sorted((START - r.timestamp).total_seconds() for r in kept) == [-50, 3599, 3600]


def test_sla_counts_whole_seconds(spark):
    df = make(spark, [frame(second=-s) for s in (299, 300, 300.5, 301)])
    got = {(START - r.timestamp).total_seconds(): r.is_corrupted for r in S.flag_sla(df, START).collect()}
    # 300.5 s before midnight lies in the second that began 301 s before it
    assert got == {299: False, 300: False, 300.5: True, 301: True}


def test_schema_rot_values(spark):
    values = [390.0, None, math.nan, math.inf, -math.inf, 0.0]
    df = make(spark, [frame(second=n, htBleed=v) for n, v in enumerate(values)])
    out = S.flag_schema_rot(df).orderBy("timestamp").collect()
    assert [r.is_corrupted for r in out] == [False, True, True, True, True, False]
    assert [r.htBleed for r in out] == [390.0, None, None, None, None, 0.0]


def test_thermocouple_needs_a_turning_rotor(spark):
    rows = [
        frame(second=0, T50=500.0), frame(second=1, T50=500.0, Nf=2000.0),
        frame(second=2, T50=518.0), frame(second=3, T50=None), frame(second=4, T50=math.nan),
        frame(second=5, T50=500.0, Nf=None),
    ]
    out = S.flag_thermocouple_break(make(spark, rows)).orderBy("timestamp").collect()
    assert [r.is_corrupted for r in out] == [True, False, False, False, False, False]
    assert out[0].T50 is None and out[1].T50 == 500.0


def test_zombie_allows_equal_cycles_and_first_row(spark):
    df = make(spark, [frame(cycle=c, second=n) for n, c in enumerate([5, 5, 6, 4, None, 3, 2])])
    assert flags(S.flag_zombie_state(df)) == [
        "", "", "", "ZOMBIE_STATE_DETECTED", "", "", "ZOMBIE_STATE_DETECTED"
    ]


def test_freeze_starts_at_the_fifth_row_and_sees_raw_values(spark):
    rows = [frame(second=n, Nc=8000.0 + n) for n in range(7)]
    out = S.flag_sensor_freeze(make(spark, rows)).orderBy("timestamp").collect()
    assert [r.is_corrupted for r in out] == [False] * 4 + [True] * 3
    assert [r.P30 for r in out] == [554.0] * 4 + [None] * 3


def test_freeze_needs_changing_speed_and_counts_nan_runs(spark):
    still = [frame(second=n) for n in range(6)]
    assert flags(S.flag_sensor_freeze(make(spark, still))) == [""] * 6
    nan_run = [frame(second=n, P30=math.nan, Nc=8000.0 + n) for n in range(5)]
    assert flags(S.flag_sensor_freeze(make(spark, nan_run)))[-1] == "SENSOR_FREEZE"
    null_run = [frame(second=n, P30=None, Nc=8000.0 + n) for n in range(5)]
    assert flags(S.flag_sensor_freeze(make(spark, null_run)))[-1] == ""


def test_broken_row_and_its_successor_are_not_drift(spark):
    rows = [
        frame(second=0, phi=1.0, T50=1400.0),
        frame(second=1, phi=2.0, T50=500.0),
        frame(second=2, phi=3.0, T50=1300.0),
        frame(second=3, phi=4.0, T50=1200.0),
    ]
    out = S.quality_shield(make(spark, rows), START + timedelta(seconds=4))
    assert flags(out) == ["", "THERMOCOUPLE_BREAK", "", "ADVERSARIAL_DRIFT"]


def test_drift_is_skipped_without_fuel_flow(spark):
    df = make(spark, [frame(second=n) for n in range(3)]).drop("phi")
    assert flags(S.quality_shield(df, START)) == [""] * 3
    assert S.flag_adversarial_drift(df).columns == [*df.columns, "is_corrupted", "corruption_reason"]


@pytest.mark.parametrize("limit", [2_000_000, 60, 9])
def test_pipeline_matches_plain_python_however_runs_are_split(spark, limit):
    rows = unique_by_key(random_frames(900))
    as_of = START + timedelta(seconds=900 * 40)
    expected = shield_by_hand(rows, as_of, max_age=30_000, sla=9_000)
    settings = ShieldSettings(max_age_seconds=30_000, sla_seconds=9_000, max_run_rows=limit)
    doubled = make(spark, rows + rows[::7]).repartition(5)
    got = as_results(S.quality_shield(doubled, as_of, settings))
    assert got == plain_results(expected)
    assert {r for v in got.values() for r in v[0]} == set(S.C.REASONS)


def test_one_frame_copied_many_times_and_one_hot_instant(spark):
    """Copies of one frame, and cycles that share one instant, each a third of the rows."""
    rows = [frame(cycle=1, second=10)] * 400
    rows += [frame(cycle=n, second=20, Nc=8000.0 + n % 3, phi=520.0 + n % 5) for n in range(400)]
    rows += [frame(unit=2 + n % 9, cycle=n, second=n % 97, T50=1400.0 - n % 4) for n in range(400)]
    as_of = START + timedelta(seconds=100)
    expected = shield_by_hand(unique_by_key(rows), as_of)
    got = as_results(S.quality_shield(make(spark, rows), as_of, ShieldSettings(max_run_rows=40)))
    assert got == plain_results(expected)


def test_flagging_twice_changes_nothing(spark):
    df = make(spark, random_frames(60))
    once = S.flag_schema_rot(df)
    assert flags(S.flag_schema_rot(once)) == flags(once)
    text = once.withColumn("corruption_reason", F.array_join("corruption_reason", ","))
    assert flags(with_quality_columns(text)) == flags(once)


def test_survivor_of_different_copies_does_not_depend_on_partitions(spark, rows_of):
    rows = [frame(second=n % 5, T50=1400.0 + n) for n in range(60)]
    df = make(spark, rows)
    picks = [
        rows_of(f(df.repartition(p)).select(*df.columns))
        for p in (1, 3, 8)
        for f in (drop_duplicate_frames, drop_duplicates_by_unit)
    ]
    assert all(p == picks[0] for p in picks)
    assert len(picks[0]) == 5 and set(picks[0]) <= {tuple(r) for r in rows}


def test_per_row_reference_time(spark):
    df = make(spark, [frame(second=0), frame(second=1)]).withColumn(
        "processing_at", F.col("timestamp") + F.expr("INTERVAL 301 SECONDS")
    )
    assert flags(S.quality_shield(df, F.col("processing_at"))) == ["SLA_VIOLATION"] * 2


def test_rejection_summary_counts_each_reason(spark, rows_of):
    rows = [frame(second=0, htBleed=None, T50=500.0), frame(second=1, htBleed=None)]
    out = S.quality_shield(make(spark, rows), START)
    assert rows_of(S.rejection_summary(out)) == [("SCHEMA_ROT", 2), ("THERMOCOUPLE_BREAK", 1)]
