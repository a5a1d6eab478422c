from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators import ledger as L
from fleetpulse.operators import rul as R
from fleetpulse.operators import ticks as X
from fleetpulse.schema import SENSORS
from fleetpulse.settings import FlightSettings

ANCHOR = datetime(2026, 1, 1)
COLUMNS = (
    "status string, flight_start_time timestamp, target_duration_sec int,"
    " unit_number int, time_cycles int"
)


def ledger(spark, *rows):
    return spark.createDataFrame([(s, None, None, u, c) for u, c, s in rows], COLUMNS)


def states(df):
    return {(r.unit_number, r.time_cycles): r.status for r in df.collect()}


def test_recovery(spark):
    df = ledger(
        spark, (1, 1, "IN_FLIGHT"), (1, 2, "INTERRUPTED"), (1, 3, "FAILED"), (1, 4, "COMPLETED")
    )
    assert list(states(L.recover_ledger(df)).values()) == ["PENDING", "PENDING", "FAILED", "COMPLETED"]


def test_next_pending_and_reservation(spark):
    df = ledger(
        spark, (1, 5, "PENDING"), (1, 4, "PENDING"), (1, 3, "COMPLETED"), (2, 1, "FAILED"), (3, 9, "PENDING")
    )
    assert states(L.next_pending(df)) == {(1, 4): "PENDING", (3, 9): "PENDING"}
    booked = L.reserve_next(df, ANCHOR, L.REALTIME).filter("status = 'IN_FLIGHT'").collect()
    assert {(r.unit_number, r.time_cycles) for r in booked} == {(1, 4), (3, 9)}
    assert {r.flight_start_time for r in booked} == {ANCHOR}
    assert all(120 <= r.target_duration_sec <= 300 for r in booked)
    later = L.reserve_next(df, ANCHOR).filter("status = 'IN_FLIGHT'").collect()
    assert all(15 <= (r.flight_start_time - ANCHOR).total_seconds() <= 30 for r in later)
    with pytest.raises(ValueError):
        L.reserve_next(df, ANCHOR, "FAST")


def test_later_bookings_never_overlap_earlier_ones(spark):
    df = spark.createDataFrame(
        [(u, c, "PENDING", None, None) for u in (1, 2) for c in range(1, 7)],
        "unit_number int, time_cycles int, status string, flight_start_time timestamp, target_duration_sec int",
    )
    for _ in range(3):
        df = L.reserve_next(df, ANCHOR).replace("IN_FLIGHT", "COMPLETED", "status")
    rest = L.schedule_flights(df, ANCHOR)
    booked = df.filter("status = 'COMPLETED'").unionByName(rest).collect()
    assert len(booked) == 12
    for unit in (1, 2):
        mine = sorted((r.flight_start_time, r.target_duration_sec) for r in booked if r.unit_number == unit)
        assert all((b[0] - a[0]).total_seconds() >= a[1] for a, b in zip(mine, mine[1:]))


def test_last_report_wins_and_unknown_flights_are_ignored(spark):
    df = ledger(spark, (1, 1, "IN_FLIGHT"), (1, 2, "IN_FLIGHT"))
    reports = spark.createDataFrame(
        [(1, 1, "COMPLETED", 1), (1, 1, "FAILED", 2), (9, 9, "COMPLETED", 3)],
        "unit_number int, time_cycles int, status string, seq int",
    )
    assert states(L.apply_status_reports(df, reports)) == {(1, 1): "FAILED", (1, 2): "IN_FLIGHT"}


@pytest.mark.parametrize("limit", [2_000_000, 20])
def test_schedules_never_overlap(spark, limit):
    rows = [(1 if n % 3 else n % 5 + 1, n, "PENDING") for n in range(300)]
    out = L.schedule_flights(ledger(spark, *rows), ANCHOR, max_run_rows=limit)
    runs = {}
    for r in out.orderBy("unit_number", "time_cycles").collect():
        runs.setdefault(r.unit_number, []).append(r)
    for run in runs.values():
        end = ANCHOR
        for r in run:
            assert 15 <= (r.flight_start_time - end).total_seconds() <= 30
            assert 120 <= r.target_duration_sec <= 300
            end = r.flight_start_time + timedelta(seconds=r.target_duration_sec)


def test_draws_reach_both_ends(spark):
    settings = FlightSettings(min_duration_sec=1, max_duration_sec=3, idle_min_sec=0, idle_max_sec=1)
    out = L.schedule_flights(ledger(spark, *[(1, n, "PENDING") for n in range(100)]), ANCHOR, settings)
    assert {r.target_duration_sec for r in out.collect()} == {1, 2, 3}


@pytest.mark.parametrize(
    "wrong",
    [{"min_duration_sec": 0}, {"min_duration_sec": 400}, {"idle_min_sec": -1}, {"idle_min_sec": 31}, {"hz": 0}],
)
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        FlightSettings(**wrong)


def test_run_summary_counts(spark):
    flights = spark.createDataFrame(
        [("a", "COMPLETED", 10), ("a", "COMPLETED", 5), ("a", "INTERRUPTED", 3),
         ("a", "INTERRUPTED", 0), ("a", "FAILED", 9), ("b", "PENDING", None)],
        "run_id string, status string, target_duration_sec int",
    )
    got = sorted(map(tuple, L.run_summary(flights, hz=100).collect()))
    assert got == [("a", 2, 1500, 3, 1), ("b", 0, 0, 0, 0)]


def test_outcomes(spark):
    df = spark.createDataFrame(
        [(True, False, 9), (False, False, 9), (True, True, 4), (True, True, 0)],
        "ok boolean, stopped boolean, elapsed int",
    )
    got = df.select(L.outcome_status(F.col("ok"), F.col("stopped"), F.col("elapsed"))).collect()
    assert [r[0] for r in got] == ["COMPLETED", "FAILED", "INTERRUPTED", None]


def test_latest_run_and_duplicates(spark, rows_of):
    df = spark.createDataFrame(
        [("r1", 1, 1, 0), ("r2", 1, 1, 0), ("r2", 1, 1, 1), ("r1", 1, 2, 0)],
        "run_id string, unit_number int, time_cycles int, tick int",
    )
    assert rows_of(L.latest_run_per_flight(df)) == [("r1", 1, 2, 0), ("r2", 1, 1, 0), ("r2", 1, 1, 1)]
    assert rows_of(L.duplicate_flights(df)) == [(1, 1, 3)]


def flights(spark, *durations):
    columns = ", ".join(f"{100.0 + n}D AS {name}" for n, name in enumerate(SENSORS) if name != "epr")
    rows = " UNION ALL ".join(
        f"SELECT 1 AS unit_number, {n} AS time_cycles, {d} AS target_duration_sec,"
        f" timestamp'2026-01-01 00:00:00' AS flight_start_time, 0.0D AS epr, {columns}"
        for n, d in enumerate(durations)
    )
    return spark.sql(rows)


def test_ticks_per_flight_and_their_times(spark):
    out = X.expand_ticks(flights(spark, 0, 1, 61, 130), hz=7)
    counts = {r.time_cycles: r["count"] for r in out.groupBy("time_cycles").count().collect()}
    assert counts == {1: 7, 2: 427, 3: 910}
    step = 1_000_000_000 // 7
    for r in out.filter("time_cycles = 3").collect():
        assert r.timestamp == ANCHOR + timedelta(microseconds=r.tick * step // 1000)


def test_noise_is_small_exact_where_promised_and_independent_of_partitions(spark, rows_of):
    ticks = X.expand_ticks(flights(spark, 40), hz=50)
    noisy = X.with_noise(ticks, "run")
    assert rows_of(noisy) == rows_of(X.with_noise(ticks.repartition(9), "run"))
    assert rows_of(noisy) != rows_of(X.with_noise(ticks, "other"))
    z = noisy.select(((F.col("T50") - 106.0) / 106.0 / 1e-4).alias("a"), ((F.col("T30") - 105.0) / 105.0 / 1e-4).alias("b"))
    stats = z.select(F.avg("a"), F.stddev("a"), F.avg("b"), F.stddev("b"), F.corr("a", "b")).first()
    assert abs(stats[0]) < 0.08 and abs(stats[2]) < 0.08 and abs(stats[4]) < 0.08
    assert abs(stats[1] - 1) < 0.06 and abs(stats[3] - 1) < 0.06
    exact = noisy.select("op_setting_3", "epr", "unit_number").distinct().collect()
    assert [tuple(r) for r in exact] == [(102.0, 0.0, 1)]


def test_life_labels(spark, rows_of):
    df = spark.createDataFrame([(1, 1), (1, 3), (2, 5), (4, 1)], "unit_number int, time_cycles int")
    assert rows_of(R.label_training(df)) == [(1, 1, 2), (1, 3, 0), (2, 5, 0), (4, 1, 0)]
    truth = spark.createDataFrame([(1, 10), (2, 0), (3, 7)], "unit_number int, rul int")
    assert rows_of(R.join_truth(df, truth)) == [(1, 1, 12), (1, 3, 10), (2, 5, 0)]
    assert rows_of(R.check_truth(df, truth)) == [(3, True), (4, False)]
