"""The flight ledger as a table: recovery, next work, reservations, reports, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.noise import uniform_int
from fleetpulse.functions.times import AsOf, as_of_column
from fleetpulse.operators.joins import join_checked
from fleetpulse.operators.pick import lowest_row
from fleetpulse.operators.running import running_sum
from fleetpulse.operators.split_runs import Runs
from fleetpulse.schema import (
    COMPLETED, CYCLE, FAILED, IN_FLIGHT, INTERRUPTED, PENDING, UNIT,
)
from fleetpulse.settings import MAX_RUN_ROWS, FlightSettings

DEFAULTS = FlightSettings()
FLIGHT_KEY = (UNIT, CYCLE)
FLIGHT_RUNS = Runs(keys=(UNIT,), order=(CYCLE,), levels=((CYCLE, 4096), (CYCLE, 64), (CYCLE, 1)))

REALTIME = "REALTIME"
ACCELERATED = "ACCELERATED"


def duplicate_flights(ledger: DataFrame) -> DataFrame:
    """Keys that occur more than once; empty for a sound ledger."""
    return (
        ledger.groupBy(*FLIGHT_KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def new_ledger(blueprint: DataFrame) -> DataFrame:
    """A ledger in which every blueprint row waits to be flown."""
    return blueprint.select(
        F.lit(PENDING).alias("status"),
        F.lit(None).cast("timestamp").alias("flight_start_time"),
        F.lit(None).cast("int").alias("target_duration_sec"),
        *blueprint.columns,
    )


def recover_ledger(ledger: DataFrame) -> DataFrame:
    """Flights that were left in the air wait again; finished and failed ones stay."""
    abandoned = F.col("status").isin(IN_FLIGHT, INTERRUPTED)
    return ledger.withColumn("status", F.when(abandoned, PENDING).otherwise(F.col("status")))


def next_pending(ledger: DataFrame) -> DataFrame:
    """Per unit, the waiting flight with the lowest cycle; units with none have no row."""
    waiting = ledger.filter(F.col("status") == PENDING).drop("status")
    return (
        lowest_row(waiting, (UNIT,), F.col(CYCLE))
        .withColumn("status", F.lit(PENDING))
        .select(*ledger.columns)
    )


def schedule_flights(
    ledger: DataFrame,
    anchor: AsOf,
    settings: FlightSettings = DEFAULTS,
    duration: Column | None = None,
    idle: Column | None = None,
    max_run_rows: int = MAX_RUN_ROWS,
) -> DataFrame:
    """Start time and duration of every waiting flight on its unit's clock.

    A flight starts after an idle time from the end of the one before; the first counts from
    the unit's last booked end, or the anchor where the unit has none. Durations and idle times are drawn from a hash of seed, unit and cycle unless
    given as columns.
    """
    waiting = _with_clock(ledger.filter(F.col("status") == PENDING), ledger, anchor)
    if duration is None:
        duration = _draw("duration", settings.min_duration_sec, settings.max_duration_sec, settings)
    if idle is None:
        idle = _draw("idle", settings.idle_min_sec, settings.idle_max_sec, settings)
    timed = waiting.withColumns(
        {"target_duration_sec": duration.cast("int"), "_idle": idle.cast("long")}
    ).withColumn("_step", F.col("_idle") + F.col("target_duration_sec"))
    summed = running_sum(timed, FLIGHT_RUNS, "_step", "_end", max_run_rows)
    start = F.col("_clock") + (
        F.col("_end") - F.col("target_duration_sec")
    ) * F.lit(1_000_000)
    return summed.withColumn("flight_start_time", F.timestamp_micros(start)).drop(
        "_idle", "_step", "_end", "_clock"
    )


def _with_clock(flights: DataFrame, ledger: DataFrame, anchor: AsOf) -> DataFrame:
    """Adds the microsecond from which a unit may fly again: the end of its last booked flight,
    the anchor without any."""
    start = F.unix_micros(as_of_column(anchor))
    if "flight_start_time" not in ledger.columns:
        return flights.withColumn("_clock", start)
    end = F.unix_micros(F.col("flight_start_time").cast("timestamp")) + F.col(
        "target_duration_sec"
    ).cast("long") * F.lit(1_000_000)
    ends = ledger.groupBy(UNIT).agg(F.max(end).alias("_free")).filter(F.col("_free").isNotNull())
    return join_checked(flights, ends, [UNIT], "left").select(
        *flights.columns, F.coalesce("_free", start).alias("_clock")
    )


def _draw(name: str, low: int, high: int, settings: FlightSettings) -> Column:
    return uniform_int(low, high, F.lit(settings.seed), F.lit(name), F.col(UNIT), F.col(CYCLE))


def reserve_next(
    ledger: DataFrame,
    as_of: AsOf,
    mode: str = ACCELERATED,
    settings: FlightSettings = DEFAULTS,
    duration: Column | None = None,
    idle: Column | None = None,
) -> DataFrame:
    """The ledger with each unit's next flight in the air, with its start and duration.

    In real time a flight starts now; otherwise after an idle time from the end of the unit's
    last booked flight, or from ``as_of`` where it has none.
    """
    if mode not in (REALTIME, ACCELERATED):
        raise ValueError(f"mode must be {REALTIME} or {ACCELERATED}")
    if duration is None:
        duration = _draw("duration", settings.min_duration_sec, settings.max_duration_sec, settings)
    if mode == REALTIME:
        following = next_pending(ledger).withColumn("_clock", F.unix_micros(as_of_column(as_of)))
        idle = F.lit(0)
    else:
        following = _with_clock(next_pending(ledger), ledger, as_of)
        if idle is None:
            idle = _draw("idle", settings.idle_min_sec, settings.idle_max_sec, settings)
    begin = F.col("_clock") + idle.cast("long") * F.lit(1_000_000)
    booked = following.select(
        *FLIGHT_KEY,
        F.lit(IN_FLIGHT).alias("_status"),
        F.timestamp_micros(begin).alias("_start"),
        duration.cast("int").alias("_duration"),
    )
    joined = join_checked(ledger, booked, list(FLIGHT_KEY), "left")
    return joined.withColumns(
        {
            "status": F.coalesce("_status", "status"),
            "flight_start_time": F.coalesce("_start", "flight_start_time"),
            "target_duration_sec": F.coalesce("_duration", "target_duration_sec"),
        }
    ).select(*ledger.columns)


def apply_status_reports(ledger: DataFrame, reports: DataFrame) -> DataFrame:
    """Set the last reported status per flight; reports on unknown flights are ignored.

    ``reports`` has the flight key, ``status`` and ``seq``. They collapse to one per flight
    before the join, so the join key is unique on both sides.
    """
    last = reports.groupBy(*FLIGHT_KEY).agg(
        F.max(F.struct("seq", "status"))["status"].alias("_reported")
    )
    return (
        ledger.join(last, list(FLIGHT_KEY), "left")
        .withColumn("status", F.coalesce("_reported", "status"))
        .select(*ledger.columns)
    )


def outcome_status(ok: Column, interrupted: Column, elapsed_sec: Column) -> Column:
    """What a flight reports; one that was stopped before its first second reports nothing."""
    return (
        F.when(interrupted & (elapsed_sec > 0), INTERRUPTED)
        .when(interrupted, F.lit(None))
        .when(ok, COMPLETED)
        .otherwise(FAILED)
    )


def run_summary(flights: DataFrame, hz: int, by: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Counters of a run. Points count completed flights only; a stopped flight leaves a file
    when it lasted at least a second (its duration holds the seconds it flew)."""
    return flights.groupBy(*by).agg(*run_counters(hz))


def run_counters(hz: int) -> list[Column]:
    """The counters as aggregates; a running stream can observe them as its flights pass."""
    status = F.col("status")
    done = status == COMPLETED
    stopped = (status == INTERRUPTED) & (F.col("target_duration_sec") > 0)
    points = F.col("target_duration_sec").cast("long") * F.lit(hz)
    return [
        F.count_if(done).alias("total_flights"),
        F.coalesce(F.sum(F.when(done, points)), F.lit(0)).alias("points_generated"),
        F.count_if(done | stopped).alias("files_saved"),
        F.count_if(status == FAILED).alias("errors"),
    ]


def winning_runs(flights: DataFrame) -> DataFrame:
    """(unit, cycle, run_id): the last run of each flight."""
    return flights.groupBy(*FLIGHT_KEY).agg(F.max("run_id").alias("run_id"))


def latest_run_per_flight(ticks: DataFrame) -> DataFrame:
    """Keep only the last run of flights that were flown again."""
    return join_checked(ticks, winning_runs(ticks), [*FLIGHT_KEY, "run_id"], "left_semi").select(*ticks.columns)
