"""Expand flights into noisy ticks, and encode ticks as wire frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.noise import jitter, polar
from fleetpulse.functions.times import (
    AsOf, as_of_column, rfc3339_nano, truncate_to_millis,
)
from fleetpulse.operators.joins import join_checked
from fleetpulse.schema import CYCLE, SENSORS, TS, UNIT, edge_schema
from fleetpulse.settings import FlightSettings

DEFAULTS = FlightSettings()

# Fixed value: the one setting that carries no noise.
EXACT_READINGS = ("op_setting_3",)

_CHUNK_SEC = 60
_TICKS_PER_TASK = 1_000_000
_MAX_TASKS = 100_000


def _tasks(flights: DataFrame, hz: int, duration: str) -> int:
    """Tasks for an expansion. The rows before it are few and small, so neither their size nor
    adaptive merging says how much work they stand for; the sum of durations does."""
    seconds = flights.agg(F.sum(duration)).first()[0] or 0
    least = flights.sparkSession.sparkContext.defaultParallelism
    return min(_MAX_TASKS, max(least, -(-seconds * hz // _TICKS_PER_TASK)))


def expand_ticks(
    flights: DataFrame, hz: int = DEFAULTS.hz, start: str = "flight_start_time",
    duration: str = "target_duration_sec",
) -> DataFrame:
    """One row per tick: ``tick`` counts from 0, ``timestamp`` is the start plus whole steps.

    A step is 1/hz of a second, rounded down to a nanosecond; times keep microseconds. Flights
    are first cut into pieces of a minute and spread by a hash, so neither a long flight nor a
    ledger in few files ends up in few tasks.
    """
    step_ns = 1_000_000_000 // hz
    last = F.col(duration) - F.lit(1)
    pieces = (
        flights.filter(F.col(duration) > 0)
        .withColumn("_from", F.explode(F.sequence(F.lit(0), last, F.lit(_CHUNK_SEC))))
        .repartition(_tasks(flights, hz, duration), UNIT, CYCLE, "_from")
    )
    until = F.least(F.col(duration), F.col("_from") + F.lit(_CHUNK_SEC))
    ticks = F.sequence(
        F.col("_from").cast("long") * F.lit(hz), until.cast("long") * F.lit(hz) - F.lit(1)
    )
    expanded = pieces.withColumn("tick", F.explode(ticks))
    # Exact integer division: micros = floor(tick * step_ns / 1000).
    nanos = F.col("tick") * F.lit(step_ns)
    micros = F.floor((nanos - F.pmod(nanos, F.lit(1000))) / F.lit(1000)).cast("long")
    at = F.timestamp_micros(F.unix_micros(F.col(start).cast("timestamp")) + micros)
    return expanded.withColumn(TS, at).drop("_from")


def with_noise(
    ticks: DataFrame, run_id: str, settings: FlightSettings = DEFAULTS
) -> DataFrame:
    """Gaussian noise in proportion to each reading present, drawn from a hash of run, unit,
    cycle, tick and reading; ids, times and the exact setting are untouched."""
    noisy = [n for n in SENSORS if n in ticks.columns and n not in EXACT_READINGS]
    # One hash per tick feeds all draws. This keeps the generated method below the size up to
    # which the JVM compiles it; beyond that the same plan runs ten times slower.
    seeded = ticks.withColumn(
        "_seed", F.xxhash64(F.lit(run_id), F.col(UNIT), F.col(CYCLE), F.col("tick"))
    )
    pairs = [noisy[i : i + 2] for i in range(0, len(noisy), 2)]
    draws = {}
    for pair in pairs:
        place = F.lit(SENSORS.index(pair[0]))
        radius, angle = polar(F.col("_seed"), place)
        draws[f"_r_{pair[0]}"] = radius
        draws[f"_a_{pair[0]}"] = angle
    drawn = seeded.withColumns(draws)
    values = {}
    for pair in pairs:
        radius, angle = F.col(f"_r_{pair[0]}"), F.col(f"_a_{pair[0]}")
        for name, wave in zip(pair, (F.cos, F.sin)):
            values[name] = jitter(F.col(name), radius * wave(angle), settings.noise_scale)
    return drawn.withColumns(values).drop(*draws, "_seed")


def with_start(ticks: DataFrame, flight: list[str], start: str = "flight_start_time") -> DataFrame:
    """Adds the time of each flight's first tick; a tick of no known flight has its own time."""
    first = ticks.groupBy(*flight).agg(F.min(TS).alias("_first"))
    return join_checked(ticks, first, flight, "left").select(
        *ticks.columns, F.coalesce("_first", TS).alias(start)
    )


def edge_rows(ticks: DataFrame, run_id: str, start: str = "flight_start_time") -> DataFrame:
    """Rows of the tick files: millisecond times, and the keys of the folder layout. The date
    is that of the flight's start, so a flight over midnight stays in one folder."""
    millis = ticks.withColumn(TS, truncate_to_millis(F.col(TS)))
    declared = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in edge_schema().fields
        if f.name in ticks.columns
    ]
    return millis.select(
        *declared,
        F.lit(run_id).alias("run_id"),
        F.col(UNIT).cast("int").alias("unit"),
        F.to_date(F.col(start)).alias("date"),
    )


def encode_frames(ticks: DataFrame, processing_at: AsOf = None) -> DataFrame:
    """Wire frames: one JSON text per tick in ``value``, fields in frame order, no key."""
    fields = [rfc3339_nano(F.col(TS)).alias(TS), F.col(UNIT), F.col(CYCLE)]
    fields += [F.col(n) for n in SENSORS if n in ticks.columns]
    fields.append(rfc3339_nano(as_of_column(processing_at)).alias("processing_at"))
    return ticks.select(F.to_json(F.struct(*fields)).alias("value"))
