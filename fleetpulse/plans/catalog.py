"""Every operator as a query over the given tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import checks as C
from fleetpulse.functions.parsing import once
from fleetpulse.functions.times import epoch_millis, rfc3339, rfc3339_nano
from fleetpulse.operators import ledger as L
from fleetpulse.operators import rul as R
from fleetpulse.operators import shield as S
from fleetpulse.operators import ticks as X
from fleetpulse.operators.pick import drop_duplicate_frames, top_rows
from fleetpulse.plans import marts as M
from fleetpulse.plans import sample_views as V
from fleetpulse.schema import CYCLE, REASON, SENSORS, TS, UNIT
from fleetpulse.session import prepare, scratch_path
from fleetpulse.settings import ShieldSettings
from fleetpulse.sources import frames as FR
from fleetpulse.sources import lake as K
from fleetpulse.sources import text as TX
from fleetpulse.sources.ledger_store import (
    apply_reports, read_ledger, start_report_ingest, store_ledger,
)
from fleetpulse.sources.versions import Folder
from fleetpulse.streaming.ingest import start_lake_ingest, write_stream
from fleetpulse.streaming.progress import (
    LiveCounters, WatermarkLog, last_watermark, observed, settle,
)
from fleetpulse.streaming.shield import (
    closing_frame, drop_duplicates_stream, late_frames, least_copies_stream, shield_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

# The sample telemetry covers January 2024; these ages keep a good part of it.
AS_OF = "2024-01-31 00:00:00"
SAMPLE_SHIELD = ShieldSettings(max_age_seconds=10 * 86_400, sla_seconds=5 * 86_400)
ANCHOR = "2026-01-01 00:00:00"
TREND = {"unit": 8, "start": "2024-01-22", "end": "2024-01-28"}
READINGS = ("T2", "T50", "P30", "Nf", "Nc", "phi")

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _plain(df: DataFrame) -> DataFrame:
    """Reasons as text and times without a zone, for comparison with other engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- sources ----------------------------------------------------------------------------


@query
def event_props_decode(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def _decoded(spark, sf_dir):
    return FR.decode_frames(V.run_view(spark, V.WIRE, sf_dir, "events", heavy=True))


@query
def frame_json_decode(spark, sf_dir):
    frames = FR.accepted_frames(_decoded(spark, sf_dir))
    return frames.select(UNIT, F.coalesce(CYCLE, F.lit(-1)).alias(CYCLE), TS, "T50")


@query
def frame_json_rejects(spark, sf_dir):
    return FR.rejected_frames(_decoded(spark, sf_dir))


@query
def frame_roundtrip(spark, sf_dir):
    frames = V.telemetry(spark, sf_dir)
    back = FR.accepted_frames(FR.decode_frames(X.encode_frames(frames, F.col(TS))))
    return back.select(UNIT, CYCLE, TS, *READINGS, "processing_at")


@query
def frames_batch_read(spark, sf_dir):
    """Wire frames read from files as one bounded batch."""
    path, files = V.write_slices(V.telemetry(spark, sf_dir), as_json=True)
    frames = FR.accepted_frames(FR.decode_frames(FR.read_frames_batch(spark, FR.FileSource(path, files))))
    return frames.select(UNIT, CYCLE, TS, *READINGS)


def _lines(spark, sf_dir):
    lines = V.run_view(spark, V.LINES, sf_dir, "lineitem", heavy=True)
    text = once(lines.withColumnRenamed("line", "_line"), "line", F.col("_line")).select("line")
    return TX.parse_lines(text.filter(F.col("line").rlike(r"\S")))


@query
def text_parse_valid(spark, sf_dir):
    return TX.accepted_lines(_lines(spark, sf_dir))


@query
def blueprint_load(spark, sf_dir):
    """The same lines from text files."""
    path = scratch_path(spark, "blueprint")
    V.run_view(spark, V.LINES, sf_dir, "lineitem", heavy=True).select("line").write.text(path)
    return TX.accepted_lines(TX.parse_lines(TX.read_lines(spark, path)))


def _filed_lines(spark, sf_dir):
    path = scratch_path(spark, "blueprint")
    lines = V.run_view(spark, V.FILED_LINES, sf_dir, "lineitem", heavy=True)
    lines.repartition("batch").sortWithinPartitions("batch", "line").write.partitionBy("batch").text(path)
    return path


@query
def blueprint_rejects(spark, sf_dir):
    """Bad lines of text files, by the folder of their file and their number in it.

    Each folder gets one file, written in the order of its lines.
    """
    rejects = TX.read_blueprint(spark, _filed_lines(spark, sf_dir))[1]
    batch = F.regexp_extract("file", r"batch=(\d+)", 1).cast("int")
    return rejects.select(batch.alias("batch"), "line_number", "line", TX.REJECT)


# A compressed file is read by one task, so each holds a bounded number of lines.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


@query
def blueprint_strict(spark, sf_dir):
    """A sound blueprint is loaded; a source with bad lines then changes nothing.

    The lines take several times the table's room, so both sources are compressed, and each goes
    when its load is over.
    """
    table, good, mixed = (scratch_path(spark, name) for name in ("table", "good", "mixed"))
    V.run_view(spark, V.LINES, sf_dir, "lineitem", heavy=True).select("line").write.options(**PACKED).text(mixed)
    lines = TX.parse_lines(TX.read_lines(spark, mixed))
    lines.filter(F.col(TX.REJECT).isNull()).select("line").write.options(**PACKED).text(good)
    TX.load_blueprint_strict(spark, good, table)
    Folder(spark, good).delete(good)
    try:
        TX.load_blueprint_strict(spark, mixed, table)
    except TX.BadLine:
        Folder(spark, mixed).delete(mixed)
        return TX.read_blueprint_table(spark, table)
    raise AssertionError("bad lines were loaded")


@query
def blueprint_first_reject(spark, sf_dir):
    """The line that a strict load of files stops at."""
    path = _filed_lines(spark, sf_dir)
    try:
        TX.load_blueprint_strict(spark, path, scratch_path(spark, "table"))
    except TX.BadLine as bad:
        batch = int(re.search(r"batch=(\d+)", bad.file)[1])
        return spark.range(1).select(
            F.lit(batch).alias("batch"), F.lit(bad.line_number).cast("long").alias("line_number"),
            F.lit(bad.reason).alias(TX.REJECT),
        )
    raise AssertionError("bad lines were loaded")


@query
def text_parse_rejects(spark, sf_dir):
    return TX.rejected_lines(_lines(spark, sf_dir))


@query
def topic_size(spark, sf_dir):
    return FR.topic_size(V.run_view(spark, V.WIRE, sf_dir, "events"))


# --- quality rules ----------------------------------------------------------------------


def _deduplicated(spark, sf_dir):
    return drop_duplicate_frames(V.telemetry(spark, sf_dir))


def _checked(df, *readings):
    return df.select(UNIT, CYCLE, TS, *readings, C.FLAG, REASON)


@query
def dedup_frames(spark, sf_dir):
    return _deduplicated(spark, sf_dir).select(UNIT, CYCLE, TS, *READINGS)


@query
def top_frames(spark, sf_dir):
    """The hundred hottest frames."""
    frames = _deduplicated(spark, sf_dir).select(UNIT, CYCLE, TS, *READINGS)
    return top_rows(frames, 100, F.col("T50").desc(), F.col(UNIT), F.col(CYCLE), F.col(TS))


@query
def age_filter(spark, sf_dir):
    kept = S.drop_stale(_deduplicated(spark, sf_dir), AS_OF, SAMPLE_SHIELD)
    return kept.select(UNIT, CYCLE, TS, *READINGS)


@query
def sla_flag(spark, sf_dir):
    kept = S.drop_stale(_deduplicated(spark, sf_dir), AS_OF, SAMPLE_SHIELD)
    return _checked(S.flag_sla(kept, AS_OF, SAMPLE_SHIELD))


@query
def schema_rot(spark, sf_dir):
    return _checked(S.flag_schema_rot(_deduplicated(spark, sf_dir)), "htBleed")


@query
def thermocouple_break(spark, sf_dir):
    return _checked(S.flag_thermocouple_break(_deduplicated(spark, sf_dir)), "T50")


def _along_runs(rule, spark, sf_dir):
    return rule(_deduplicated(spark, sf_dir), sized_by=V.telemetry(spark, sf_dir))


@query
def zombie_state(spark, sf_dir):
    return _checked(_along_runs(S.flag_zombie_state, spark, sf_dir))


@query
def sensor_freeze(spark, sf_dir):
    return _checked(_along_runs(S.flag_sensor_freeze, spark, sf_dir), "P30")


@query
def adversarial_drift(spark, sf_dir):
    return _checked(_along_runs(S.flag_adversarial_drift, spark, sf_dir))


def _shielded(spark, sf_dir):
    return S.quality_shield(V.telemetry(spark, sf_dir), AS_OF, SAMPLE_SHIELD)


@query
def quality_shield(spark, sf_dir):
    return _shielded(spark, sf_dir)


@query
def rejection_summary(spark, sf_dir):
    return S.rejection_summary(_shielded(spark, sf_dir))


# --- warehouse models -------------------------------------------------------------------


def _stored_lake(spark, sf_dir):
    """Shielded frames through the lake, as the models read them."""
    path = scratch_path(spark, "lake")
    K.write_lake(FR.with_ingest_columns(_shielded(spark, sf_dir), AS_OF), path)
    return K.read_lake(spark, path)


def _staged(spark, sf_dir):
    return M.staging(_shielded(spark, sf_dir))


def _sizes(spark, sf_dir):
    return M.sizes_of(V.telemetry(spark, sf_dir))


def _fresh_sizes(spark, sf_dir):
    """The frames that the age filter leaves; their count scan is as narrow as the mart's."""
    return M.sizes_of(S.drop_stale(V.telemetry(spark, sf_dir), AS_OF, SAMPLE_SHIELD))


def _mart(spark, sf_dir):
    return M.health_mart(_staged(spark, sf_dir), sized_by=_fresh_sizes(spark, sf_dir))


@query
def stg_telemetry(spark, sf_dir):
    return _staged(spark, sf_dir)


@query
def staging_view_read(spark, sf_dir):
    """Staging published as a view and read by its name."""
    return M.staging_view(_shielded(spark, sf_dir), "stg_telemetry_view")


@query
def mart_engine_health(spark, sf_dir):
    return _mart(spark, sf_dir)


@query
def mart_all_frames(spark, sf_dir):
    """The mart over a whole month: only the one-row rules ran before it."""
    frames = S.flag_thermocouple_break(S.flag_schema_rot(_deduplicated(spark, sf_dir)))
    return M.health_mart(M.staging(frames), sized_by=_sizes(spark, sf_dir))


@query
def mart_per_cycle(spark, sf_dir):
    cycles = _fresh_sizes(spark, sf_dir).select(UNIT, CYCLE).distinct()
    return M.health_per_cycle(_staged(spark, sf_dir), sized_by=cycles)


def _stored_mart(spark, sf_dir):
    """The mart written down and read back, as whoever serves it reads it."""
    path = scratch_path(spark, "mart")
    K.write_mart(_mart(spark, sf_dir), path)
    return K.read_mart(spark, path)


@query
def engine_trend(spark, sf_dir):
    return M.engine_trend(_stored_mart(spark, sf_dir), **TREND)


@query
def trend_long(spark, sf_dir):
    return M.trend_long(M.engine_trend(_stored_mart(spark, sf_dir), **TREND))


@query
def lake_roundtrip(spark, sf_dir):
    lake = _stored_lake(spark, sf_dir)
    return lake.select(
        UNIT, CYCLE, TS, "htBleed", *READINGS, C.FLAG, REASON, "processing_date"
    )


@query
def lake_compact(spark, sf_dir):
    """Two loads of different days share the lake; one day is rewritten, nothing is lost."""
    path = scratch_path(spark, "lake")
    frames = FR.with_ingest_columns(_deduplicated(spark, sf_dir), AS_OF)
    early = F.col(TS) < F.lit("2024-01-15").cast("timestamp")
    K.write_lake(frames.filter(~early), path)
    K.write_lake(frames.filter(early).withColumn("processing_date", F.lit("2024-01-15").cast("date")), path)
    K.compact_lake(spark, path, "2024-01-31")
    return (
        K.read_lake(spark, path)
        .groupBy("processing_date", UNIT)
        .agg(
            F.count(F.lit(1)).alias("frames"),
            F.min(TS).alias("first_frame"),
            F.max(TS).alias("last_frame"),
            F.sum("Nc").alias("nc_total"),
        )
    )


@query
def lake_expire(spark, sf_dir):
    """Loads of two days, one written twice, compaction, expiry, and a late load after it."""
    path = scratch_path(spark, "lake")
    frames = FR.with_ingest_columns(_deduplicated(spark, sf_dir), AS_OF)
    part = lambda n: frames.filter(F.pmod(F.col(CYCLE), F.lit(4)) == n)
    K.write_lake(part(1), path, "hourly-0")
    for n in range(2):
        K.write_lake(part(n), path, f"hourly-{n}")
    earlier = part(2).withColumn("processing_date", F.date_sub("processing_date", 1))
    K.write_lake(earlier, path, "daily-0")
    K.compact_lake(spark, path, "2024-01-31")
    K.expire_lake(spark, path, keep_hours=0)
    K.write_lake(part(3), path, "hourly-3")
    return K.read_lake(spark, path).select(UNIT, CYCLE, TS, *READINGS, "processing_date")


@query
def mart_unit_trend(spark, sf_dir):
    """A unit's trend on some days of a stored mart, whose other days are not even listed."""
    path = scratch_path(spark, "mart")
    K.write_mart(_mart(spark, sf_dir), path)
    days = ("2024-01-22", "2024-01-23", "2024-01-26", "2024-01-27")
    return M.engine_trend(K.read_mart(spark, path, days), TREND["unit"], days[0], days[-1])


@query
def lake_seed(spark, sf_dir):
    """A seeded lake and a load on top of it."""
    path = scratch_path(spark, "lake")
    K.seed_lake(spark, path, AS_OF)
    K.write_lake(FR.with_ingest_columns(_deduplicated(spark, sf_dir), AS_OF), path, "frames")
    return K.read_lake(spark, path).select(UNIT, CYCLE, TS, *READINGS, "processing_date")


@query
def lake_two_loads(spark, sf_dir):
    """Two loads of one day stand side by side; writing one of them again changes nothing."""
    path = scratch_path(spark, "lake")
    frames = FR.with_ingest_columns(_deduplicated(spark, sf_dir), AS_OF)
    even = F.col(CYCLE) % 2 == 0
    K.write_lake(frames.filter(even), path, "even")
    K.write_lake(frames.filter(~even), path, "odd")
    K.write_lake(frames.filter(even), path, "even")
    return K.read_lake(spark, path).select(UNIT, CYCLE, TS, *READINGS, "processing_date")


@query
def mart_rebuild(spark, sf_dir):
    """A second build, for which one day is flagged, leaves nothing of the first."""
    path = scratch_path(spark, "mart")
    frames = _shielded(spark, sf_dir)
    K.write_mart(M.health_mart(M.staging(frames), sized_by=_fresh_sizes(spark, sf_dir)), path)
    flagged = _without_a_day(frames)
    K.write_mart(M.health_mart(M.staging(flagged), sized_by=_fresh_sizes(spark, sf_dir)), path)
    return _mart_columns(K.read_mart(spark, path))


def _without_a_day(frames):
    day = F.to_date(TS) == F.lit("2024-01-28").cast("date")
    return frames.withColumn(C.FLAG, F.col(C.FLAG) | day)


def _mart_columns(mart):
    return mart.select(UNIT, CYCLE, M.EVENT_TS, "T50", "event_date", M.AVERAGE)


@query
def mart_day_range(spark, sf_dir):
    """Three days of a stored mart are built again; the middle one has nothing left."""
    path = scratch_path(spark, "mart")
    frames = _shielded(spark, sf_dir)
    K.write_mart(M.health_mart(M.staging(frames), sized_by=_fresh_sizes(spark, sf_dir)), path)
    days = "2024-01-27", "2024-01-29"
    M.refresh_mart_days(spark, M.staging(_without_a_day(frames)), path, *days)
    return _mart_columns(K.read_mart(spark, path))


@query
def mart_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mart")
    K.write_mart(M.health_mart(M.staging(_stored_lake(spark, sf_dir))), path)
    return _mart_columns(K.read_mart(spark, path))


# --- ledger -----------------------------------------------------------------------------


@query
def ledger_rebuild(spark, sf_dir):
    """A ledger table made from blueprint rows, made twice."""
    parsed = scratch_path(spark, "blueprint")  # the lines are parsed once for both
    TX.accepted_lines(_lines(spark, sf_dir)).write.parquet(parsed)
    name, path = f"ledger_{uuid.uuid4().hex}", scratch_path(spark, "ledger")
    for _ in range(2):
        K.rebuild_table(L.new_ledger(spark.read.parquet(parsed)), name, path)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return table.select(
        "status", F.col("flight_start_time").isNotNull().alias("has_start"),
        F.col("target_duration_sec").isNotNull().alias("has_duration"), UNIT, CYCLE, *SENSORS,
    )


@query
def ledger_recover(spark, sf_dir):
    return L.recover_ledger(V.ledger(spark, sf_dir))


@query
def ledger_next_pending(spark, sf_dir):
    return L.next_pending(V.ledger(spark, sf_dir))


@query
def ledger_duplicate_flights(spark, sf_dir):
    return L.duplicate_flights(V.run_view(spark, V.REFLOWN, sf_dir, "orders"))


@query
def ledger_reserve(spark, sf_dir):
    book = V.ledger(spark, sf_dir).withColumn("flight_start_time", F.lit(None).cast("timestamp"))
    return L.reserve_next(
        book, ANCHOR, duration=F.col("target_duration_sec"), idle=F.col("idle_sec")
    )


@query
def ledger_reserve_twice(spark, sf_dir):
    """Reserve, land, reserve again: the second flight starts from the end of the first."""
    book = V.ledger(spark, sf_dir).withColumn("flight_start_time", F.lit(None).cast("timestamp"))
    times = {"duration": F.col("target_duration_sec"), "idle": F.col("idle_sec")}
    first = L.reserve_next(book, ANCHOR, **times)
    landed = first.withColumn(
        "status", F.when(F.col("flight_start_time").isNotNull(), "COMPLETED").otherwise(F.col("status"))
    )
    return L.reserve_next(landed, ANCHOR, **times)


@query
def ledger_apply_reports(spark, sf_dir):
    reports = V.run_view(spark, V.REPORTS, sf_dir, "orders")
    return L.apply_status_reports(V.ledger(spark, sf_dir), reports)


def _scheduled(flights):
    return L.schedule_flights(
        flights, ANCHOR, duration=F.col("target_duration_sec"), idle=F.col("idle_sec")
    )


@query
def flight_schedule(spark, sf_dir):
    return _scheduled(V.ledger(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return L.run_summary(V.run_view(spark, V.FLOWN, sf_dir, "orders"), hz=100)


@query
def latest_run_per_flight(spark, sf_dir):
    return L.latest_run_per_flight(V.run_view(spark, V.REFLOWN, sf_dir, "orders"))


# --- ticks ------------------------------------------------------------------------------


@query
def tick_expand(spark, sf_dir):
    """All ticks of all waiting flights at 3 Hz, a step that is no whole microsecond."""
    ticks = X.expand_ticks(_scheduled(V.ledger(spark, sf_dir)), hz=3)
    return ticks.groupBy(UNIT, CYCLE).agg(
        F.count(F.lit(1)).alias("ticks"),
        F.min(TS).alias("first_tick"),
        F.max(TS).alias("last_tick"),
        F.sum(F.unix_micros(TS) % F.lit(1_000_003)).alias("time_check"),
    )


@query
def tick_noise(spark, sf_dir):
    """Per flight: exact columns stay, zero stays zero, and all noise is within its bound."""
    flown = _scheduled(V.flights(spark, sf_dir))
    bases = flown.select("*", *[F.col(n).alias(f"base_{n}") for n in SENSORS])
    ticks = X.with_noise(X.expand_ticks(bases, hz=1), "run_1")
    off = [F.abs(F.col(n) - F.col(f"base_{n}")) for n in SENSORS]
    excess = [d - F.abs(F.col(f"base_{n}")) * F.lit(7e-4) for n, d in zip(SENSORS, off)]
    checked = ticks.select(
        UNIT,
        CYCLE,
        "op_setting_3",
        F.abs("epr").alias("epr"),
        F.greatest(*excess).alias("excess"),
        reduce(add, [F.coalesce((d > 0).cast("int"), F.lit(0)) for d in off]).alias("noisy"),
    )
    return checked.groupBy(UNIT, CYCLE).agg(
        F.count(F.lit(1)).alias("ticks"),
        F.count_if(F.col("excess") <= 0).alias("within_bound"),
        F.max("op_setting_3").alias("exact_setting"),
        F.max("epr").alias("zero_reading"),
        F.max("noisy").alias("noisy_readings"),
    )


@query
def edge_roundtrip(spark, sf_dir):
    """Frames as tick files, under the day on which they were taken."""
    path = scratch_path(spark, "edge")
    frames = _deduplicated(spark, sf_dir).withColumn("flight_start_time", F.date_trunc("day", TS))
    K.write_edge(X.edge_rows(frames, "run_1"), path)
    return (
        K.read_edge(spark, path)
        .groupBy("run_id", "unit", "date")
        .agg(
            F.count(F.lit(1)).alias("ticks"),
            F.min(TS).alias("first_tick"),
            F.max(TS).alias("last_tick"),
            F.sum("Nc").alias("nc_total"),
        )
    )


@query
def latest_run_from_edge(spark, sf_dir):
    """Tick files of flights that were flown again: only folders of winning runs are read.

    A flight starts with its first tick, so all its ticks are in the folder of that day.
    """
    path = scratch_path(spark, "edge")
    flown = V.run_view(spark, V.REFLOWN_TICKS, sf_dir, "orders")
    ticks = X.with_start(flown.withColumn(TS, F.col(TS).cast("timestamp")), ["run_id", UNIT, CYCLE])
    K.write_edge(X.edge_rows(ticks, F.col("run_id")), path)
    return K.latest_run_from_edge(spark, path).groupBy("run_id", UNIT, CYCLE).agg(
        F.count(F.lit(1)).alias("ticks"), F.min(TS).alias("first_tick"), F.sum("T50").alias("t50_total")
    )


@query
def time_formats(spark, sf_dir):
    """Frame times as ledger text, as milliseconds and as a partition date."""
    return V.telemetry(spark, sf_dir).select(
        UNIT, CYCLE, rfc3339(F.col(TS)).alias("second_text"), rfc3339_nano(F.col(TS)).alias("wire_text"),
        epoch_millis(F.col(TS)).alias("millis"), F.to_date(TS).alias("date"),
    )


# --- life labels ------------------------------------------------------------------------


@query
def rul_label(spark, sf_dir):
    return R.label_training(V.telemetry(spark, sf_dir).select(UNIT, CYCLE, TS))


@query
def rul_truth_join(spark, sf_dir):
    frames = V.telemetry(spark, sf_dir).select(UNIT, CYCLE, TS)
    return R.join_truth(frames, V.truth(frames))


def _life_vector(spark, sf_dir):
    """A life vector from its text files, line i for unit i; one line per supplier here."""
    path = scratch_path(spark, "life")
    lives = V.run_view(spark, V.LIVES, sf_dir, "supplier")
    lives.repartitionByRange("s_suppkey").sortWithinPartitions("s_suppkey").select("line").write.text(path)
    return TX.read_life_vector(spark, path)


@query
def life_vector_join(spark, sf_dir):
    frames = V.telemetry(spark, sf_dir).select(UNIT, CYCLE, TS)
    return R.join_truth(frames, _life_vector(spark, sf_dir))


@query
def life_vector_check(spark, sf_dir):
    """Units without an entry, and entries without a unit."""
    return R.check_truth(V.telemetry(spark, sf_dir), _life_vector(spark, sf_dir))


# --- streams ----------------------------------------------------------------------------


def _drain(spark, df, keys=(), listener=None):
    out = scratch_path(spark, "out")
    if listener is not None:
        spark.streams.addListener(listener)
    try:
        running = write_stream(df, out, scratch_path(spark, "checkpoint"), keys, once=True)
        running.awaitTermination()
        if listener is not None:
            settle(listener, running)
    finally:
        if listener is not None:
            spark.streams.removeListener(listener)
    return spark.read.schema(df.schema).parquet(out)


# Frames that the sample holds back until all others have come.
HELD_BACK = "time_cycles % 9 = 4 AND timestamp < TIMESTAMP'2024-01-23'"


def _telemetry_stream(spark, sf_dir, closed=False, held_back=None):
    frames = V.telemetry(spark, sf_dir)
    path, files = V.write_slices(frames.filter(f"NOT ({held_back})") if held_back else frames)
    if held_back:
        frames.filter(held_back).repartition(files).write.mode("append").parquet(path)
    if closed:
        closing_frame(frames).write.mode("append").parquet(path)
    reader = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(path)


@query
def stream_ingest(spark, sf_dir):
    """Wire frames from files into the lake."""
    lake = _streamed_lake(spark, sf_dir)
    rows = K.read_lake(spark, lake)
    return rows.select(UNIT, CYCLE, TS, *READINGS, C.FLAG, REASON, "processing_date")


def _streamed_lake(spark, sf_dir):
    path, files = V.write_slices(V.telemetry(spark, sf_dir), as_json=True)
    lake = scratch_path(spark, "lake")
    start_lake_ingest(
        spark, FR.FileSource(path, files), lake, scratch_path(spark, "checkpoint"),
        as_of=AS_OF, once=True,
    ).awaitTermination()
    return lake


@query
def stream_lake_compact(spark, sf_dir):
    """A lake written by a stream holds the same rows after its day was compacted."""
    lake = _streamed_lake(spark, sf_dir)
    K.compact_lake(spark, lake, "2024-01-31")
    rows = K.read_lake(spark, lake)
    return rows.select(UNIT, CYCLE, TS, *READINGS, C.FLAG, REASON, "processing_date")


@query
def lake_stream_and_batch(spark, sf_dir):
    """A stream and a batch load share a day of the lake, and compaction keeps both."""
    lake = _streamed_lake(spark, sf_dir)
    K.compact_lake(spark, lake, "2024-01-31")
    K.write_lake(FR.with_ingest_columns(_deduplicated(spark, sf_dir), AS_OF), lake, "batch")
    K.compact_lake(spark, lake, "2024-01-31")
    return K.read_lake(spark, lake).select(UNIT, CYCLE, TS, *READINGS, "processing_date")


@query
def stream_dedup(spark, sf_dir):
    frames = drop_duplicates_stream(_telemetry_stream(spark, sf_dir))
    return _drain(spark, frames.select(UNIT, CYCLE, TS, *READINGS))


@query
def stream_least_copies(spark, sf_dir):
    """Copies that differ: which one a stream keeps is what a batch keeps, not what came first."""
    frames = V.run_view(spark, V.COPIES, sf_dir, "events").withColumn(TS, F.col(TS).cast("timestamp"))
    path, files = V.write_slices(frames)
    closing_frame(frames).write.mode("append").parquet(path)
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", files).parquet(path)
    kept = _drain(spark, least_copies_stream(stream))
    batch = drop_duplicate_frames(frames).select(UNIT, CYCLE, TS, F.col("Nc").alias("_nc"), F.col("phi").alias("_phi"))
    same = (F.col("Nc") == F.col("_nc")) & (F.col("phi") == F.col("_phi"))
    both = kept.join(batch, [UNIT, CYCLE, TS], "full")
    return both.select(UNIT, CYCLE, TS, F.coalesce(same, F.lit(False)).alias("as_in_batch"))


@query
def stream_run_counters(spark, sf_dir):
    """Counters of flights that a stream observes as they pass, without a second scan."""
    flown = V.run_view(spark, V.FLOWN, sf_dir, "orders")
    path = scratch_path(spark, "flown")
    V.spread(flown).write.parquet(path)
    stream = spark.readStream.schema(flown.schema).option("maxFilesPerTrigger", 3).parquet(path)
    counters = LiveCounters()
    _drain(spark, observed(stream, "flights", *L.run_counters(hz=100)), listener=counters)
    totals = counters.totals("flights")
    named = ("total_flights", "points_generated", "files_saved", "errors")
    return spark.range(1).select(*[F.lit(totals[name]).cast("long").alias(name) for name in named])


@query
def ledger_stream_reports(spark, sf_dir):
    """Reports reach a stored ledger as a stream, and then all of them once more."""
    path, source = scratch_path(spark, "ledger"), scratch_path(spark, "reports")
    store_ledger(V.ledger(spark, sf_dir), path, buckets=16)
    reports = V.run_view(spark, V.REPORTS, sf_dir, "orders")
    reports.repartition(4, "seq", CYCLE).write.parquet(source)
    stream = spark.readStream.schema(reports.schema).option("maxFilesPerTrigger", 2).parquet(source)
    start_report_ingest(stream, path, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    apply_reports(spark, path, reports)
    return read_ledger(spark, path)


@query
def stream_shield(spark, sf_dir):
    """All rules on a stream that ends: a closing frame releases the last ones."""
    frames = shield_stream(_telemetry_stream(spark, sf_dir, closed=True), AS_OF, SAMPLE_SHIELD)
    return _drain(spark, frames)


@query
def stream_shield_by_span(spark, sf_dir):
    """The same rules with units spread over spans of eight days."""
    stream = _telemetry_stream(spark, sf_dir, closed=True)
    return _drain(spark, shield_stream(stream, AS_OF, SAMPLE_SHIELD, span_seconds=8 * 86_400))


@query
def stream_late_frames(spark, sf_dir):
    """Frames held back until the watermark had passed them, found by comparing sent and released."""
    stream = _telemetry_stream(spark, sf_dir, closed=True, held_back=HELD_BACK)
    return _late(spark, sf_dir, stream)


@query
def stream_late_in_gap(spark, sf_dir):
    """The stream releases nothing at all: one frame far ahead came first, all others are late."""
    frames = V.telemetry(spark, sf_dir)
    path = scratch_path(spark, "ahead")
    for _ in range(2):  # lateness is judged by the watermark of the batch before
        closing_frame(frames).coalesce(1).write.mode("append").parquet(path)
    frames.coalesce(4).write.mode("append").parquet(path)
    return _late(spark, sf_dir, spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(path))


def _late(spark, sf_dir, stream):
    marks = scratch_path(spark, "watermarks")
    released = _drain(
        spark, shield_stream(stream, AS_OF, SAMPLE_SHIELD), listener=WatermarkLog(spark, marks)
    )
    last = last_watermark(spark, marks)
    late = late_frames(V.telemetry(spark, sf_dir), released, AS_OF, SAMPLE_SHIELD, last)
    return late.select(UNIT, CYCLE, TS, *READINGS, FR.REJECT)


@query
def stream_rejects(spark, sf_dir):
    """What a stream could not decode, written beside the lake from the same pass."""
    path, rejects = scratch_path(spark, "wire"), scratch_path(spark, "rejects")
    V.run_view(spark, V.WIRE, sf_dir, "events", heavy=True).write.text(path)
    start_lake_ingest(
        spark, FR.FileSource(path), scratch_path(spark, "lake"), scratch_path(spark, "checkpoint"),
        as_of=AS_OF, once=True, rejects=rejects,
    ).awaitTermination()
    return spark.read.parquet(rejects).select("value", FR.REJECT)
