"""Partitioned Parquet: the lake, tick files, the mart, the ledger, and small files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.checks import reasons_as_text
from fleetpulse.functions.times import AsOf, as_of_column
from fleetpulse.operators.joins import join_checked
from fleetpulse.operators.ledger import winning_runs
from fleetpulse.schema import (
    CYCLE, EVENT_TS, FLAG, REASON, REASON_TYPE, TS, UNIT, edge_partitions, edge_schema,
    lake_schema, mart_schema,
)
from fleetpulse.session import cut_lineage
from fleetpulse.sources.versions import (
    MARKER, Folder, cutoff, latest, publish, read_parts, write_parts,
)

LAKE_KEYS = ("processing_date", UNIT)
MART_FILES = {"maxRecordsPerFile": "5000000"}
EDGE_KEYS = ("run_id", "unit", "date")
_TASK_FOLDERS = 100  # folders that a task writes, about
_FOLDER_ROWS = 5_000_000

_COMPACTED = "compacted-"
_MANIFEST = "_manifest"  # a folder for each compacted day
_LANDED = "_landed"  # a folder for each series of loads

# How tick files are encoded.
EDGE_PARQUET = {
    "compression": "snappy",
    "parquet.enable.dictionary": "false",
    "parquet.writer.version": "v2",
}


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of a folder together before a write; adaptive execution splits a folder that
    is too large for one task and merges small ones."""
    return df.hint("rebalance", *keys)


# --- lake -------------------------------------------------------------------------------


def lake_rows(frames: DataFrame) -> DataFrame:
    """Frames as the lake stores them: every declared column that is known, reasons as text."""
    fields = {f.name: f.dataType for f in frames.schema.fields}
    if isinstance(fields[REASON], T.ArrayType):
        frames = frames.withColumn(REASON, reasons_as_text())
    return frames.select(
        *[
            (F.col(f.name) if f.name in fields else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in lake_schema().fields
        ]
    )


def write_lake(frames: DataFrame, path: str, load: str | None = None) -> None:
    """Add the frames to the lake as one load.

    A load is a folder of its own, so loads of the same day stand side by side, whether they
    come from a batch or a stream. It counts once its marker exists. Writing a load again under
    its name makes a new attempt, which replaces just that load when it is complete; until then
    readers see the one before. A load that a compaction has taken in cannot be written again.
    Without a name every call adds a new load.
    """
    load = load or f"batch-{uuid.uuid4().hex}"
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load) or load.startswith(_COMPACTED):
        raise ValueError(f"not a load name: {load}")
    folder = Folder(frames.sparkSession, path)
    if any(load in taken for _, taken in _manifests(folder).values()):
        raise ValueError(f"load {load} is part of a compacted day")
    _write_load(rebalanced(lake_rows(frames), *LAKE_KEYS), path, load)


def _write_load(rows: DataFrame, path: str, load: str) -> None:
    folder = Folder(rows.sparkSession, path)
    tries = [int(e.name.split("=")[1]) for e in folder.find(f"load_id={load}/attempt=*")]
    attempt = f"load_id={load}/attempt={max(tries, default=0) + 1}"
    rows.write.partitionBy(*LAKE_KEYS).parquet(f"{folder.path}/{attempt}")
    if not folder.exists(f"{attempt}/{MARKER}"):  # some sessions leave it out
        folder.create(f"{attempt}/{MARKER}")


@dataclass(frozen=True)
class _Load:
    """A complete load: its name, attempt and when it was completed."""

    name: str
    attempt: int
    completed: int


def _complete(folder: Folder) -> dict[str, _Load]:
    """The newest complete attempt of each load."""
    found: dict[str, _Load] = {}
    for marker in folder.find(f"load_id=*/attempt=*/{MARKER}"):
        load, attempt = (part.split("=", 1)[1] for part in marker.path.split("/")[-3:-1])
        if load not in found or found[load].attempt < int(attempt):
            found[load] = _Load(load, int(attempt), marker.changed)
    return found


def _manifests(folder: Folder) -> dict[str, tuple[str, set[str]]]:
    """For each compacted day the load that holds it, and those that are in it and not yet deleted."""
    days = {}
    for entry in folder.find(f"{_MANIFEST}/*"):
        _, content = latest(folder, f"{_MANIFEST}/{entry.name}")
        if content:
            days[entry.name] = content["holds"], set(content["loads"])
    return days


def _live(folder: Folder) -> list[tuple[str, _Load, str]]:
    """(day, load, folder) of all that counts.

    Compaction publishes one small file for a day, which names its own load and those in it.
    Until then its load is not read, and from then on theirs are not.
    """
    complete, days = _complete(folder), _manifests(folder)
    live = []
    for entry in folder.find("load_id=*/attempt=*/processing_date=*"):
        load, attempt, day = (part.split("=", 1)[1] for part in entry.path.split("/")[-3:])
        known = complete.get(load)
        if known is None or known.attempt != int(attempt):
            continue
        holds, taken = days.get(day, ("", set()))
        if load == holds if load.startswith(_COMPACTED) else load not in taken:
            live.append((day, known, entry.path))
    return live


def read_lake(
    spark: SparkSession, path: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """The lake with its declared schema; both partition keys come from the folder names.

    The driver lists folders, not rows, and the plan does not grow with the number of loads.
    ``start`` and ``end`` leave out the folders of other days before Spark lists their files.
    """
    folder = Folder(spark, path)
    if not folder.exists():
        raise FileNotFoundError(f"no lake at {path}")
    keep = lambda day: (start is None or day >= str(start)) and (end is None or day <= str(end))
    return _rows(spark, folder, [place for day, _, place in _live(folder) if keep(day)])


def _rows(spark: SparkSession, folder: Folder, places: list[str]) -> DataFrame:
    schema = lake_schema()
    if not places:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", folder.path).parquet(*places)
    return rows.select(*schema.names)


def compact_lake(spark: SparkSession, path: str, day: date | str) -> None:
    """Rewrite one ingest date with few files per unit, out of the loads that are complete now.

    It may run beside writers: a load that is still being committed, or arrives meanwhile, stays
    as it is. A failure before the day's file is published changes nothing for readers. Of two
    compactions of a day at once, one fails; so does one during which a load it has read was
    written again. What it replaces stays on disk for running readers until ``expire_lake``.
    """
    folder, day = Folder(spark, path), str(day)
    number, content = latest(folder, f"{_MANIFEST}/{day}")
    chosen = [(load, place) for of_day, load, place in _live(folder) if of_day == day]
    if not chosen or [load.name for load, _ in chosen] == [content.get("holds")]:
        return
    name = f"{_COMPACTED}{uuid.uuid4().hex}"
    merged = _rows(spark, folder, [place for _, place in chosen])
    _write_load(rebalanced(merged, *LAKE_KEYS).sortWithinPartitions(*LAKE_KEYS, TS), path, name)
    now = _complete(folder)
    again = [load.name for load, _ in chosen if now.get(load.name) != load]
    if again:
        raise RuntimeError(f"written again during the compaction: {again[:5]}")
    taken = {load.name for load, _ in chosen if not load.name.startswith(_COMPACTED)}
    for series, last in _series(taken).items():
        before, known = latest(folder, f"{_LANDED}/{series}")
        if last > known.get("last", -1):
            publish(folder, f"{_LANDED}/{series}", before + 1, {"last": last})
    loads = sorted(taken | set(content.get("loads", ())))
    publish(folder, f"{_MANIFEST}/{day}", number + 1, {"holds": name, "loads": loads})


def _series(loads: set[str]) -> dict[str, int]:
    """The highest number of each series of loads named series-number."""
    found: dict[str, int] = {}
    for load in loads:
        series, _, number = load.rpartition("-")
        if series and number.isdecimal():
            found[series] = max(found.get(series, -1), int(number))
    return found


def has_landed(spark: SparkSession, path: str, series: str, number: int) -> bool:
    """Whether a numbered load of a series is complete, on its own or inside a compacted day."""
    folder = Folder(spark, path)
    if folder.find(f"load_id={series}-{number}/attempt=*/{MARKER}"):
        return True
    return latest(folder, f"{_LANDED}/{series}")[1].get("last", -1) >= number


def expire_lake(spark: SparkSession, path: str, keep_hours: float = 168) -> int:
    """Delete folders that no reader has seen for so long, and return how many.

    These are loads that a compacted day holds, days compacted anew, attempts that were replaced,
    and attempts never completed. ``keep_hours`` must exceed what a reader or a load takes. Names
    of deleted loads leave the day's file, so it names no more than what lies on disk.
    """
    folder, limit = Folder(spark, path), cutoff(keep_hours)
    complete, live = _complete(folder), {place for _, _, place in _live(folder)}
    published = {
        entry.name: folder.find(f"{_MANIFEST}/{entry.name}/[0-9]*.json")[-1].changed
        for entry in folder.find(f"{_MANIFEST}/*")
    }
    gone = 0
    for entry in folder.find("load_id=*/attempt=*/processing_date=*"):
        load, attempt, day = (part.split("=", 1)[1] for part in entry.path.split("/")[-3:])
        known = complete.get(load)
        if entry.path in live:
            continue
        if known is None or known.attempt < int(attempt):  # not completed
            since = entry.changed
        elif known.attempt > int(attempt):
            since = known.completed
        else:
            since = max(known.completed, published.get(day, known.completed))
        if since <= limit:
            folder.delete(entry.path)
            gone += 1
    for entry in folder.find("load_id=*/attempt=*"):
        load, attempt = (part.split("=", 1)[1] for part in entry.path.split("/")[-2:])
        known = complete.get(load)
        since = entry.changed if known is None or known.attempt < int(attempt) else known.completed
        if since <= limit and not folder.find(f"load_id={load}/{entry.name}/processing_date=*"):
            folder.delete(entry.path)
            if not folder.find(f"load_id={load}/*"):
                folder.delete(f"{folder.path}/load_id={load}")
    left = {e.name.split("=", 1)[1] for e in folder.find("load_id=*")}
    for day in published:
        number, content = latest(folder, f"{_MANIFEST}/{day}")
        loads = [load for load in content["loads"] if load in left]
        if loads != content["loads"]:
            publish(folder, f"{_MANIFEST}/{day}", number + 1, {**content, "loads": loads})
        for old in folder.find(f"{_MANIFEST}/{day}/[0-9]*.json")[:-1]:
            folder.delete(old.path)
    return gone


def _replace(df: DataFrame, path: str, keys: tuple[str, ...], **options: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        # Tasks move their files into the staged folders themselves, the driver whole folders.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .options(**options)
        .partitionBy(*keys)
        .parquet(path)
    )


def seed_lake(spark: SparkSession, path: str, as_of: AsOf = None) -> None:
    """One plausible clean frame under the lake's path, so that readers find a schema."""
    # Readings of the seed frame.
    seed = {
        UNIT: 1, CYCLE: 1, "htBleed": 0.0, "T2": 518.67, "T50": 641.82,
        "P30": 554.43, "Nf": 2388.0, "Nc": 8138.62, "phi": 0.0,
    }
    now = as_of_column(as_of)
    write_lake(
        spark.range(1).select(
            now.alias(TS),
            *[F.lit(value).alias(name) for name, value in seed.items()],
            now.alias("processing_at"),
            F.lit(False).alias(FLAG),
            F.array().cast(REASON_TYPE).alias(REASON),
            F.to_date(now).alias("processing_date"),
        ),
        path,
        "seed",
    )


# --- tick files -------------------------------------------------------------------------


def write_edge(rows: DataFrame, path: str) -> None:
    """Tick files under run, unit and start date."""
    _replace(_dealt_by_folder(rows), path, EDGE_KEYS, **EDGE_PARQUET)


def _dealt_by_folder(rows: DataFrame) -> DataFrame:
    """Bring the rows of a folder together for a write.

    Opening a file takes far longer than writing a few rows, so where folders are many the tasks
    follow their number; ``rebalanced`` follows bytes alone and would leave them all to a few
    tasks. A folder above ``_FOLDER_ROWS`` is dealt to several tasks.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy(*EDGE_KEYS).agg(F.count(F.lit(1)).alias("_rows"))
    found = sizes.agg(
        F.count(F.lit(1)).alias("folders"), F.max("_rows").alias("largest"), F.sum("_rows").alias("rows")
    ).first()
    tasks = max(found.folders // _TASK_FOLDERS, (found.rows or 0) // _FOLDER_ROWS)
    if found.folders < spark.sparkContext.defaultParallelism * _TASK_FOLDERS:
        return rebalanced(rows, *EDGE_KEYS)
    if found.largest <= _FOLDER_ROWS:
        return rows.repartition(tasks, *EDGE_KEYS)
    share = F.xxhash64(UNIT, CYCLE, TS) % F.ceil(F.col("_rows") / F.lit(_FOLDER_ROWS))
    large = sizes.filter(F.col("_rows") > _FOLDER_ROWS)
    placed = join_checked(rows, large, list(EDGE_KEYS), "left").withColumn("_share", F.coalesce(share, F.lit(0)))
    return placed.repartition(tasks, *EDGE_KEYS, "_share").select(*rows.columns)


def read_edge(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(edge_schema().fields + edge_partitions())
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def latest_run_from_edge(spark: SparkSession, path: str) -> DataFrame:
    """Ticks of the last run of each flight, from the folders of winning runs alone.

    Which run wins a flight is read from two columns. Folders of a run and unit that win no
    flight are left out before Spark opens their files; in the others a flight that was flown
    again is dropped by a join. The driver gets names of folders, not flights.
    """
    ticks = read_edge(spark, path)
    winners = cut_lineage(winning_runs(ticks.select("run_id", UNIT, CYCLE).distinct()))
    wanted = winners.select("run_id", F.col(UNIT).alias("unit")).distinct().collect()
    folder = Folder(spark, path)
    places = [f"{folder.path}/run_id={r.run_id}/unit={r.unit}" for r in wanted]
    if not places:
        return ticks
    schema = T.StructType(edge_schema().fields + edge_partitions())
    chosen = spark.read.schema(schema).option("basePath", folder.path).parquet(*places)
    return join_checked(chosen, winners, [UNIT, CYCLE, "run_id"], "left_semi").select(*ticks.columns)


# --- mart and ledger --------------------------------------------------------------------


def write_mart(mart: DataFrame, path: str) -> None:
    """Replace the stored mart as a whole: days that are gone from the mart go."""
    write_parts(_mart_rows(mart), path, "event_date", **MART_FILES)


def write_mart_days(mart: DataFrame, path: str, days: Iterable[date | str]) -> None:
    """Replace the named days by those of ``mart`` in one step; a day without rows goes.

    ``plans.marts.refresh_mart_days`` says which days a change reaches.
    """
    write_parts(_mart_rows(mart), path, "event_date", days, **MART_FILES)


def _mart_rows(mart: DataFrame) -> DataFrame:
    """The declared columns in reading order, reasons as text.

    Rows are dealt by ranges of day and unit, so a file holds few neighbouring units of few days
    however a large day is split, and a unit's filter opens only the files of its range. A hot
    unit is split along its cycles.
    """
    if isinstance(mart.schema[REASON].dataType, T.ArrayType):
        mart = mart.withColumn(REASON, reasons_as_text())
    order = ("event_date", UNIT, CYCLE, EVENT_TS)
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in mart_schema().fields]
    return mart.select(*declared).repartitionByRange(*order).sortWithinPartitions(*order)


def read_mart(
    spark: SparkSession, path: str, days: Iterable[date | str] | None = None
) -> DataFrame:
    """The stored mart; with ``days`` those alone, whose folders alone are listed."""
    return read_parts(spark, path, "event_date", mart_schema(), days)


def save_mart(mart: DataFrame, table: str) -> None:
    """The mart as a catalog table, rebuilt as a whole."""
    rows = rebalanced(mart, "event_date").sortWithinPartitions("event_date", UNIT, CYCLE)
    rows.write.mode("overwrite").partitionBy("event_date").format("parquet").saveAsTable(table)


def rebuild_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Drop, create and load in one step; running it again gives the same table. With ``path``
    the table's files lie there and stay when the table is dropped."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_topic(encoded: DataFrame, servers: str, topic: str) -> None:
    """Publish encoded frames. Needs the Kafka connector on the session."""
    (
        encoded.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
