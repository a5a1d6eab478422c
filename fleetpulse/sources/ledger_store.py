"""The flight ledger as a stored table in buckets, of which a batch of reports rewrites only its own.

A bucket is a hash of the flight, so a flight's bucket follows from a report. A stored flight also
knows the number (``seq``) of the report that set its status, so reports that come again, late or
in another order change nothing. A new state is published as a whole (``versions``).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.operators.ledger import FLIGHT_KEY
from fleetpulse.session import cut_lineage
from fleetpulse.sources.versions import note_of, query_id, read_parts, write_parts

BUCKET_ROWS = 500_000
SEQ = "report_seq"
_BUCKET = "bucket"


def _bucket(buckets: int) -> Column:
    key = [F.col(name).cast("long") for name in FLIGHT_KEY]
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def store_ledger(ledger: DataFrame, path: str, buckets: int | None = None) -> None:
    """Replace the stored ledger; no report has been applied to the new one.

    Without ``buckets`` their number follows a count, so that a bucket is one file of some
    hundred thousand flights however large the ledger is.
    """
    if buckets is None:
        buckets = max(8, math.ceil(ledger.count() / BUCKET_ROWS))
    _write(ledger.withColumn(SEQ, F.lit(None).cast("long")), path, buckets, None)


def _write(
    rows: DataFrame, path: str, buckets: int, touched: list[int] | None, applied: dict | None = None
) -> None:
    note = {"buckets": buckets, "schema": rows.schema.json(), "applied": applied or {}}
    rows = rows.withColumn(_BUCKET, _bucket(buckets)).repartition(_BUCKET)
    write_parts(rows, path, _BUCKET, touched, note)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All flights, without the numbers of their reports."""
    return _read(spark, path, note_of(spark, path)).drop(SEQ)


def _read(spark: SparkSession, path: str, note: dict, only: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(note["schema"]))
    return read_parts(spark, path, _BUCKET, schema, only)


def apply_reports(
    spark: SparkSession, path: str, reports: DataFrame, series: str | None = None, number: int = 0
) -> list[int]:
    """Set the last reported status of the flights that ``reports`` names; returns the buckets read.

    ``reports`` has the flight key, ``status`` and ``seq``; of several for a flight the highest
    ``seq`` counts, also against those applied before. Unknown flights are ignored. The driver
    gets the numbers of buckets, which the ledger bounds. A batch with a ``series`` and a
    ``number`` not above that of the series' last one is not looked at.
    """
    note = note_of(spark, path)
    applied = dict(note.get("applied", {}))
    if series is not None and number <= applied.get(series, -1):
        return []
    last = cut_lineage(
        reports.groupBy(*FLIGHT_KEY)
        .agg(F.max(F.struct("seq", "status")).alias("_last"))
        .select(*FLIGHT_KEY, F.col("_last.seq").cast("long").alias("_seq"), F.col("_last.status").alias("_status"))
        .withColumn(_BUCKET, _bucket(note["buckets"]))
    )
    touched = sorted(r[0] for r in last.select(_BUCKET).distinct().collect())
    if not touched:
        return []
    ledger = _read(spark, path, note, touched)
    newer = F.col("_seq").isNotNull() & (F.col(SEQ).isNull() | (F.col("_seq") > F.col(SEQ)))
    changed = (
        ledger.join(last.drop(_BUCKET), list(FLIGHT_KEY), "left")
        .withColumn("status", F.when(newer, F.col("_status")).otherwise(F.col("status")))
        .withColumn(SEQ, F.when(newer, F.col("_seq")).otherwise(F.col(SEQ)))
        .select(*ledger.columns)
    )
    if series is not None:
        applied[series] = number
    _write(changed, path, note["buckets"], touched, applied)
    return touched


def start_report_ingest(
    reports: DataFrame, path: str, checkpoint: str, once: bool = False, trigger: str = "10 seconds"
) -> StreamingQuery:
    """Apply a stream of reports, batch by batch. A batch that is tried again changes nothing."""
    spark = reports.sparkSession
    series = ""

    def land(batch: DataFrame, number: int) -> None:
        nonlocal series
        series = series or query_id(spark, checkpoint)
        apply_reports(batch.sparkSession, path, batch, series, number)

    writer = reports.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()
