"""Telemetry, ledger, blueprint and text inputs derived from the given tables.

Each view is SQL that Spark and DuckDB both run, so a check sees the very same input. Sensors
are whole numbers or quarter steps, so sums agree whatever their order.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators.ticks import encode_frames
from fleetpulse.schema import SENSORS, TS, UNIT
from fleetpulse.session import scratch_path

TELEMETRY = """
SELECT CAST(e.user_id % 50 + 1 AS INT) AS unit_number,
  CAST(FLOOR(e.event_id / 100) - CASE WHEN e.event_id % 97 = 0 THEN 5 ELSE 0 END AS INT) AS time_cycles,
  e.ts AS timestamp,
  CASE WHEN e.event_id % 53 = 0 THEN CAST(NULL AS DOUBLE)
       WHEN e.event_id % 59 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN e.event_id % 61 = 0 THEN CAST('Infinity' AS DOUBLE)
       ELSE CAST(390 + e.event_id % 8 AS DOUBLE) END AS htBleed,
  CAST(518.5 AS DOUBLE) AS T2,
  CASE WHEN e.event_id % 41 = 0 THEN CAST(500 AS DOUBLE)
       ELSE CAST(1400 + CAST(FLOOR(e.value) AS BIGINT) % 32 AS DOUBLE) END AS T50,
  CASE WHEN CAST(FLOOR(e.event_id / 500) AS BIGINT) % 4 = 0 THEN CAST(554.25 AS DOUBLE)
       ELSE CAST(540 + e.event_id % 64 AS DOUBLE) END AS P30,
  CAST(CASE WHEN e.event_id % 82 = 0 THEN 1500 ELSE 2388 END AS DOUBLE) AS Nf,
  CAST(8138 + e.event_id % 16 AS DOUBLE) AS Nc,
  CAST(520 + (e.event_id * 7) % 16 AS DOUBLE) AS phi
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 20 = 0) e
"""

# Frames of which some come twice with other readings.
COPIES = """
SELECT CAST(user_id % 50 + 1 AS INT) AS unit_number, CAST(FLOOR(event_id / 100) AS INT) AS time_cycles,
  ts AS timestamp, CAST(event_id % 16 AS DOUBLE) AS Nc, CAST(520 + (event_id * 7) % 16 AS DOUBLE) AS phi
FROM events
UNION ALL
SELECT CAST(user_id % 50 + 1 AS INT) AS unit_number, CAST(FLOOR(event_id / 100) AS INT) AS time_cycles,
  ts AS timestamp, CAST(event_id % 13 AS DOUBLE) AS Nc, CAST(500 + event_id % 11 AS DOUBLE) AS phi
FROM events WHERE event_id % 3 = 0
"""

LEDGER = """
SELECT CAST(o_custkey % 100 + 1 AS INT) AS unit_number, o_orderkey AS time_cycles,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'IN_FLIGHT' ELSE 'PENDING' END AS status,
  CAST(120 + o_orderkey % 181 AS INT) AS target_duration_sec,
  CAST(15 + o_orderkey % 16 AS INT) AS idle_sec
FROM orders
"""

# Flights with all four end states, under four runs.
FLOWN = """
SELECT concat('run_', CAST(o_orderkey % 4 AS STRING)) AS run_id,
  CAST(o_custkey % 100 + 1 AS INT) AS unit_number, o_orderkey AS time_cycles,
  CASE WHEN o_orderkey % 7 = 0 THEN 'INTERRUPTED'
       WHEN o_orderstatus = 'F' THEN 'COMPLETED'
       WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 3 ELSE 120 + o_orderkey % 181 END AS INT)
    AS target_duration_sec
FROM orders
"""

# Flights that were flown again: the same unit and cycle under several runs.
REFLOWN = """
SELECT concat('run_', CAST(o_orderdate AS STRING)) AS run_id,
  CAST(o_custkey % 100 + 1 AS INT) AS unit_number,
  CAST(o_custkey % 37 AS INT) AS time_cycles,
  o_orderkey AS tick
FROM orders
"""

# The same flights as ticks with a time and one reading; few of many runs are the last of any.
REFLOWN_TICKS = """
SELECT concat('run_', CAST(YEAR(o_orderdate) AS STRING)) AS run_id,
  CAST(o_custkey % 40 + 1 AS INT) AS unit_number, CAST(o_custkey % 7 AS INT) AS time_cycles,
  CAST(o_orderdate AS TIMESTAMP) AS timestamp, CAST(o_orderkey % 97 AS DOUBLE) AS T50
FROM orders
"""

# A ledger in which the units and readings of each flight are known.
FLIGHTS = (
    LEDGER.rstrip().removesuffix("FROM orders").rstrip()
    + ",\n  "
    + ",\n  ".join(
        "CAST(0 AS DOUBLE) AS epr"
        if name == "epr"
        else f"CAST({100 + 20 * n} + o_orderkey % {7 + n} AS DOUBLE) AS {name}"
        for n, name in enumerate(SENSORS)
    )
    + "\nFROM orders\n"
)

# Wire frames, with malformed text, unreadable times, missing units and wrong number types.
WIRE = """
SELECT CASE WHEN event_id % 37 = 0 THEN concat('{bad ', CAST(event_id AS STRING))
  ELSE concat('{"timestamp":"',
    CASE WHEN event_id % 41 = 0 THEN 'not a time'
         ELSE concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z') END,
    '","unit_number":',
    CASE WHEN event_id % 43 = 0 THEN 'null' ELSE CAST(user_id % 50 + 1 AS STRING) END,
    ',"time_cycles":',
    CASE WHEN event_id % 29 = 0 THEN '1.5' ELSE CAST(event_id % 1000 AS STRING) END,
    ',"T50":', CAST(1400 + event_id % 32 AS STRING), '.25}') END AS value
FROM events
"""


def _line_sql() -> str:
    """Lines of 26 numbers with ragged blanks; some one field short, some with a letter."""
    fields = [
        "CAST(l_suppkey % 100 + 1 AS STRING)",
        "CAST(l_partkey AS STRING)",
        "CASE WHEN l_partkey % 19 = 0 THEN '4x2' ELSE CAST(l_orderkey % 89 AS STRING) END",
    ]
    fields += [
        f"concat(CAST((l_orderkey * {n} + l_partkey) % 997 AS STRING), '.25')"
        for n in range(4, 26)
    ]
    last = "CASE WHEN l_orderkey % 23 = 0 THEN '' ELSE '7' END"
    parts = ["CASE WHEN l_linenumber % 2 = 0 THEN '  ' ELSE '' END"]
    for n, field in enumerate(fields):
        parts += [field, "'   '" if n % 5 == 0 else "' '"]
    parts += [last, "'  '"]
    line = "concat(" + ", ".join(parts) + ")"
    return (
        f"SELECT CASE WHEN l_orderkey % 101 = 0 THEN '   ' ELSE {line} END AS line FROM lineitem"
    )


LINES = _line_sql()

# The same lines with the file they go to; the number of files grows with the orders.
FILED_LINES = LINES.replace(
    " AS line FROM", " AS line, CAST(FLOOR(l_orderkey / 20000) AS INT) AS batch FROM"
)

# A life vector in words: one line per supplier.
LIVES = """
SELECT s_suppkey, concat('  ', CAST(s_suppkey * 3 % 126 + 6 AS STRING), ' ') AS line FROM supplier
"""

# Status reports: a first wave, a later one that overrides part of it, and an unknown flight.
REPORTS = """
SELECT CAST(o_custkey % 100 + 1 AS INT) AS unit_number, o_orderkey AS time_cycles,
  'COMPLETED' AS status, 1 AS seq FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT CAST(o_custkey % 100 + 1 AS INT) AS unit_number, o_orderkey AS time_cycles,
  'FAILED' AS status, 2 AS seq FROM orders WHERE o_orderkey % 20 = 0
UNION ALL
SELECT CAST(o_custkey % 100 + 1 AS INT) AS unit_number, -1 - o_orderkey AS time_cycles,
  'COMPLETED' AS status, 3 AS seq FROM orders
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that comes in fewer pieces than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def run_view(
    spark: SparkSession, sql: str, sf_dir: str, *names: str, heavy: bool = False
) -> DataFrame:
    """Run a view's SQL over the named tables of a folder; ``heavy`` when its text is costly to
    parse, so that even a table in one file is parsed by all cores."""
    views = []
    for name in names:
        view = f"{name}_{uuid.uuid4().hex}"
        source = table(spark, sf_dir, name)
        (spread(source) if heavy else source).createOrReplaceTempView(view)
        sql = re.sub(rf"\bFROM {name}\b", f"FROM {view}", sql)
        views.append(view)
    result = spark.sql(sql)
    for view in views:
        spark.catalog.dropTempView(view)
    return result


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = run_view(spark, TELEMETRY, sf_dir, "events")
    return frames.withColumn(TS, F.col(TS).cast("timestamp"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_view(spark, LEDGER, sf_dir, "orders")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_view(spark, FLIGHTS, sf_dir, "orders")


def truth(frames: DataFrame) -> DataFrame:
    """A life vector for the units of the frames."""
    units = frames.select(UNIT).distinct()
    return units.withColumn("rul", (F.col(UNIT) * F.lit(3) % F.lit(126) + F.lit(6)).cast("int"))


# --- stream inputs ----------------------------------------------------------------------

SLICE_ROWS = 20_000_000


def write_slices(frames: DataFrame, as_json: bool = False) -> tuple[str, int]:
    """Write frames as a stream source, slice after slice in event time.

    Returns the folder and the number of files per slice. A stream that takes that many files
    per trigger sees one slice per micro-batch, in order, whatever the size of the data. One
    pass sorts the frames into slice folders, so each slice is then read alone.
    """
    spark = frames.sparkSession
    path, staged = scratch_path(spark, "slices"), scratch_path(spark, "staged")
    second = F.unix_seconds(F.col(TS))
    bounds = frames.agg(
        F.count(F.lit(1)).alias("rows"), F.min(second).alias("low"), F.max(second).alias("high")
    ).first()
    if bounds.low is None:
        encoded = encode_frames(frames, F.col(TS)) if as_json else frames
        (encoded.write.text if as_json else encoded.write.parquet)(path)
        return path, 1
    count = max(4, math.ceil(bounds.rows / SLICE_ROWS))
    step = (bounds.high - bounds.low) // count + 1
    files = max(1, min(bounds.rows // (count * 8), spark.sparkContext.defaultParallelism))
    place = F.floor((second - F.lit(bounds.low)) / F.lit(step)).cast("int")
    frames.withColumn("slice", place).write.partitionBy("slice").parquet(staged)
    slices = spark.read.parquet(staged)
    for n in range(count):
        part = slices.filter(F.col("slice") == n).drop("slice").repartition(files)
        if as_json:
            encode_frames(part, F.col(TS)).write.mode("append").text(path)
        else:
            part.write.mode("append").parquet(path)
    return path, files

