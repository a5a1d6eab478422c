"""The one declaration of every column; all other schemas are derived from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The 24 readings in the order of the text file and of the wire frame.
SENSORS = (
    "op_setting_1", "op_setting_2", "op_setting_3",
    "T2", "T24", "T30", "T50",
    "P2", "P15", "P30",
    "Nf", "Nc", "epr", "Ps30", "phi", "NRf", "NRc", "BPR", "farB",
    "htBleed", "Nf_dmd", "PCNfR_dmd", "W31", "W32",
)

# Identity columns of a reading and what makes two frames the same frame.
UNIT = "unit_number"
CYCLE = "time_cycles"
TS = "timestamp"
FRAME_KEY = (UNIT, CYCLE, TS)

# Names the warehouse models add.
EVENT_TS = "event_timestamp"
AVERAGE = "t50_moving_avg_10"

# Ledger states.
PENDING = "PENDING"
IN_FLIGHT = "IN_FLIGHT"
INTERRUPTED = "INTERRUPTED"
COMPLETED = "COMPLETED"
FAILED = "FAILED"

REASON = "corruption_reason"
FLAG = "is_corrupted"
REASON_TYPE = T.ArrayType(T.StringType(), containsNull=True)


def _ids() -> list[T.StructField]:
    return [T.StructField(UNIT, T.IntegerType()), T.StructField(CYCLE, T.IntegerType())]


def _readings() -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in SENSORS]


def blueprint_schema() -> T.StructType:
    """One row per flight cycle as the text files hold it: 2 integers and 24 doubles."""
    return T.StructType(_ids() + _readings())


def wire_schema() -> T.StructType:
    """The JSON frame: both times are text on the wire."""
    return T.StructType(
        [T.StructField(TS, T.StringType())]
        + _ids()
        + _readings()
        + [T.StructField("processing_at", T.StringType())]
    )


def frame_schema() -> T.StructType:
    """A decoded frame: both times are timestamps."""
    return T.StructType(
        [T.StructField(TS, T.TimestampType())]
        + _ids()
        + _readings()
        + [T.StructField("processing_at", T.TimestampType())]
    )


def edge_schema() -> T.StructType:
    """Tick files written next to the engine, without the partition keys in the path."""
    return T.StructType([T.StructField(TS, T.TimestampType())] + _ids() + _readings())


def edge_partitions() -> list[T.StructField]:
    return [
        T.StructField("run_id", T.StringType()),
        T.StructField("unit", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]


def lake_schema() -> T.StructType:
    """The lake table; reasons are joined text at this edge, partition keys come last."""
    columns = [f for f in frame_schema().fields if f.name != UNIT]
    return T.StructType(
        columns
        + [
            T.StructField(FLAG, T.BooleanType()),
            T.StructField(REASON, T.StringType()),
            T.StructField("processing_date", T.DateType()),
            T.StructField(UNIT, T.IntegerType()),
        ]
    )


def mart_schema() -> T.StructType:
    """The stored health mart; reasons are joined text, the partition key comes last."""
    readings = ("T2", "T50", "P30", "Nf", "Nc", "phi", "htBleed", "egt_margin")
    return T.StructType(
        _ids()
        + [T.StructField(EVENT_TS, T.TimestampType())]
        + [T.StructField(name, T.DoubleType()) for name in readings]
        + [
            T.StructField(FLAG, T.BooleanType()),
            T.StructField(REASON, T.StringType()),
            T.StructField(AVERAGE, T.DoubleType()),
            T.StructField("event_date", T.DateType()),
        ]
    )


def ledger_schema() -> T.StructType:
    """The flight ledger: 3 bookkeeping columns, then the blueprint."""
    return T.StructType(
        [
            T.StructField("status", T.StringType()),
            T.StructField("flight_start_time", T.TimestampType()),
            T.StructField("target_duration_sec", T.IntegerType()),
        ]
        + blueprint_schema().fields
    )
