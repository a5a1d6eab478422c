"""The quality rules on a stream.

Duplicates, stale frames and one-row rules are plain streaming expressions. The look-back
rules need each unit's frames in event-time order, so they run in a stateful operator per
unit: frames wait until the watermark has passed them, are then judged in order against the
last few frames before them, and leave. The answer is that of the batch rules.

Waiting frames lie in a state map; a task holds about an hour of a unit at a time. Frames
that arrive behind the watermark leave a stream without a trace, so ``late_frames`` finds them
by comparing what was sent with what was released.
"""

from __future__ import annotations

from datetime import datetime

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import checks as C
from fleetpulse.functions.times import AsOf, as_of_column
from fleetpulse.operators.pick import content_hash, drop_duplicate_frames
from fleetpulse.operators.shield import assemble, drop_stale, with_row_hits
from fleetpulse.schema import FRAME_KEY, TS, UNIT
from fleetpulse.session import ROCKSDB_PROVIDER, STATE_STORE
from fleetpulse.settings import ShieldSettings
from fleetpulse.sources.frames import REJECT
from fleetpulse.streaming import run_rules as R
from fleetpulse.streaming.progress import utc_text

cloudpickle.register_pickle_by_value(R)

LATE = "behind the watermark"


def drop_duplicates_stream(
    frames: DataFrame, settings: ShieldSettings = ShieldSettings()
) -> DataFrame:
    """Drop repeated frames; state of a frame is forgotten once the watermark passes it."""
    return frames.withWatermark(TS, settings.watermark).dropDuplicates(list(FRAME_KEY))


def least_copies_stream(
    frames: DataFrame, settings: ShieldSettings = ShieldSettings()
) -> DataFrame:
    """Of the copies of a frame the one that ``drop_duplicate_frames`` keeps, whichever came first.

    State holds the least copy of each frame until the watermark passes it; then it leaves, so
    frames come out later than from ``drop_duplicates_stream``, by the watermark's delay.
    """
    keys = list(FRAME_KEY)
    rest = [c for c in frames.columns if c not in keys]
    ranked = frames.withColumn("_by", content_hash(frames, FRAME_KEY)).withWatermark(TS, settings.watermark)
    least = ranked.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("_by")).alias("_copy"))
    return least.select(*[c if c in keys else F.col(f"_copy.{c}").alias(c) for c in frames.columns])


def closing_frame(frames: DataFrame, at: str = "2200-01-01 00:00:00") -> DataFrame:
    """One frame of no unit, far after all others.

    Read last from a bounded source, it moves the watermark past every real frame, so the look-back
    rules release all that still waits. It waits itself and never leaves.
    """
    made = {UNIT: F.lit(-1), TS: F.lit(at)}
    return frames.sparkSession.range(1).select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in frames.schema.fields]
    )


def shield_stream(
    frames: DataFrame, as_of: AsOf = None, settings: ShieldSettings = ShieldSettings(),
    span_seconds: int | None = None,
) -> DataFrame:
    """All rules, in the order of the batch pipeline. Input has no quality columns yet.

    Frames are judged by unit, so a unit is one task. With ``span_seconds`` they are judged
    by unit and span of time, and only the few frames at the edges of a span meet by unit. That
    suits units with a large share of all frames and spans of many frames; it takes a second pass
    through Python.
    """
    if frames.sparkSession.conf.get(STATE_STORE, None) != ROCKSDB_PROVIDER:
        raise RuntimeError(f"{STATE_STORE} must be {ROCKSDB_PROVIDER}, as build_session sets it")
    reference = as_of_column(as_of)
    fresh = drop_stale(drop_duplicates_stream(frames, settings), reference, settings)
    packed, payload = _pack(with_row_hits(fresh, reference, settings))
    rules = {C.ZOMBIE_STATE: R.COUNTER_FELL, C.SENSOR_FREEZE: R.FROZEN}
    if R.FUEL in frames.columns:
        rules[C.ADVERSARIAL_DRIFT] = R.DRIFTED
    places = {f.name: n for n, f in enumerate(payload)}
    output = T.StructType(
        [f for f in packed.schema.fields if f.name != TS]
        + [T.StructField(f"hit{n}", T.BooleanType()) for n in range(len(rules))]
    )
    how = (
        [f.name for f in packed.schema.fields if f.name != TS],
        {name: places[name] for name in R.READ if name in places},
        list(rules.values()),
        settings.freeze_horizon,
    )
    if span_seconds is not None:
        micros = span_seconds * 1_000_000
        span = F.floor(F.col(R.MICROS) / micros)
        marks = [(R.SPAN, T.LongType()), (R.EDGE, T.IntegerType()), (R.LANE, T.LongType())]
        marked = packed.withColumn(R.SPAN, span).groupBy(UNIT, R.SPAN).transformWithStateInPandas(
            statefulProcessor=R.SpanRules(*how, micros),
            outputStructType=T.StructType([*output.fields, *[T.StructField(*m) for m in marks]]),
            outputMode="Append",
            timeMode="EventTime",
        )
        judged = marked.groupBy(UNIT, R.LANE).transformWithStateInPandas(
            statefulProcessor=R.EdgeRules(*how), outputStructType=output, outputMode="Append", timeMode="None",
        )
    else:
        judged = packed.groupBy(UNIT).transformWithStateInPandas(
            statefulProcessor=R.RunRules(*how), outputStructType=output, outputMode="Append", timeMode="EventTime",
        )
    frames_back = _unpack(judged, payload).withColumns(
        {f"_hit_{code}": F.col(f"hit{n}") for n, code in enumerate(rules)}
    )
    flagged = assemble(C.with_quality_columns(frames_back), settings)
    return flagged.select(*frames.columns, C.FLAG, C.REASON)


def late_frames(
    frames: DataFrame, released: DataFrame, as_of: AsOf = None,
    settings: ShieldSettings = ShieldSettings(), watermark: datetime | None = None,
) -> DataFrame:
    """Frames that came to a stream too late, with a reason; a batch job over stored tables.

    ``frames`` are those that were sent, ``released`` is the output of ``shield_stream``. A late
    frame is young enough, is not among the released ones, and is not newer than ``watermark``, the
    last one of the stream (``progress.last_watermark``): what that has passed is released or
    lost, whatever else was released. Without a watermark the newest released frame stands for
    it, which misses late frames above that one. One anti-join on the frame's key.
    """
    if watermark is None:
        bound = F.lit(released.agg(F.max(TS).alias("newest")).first().newest)
    else:
        bound = F.lit(utc_text(watermark)).cast("timestamp")
    sent = drop_stale(drop_duplicate_frames(frames), as_of_column(as_of), settings)
    passed = sent.filter(F.col(TS) <= bound).alias("sent")
    known = released.select(*FRAME_KEY).alias("released")
    same = F.lit(True)
    for name in FRAME_KEY:
        same = same & F.col(f"sent.{name}").eqNullSafe(F.col(f"released.{name}"))
    return passed.join(known, same, "left_anti").withColumn(REJECT, F.lit(LATE))


# --- packing ----------------------------------------------------------------------------
#
# Pandas cannot tell NULL from NaN in a double column, but the rules do. Every payload column
# travels as a double, with one bit per column that says NULL and one that says NaN.


def _pack(df: DataFrame) -> tuple[DataFrame, list[T.StructField]]:
    payload = [f for f in df.schema.fields if f.name not in (UNIT, TS)]
    values, nulls, nans = [], F.lit(0).cast("long"), F.lit(0).cast("long")
    for n, field in enumerate(payload):
        value = _as_double(field)
        bit = F.lit(1 << n).cast("long")
        nulls = nulls + F.when(F.col(field.name).isNull(), bit).otherwise(F.lit(0))
        nans = nans + F.when(F.isnan(value), bit).otherwise(F.lit(0))
        values.append(value.alias(f"value{n}"))
    packed = df.select(
        F.col(UNIT),
        F.col(TS),
        F.unix_micros(F.col(TS)).alias(R.MICROS),
        *values,
        nulls.alias(R.NULLS),
        nans.alias(R.NANS),
    )
    return packed, payload


def _as_double(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.BooleanType)):
        return column.cast("double")
    raise TypeError(f"column {field.name} of type {field.dataType.simpleString()} cannot stream")


def _unpack(df: DataFrame, payload: list[T.StructField]) -> DataFrame:
    columns = [F.col(UNIT), F.timestamp_micros(F.col(R.MICROS)).alias(TS)]
    for n, field in enumerate(payload):
        bit = F.lit(1 << n).cast("long")
        value = F.when(
            F.col(R.NANS).bitwiseAND(bit) != 0, F.lit(float("nan"))
        ).otherwise(F.col(f"value{n}"))
        value = F.when(F.col(R.NULLS).bitwiseAND(bit) == 0, value)
        if isinstance(field.dataType, T.TimestampType):
            value = F.timestamp_micros(value.cast("long"))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *[c for c in df.columns if c.startswith("hit")])
