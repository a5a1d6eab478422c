"""Streams from a source of wire frames into the lake, with a quarantine for rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.functions.times import AsOf
from fleetpulse.settings import ShieldSettings
from fleetpulse.sources.frames import (
    FileSource, TopicSource, accepted_frames, decode_frames, read_frames_stream,
    rejected_frames, with_ingest_columns,
)
from fleetpulse.sources.lake import has_landed, write_lake
from fleetpulse.sources.versions import query_id
from fleetpulse.streaming.progress import observed
from fleetpulse.streaming.shield import shield_stream

# Fixed value: how often a micro-batch starts.
TRIGGER = "10 seconds"


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: tuple[str, ...] = (),
    once: bool = False,
) -> StreamingQuery:
    """Append to Parquet exactly once; with ``once`` take what is there and stop."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if keys:
        writer = writer.partitionBy(*keys)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def start_lake_ingest(
    spark: SparkSession,
    source: TopicSource | FileSource,
    path: str,
    checkpoint: str,
    shield: ShieldSettings | None = None,
    as_of: AsOf = None,
    once: bool = False,
    rejects: str | None = None,
    counted_as: str | None = None,
) -> StreamingQuery:
    """Decode frames and add them to the lake, through the quality rules if asked for.

    Each micro-batch is a load named by the stream and its number. A batch that is tried again
    although its load is complete, on its own or inside a day compacted since, adds nothing, so it
    cannot turn up a second time under the date of the second try. ``compact_lake`` merges loads
    later, beside the running stream.

    ``rejects`` names a folder for what could not be decoded, read and decoded together with the
    rest. Behind the quality rules rejects are gone, so there use ``start_quarantine``.
    ``counted_as`` names the run that ``LiveCounters`` knows the accepted and rejected frames of
    each batch by; they are observed in the same pass.
    """
    frames = decode_frames(read_frames_stream(spark, source))
    if shield is not None:
        if rejects is not None:
            raise ValueError("with quality rules, rejects need a stream of their own")
        frames = shield_stream(accepted_frames(frames), as_of, shield)
    if counted_as is not None:
        frames = observed(frames, counted_as)
    series = ""

    def land(batch: DataFrame, number: int) -> None:
        nonlocal series
        # Only the first batch of a run can be one that was tried before.
        first, series = not series, series or _series_of(spark, checkpoint)
        done = first and has_landed(spark, path, series, number)
        load = f"{series}-{number}"
        if rejects is not None:
            batch = batch.persist()
        good = batch if shield is not None else accepted_frames(batch)
        if not done:
            write_lake(with_ingest_columns(good, as_of), path, load)
        if rejects is not None:
            rejected_frames(batch).write.mode("overwrite").parquet(f"{rejects}/load_id={load}")
            batch.unpersist()

    writer = frames.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def _series_of(spark: SparkSession, checkpoint: str) -> str:
    """The stream's name: that of its query, which stays with the checkpoint."""
    return "stream-" + query_id(spark, checkpoint).replace("-", "")


def start_quarantine(
    spark: SparkSession,
    source: TopicSource | FileSource,
    path: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Keep what could not be decoded, with the reason."""
    rejects = rejected_frames(decode_frames(read_frames_stream(spark, source)))
    return write_stream(rejects, path, checkpoint, once=once)
