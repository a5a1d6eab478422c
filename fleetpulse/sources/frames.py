"""Wire frames from a topic or from files, decoded with a reject output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.times import AsOf, ingest_date
from fleetpulse.functions.checks import with_quality_columns
from fleetpulse.functions.parsing import once
from fleetpulse.schema import CYCLE, SENSORS, TS, UNIT, wire_schema

REJECT = "reject_reason"


@dataclass(frozen=True)
class TopicSource:
    """A Kafka topic, read from the earliest offset. Needs the Kafka connector on the session.

    ``per_trigger`` bounds a micro-batch, so a replay of the whole topic stays in memory. Lost
    offsets fail the stream; with ``fail_on_data_loss`` off it goes on without them.
    """

    servers: str
    topic: str
    per_trigger: int = 5_000_000
    fail_on_data_loss: bool = True

    def _options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
        }

    def batch(self, spark: SparkSession) -> DataFrame:
        options = {**self._options(), "endingOffsets": "latest"}
        return spark.read.format("kafka").options(**options).load()

    def stream(self, spark: SparkSession) -> DataFrame:
        options = {
            **self._options(),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            "maxOffsetsPerTrigger": str(self.per_trigger),
        }
        return spark.readStream.format("kafka").options(**options).load()


@dataclass(frozen=True)
class FileSource:
    """Text files with one JSON frame per line; the same shape as a topic without a broker."""

    path: str
    per_trigger: int = 1000

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.text(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.option("maxFilesPerTrigger", self.per_trigger).text(self.path)


def read_frames_batch(spark: SparkSession, source: TopicSource | FileSource) -> DataFrame:
    return source.batch(spark)


def read_frames_stream(spark: SparkSession, source: TopicSource | FileSource) -> DataFrame:
    return source.stream(spark)


def decode_frames(raw: DataFrame) -> DataFrame:
    """Typed frames, the raw text, and why a frame cannot be kept.

    A field of the wrong type becomes NULL on its own. A frame is rejected when its text is
    no JSON object with any known field, or when its time or unit is missing or unreadable.
    """
    wire = wire_schema()
    text = raw.select(F.col("value").cast("string").alias("value"))
    flat = once(text, "_f", F.from_json("value", wire)).select(
        "value", *[F.col("_f")[name].alias(name) for name in wire.names]
    )
    known = F.lit(False)
    for name in wire.names:
        known = known | F.col(name).isNotNull()
    at = F.try_to_timestamp(F.col(TS))
    reason = (
        F.when(~known, "malformed frame")
        .when(at.isNull(), "no readable timestamp")
        .when(F.col(UNIT).isNull(), "no unit")
    )
    # The reason reads every column. As a plain column it would stay with the optimizer as a
    # constraint over all of them, and rewriting that for each later alias never ends.
    judged = once(flat, REJECT, reason)
    return judged.withColumns(
        {TS: at, "processing_at": F.try_to_timestamp(F.col("processing_at"))}
    )


def accepted_frames(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REJECT).isNull()).select(TS, UNIT, CYCLE, *SENSORS, "processing_at")


def rejected_frames(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REJECT).isNotNull()).select("value", REJECT)


def with_ingest_columns(frames: DataFrame, as_of: AsOf = None) -> DataFrame:
    """What every ingested frame carries: a clean flag, no reasons, and the ingest date."""
    return with_quality_columns(frames).withColumn("processing_date", ingest_date(as_of))


def topic_size(raw: DataFrame) -> DataFrame:
    """How many messages a bounded read holds."""
    return raw.agg(F.count(F.lit(1)).alias("messages"))
