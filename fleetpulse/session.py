"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Set on any session that runs our plans; each is a runtime setting.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method above 8000 bytes. Wide frames reach that; such a stage is
    # ten times faster as separate operators, whose code Spark splits into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Map state and timers of the stream rules need it.
    STATE_STORE: ROCKSDB_PROVIDER,
}


def build_session(app: str = "fleetpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with our runtime settings; anything else is left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local one is made only for a local master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return named or current
    if named:
        context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fleetpulse-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a small result once, in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
