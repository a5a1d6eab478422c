"""Line deduplication over levelled sorted runs of line keys.

The state is a set of runs, each a table of distinct keys, bucketed and sorted by key. A batch
of documents is merge-anti-joined with the runs: keys that the runs have settled already are
left out, the rest becomes a run of level 0. When a level holds ``fan_out`` runs they are
merged into one run of the next level. Runs share their bucketing, so neither the anti-joins
nor the merges move them; a key is rewritten once for each level.

Batches come by falling id. A key is settled once ``min_docs`` documents hold it, and its
largest id is that of the first batch with it, so a run row never changes after that.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import shuffle_partitions, text_of
from fleetpulse.session import cut_lineage, scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN_OUT = 2
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    bare = F.trim(line, F.lit(_BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _UPPER.lower())
    )


class LineRuns:
    """The runs, by level. Each row: key, number of documents, largest id."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT, min_docs: int = MIN_DOCS):
        self.spark, self.fan_out, self.min_docs = spark, fan_out, min_docs
        self.buckets = shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.names: list[str] = []

    def add(self, keys: DataFrame) -> None:
        """Take in a batch: (key, docs, top) with one row per key."""
        for settled in self._settled():
            keys = keys.join(settled, "key", "left_anti")
        self._push(0, self._write(keys))

    def _settled(self) -> list[DataFrame]:
        """Keys with enough documents, by run; counts that span runs meet when these merge."""
        return [
            self.spark.table(name).filter(F.col("docs") >= self.min_docs).select("key")
            for level in self.levels for name in level
        ]

    def _push(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            merged = self._write(self._merged(self.levels[level]))
            self.levels[level] = []
            self._push(level + 1, merged)

    def _merged(self, names: list[str]) -> DataFrame:
        def join(left: DataFrame, right: DataFrame) -> DataFrame:
            renamed = right.select("key", F.col("docs").alias("more"), F.col("top").alias("other"))
            return left.join(renamed, "key", "full").select(
                "key",
                (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"),
                F.greatest("top", "other").alias("top"),
            )

        return reduce(join, map(self.spark.table, names))

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        run.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option(
            "path", scratch_path(self.spark, "line-run")
        ).format("parquet").saveAsTable(name)
        return name

    def repeated(self) -> DataFrame:
        """(key, top) of the keys that enough documents hold, from all runs merged."""
        names = [name for level in self.levels for name in level]
        return self._merged(names).filter(F.col("docs") >= self.min_docs).select("key", "top")

    def release(self) -> None:
        """Forget the tables; their files lie in the scratch folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _batch_of(lines: DataFrame, ids: DataFrame, batches: int) -> DataFrame:
    """Adds the batch of each line: 0 has the largest ids. NULL ids come last."""
    shares = [n / batches for n in range(1, batches)]
    cuts = ids.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else None
    above = [F.when(F.col("id") > F.lit(c), 1).otherwise(0) for c in cuts or []]
    return lines.withColumn("batch", reduce(lambda a, b: a - b, above, F.lit(batches - 1)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_out: int = FAN_OUT,
) -> DataFrame:
    """(doc, id, n_lines, n_dropped, kept) for each row; ``doc`` holds the input columns.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their
    lines except in the document of the largest id that holds them. Rows with the same id are
    one document, those with a NULL id together one that has the smallest id. A NULL or empty
    text is one empty line. Keys are compared by their MD5.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_of(text_col)).alias("tag"), text_of(text_col).alias("text"),
    )
    split = base.select("id", "tag", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = split.select("id", "tag", "pos", line_key(F.col("line")).alias("bare"))
    lines = keyed.filter(F.length("bare") >= min_chars).select(
        F.coalesce("id", F.lit(-(2**63))).alias("id"), "tag", "pos",
        F.unhex(F.md5(F.col("bare").cast("binary"))).alias("key"),
    )
    lines = cut_lineage(_batch_of(lines, docs.select(F.col(id_col).cast("long").alias("id")), batches))
    runs = LineRuns(spark, fan_out, min_docs)
    for batch in range(batches):
        held = lines.filter(F.col("batch") == batch).select("key", "id").distinct()
        runs.add(held.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("top")))
    repeated = cut_lineage(runs.repeated())
    runs.release()
    hits = (
        lines.join(repeated, "key")
        .filter(F.col("id") != F.col("top"))
        .groupBy("id", "tag")
        .agg(F.collect_set("pos").alias("dropped"))
        .select(F.col("id").alias("hit_id"), F.col("tag").alias("hit_tag"), "dropped")
    )
    # The lines are made below the join, so that the lambda reads an array that is there.
    whole = base.select("doc", "id", "tag", F.split("text", "\n", -1).alias("lines"))
    same = (F.coalesce("id", F.lit(-(2**63))) == F.col("hit_id")) & (F.col("tag") == F.col("hit_tag"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(every, F.col("dropped")), lambda n: F.get("lines", n))
    return whole.join(hits, same, "left").select(
        "doc",
        "id",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(left), "\n").alias("kept"),
    )


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """The documents with their kept text, and its length where there is such a column."""
    found = dedup_lines(docs, id_col, text_col)
    columns = []
    for field in docs.schema.fields:
        old = F.col("doc").getField(field.name)
        if field.name == text_col:
            old = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(old)
        elif field.name == length_col:
            old = F.when(F.col("n_dropped") > 0, F.length("kept").cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return found.select(*columns)
