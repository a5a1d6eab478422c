"""Whitespace-separated text: blueprint files and life vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.functions.parsing import contract_breach, id_value, numbers, once, tokens
from fleetpulse.operators.joins import join_checked
from fleetpulse.schema import CYCLE, SENSORS, UNIT, blueprint_schema
from fleetpulse.session import cut_lineage
from fleetpulse.sources.versions import read_parts, write_parts

REJECT = "reject_reason"
_SOME_TEXT = r"\S"


def read_lines(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    """Lines that are not blank, as ``line``; with ``numbered`` also ``file`` and the 1-based
    ``line_number`` in it (blank lines count)."""
    raw = spark.read.text(path).withColumnRenamed("value", "line")
    if numbered:
        raw = _number(_placed(raw), "line")
    return raw.filter(F.col("line").rlike(_SOME_TEXT))


def _placed(raw: DataFrame) -> DataFrame:
    """Lines with their file, the piece of it that a task reads, and an id that rises along it."""
    return raw.select(
        "line",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_piece"),
        F.monotonically_increasing_id().alias("_id"),
    )


def _number(placed: DataFrame, wanted: str, within_file: bool = True) -> DataFrame:
    """Number placed lines without a global sort; those stay in which ``wanted`` is known.

    A scan task reads a piece of a file in order, so ids rise along a piece. The tagged lines
    are written once, which fixes the pieces; then a line's number is its place in its piece
    plus the lines in the pieces before, of its file or of all files by name. Only one row per
    piece is moved.
    """
    tagged = cut_lineage(placed)
    along = Window.partitionBy("file").orderBy("_piece") if within_file else Window.orderBy("file", "_piece")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        tagged.groupBy("file", "_piece")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
        .drop("_lines")
    )
    kept = tagged.filter(F.col(wanted).isNotNull())
    others = [c for c in tagged.columns if c not in ("file", "_piece", "_id")]
    return join_checked(kept, pieces, ["file", "_piece"], "inner").select(
        *others, "file", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line_number")
    )


def numbered_rejects(spark: SparkSession, path: str | list[str], file: str | None = None) -> DataFrame:
    """Rejected lines with file, line number and reason; with ``file`` those of it alone, and no
    other is opened. Of an accepted line only its place is written down, not its text."""
    raw = spark.read.text(path).withColumnRenamed("value", "line")
    if file is not None:
        raw = raw.filter(F.col("_metadata.file_path") == file)
    parsed = parse_lines(_placed(raw))
    bad = F.col(REJECT).isNotNull() & F.col("line").rlike(_SOME_TEXT)
    slim = parsed.select(
        "file", "_piece", "_id",
        F.when(bad, F.col("line")).alias("line"), F.when(bad, F.col(REJECT)).alias(REJECT),
    )
    return _number(slim, REJECT).select("file", "line_number", "line", REJECT)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add the typed blueprint columns and the reason why a line is not acceptable."""
    split = once(lines, "_fields", tokens(F.col("line")))
    typed = once(split, "_readings", numbers(F.col("_fields")))
    return typed.select(
        *lines.columns,
        *[id_value(F.col("_fields"), n).alias(name) for n, name in enumerate((UNIT, CYCLE))],
        *[F.get("_readings", F.lit(n)).alias(name) for n, name in enumerate(SENSORS)],
        contract_breach(F.col("line"), F.col("_fields"), F.col("_readings")).alias(REJECT),
    )


def accepted_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNull()).select(*blueprint_schema().names)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    known = [c for c in ("file", "line_number", "line", REJECT) if c in parsed.columns]
    return parsed.filter(F.col(REJECT).isNotNull()).select(*known)


def strict_lines(parsed: DataFrame) -> DataFrame:
    """Blueprint rows; the job fails on a bad line and says where it is."""
    where = (
        F.concat_ws(":", "file", F.col("line_number").cast("string"))
        if "line_number" in parsed.columns
        else F.col("line")
    )
    message = F.concat(where, F.lit(": "), F.col(REJECT))
    first, *rest = blueprint_schema().names
    checked = F.when(F.col(REJECT).isNull(), F.col(first)).otherwise(
        F.raise_error(message).cast("int")
    )
    return parsed.select(checked.alias(first), *rest)


def read_blueprint(
    spark: SparkSession, path: str | list[str], strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Blueprint rows and rejected lines. In strict mode reading the rows fails on a reject.

    Accepted rows come straight from the scan; only what names a line needs line numbers.
    """
    rejects = numbered_rejects(spark, path)
    if strict:
        return strict_lines(parse_lines(read_lines(spark, path, numbered=True))), rejects
    return accepted_lines(parse_lines(read_lines(spark, path))), rejects


class BadLine(ValueError):
    """The first line, by file name and number, that a strict load does not accept."""

    def __init__(self, file: str, line_number: int, reason: str):
        super().__init__(f"{file}:{line_number}: {reason}")
        self.file, self.line_number, self.reason = file, line_number, reason


def load_blueprint_strict(spark: SparkSession, source: str | list[str], table: str) -> None:
    """Replace a stored blueprint by all lines of the source, or leave it as it is.

    The lines are read once and staged beside the table while bad ones are counted. Without any,
    one small file publishes the stage; otherwise the lines of the first file with a bad one are
    numbered, and the first bad one is raised as ``BadLine``.
    """
    seen = Observation()
    bad = F.col(REJECT).isNotNull()
    lines = spark.read.text(source).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    parsed = parse_lines(lines.filter(F.col("line").rlike(_SOME_TEXT))).observe(
        seen, F.count_if(bad).alias("bad"), F.min(F.when(bad, F.col("file"))).alias("file")
    )

    def sound() -> None:
        if seen.get["bad"]:
            rejects = numbered_rejects(spark, source, seen.get["file"])
            first = rejects.agg(F.min(F.struct("file", "line_number", REJECT)).alias("first"))
            raise BadLine(*first.first().first)

    write_parts(accepted_lines(parsed).withColumn("stage", F.lit("whole")), table, "stage", check=sound)


def read_blueprint_table(spark: SparkSession, table: str) -> DataFrame:
    return read_parts(spark, table, "stage", blueprint_schema())


def read_life_vector(spark: SparkSession, path: str) -> DataFrame:
    """Truth per test unit: the entry on line i belongs to unit i.

    A vector in several files goes on from one to the next by their names; each is read by tasks
    of its own, and a line's place is counted from the lines before it.
    """
    lines = _number(_placed(spark.read.text(path).withColumnRenamed("value", "line")), "line", within_file=False)
    return lines.filter(F.col("line").rlike(_SOME_TEXT)).select(
        F.col("line_number").cast("int").alias(UNIT), F.trim("line").cast("int").alias("rul")
    )
