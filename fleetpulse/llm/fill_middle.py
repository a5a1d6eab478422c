"""Fill-in-the-middle by one match of a counted pattern.

``regexp_count`` gives the number n of a text's units. Two cuts are drawn from a hash of the id,
and a pattern made for the row takes ``unit{a}+`` and ``unit{b-a}+`` as the first two groups and
the rest as the third, so one match gives prefix, middle and suffix. Possessive counts are matched
in a loop without backtracking, so a text may have any number of units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_of

LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
PERCENT = 100
SPM_PERCENT = 50


def _draw(digest: Column, number: int) -> Column:
    """One of the digest's 8-digit groups as an unsigned integer, counted from 0."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
    percent: int = PERCENT, spm_percent: int = SPM_PERCENT, unit: str = LINE,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row.

    ``form`` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: a text
    that is empty or NULL, holds a marker itself, or is not among the ``percent`` drawn. Such a
    text is its own output and has NULL lengths. Cuts and form depend on the id and n alone, so
    rows of one id draw alike; a NULL id draws as an empty one. ``unit`` is a pattern in Java's
    syntax whose matches cover every text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(
        F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), digest.alias("_digest")
    ).withColumn("n", F.regexp_count("_text", F.lit(unit)).cast("long"))
    marked = F.contains("_text", F.lit(PREFIX)) | F.contains("_text", F.lit(SUFFIX)) | F.contains("_text", F.lit(MIDDLE))
    plain = (F.col("_text") == "") | marked | (_draw(F.col("_digest"), 2) % 100 >= percent)
    one, two = (_draw(F.col("_digest"), n) % (F.col("n") + 1) for n in (0, 1))
    rows = rows.select(
        "*",
        F.when(plain, "plain").when(_draw(F.col("_digest"), 3) % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(one, two).alias("_a"),
        F.abs(one - two).alias("_m"),
    )
    pattern = F.concat(
        F.lit(rf"\A((?:{unit}){{"), "_a", F.lit(rf"}}+)((?:{unit}){{"), "_m", F.lit(r"}+)([\s\S]*+)\z")
    )
    # The markers are not in the text, so they part the groups of the one match.
    parted = F.regexp_replace("_text", pattern, F.lit(f"$1{PREFIX}$2{PREFIX}$3"))
    rows = rows.withColumn("_parts", F.when(F.col("form") != "plain", F.split(parted, PREFIX, -1)))
    prefix, middle, suffix = (F.col("_parts")[n] for n in range(3))
    output = (
        F.when(F.col("form") == "plain", F.col("_text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return rows.select(
        F.col("_id").alias(id_col), "n", "form",
        F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(middle).cast("long").alias("middle_chars"),
        output.alias("output"),
    )


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    whole = lambda *order: F.concat(*[parts[n] for n in order])
    return F.when(form == "plain", output).when(form == "psm", whole(1, 3, 2)).otherwise(whole(2, 3, 1))
