"""Expressions that turn text into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.schema import SENSORS

IDS = 2

# Java accepts "1.0d", "1f" and hex floats as numbers; the text contract does not. The pattern is
# tried only on lines with one of its letters.
_NOT_A_NUMBER = r"(?i)[0-9.][df](\s|$)|0x"
_ITS_LETTERS = "[dfxDFX]"
_BLANKS = "\t\n\x0b\f\r"  # that are no space


def tokens(line: Column) -> Column:
    """Fields of a line separated by runs of blanks; outer blanks are ignored."""
    # A split at one plain character needs no pattern, and takes a third of a pattern's time.
    other = F.lit(False)
    for blank in _BLANKS:
        other = other | F.contains(line, F.lit(blank))
    spaced = F.when(other, F.translate(line, _BLANKS, " " * len(_BLANKS))).otherwise(line)
    return F.array_remove(F.split(spaced, " "), "")


def numbers(fields: Column) -> Column:
    """The fields after the two ids as doubles; NULL where a field is none."""
    return F.transform(
        F.slice(fields, IDS + 1, len(SENSORS)), lambda field: field.try_cast("double")
    )


def id_value(fields: Column, index: int) -> Column:
    return F.get(fields, F.lit(index)).try_cast("int")


def contract_breach(line: Column, fields: Column, readings: Column) -> Column:
    """Why a line breaks the contract of 2 integers and 24 doubles, or NULL."""
    width = IDS + len(SENSORS)
    bad = (line.rlike(_ITS_LETTERS) & line.rlike(_NOT_A_NUMBER)) | F.exists(readings, lambda reading: reading.isNull())
    for index in range(IDS):
        bad = bad | id_value(fields, index).isNull()
    found = F.concat(F.lit(f"expected {width} fields, found "), F.size(fields).cast("string"))
    return F.when(F.size(fields) != width, found).when(bad, F.lit("field is not a number"))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column in a way that it is evaluated once per row.

    A plain projection would be merged into the filters and projections above it, and a parse
    that many of them read would run again for each. A one-element explode is not merged.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
