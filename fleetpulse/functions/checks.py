"""Predicates of the quality rules that look at one row, and how hits are recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.schema import FLAG, REASON, REASON_TYPE

# Reason codes, in the order in which the pipeline applies the rules.
SLA_VIOLATION = "SLA_VIOLATION"
SCHEMA_ROT = "SCHEMA_ROT"
ZOMBIE_STATE = "ZOMBIE_STATE_DETECTED"
THERMOCOUPLE_BREAK = "THERMOCOUPLE_BREAK"
SENSOR_FREEZE = "SENSOR_FREEZE"
ADVERSARIAL_DRIFT = "ADVERSARIAL_DRIFT"
REASONS = (
    SLA_VIOLATION, SCHEMA_ROT, ZOMBIE_STATE,
    THERMOCOUPLE_BREAK, SENSOR_FREEZE, ADVERSARIAL_DRIFT,
)


def hit(condition: Column) -> Column:
    """A comparison with NULL is never a hit."""
    return F.coalesce(condition, F.lit(False))


def unusable(reading: Column) -> Column:
    """NULL, NaN or an infinity of either sign."""
    return reading.isNull() | F.isnan(reading) | (F.abs(reading) == F.lit(float("inf")))


def any_unusable(names: tuple[str, ...]) -> Column:
    condition = F.lit(False)
    for name in names:
        condition = condition | unusable(F.col(name))
    return condition


def below_inlet(rotor_threshold: float) -> Column:
    """Exhaust colder than the inlet while the rotor turns."""
    return hit((F.col("T50") < F.col("T2")) & (F.col("Nf") > F.lit(rotor_threshold)))


def blank(reading: str, condition: Column) -> Column:
    """The reading, or NULL where the condition holds."""
    return F.when(~condition, F.col(reading))


def with_quality_columns(df: DataFrame) -> DataFrame:
    """Add the flag and the reasons where absent; bring existing ones to our types.

    Joined text becomes an array again and NULL becomes "clean", so the call is idempotent.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    empty = F.array().cast(REASON_TYPE)
    if FLAG not in fields:
        flag = F.lit(False)
    else:
        flag = F.coalesce(F.col(FLAG), F.lit(False))
    if REASON not in fields:
        reasons = empty
    elif isinstance(fields[REASON], T.StringType):
        reasons = F.when(
            F.length(F.trim(F.col(REASON))) > 0, F.split(F.col(REASON), ",")
        ).otherwise(empty)
    elif isinstance(fields[REASON], T.ArrayType):
        reasons = F.coalesce(F.col(REASON).cast(REASON_TYPE), empty)
    else:
        raise TypeError(f"{REASON} must be text or an array of text")
    return df.withColumns({FLAG: flag, REASON: reasons})


def record(df: DataFrame, hits: dict[str, Column]) -> DataFrame:
    """Append each code whose condition holds (once, in the given order) and set the flag."""
    codes = F.array_compact(
        F.array(*[F.when(condition, F.lit(code)) for code, condition in hits.items()])
    )
    touched = F.lit(False)
    for condition in hits.values():
        touched = touched | condition
    return df.withColumns(
        {
            REASON: F.when(touched, F.array_union(F.col(REASON), codes)).otherwise(F.col(REASON)),
            FLAG: F.col(FLAG) | touched,
        }
    )


def reasons_as_text(separator: str = ",") -> Column:
    """Reasons for the warehouse edge; empty text when clean."""
    return F.array_join(F.col(REASON), separator)
