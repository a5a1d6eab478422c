"""Quality rules over frames, one by one and as a pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from fleetpulse.functions import checks as C
from fleetpulse.functions.times import AsOf, age_seconds, as_of_column
from fleetpulse.operators.pick import drop_duplicate_frames, drop_duplicates_by_unit
from fleetpulse.operators.split_runs import (
    HOUR, MILLI, MINUTE, SECOND, Cuts, Runs, over_runs, plan_cuts,
)
from fleetpulse.schema import CYCLE, REASON, TS, UNIT
from fleetpulse.settings import ShieldSettings

DEFAULTS = ShieldSettings()

# A unit's frames by event time; the cycle breaks ties that are left after deduplication.
FRAME_RUNS = Runs(
    keys=(UNIT,),
    order=(TS, CYCLE),
    levels=((TS, HOUR), (TS, MINUTE), (TS, SECOND), (TS, MILLI), (CYCLE, 1)),
)


# --- rules that drop rows ---------------------------------------------------------------


def drop_stale(df: DataFrame, as_of: AsOf = None, settings: ShieldSettings = DEFAULTS) -> DataFrame:
    """Keep frames no older than the limit; future frames stay, frames without a time go."""
    oldest = as_of_column(as_of) - F.expr(f"INTERVAL {settings.max_age_seconds} SECONDS")
    return df.filter(F.col(TS) >= oldest)


# --- rules that look at one row ---------------------------------------------------------


def flag_sla(df: DataFrame, as_of: AsOf = None, settings: ShieldSettings = DEFAULTS) -> DataFrame:
    """Frames that arrived more than the allowed whole seconds after their event."""
    return C.record(C.with_quality_columns(df), {C.SLA_VIOLATION: late(as_of, settings)})


def flag_schema_rot(df: DataFrame, settings: ShieldSettings = DEFAULTS) -> DataFrame:
    """Required readings that are NULL, NaN or infinite; those readings become NULL."""
    names = settings.required_readings
    flagged = C.record(C.with_quality_columns(df), {C.SCHEMA_ROT: C.any_unusable(names)})
    return flagged.withColumns({n: C.blank(n, C.unusable(F.col(n))) for n in names})


def flag_thermocouple_break(df: DataFrame, settings: ShieldSettings = DEFAULTS) -> DataFrame:
    """Exhaust colder than the inlet in operation; the exhaust reading becomes NULL."""
    broken = C.below_inlet(settings.rotor_threshold)
    flagged = C.record(C.with_quality_columns(df), {C.THERMOCOUPLE_BREAK: broken})
    return flagged.withColumn("T50", C.blank("T50", broken))


# --- rules that look back along a unit --------------------------------------------------
#
# ``sized_by`` is a cheaper superset of the frames, such as those before deduplication, to find
# long units by. It affects the plan only.


def flag_zombie_state(
    df: DataFrame, settings: ShieldSettings = DEFAULTS, sized_by: DataFrame | None = None
) -> DataFrame:
    """The cycle counter ran backwards."""
    return _flag_along_runs(df, settings, {C.ZOMBIE_STATE: cycle_fell}, sized_by)


def flag_sensor_freeze(
    df: DataFrame, settings: ShieldSettings = DEFAULTS, sized_by: DataFrame | None = None
) -> DataFrame:
    """Pressure stood still over the horizon while core speed changed; it becomes NULL."""
    rule = frozen(settings.freeze_horizon)
    return _flag_along_runs(df, settings, {C.SENSOR_FREEZE: rule}, sized_by, blank="P30")


def flag_adversarial_drift(
    df: DataFrame, settings: ShieldSettings = DEFAULTS, sized_by: DataFrame | None = None
) -> DataFrame:
    """Fuel flow rose while exhaust temperature fell. Without fuel flow, nothing to do."""
    if "phi" not in df.columns:
        return C.with_quality_columns(df)
    return _flag_along_runs(df, settings, {C.ADVERSARIAL_DRIFT: drifted}, sized_by)


def late(as_of: AsOf, settings: ShieldSettings) -> Column:
    return C.hit(age_seconds(as_of_column(as_of), F.col(TS)) > F.lit(settings.sla_seconds))


def cycle_fell(window: WindowSpec) -> Column:
    return C.hit(F.col(CYCLE) < F.lag(CYCLE, 1).over(window))


def frozen(horizon: int):
    def condition(window: WindowSpec) -> Column:
        reading = F.col("P30")
        still = F.col("Nc") != F.lag("Nc", horizon - 1).over(window)
        for step in range(1, horizon):
            still = still & (reading == F.lag("P30", step).over(window))
        return C.hit(still)

    return condition


def drifted(window: WindowSpec) -> Column:
    return C.hit(
        (F.col("phi") > F.lag("phi", 1).over(window))
        & (F.col("T50") < F.lag("T50", 1).over(window))
    )


def _flag_along_runs(
    df: DataFrame,
    settings: ShieldSettings,
    rules: dict,
    sized_by: DataFrame | None,
    blank: str | None = None,
) -> DataFrame:
    frames = C.with_quality_columns(df)
    cuts = plan_cuts(df if sized_by is None else sized_by, FRAME_RUNS, settings.max_run_rows)
    marked = _mark(frames, rules, settings, cuts)
    hits = {code: F.col(f"_hit_{code}") for code in rules}
    flagged = C.record(marked, hits)
    if blank:
        flagged = flagged.withColumn(blank, C.blank(blank, next(iter(hits.values()))))
    return flagged.select(*frames.columns)


def _mark(frames: DataFrame, rules: dict, settings: ShieldSettings, cuts: Cuts | None) -> DataFrame:
    """Evaluate look-back rules in one pass over the runs, as boolean columns."""

    def compute(df: DataFrame, window: WindowSpec) -> DataFrame:
        return df.withColumns({f"_hit_{code}": rule(window) for code, rule in rules.items()})

    return over_runs(frames, FRAME_RUNS, settings.freeze_horizon - 1, compute, cuts)


# --- the pipeline -----------------------------------------------------------------------


def quality_shield(
    df: DataFrame, as_of: AsOf = None, settings: ShieldSettings = DEFAULTS
) -> DataFrame:
    """All rules in order: duplicates, stale frames, lateness, required readings, cycle order,
    exhaust bound, frozen pressure, drift.

    The exhaust bound is evaluated before the look-back, since drift must see the blanked
    value; reasons still list in rule order. One pass of windows serves all three look-back
    rules. Raw counts decide the shuffles: when no unit is long, frames move once, by unit,
    and duplicates are dropped there; otherwise duplicates collapse map-side first, so that
    copies of one frame never gather in a task, and then frames move by unit and block.
    """
    reference = as_of_column(as_of)
    per_row = isinstance(as_of, Column)
    cuts = plan_cuts(
        df if per_row else drop_stale(df, reference, settings), FRAME_RUNS, settings.max_run_rows
    )
    unique = drop_duplicates_by_unit(df) if cuts is None else drop_duplicate_frames(df)
    frames = drop_stale(unique, reference, settings)
    frames = C.with_quality_columns(frames)
    columns = frames.columns

    frames = with_row_hits(frames, reference, settings)
    marked = _mark(frames, history_rules(df, settings), settings, cuts)
    return assemble(marked, settings).select(*columns)


def history_rules(df: DataFrame, settings: ShieldSettings) -> dict:
    rules = {C.ZOMBIE_STATE: cycle_fell, C.SENSOR_FREEZE: frozen(settings.freeze_horizon)}
    if "phi" in df.columns:
        rules[C.ADVERSARIAL_DRIFT] = drifted
    return rules


def with_row_hits(frames: DataFrame, as_of: AsOf, settings: ShieldSettings) -> DataFrame:
    """Evaluate the one-row rules and blank what they condemn."""
    names = settings.required_readings
    broken = f"_hit_{C.THERMOCOUPLE_BREAK}"
    frames = frames.withColumns(
        {
            f"_hit_{C.SLA_VIOLATION}": late(as_of, settings),
            f"_hit_{C.SCHEMA_ROT}": C.any_unusable(names),
            broken: C.below_inlet(settings.rotor_threshold),
        }
    )
    blanks = {n: C.blank(n, C.unusable(F.col(n))) for n in names}
    return frames.withColumns({**blanks, "T50": C.blank("T50", F.col(broken))})


def assemble(marked: DataFrame, settings: ShieldSettings) -> DataFrame:
    """Turn hits into reasons in rule order, and blank frozen pressure."""
    hits = {
        code: F.col(f"_hit_{code}") for code in C.REASONS if f"_hit_{code}" in marked.columns
    }
    flagged = C.record(marked, hits)
    return flagged.withColumn("P30", C.blank("P30", hits[C.SENSOR_FREEZE])).drop(
        *[f"_hit_{code}" for code in hits]
    )


def rejection_summary(shielded: DataFrame) -> DataFrame:
    """Frames per reason; a frame counts once under each of its reasons."""
    return (
        shielded.select(F.explode(REASON).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("frames"))
    )
