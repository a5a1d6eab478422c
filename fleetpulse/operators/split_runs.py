"""Windows with a short look-back over runs of any length.

The rules and the moving average look back a fixed number of rows inside one unit. A plain
window puts a whole unit in one task, which fails when a unit holds a large share of the
data. Here a unit that is too long is cut along its own sort order into blocks, each block
gets copies of the last few rows before it, the window runs per (unit, block), and the
copies are dropped again. The result is exactly that of the plain window.

Whether and where to cut is decided from counts that are aggregated map-side, so data with
no long unit keeps the plain window and pays one small count. Cutting goes level by level:
only a block that is still too long is cut again at the next, finer level. The tables that
say which blocks to cut hold at most (all rows / ``max_rows``) rows each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.session import cut_lineage
from fleetpulse.settings import MAX_BROADCAST_ROWS

_SPLIT, _CARRY, _RANK, _NEXT, _ROWS = "_split", "_carry", "_rank", "_next", "_rows"
_FIRST = -(2**62)

# Widths of a timestamp level, in microseconds.
HOUR, MINUTE, SECOND, MILLI = 3_600_000_000, 60_000_000, 1_000_000, 1_000


@dataclass(frozen=True)
class Runs:
    """How rows form runs, and along which (column, width) levels a long run is cut.

    Levels go from coarse to fine and follow ``order``: first all levels of its first
    column, then of the second, and so on.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    levels: tuple[tuple[str, int], ...]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)


@dataclass(frozen=True)
class Cuts:
    """The nodes to cut at each level: whole runs first, then blocks of the level before."""

    runs: Runs
    widths: tuple[int, ...]
    tables: tuple[DataFrame, ...]
    counts: tuple[int, ...]

    @property
    def blocks(self) -> tuple[str, ...]:
        return tuple(f"_block_{depth}" for depth in range(len(self.tables)))

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the block of every row; the rows of a short run share one block."""
        for depth, table in enumerate(self.tables):
            path = (*self.runs.keys, *self.blocks[:depth])
            renamed = table.select(
                *[F.col(name).alias(f"_cut{name}") for name in path], F.lit(True).alias("_cut")
            )
            if self.counts[depth] <= MAX_BROADCAST_ROWS:
                renamed = F.broadcast(renamed)
            same = F.lit(True)
            for name in path:
                same = same & F.col(name).eqNullSafe(F.col(f"_cut{name}"))
            cut = F.col("_cut").isNotNull()
            bucket = _bucket(df, self.runs.levels[depth][0], self.widths[depth])
            block = F.when(cut, bucket).otherwise(F.lit(0).cast("long"))
            added = [block.alias(f"_block_{depth}")]
            if depth == 0:
                added.append(cut.alias(_SPLIT))
            df = df.join(renamed, same, "left").select(*df.columns, *added)
        return df


def _bucket(df: DataFrame, name: str, width: int) -> Column:
    """A long that sorts as the column does, NULL first, and is constant over a bucket."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        mark = F.unix_micros(F.col(name).cast("timestamp"))
    else:
        mark = F.col(name).cast("long")
    mark = F.coalesce(mark, F.lit(_FIRST))
    return mark - F.pmod(mark, F.lit(width).cast("long"))


def plan_cuts(df: DataFrame, runs: Runs, max_rows: int) -> Cuts | None:
    """Count rows per run; None when every run fits one task, else where to cut.

    Runs one small job over the key and order columns, and one more per level that is cut.
    """
    needed = list(dict.fromkeys((*runs.keys, *runs.order)))
    df = df.select(*needed)
    first, width = runs.levels[0]
    totals = (
        df.groupBy(*runs.keys, _bucket(df, first, width).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias(_ROWS))
        .groupBy(*runs.keys)
        .agg(F.sum(_ROWS).alias(_ROWS), F.count(F.lit(1)).alias("_buckets"))
    )
    long_runs = totals.filter(F.col(_ROWS) > F.lit(max_rows))
    found = long_runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(_ROWS).alias("rows"),
        F.sum("_buckets").alias("buckets"),
    ).first()
    if not found.runs:
        return None
    # Sparse buckets are widened until an average one fills half a task.
    widen = max(1, max_rows * found.buckets // (2 * found.rows))
    widths = tuple(w * (widen if n == 0 else 1) for n, (_, w) in enumerate(runs.levels))
    cuts = Cuts(runs, widths, (cut_lineage(long_runs.select(*runs.keys)),), (found.runs,))
    for _ in runs.levels[1:]:
        path = (*runs.keys, *cuts.blocks)
        table = cut_lineage(
            cuts.tag(df)
            .filter(F.col(_SPLIT))
            .groupBy(*path)
            .agg(F.count(F.lit(1)).alias(_ROWS))
            .filter(F.col(_ROWS) > F.lit(max_rows))
            .select(*path)
        )
        count = table.count()
        if not count:
            break
        cuts = Cuts(runs, widths, (*cuts.tables, table), (*cuts.counts, count))
    return cuts


def over_runs(
    df: DataFrame,
    runs: Runs,
    history: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    cuts: Cuts | None,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Apply ``compute(df, window)``, which looks back at most ``history`` rows.

    ``carry`` names the columns the look-back reads (all when None); others are NULL in the
    copied rows, which keeps the scan for them narrow.
    """
    if cuts is None:
        return compute(df, runs.window())
    blocks = cuts.blocks
    tagged = cuts.tag(df)
    own = F.struct(*blocks)
    last_rows = tagged.filter(F.col(_SPLIT)).drop(_SPLIT)
    if carry is not None:
        last_rows = last_rows.select(*dict.fromkeys((*runs.keys, *runs.order, *carry, *blocks)))
    # The row_number filter is pushed below the shuffle, so a task ships only these rows.
    newest_first = Window.partitionBy(*runs.keys, *blocks).orderBy(
        *[F.col(name).desc() for name in runs.order]
    )
    last_rows = (
        last_rows.withColumn(_RANK, F.row_number().over(newest_first))
        .filter(F.col(_RANK) <= F.lit(history))
        .drop(_RANK)
    )
    # A row is needed by every later block that starts within the next ``history`` rows.
    following = F.array(*[F.lead(own, n).over(runs.window()) for n in range(1, history + 1)])
    carried = (
        last_rows.withColumn(_NEXT, following)
        .withColumn(
            _NEXT,
            F.explode(
                F.array_distinct(
                    F.filter(F.col(_NEXT), lambda block: block.isNotNull() & (block != own))
                )
            ),
        )
        .withColumns({name: F.col(_NEXT)[name] for name in blocks})
        .drop(_NEXT)
        .withColumn(_CARRY, F.lit(True))
    )
    rows = tagged.drop(_SPLIT).withColumn(_CARRY, F.lit(False))
    together = rows.unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(*runs.keys, *blocks).orderBy(*runs.order)
    return compute(together, window).filter(~F.col(_CARRY)).drop(_CARRY, *blocks)
