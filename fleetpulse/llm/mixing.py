"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a target in words; target over size says how often its documents are taken. The
whole part of that ratio is taken for sure, the fraction is each document's inclusion
probability. The flight phase moves probabilities along directions that leave two sums as they
are, the expected words and the expected number of documents, until at most two documents of a
set are undecided: of three undecided ones, the direction is the cross product of their two
constraint rows, and its length and sign bring one of them to 0 or 1 without bias.

Sets are blocks of bounded size within a source. Blocks fly side by side; the undecided rest of
all blocks, two rows each, flies again in blocks, until each source has one block. That last
one lands: of the few ways to decide its rows the one nearest to the target is taken.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_of
from fleetpulse.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 5_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, total, target) from (source, total), one row per source.

    Sources by code point, NULL last, have the weights in turn. Targets are the same multiple
    of the weights, save those that stop at ``most`` times their source: that is what sharing
    the excess by weight comes to. The multiple follows from running sums over the sources
    sorted by the multiple at which each one stops.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    table = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    table = table.withColumn("stops", F.lit(most) * F.col("total") / F.col("weight"))
    before = Window.orderBy("stops", F.col("source").cast("binary"))
    full = before.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    table = table.withColumns({
        "stopped": F.lit(most) * F.coalesce(F.sum("total").over(full), F.lit(0)),
        "open": F.sum("weight").over(before.rowsBetween(0, Window.unboundedFollowing)),
        "wanted": F.lit(share) * F.sum("total").over(every),
    })
    rate = (F.col("wanted") - F.col("stopped")) / F.col("open")
    first = F.min(F.when(F.col("stops") >= rate, F.struct("stops", (-rate).alias("minus")))).over(every)
    table = table.withColumn("rate", -first["minus"])
    cap = F.lit(most) * F.col("total")
    return table.select(
        "source", "total",
        F.coalesce(F.least(cap, F.col("weight") * F.col("rate")), cap).cast("double").alias("target"),
    )


def _uniform(*parts: int) -> float:
    return xxhash.xxh64_intdigest(repr(parts)) / 2.0**64


def flight(size: np.ndarray, chance: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities after the flight phase: all but at most two are 0 or 1.

    The sum of probabilities and the sum of probability times size stay the same.
    """
    p = chance.tolist()
    s = size.tolist()
    draws = np.random.default_rng(seed).random(len(p)).tolist() if len(p) else []
    held: list[int] = []
    for n in range(len(p)):
        if not 0.0 < p[n] < 1.0:
            continue
        held.append(n)
        while len(held) == 3:
            a, b, c = held
            u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
            if u == (0, 0, 0):
                u = (1, -1, 0)
            up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(held, u, strict=True) if x)
            down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(held, u, strict=True) if x)
            step = up if draws[n] * (up + down) < down else -down
            for k, x in zip(held, u, strict=True):
                p[k] += step * x
                if p[k] < 1e-9:
                    p[k] = 0.0
                elif p[k] > 1 - 1e-9:
                    p[k] = 1.0
            held = [k for k in held if 0.0 < p[k] < 1.0]
            draws[n] = (draws[n] * 9_973.0) % 1.0  # another draw, if another step is due
    return np.array(p)


def landing(size: np.ndarray, chance: np.ndarray, seed: int) -> np.ndarray:
    """Decide the last few rows: as near to the expected words as their number allows.

    Among equally near ways a draw decides.
    """
    open_rows = np.flatnonzero((chance > 0) & (chance < 1))
    done = chance.copy()
    wanted = float((size[open_rows] * chance[open_rows]).sum())
    count = float(chance[open_rows].sum())
    ways = product((0.0, 1.0), repeat=len(open_rows))
    best = min(
        ways,
        key=lambda w: (
            abs(float(np.dot(w, size[open_rows])) - wanted), abs(sum(w) - count), _uniform(seed, *map(int, w))
        ),
    )
    done[open_rows] = best
    return done


_STATE = "id long, tag long, source string, size long, base long, chance double, draw long, block long"


def _decided(last: bool, seed: int):
    """Flies, and at last lands, the rows of one block of a source."""

    def kernel(table: pa.Table) -> pa.Table:
        order = table.sort_by([("draw", "ascending"), ("id", "ascending"), ("tag", "ascending")])
        size = np.asarray(order["size"].combine_chunks(), np.int64)
        chance = np.asarray(order["chance"].combine_chunks(), np.float64)
        block = order["block"][0].as_py()
        name = order["source"][0].as_py()
        own = xxhash.xxh64_intdigest(f"{seed} {block} {name}") & 0x7FFFFFFF
        chance = flight(size, chance, own)
        if last:
            chance = landing(size, chance, own)
        return order.set_column(order.column_names.index("chance"), "chance", pa.array(chance))

    return kernel


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = SHARE, most: float = MOST, block_rows: int = BLOCK_ROWS,
    seed: int = 5,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken, tag) for each row.

    ``size`` counts words between ASCII white space, NULL texts have none; ``taken`` is size
    times copies, at most ``most`` times the size when that is a whole number. A source's taken
    words differ from its target by about half of a small document. A NULL source is a source.
    Draws depend on ids and text hashes alone, so reruns agree. ``tag`` is a hash of the text.
    Rows of an empty source (no words) are taken as often as a source of the same ratio would.
    """
    text = text_of(text_col)
    rows = cut_lineage(
        docs.select(
            F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"),
        )
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("rows"))
    plan = cut_lineage(
        source_targets(totals.select("source", "total"), weights, share, most)
        .join(totals.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("source").alias("of"), "total", "target", "rows")
    )
    ratio = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0)
    state = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "tag", "source", "size", F.floor(ratio).alias("base"),
        (ratio - F.floor(ratio)).alias("chance"), F.xxhash64(F.lit(seed), "id", "tag").alias("draw"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "id", "tag"), F.ceil(F.col("rows") / block_rows)).alias("block"),
    )
    most_rows = plan.agg(F.max("rows")).first()[0] or 0
    done = state.filter((F.col("chance") <= 0) | (F.col("chance") >= 1))
    parts = [done]
    state = state.filter((F.col("chance") > 0) & (F.col("chance") < 1))
    blocks = -(-most_rows // block_rows)
    level = 0
    while True:
        flown = state.groupBy("source", "block").applyInArrow(_decided(blocks <= 1, seed + level), _STATE)
        if blocks <= 1:
            parts.append(flown)
            break
        flown = cut_lineage(flown)
        parts.append(flown.filter((F.col("chance") <= 0) | (F.col("chance") >= 1)))
        per_block = block_rows // 2
        state = flown.filter((F.col("chance") > 0) & (F.col("chance") < 1)).withColumn(
            "block", F.floor(F.col("block") / per_block)
        )
        blocks = -(-blocks // per_block)
        level += 1
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    copies = (F.col("base") + F.when(F.col("chance") >= 1, 1).otherwise(0)).alias("copies")
    return together.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "size", F.col("total").alias("source_size"), "target", copies,
        (F.col("size") * copies).cast("long").alias("taken"), "tag",
    )


def apply_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how
) -> DataFrame:
    """The documents, each as many times as the mix takes it.

    Rows that agree in id, source and text are dealt their copies together, evenly.
    """
    found = mix(docs, id_col, text_col, source_col, **how)
    dealt = found.groupBy(F.col(id_col).alias("of_id"), F.col("tag").alias("of_tag")).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("alike")
    ).filter(F.col("copies") > 0)
    packed = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_of(text_col)).alias("tag"),
    )
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("tag") == F.col("of_tag"))
    turn = F.row_number().over(Window.partitionBy("of_id", "of_tag").orderBy("tag"))
    share: Column = F.floor(F.col("copies") / F.col("alike")) + F.when(
        turn <= F.col("copies") % F.col("alike"), 1
    ).otherwise(0)
    times = packed.join(dealt, same).withColumn("times", share.cast("int"))
    return times.filter("times > 0").select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("n")
    ).select("doc.*")
