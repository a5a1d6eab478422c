"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard drawn from a hash. In
each round a linked document learns, by joins, in which shard most of its group lies and wishes
to move there; of the wishes between two shards as many are granted as go the other way, plus
a share of the room that the wanted shard's quota leaves beside its linked documents. Unlinked
documents make way in the end, so shards stay even while cut links fall.
A group larger than a quarter of a shard is first cut into parts of that size, each with links
of its own, so no group has to fit into one shard.

The law is ``rows``: in the end counts differ by one at most. Rows above a shard's quota move to
shards with room, unlinked ones first. Ranks within a shard come from counts per slice of a
hash and a row number inside the slice, so no task sees a whole shard.

Everything is DataFrame operations. Only tables with a row per pair of shards reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import text_of
from fleetpulse.session import cut_lineage

SHARDS = 24
ROUNDS = 4
SLICE_ROWS = 10_000
_UNIT = 1 << 30


def _draw(*salt: Column) -> Column:
    """A number from 0 to 1 that depends on these values alone."""
    return F.pmod(F.xxhash64(*salt), F.lit(_UNIT)) / F.lit(float(_UNIT))


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for each row.

    ``size`` is the UTF-8 length of the text plus 8, and NULL texts are empty. ``slot`` counts
    from 0 without gaps in each shard. ``grown_shard`` is NULL, as the law is not ``key``. Rows
    with NULL or repeated ids are rows like any other. An empty table gives an empty result.
    """
    text = text_of(text_col)
    rows = cut_lineage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ).withColumn("spread", F.xxhash64(F.lit("shard"), "doc_id", "text_hash"))
    )
    group = ["text_hash", "text_crc32", "size"]
    total = rows.count()
    part_rows = max(1, total // (4 * shards))
    # Stored apart from the counting, so that the join below may split a hot group.
    groups = cut_lineage(
        rows.groupBy(*group).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )
    start = F.pmod(F.xxhash64(F.lit("start"), "spread"), F.lit(shards)).cast("int")
    spread_parts = F.ceil(F.col("copies") / F.lit(part_rows))
    part = F.when(
        F.col("copies").isNotNull(),
        F.xxhash64(*group, F.pmod(F.xxhash64(F.lit("part"), "spread"), spread_parts)),
    )
    placed = cut_lineage(
        rows.join(groups, group, "left").select(
            "doc_id", "size", "text_crc32", "spread", part.alias("part"), start.alias("shard")
        )
    )
    single = placed.filter(F.col("part").isNull()).withColumn("home", F.lit(False))
    linked = placed.filter(F.col("part").isNotNull())
    for turn in range(rounds):
        wishes = cut_lineage(_wishes(linked))
        flows = {
            (r.shard, r.want): r.n
            for r in wishes.filter(F.col("shard") != F.col("want"))
            .groupBy("shard", "want").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        linked = wishes.drop("want")
        if not flows:
            break
        granted = _granted(flows, _loads(linked, shards), total / shards, shards)
        chance = _pick(granted, F.col("shard") * shards + F.col("want"))
        goes = _draw(F.lit(turn), F.col("spread")) < chance
        linked = wishes.select(
            *[c for c in linked.columns if c != "shard"],
            F.when(goes, F.col("want")).otherwise(F.col("shard")).alias("shard"),
        )
    last = _wishes(linked).withColumn("home", F.col("shard") == F.col("want")).drop("want")
    together = cut_lineage(last.unionByName(single))
    return _settle(together, total, shards).select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def _loads(df: DataFrame, shards: int) -> list[int]:
    found = {r.shard: r.n for r in df.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _wishes(linked: DataFrame) -> DataFrame:
    """Each linked row with the shard that holds most of its part; a hash decides ties."""
    tally = linked.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct("n", F.xxhash64("part", "shard"))
    best = tally.groupBy("part").agg(F.max_by("shard", order).alias("want"))
    return linked.join(best, "part")


def _granted(flows: dict, loads: list[int], cap: float, shards: int) -> list[float]:
    """The share of wishes granted for each pair of shards, row by row."""
    left = {k: n - min(n, flows.get((k[1], k[0]), 0)) for k, n in flows.items()}
    into = [sum(left.get((a, b), 0) for a in range(shards)) for b in range(shards)]
    shares = []
    for a in range(shards):
        for b in range(shards):
            n = flows.get((a, b), 0)
            if not n:
                shares.append(0.0)
                continue
            room = max(0.0, cap - loads[b])
            extra = left[(a, b)] * min(1.0, room / into[b]) if into[b] else 0.0
            shares.append((n - left[(a, b)] + extra) / n)
    return shares


def _settle(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Final shards of exactly even counts, and slots."""
    loads = _loads(rows, shards)
    largest = set(sorted(range(shards), key=lambda s: (-loads[s], s))[: total % shards])
    quota = [total // shards + (s in largest) for s in range(shards)]
    over = [max(0, n - q) for n, q in zip(loads, quota, strict=True)]
    free = [max(0, q - n) for n, q in zip(loads, quota, strict=True)]
    over_before = [sum(over[:s]) for s in range(shards)]
    free_before = [sum(free[:s]) for s in range(shards)]
    slices = max(4, -(-total // (shards * SLICE_ROWS)))
    stay = F.when(F.col("home"), 0).when(F.col("part").isNotNull(), 1).otherwise(2)
    cell = ["shard", "stay", "slice"]
    keyed = rows.withColumns({"stay": stay, "slice": F.pmod("spread", F.lit(slices))})
    before = Window.partitionBy("shard").orderBy("stay", "slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = keyed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*cell).orderBy("spread", "doc_id", "text_crc32", "size")
    ranked = (
        keyed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(offsets, cell)
        .withColumn("rank", F.col("inside") + F.col("offset"))
    )
    moves = F.col("rank") >= _pick(quota, F.col("shard"))
    place = _pick(over_before, F.col("shard")) + F.col("rank") - _pick(quota, F.col("shard"))
    roomy = [s for s in range(shards) if free[s]] or [0]
    marks = F.array(*[F.lit(free_before[s]) for s in roomy])
    found = F.size(F.filter(marks, lambda m: m <= F.col("place"))) - 1
    target = F.element_at(F.array(*[F.lit(s) for s in roomy]), F.col("found") + 1)
    slot_there = _pick([loads[s] - free_before[s] for s in roomy], F.col("found")) + F.col("place")
    return (
        ranked.withColumn("place", F.when(moves, place))
        .withColumn("found", F.when(moves, found))
        .select(
            "doc_id", "size", "text_crc32",
            F.when(moves, target).otherwise(F.col("shard")).cast("int").alias("shard"),
            F.when(moves, slot_there).otherwise(F.col("rank")).cast("long").alias("slot"),
        )
    )
