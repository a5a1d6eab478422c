"""The prefix trie of conversations, rolled up in bands of depth.

Every conversation starts with the first turns of its base conversation (``rebuilt``), so many
share a prefix. A node is a distinct prefix. It is known by the xor of one 128-bit hash for each
of its (depth, role, text), so a running xor along a conversation names all its prefixes.

Totals over subtrees go up in two moves. First each node explodes to its ancestors within its own
band, ``height`` depths high, and sums are taken there. Then the band roots, the nodes at the
top of a band, form a trie that is lower by that factor, and the same function completes their
totals. A completed root then explodes once to the band above it. So a node makes at most
2 * ``height`` rows, and rounds follow the logarithm of the depth.

A conversation of any length is numbered and hashed in pieces; no task holds one as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.operators.running import running_sum
from fleetpulse.operators.split_runs import Runs
from fleetpulse.session import cut_lineage

HEIGHT = 16
STRIDE = 20  # a conversation's base is its id less the remainder by this, as in SQL
SHARED = 4  # it takes fewer turns than this from it
PIECE = 1024  # turns whose hashes are combined in one window
MAX_RUN_ROWS = 100_000
ID_BITS = 12  # ids that end in one node are joined in blocks of so many low bits
_WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["k1", "k2"]


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % SHARED).cast("long")


def numbered(turns: DataFrame, max_run_rows: int = MAX_RUN_ROWS) -> DataFrame:
    """(conv, pos, h1, h2, words) for each turn: its place from 1, two hashes, its words.

    NULL role and text are empty; turns without a conversation are left out. NULL turns come
    first; turns of one number are ordered by their hash, so equal rows are the only ties.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    ).filter(F.col("conv").isNotNull())
    levels = (("turn", 1024), ("turn", 1), ("h1", 1 << 52), ("h1", 1 << 40))
    runs = Runs(keys=("conv",), order=("turn", "h1", "h2"), levels=levels)
    return running_sum(rows, runs, "one", "pos", max_run_rows).select("conv", "pos", "h1", "h2", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, h1, h2, words): the numbered turns of each rebuilt conversation, and its root.

    The root is depth 0, without hashes and words; a conversation left without turns has only
    this row.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    wanted = sizes.select(
        F.col("conv").alias("to"),
        (F.col("conv") - F.col("conv") % STRIDE).alias("conv"),
        shared_turns(F.col("conv")).alias("take"),
    )
    heads = turns.filter((F.col("pos") < SHARED) & (F.col("conv") % STRIDE == 0))
    given = (
        heads.join(wanted, "conv")
        .filter(F.col("pos") <= F.col("take"))
        .select(F.col("to").alias("conv"), F.col("pos").alias("depth"), "h1", "h2", "words")
    )
    of_base = sizes.select("conv", F.least(F.col("size"), F.lit(SHARED - 1)).alias("there"))
    starts = wanted.join(of_base, "conv", "left").select(
        F.col("to").alias("conv"),
        (F.least(F.coalesce("there", F.lit(0)), "take") - F.col("take")).alias("shift"),
    )
    own = (
        turns.filter(F.col("pos") > shared_turns(F.col("conv")))
        .join(starts, "conv")
        .select("conv", (F.col("pos") + F.col("shift")).alias("depth"), "h1", "h2", "words")
    )
    none = F.lit(0).cast("long")
    roots = sizes.select("conv", *[none.alias(c) for c in ("depth", "h1", "h2", "words")])
    return given.unionByName(own).unionByName(roots)


def prefixes(rows: DataFrame, deepest: int, piece: int = PIECE) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, words, last): the key of each prefix and of its parent."""
    part = lambda h, seed: F.when(
        F.col("depth") > 0, F.xxhash64(F.lit(seed), h, "depth")
    ).otherwise(F.lit(0).cast("long"))
    rows = rows.select("conv", "depth", "words", part("h1", 2).alias("t1"), part("h2", 3).alias("t2"))
    last = F.max("depth").over(Window.partitionBy("conv")) if deepest < piece else None
    if last is not None:
        run = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
        keyed = rows.select(
            "*", F.bit_xor("t1").over(run).alias("k1"), F.bit_xor("t2").over(run).alias("k2"),
            last.alias("end"),
        )
    else:
        rows = rows.withColumn("piece", F.floor(F.col("depth") / piece))
        totals = rows.groupBy("conv", "piece").agg(
            F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"), F.max("depth").alias("end")
        )
        along = Window.partitionBy("conv").orderBy("piece")
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("conv")
        zero = F.lit(0).cast("long")
        offsets = totals.select(
            "conv", "piece", F.coalesce(F.bit_xor("t1").over(before), zero).alias("o1"),
            F.coalesce(F.bit_xor("t2").over(before), zero).alias("o2"), F.max("end").over(whole).alias("end"),
        )
        run = Window.partitionBy("conv", "piece").orderBy("depth")
        run = run.rowsBetween(Window.unboundedPreceding, 0)
        keyed = rows.select(
            "*", F.bit_xor("t1").over(run).alias("x1"), F.bit_xor("t2").over(run).alias("x2")
        ).join(offsets, ["conv", "piece"])
        keyed = keyed.withColumn("k1", F.col("x1").bitwiseXOR(F.col("o1"))).withColumn(
            "k2", F.col("x2").bitwiseXOR(F.col("o2"))
        )
    return keyed.select(
        "conv", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"), "words", (F.col("depth") == F.col("end")).alias("last"),
    )


def roll_up(values: DataFrame, paths: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """(k1, k2, leaves, saved) summed over each node's subtree.

    ``values`` has (k1, k2, conv, pos, leaves, saved) of each node, ``conv`` being one whose path
    leads through it; ``paths`` has (conv, pos, k1, k2) for these, with every pos from 0 on.
    """
    bands = cut_lineage(
        paths.groupBy("conv", F.floor(F.col("pos") / height).alias("band")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "k1", "k2"))).alias("path")
        )
    )

    def summed(rows: DataFrame, path: Column) -> DataFrame:
        up = rows.select(F.explode(path).alias("to"), "leaves", "saved")
        return up.groupBy(F.col("to.k1").alias("k1"), F.col("to.k2").alias("k2")).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )

    placed = values.withColumn("band", F.floor(F.col("pos") / height)).join(bands, ["conv", "band"])
    within = summed(placed, F.slice("path", F.lit(1), (F.col("pos") % height + 1).cast("int")))
    if deepest < height:
        return within
    within = cut_lineage(within)
    tops = values.filter(F.col("pos") % height == 0)
    lower = tops.drop("leaves", "saved").join(within, _KEY).withColumn("pos", F.floor(F.col("pos") / height))
    of_tops = paths.filter(F.col("pos") % height == 0).withColumn("pos", F.floor(F.col("pos") / height))
    complete = roll_up(lower, of_tops, deepest // height, height)
    above = (
        tops.filter(F.col("pos") > 0)
        .select(*_KEY, "conv", (F.floor(F.col("pos") / height) - 1).alias("band"))
        .join(complete, _KEY)
        .join(bands, ["conv", "band"])
    )
    return within.unionByName(summed(above, F.col("path"))).groupBy(_KEY).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the conversations that end in each node, ids ascending.

    Ids are joined in blocks of close numbers. A node of one block is hashed at once; the blocks
    of others run through one hash in order, a block in memory at a time.
    """
    pieces = cut_lineage(
        ends.groupBy(*_KEY, F.shiftright("conv", ID_BITS).alias("block"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
    )
    counts = pieces.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.max("ids").alias("ids"))
    single = counts.filter(F.col("n") == 1).select(*_KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    many = pieces.join(counts.filter(F.col("n") > 1).select(*_KEY), _KEY, "left_semi")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        out: list[tuple] = []
        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, running.hexdigest()))
                    key, running = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            if len(out) > 10_000:
                yield _digests(out)
                out = []
        if key is not None:
            out.append((*key, running.hexdigest()))
        yield _digests(out)

    ordered = many.repartition(*[F.col(c) for c in _KEY]).sortWithinPartitions(*_KEY, "block")
    hashed = ordered.select(*_KEY, "ids").mapInArrow(kernel, "k1 long, k2 long, ends_sha256 string")
    return single.unionByName(hashed)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["k1", "k2", "ends_sha256"]
    )


def prefix_trie(
    conversations: DataFrame, height: int = HEIGHT, piece: int = PIECE, max_run_rows: int = MAX_RUN_ROWS
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (the smallest member), depth, parent_conv_id (NULL at the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. Needs conv_id, turn, role and text; other columns are
    ignored. NULL turns come first, NULL roles and texts are empty, rows without conv_id are left
    out, repeated rows are turns of their own, and an empty table gives no rows.
    """
    turns = cut_lineage(numbered(conversations, max_run_rows))
    rows = cut_lineage(rebuilt(turns))
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    every = cut_lineage(prefixes(rows, deepest, piece))
    nodes = cut_lineage(
        every.groupBy(*_KEY).agg(
            F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
            F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        )
    )
    children = (
        nodes.filter(F.col("depth") > 0)
        .groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut_lineage(nodes)
    values = nodes.select(
        *_KEY, "conv", F.col("depth").alias("pos"), (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    paths = every.join(nodes.select("conv").distinct(), "conv", "left_semi")
    paths = paths.select("conv", F.col("depth").alias("pos"), *_KEY)
    totals = roll_up(values, paths, deepest, height)
    ends = ends_digest(every.filter("last").select(*_KEY, "conv"))
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id")
    )
    named = nodes.filter(F.col("depth") > 0).join(parents, ["p1", "p2"])
    top = nodes.filter(F.col("depth") == 0).withColumn("parent_conv_id", F.lit(None).cast("long"))
    found = named.unionByName(top).join(totals, _KEY).join(ends, _KEY, "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
        F.col("n_children").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
