"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to length one and cut in half. Each half has a codebook of its own, so the
pairs of codes form a grid of cells. A vector lies in the cell of its nearest codes and looks
for neighbours in the cells that the multi-sequence traversal visits: in the order of a lower
bound on the distance to anything in them, nearest first. The bound of a half is the distance
to the plane between the nearest code and the cell's; the squares of both halves add up.

The traversal stops at a bound set beforehand from the target recall: neighbours exactly at the
threshold are simulated around a sample of vectors, and the bound is the quantile of those
needed to reach their cells. The largest useful bound is the threshold's own distance, at which
nothing can be missed.

Equal vectors of a label are one node before any of this. Cells with many vectors are cut into
blocks, and every block of neighbours meets every block of searchers; a block emits counts and
a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.components import components
from fleetpulse.session import cut_lineage

THRESHOLD = 0.98
TARGET_RECALL = 0.999
SAMPLE_ROWS = 20_000
CELL_ROWS = 24  # vectors of a label that a cell should hold on average
BLOCK_ROWS = 2_000
MAX_CODES = 1_024


@dataclass
class Grid:
    """Codebooks of both halves and the bound at which a traversal stops."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def codes(self) -> int:
        return len(self.second)

    def visits(self, vectors: np.ndarray) -> Iterator[list[int]]:
        """For each unit vector the cells to visit, its own first."""
        half = self.first.shape[1]
        a = _bounds(vectors[:, :half], self.first)
        b = _bounds(vectors[:, half:], self.second)
        limit = self.reach**2
        for left, right in zip(a, b, strict=True):
            yield self._walk(left, right, limit)

    def _walk(self, left: np.ndarray, right: np.ndarray, limit: float) -> list[int]:
        """Multi-sequence traversal of the grid by the sum of squared bounds."""
        near, far = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
        x, y = (left[near] ** 2).tolist(), (right[far] ** 2).tolist()
        cells, heap, seen = [], [(0.0, 0, 0)], {(0, 0)}
        while heap:
            total, i, j = heapq.heappop(heap)
            if total > limit and cells:
                break
            cells.append(int(near[i]) * self.codes + int(far[j]))
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(x) and q < len(y) and (p, q) not in seen:
                    seen.add((p, q))
                    heapq.heappush(heap, (x[p] + y[q], p, q))
        return cells


def _distances(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of points and codes."""
    return np.maximum(
        0, (points**2).sum(1)[:, None] - 2 * points @ codes.T + (codes**2).sum(1)[None, :]
    )


def _bounds(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """At least how far each point is from anything nearest to each code; 0 for its own."""
    squares = _distances(points, codes)
    own = squares.argmin(1)
    between = np.sqrt(_distances(codes, codes))
    gap = squares - squares[np.arange(len(points)), own][:, None]
    bounds = gap / np.maximum(2 * between[own], 1e-12)
    bounds[np.arange(len(points)), own] = -1e-9  # first among ties
    return bounds


def _codebook(points: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    codes = points[rng.choice(len(points), count, replace=False)]
    for _ in range(10):
        nearest = _distances(points, codes).argmin(1)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, points)
        codes = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], codes)
    return np.unique(codes, axis=0)


def fit_grid(
    sample: np.ndarray, codes: int, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
    seed: int = 11,
) -> Grid:
    """Codebooks of at most ``codes`` entries, and the bound for the recall wanted."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1]
    half = size // 2
    count = min(codes, len(sample))
    grid = Grid(
        _codebook(sample[:, :half], count, rng), _codebook(sample[:, half:], count, rng),
        float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9,
    )
    if recall >= 1 or size < 2:
        return grid
    some = sample[rng.choice(len(sample), min(len(sample), 2_000), replace=False)]
    some = np.repeat(some, max(1, 4_000 // len(some)), axis=0)
    aside = rng.standard_normal(some.shape)
    aside -= (aside * some).sum(1)[:, None] * some
    aside /= np.maximum(np.sqrt((aside**2).sum(1)), 1e-12)[:, None]
    moved = threshold * some + np.sqrt(1 - threshold**2) * aside
    needed = np.zeros(len(some))
    for part, codes_of in ((slice(None, half), grid.first), (slice(half, None), grid.second)):
        home = _distances(moved[:, part], codes_of).argmin(1)
        bound = np.maximum(0, _bounds(some[:, part], codes_of)[np.arange(len(some)), home])
        needed += bound**2
    grid.reach = min(grid.reach, float(np.sqrt(np.quantile(needed, recall))) + 1e-9)
    return grid


def scaled_vectors(vectors: pa.Array) -> np.ndarray:
    """The vectors of a list column, all of one length, as rows.

    Each is brought near one by a power of two, which leaves cosines as they are and keeps the
    squares of very large and very small numbers within range.
    """
    rows = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None]) if len(rows) else rows


def unit_vectors(vectors: pa.Array) -> np.ndarray:
    """The vectors of a list column, all of one length, as rows of length one."""
    rows = scaled_vectors(vectors)
    return rows / np.sqrt((rows**2).sum(1))[:, None]


def _classes(rows: DataFrame) -> DataFrame:
    """Usable vectors, equal ones of a label as one row: (label, vec, rep, copies)."""
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = rows.filter(
        F.col("label").isNotNull() & F.col("id").isNotNull() & F.col("vec").isNotNull()
        & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda v: v != 0)
    )
    return usable.groupBy("label", "vec").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )


def _visit_rows(classes: DataFrame, grid: Grid) -> DataFrame:
    """A row for each visit: (label, cell, home, own, rep, copies, vec); own is its home cell."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_024):
                some = batch.slice(start, 1_024)
                cells = list(grid.visits(unit_vectors(some.column(1))))
                take = pa.array(np.repeat(np.arange(len(cells)), list(map(len, cells))))
                flat = np.array([c for row in cells for c in row], np.int64)
                home = np.concatenate([np.arange(len(row)) == 0 for row in cells])
                own = np.repeat(np.array([row[0] for row in cells], np.int64), list(map(len, cells)))
                label, vec, rep, copies = (some.column(n).take(take) for n in range(4))
                yield pa.RecordBatch.from_arrays(
                    [label, pa.array(flat), pa.array(home), pa.array(own), rep, copies, vec],
                    names=["label", "cell", "home", "own", "rep", "copies", "vec"],
                )

    return classes.select("label", "vec", "rep", "copies").mapInArrow(
        kernel, "label long, cell long, home boolean, own long, rep long, copies long, vec array<double>"
    )


def _into_blocks(visits: DataFrame, block_rows: int) -> DataFrame:
    """Adds the block of neighbours and of searchers that a row goes to; large cells have many."""
    sizes = visits.groupBy("label", "cell").agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("visits")
    )
    large = cut_lineage(sizes.filter((F.col("visits") > block_rows) & (F.col("homes") > 0)))
    if large.isEmpty():
        return visits.select(
            "*", F.lit(0).alias("near"), F.lit(0).alias("far"), F.col("home").alias("sought"),
            F.lit(True).alias("seeks"),
        )
    blocks = large.select(
        "label", "cell", F.ceil(F.col("homes") / block_rows).alias("nears"),
        F.ceil(F.col("visits") / block_rows).alias("fars"),
    )
    nears, fars = F.coalesce("nears", F.lit(1)), F.coalesce("fars", F.lit(1))
    own_near = F.pmod(F.xxhash64("rep"), nears)
    own_far = F.pmod(F.xxhash64(F.lit("far"), "rep"), fars)
    as_far = F.transform(
        F.sequence(F.lit(0).cast("long"), nears - 1),
        lambda n: F.struct(n.alias("near"), own_far.alias("far"),
                           (F.col("home") & (n == own_near)).alias("sought"), F.lit(True).alias("seeks")),
    )
    as_near = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), fars - 1), lambda n: F.col("home") & (n != own_far)),
        lambda n: F.struct(own_near.alias("near"), n.alias("far"), F.lit(True).alias("sought"),
                           F.lit(False).alias("seeks")),
    )
    return (
        visits.join(blocks, ["label", "cell"], "left")
        .withColumn("at", F.explode(F.concat(as_far, as_near)))
        .select("label", "cell", "home", "own", "rep", "copies", "vec", "at.*")
    )


def _block_links(threshold: float, grid: Grid):
    """Matches within a block: links per row, and a spanning forest.

    A match counts for its searcher. It also counts for the row found where that one's own
    traversal does not visit the searcher's home cell, so every match counts once on either side.
    """
    limit = grid.reach**2
    half = grid.first.shape[1]

    def kernel(table: pa.Table) -> pa.Table:
        reps = np.asarray(table["rep"].combine_chunks())
        order = np.argsort(reps, kind="stable")
        reps = reps[order]
        sought = np.asarray(table["sought"].combine_chunks())[order]
        seeks = np.asarray(table["seeks"].combine_chunks())[order]
        copies = np.asarray(table["copies"].combine_chunks())[order]
        raw = scaled_vectors(table["vec"].combine_chunks())[order]
        length = np.sqrt((raw**2).sum(1))
        own = np.asarray(table["own"].combine_chunks())[order]
        near = np.flatnonzero(sought)
        units = raw[near] / length[near][:, None]
        first = np.maximum(0, _bounds(units[:, :half], grid.first)) ** 2
        second = np.maximum(0, _bounds(units[:, half:], grid.second)) ** 2
        names = np.arange(len(reps))
        out: list[tuple] = []
        searchers = np.flatnonzero(seeks) if len(near) else np.zeros(0, np.int64)
        for start in range(0, len(searchers), 256):
            rows = searchers[start : start + 256]
            cosine = (raw[rows] @ raw[near].T) / (length[rows][:, None] * length[near][None, :])
            match = (cosine >= threshold) & (reps[rows][:, None] != reps[near][None, :])
            back = first[:, own[rows] // grid.codes] + second[:, own[rows] % grid.codes] <= limit
            unseen = copies[rows] @ (match & ~back.T)
            out += [(int(reps[near[n]]), int(unseen[n]), None) for n in np.flatnonzero(unseen)]
            for n in np.flatnonzero(match.any(1)):
                me, found = rows[n], near[match[n]]
                out.append((int(reps[me]), int(copies[found].sum()), None))
                groups, firsts = np.unique(names[found], return_index=True)
                for group, at in zip(groups.tolist(), firsts.tolist(), strict=True):
                    if group != names[me]:
                        out.append((int(reps[me]), 0, int(reps[found[at]])))
                        names[names == group] = names[me]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table(
            {k: pa.array(list(c), pa.int64()) for k, c in zip(("rep", "links", "other"), columns, strict=True)}
        )

    return kernel


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS, codes: int | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row.

    Rows are linked when their labels are equal and the cosine of their vectors, in double
    precision, is at least the threshold. Every match is verified, so no link is wrong; a pair
    may be missed with a probability of about 1 - ``recall`` when it is just at the threshold.
    Rows with a NULL label or id, and vectors that are NULL, empty or zero or hold NULL or
    non-finite numbers, have no links and are their own component. Vectors of different lengths
    never match. The codebooks are fitted on at most ``sample_rows`` vectors chosen by a hash,
    and every vector is indexed. Rows with the same id count as different vectors.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vec"),
    )
    classes = cut_lineage(_classes(rows))
    sizes = [r for r in classes.groupBy(F.size("vec").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels")
    ).collect()]
    found = None
    for r in sorted(sizes, key=lambda r: r.size):
        part = classes.filter(F.size("vec") == r.size)
        sample = (
            part.orderBy(F.xxhash64("rep", "label"), "rep").limit(sample_rows).select("vec").toArrow()
        )
        count = codes or min(MAX_CODES, max(1, round((r.n / r.labels / CELL_ROWS) ** 0.5)))
        grid = fit_grid(unit_vectors(sample["vec"].combine_chunks()), count, threshold, recall)
        blocks = _into_blocks(_visit_rows(part, grid), block_rows)
        links = blocks.groupBy("label", "cell", "near", "far").applyInArrow(
            _block_links(threshold, grid), "rep long, links long, other long"
        )
        found = links if found is None else found.union(links)
    if found is None:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )
    found = cut_lineage(found)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.filter(F.col("other").isNotNull()).select("rep", "other"), "rep", "other")
    named = (
        classes.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root", "rep").alias("root"),
        )
    )
    plain = rows.withColumn("mark", F.xxhash64("label", "vec"))
    named = named.withColumn("mark", F.xxhash64("label", "vec"))
    joined = plain.join(
        named.select("mark", F.col("label").alias("label_of"), F.col("vec").alias("vec_of"), "links", "root"),
        "mark", "left",
    )
    same = (F.col("label") == F.col("label_of")) & (F.col("vec") == F.col("vec_of")) & F.col("id").isNotNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(same, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        F.when(same, F.col("root")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce(F.when(same, F.col("root")).otherwise(F.col("id")) == F.col("id"), F.lit(True)).alias("kept"),
    )
