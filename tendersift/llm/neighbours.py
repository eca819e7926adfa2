"""Approximate nearest neighbours by inner product through a few stable projections and kd-trees.

Vectors are lifted by one coordinate to equal length, where the largest inner product is the smallest
distance. `PROJECTIONS` Gaussian projections turn a distance d into d * chi with as many degrees of
freedom, so once the next projected neighbour is r away, a nearer one than the k-th found at d_k would
have a projection that long with probability 1 - chi2(r^2 / d_k^2) only; the search stops when the
chi-square test holds at `CONFIDENCE`. Projected space is cut into cells by a kd-tree fitted on a bounded
sample; every vector is indexed in its cell. Each query searches its nearest cells first, then all cells
the test has not ruled out; inside a cell a kd-tree of leaves is read in order of projected distance and
candidates are verified on the original vectors in double precision.

Cells and the queries of a cell are split by counts into parts of bounded size, so a vector that a third
of the table repeats is no large group.

Every row is indexed: rows are told apart by a number of their own, not by their id, and vectors of each length have
projections, cells and a sample share of their own, since an inner product needs two vectors of one length.

Cases: vectors that are null, zero, or hold null or non-finite components take no part. Rows that repeat an id are candidates
and queries each for itself (a query's results are as many as its rows'), a row with a null id is a candidate with a null `vec_id`
and no query. Equal scores go by the smaller id, a null one last; a very long vector is one row of its length's index; other columns
are ignored; no rows, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendersift.llm.texts import read
from tendersift.session import cut_lineage

TOP = 20
EVERY = 20               # queries: ids divisible by this
PROJECTIONS = 8          # even
CONFIDENCE = 0.97
SAMPLE = 20_000          # vectors the cells are fitted on
CELL_ROWS = 512
MOST_CELLS = 4096
PART_ROWS = 1024         # vectors of one cell searched by one task at a time
BLOCK_QUERIES = 4096     # queries that search it at a time
FIRST_CELLS = 4
LEAF_ROWS = 128
SEED = 11


def chi_square(x: np.ndarray, freedom: int = PROJECTIONS) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    h = np.minimum(np.asarray(x, float) / 2, 700)
    term, total = np.ones_like(h), np.ones_like(h)
    for j in range(1, freedom // 2):
        term = term * h / j
        total = total + term
    return 1 - np.exp(-h) * total


def projections(dim: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim + 1, PROJECTIONS))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to length `longest`."""
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(1), 0))
    return np.concatenate((x, rest[:, None]), 1)


def projected_queries(q: np.ndarray, a: np.ndarray) -> np.ndarray:
    return q @ a[:-1]


def split(points: np.ndarray, leaves: int) -> tuple[list[tuple[int, float, int, int]], np.ndarray]:
    """A kd-tree with at most `leaves` leaves: nodes (axis, cut, left, right), negative children are leaves -1-i;
    and the boxes of the leaves, unbounded where no cut bounds them."""
    m = points.shape[1]
    nodes: list[tuple[int, float, int, int]] = []
    boxes: list[np.ndarray] = []

    def grow(p: np.ndarray, n: int, box: np.ndarray) -> int:
        spread = p.max(0) - p.min(0) if len(p) else np.zeros(m)
        axis = int(spread.argmax())
        if n > 1 and len(p) > 1 and spread[axis] > 0:
            cut = float(np.median(p[:, axis]))
            low = p[:, axis] <= cut
            if low.all():
                cut = float(p[p[:, axis] < cut, axis].max())
                low = p[:, axis] <= cut
            at = len(nodes)
            nodes.append((axis, cut, 0, 0))
            left, right = box.copy(), box.copy()
            left[1, axis] = right[0, axis] = cut
            nodes[at] = (axis, cut, grow(p[low], n // 2, left), grow(p[~low], n - n // 2, right))
            return at
        boxes.append(box)
        return -len(boxes)
    grow(points, leaves, np.array([[-np.inf] * m, [np.inf] * m]))
    return nodes, np.array(boxes)


def leaf_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    at = np.full(len(points), 0 if nodes else -1)
    table = np.array(nodes, float).reshape(-1, 4)
    while (open_ := np.flatnonzero(at >= 0)).size:
        n = table[at[open_]]
        low = points[open_, n[:, 0].astype(int)] <= n[:, 1]
        at[open_] = np.where(low, n[:, 2], n[:, 3]).astype(int)
    return -1 - at


def box_distances(q: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Squared projected distances, queries x boxes."""
    out = np.zeros((len(q), len(boxes)))
    for j in range(q.shape[1]):
        x = q[:, j:j + 1]
        out += np.maximum(np.maximum(boxes[:, 0, j] - x, x - boxes[:, 1, j]), 0) ** 2
    return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(pa.chunked_array([column]).combine_chunks().flatten() if isinstance(column, pa.Array) else
                      column.combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)


class Top:
    """The best `k` of each query so far, by score, then by the smaller id, then by place."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.q, self.at, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.kth = np.full(n, -np.inf)

    def add(self, q: np.ndarray, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, at, ids, scores = (np.concatenate(x) for x in ((self.q, q), (self.at, at), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((at, ids, -scores, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.q, self.at, self.ids, self.scores = q[keep], at[order][keep], ids[order][keep], scores[order][keep]
        full = rank == self.k - 1
        self.kth[q[full]] = scores[order][full]


def search(ids: np.ndarray, rows: np.ndarray, x: np.ndarray, qrows: np.ndarray, q: np.ndarray, bound: np.ndarray, longest: float,
           a: np.ndarray, k: int = TOP, confidence: float = CONFIDENCE) -> Top:
    """The best of one part for each query but its own row; `bound` is the k-th score a query has already."""
    px, pq = lifted(x, longest) @ a, projected_queries(q, a)
    nodes, _ = split(px, max(1, -(-len(x) // LEAF_ROWS)))
    leaf = leaf_of(px, nodes)
    order = np.lexsort((rows, leaf))
    edge = np.flatnonzero(np.diff(leaf[order], prepend=-1))
    groups = np.split(order, edge[1:])
    boxes = np.array([[px[g].min(0), px[g].max(0)] for g in groups])
    near = box_distances(pq, boxes)
    turn = np.argsort(near, 1, kind="stable")
    length = (q * q).sum(1)
    top = Top(len(q), k)
    active = np.ones(len(q), bool)
    slack = 1e-10 * (1 + longest * np.sqrt(length))
    for step in range(len(groups)):
        best = np.maximum(top.kth, bound)
        far = np.maximum(length + longest * longest - 2 * best, 1e-300)
        r = np.take_along_axis(near, turn[:, step:step + 1], 1)[:, 0]
        active &= ~((best > -np.inf) & (chi_square(r / far) >= confidence))
        if not active.any():
            break
        for g in np.unique(turn[active, step]):
            who = np.flatnonzero(active & (turn[:, step] == g))
            member = groups[g]
            s = q[who] @ x[member].T
            floor = np.maximum(top.kth[who], bound[who])
            if s.shape[1] > k:
                floor = np.maximum(floor, -np.partition(-s, k, 1)[:, k] if s.shape[1] > k else -np.inf)
            i, j = np.nonzero((s >= (floor - slack[who])[:, None]) & (rows[member][None, :] != qrows[who][:, None]))
            if len(i):
                a_, b_ = who[i], member[j]
                top.add(a_, b_, ids[b_], (q[a_] * x[b_]).sum(1))
    return top


@dataclass
class Cells:
    """The projected space of the vectors of one length."""
    longest: float
    a: np.ndarray
    nodes: list[tuple[int, float, int, int]]
    boxes: np.ndarray
    first: int       # the number of its first cell


def by_length(b: pa.RecordBatch, rows: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of at most `rows` rows whose vectors (column `e`) have one length, with that length."""
    size = pc.list_value_length(b.column(b.schema.get_field_index("e"))).to_numpy()
    for d in np.unique(size):
        t = b.take(pa.array(np.flatnonzero(size == d)))
        for at in range(0, t.num_rows, rows):
            yield int(d), t.slice(at, rows)


class Index:
    """Cells of the projected spaces with every vector of the table in its cell."""

    def __init__(self, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding"):
        v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
        whole = v.filter("e is not null and size(e) > 0 and forall(e, x -> x is not null and "
                         "not isnan(x) and abs(x) < double('Infinity')) and exists(e, x -> x <> 0)")
        kept = cut_lineage(whole.withColumn("row", F.monotonically_increasing_id()))
        sizes = kept.groupBy(F.size("e").alias("d")).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.expr("aggregate(e, 0D, (s, x) -> s + x * x)")).alias("m")).orderBy("d").collect()
        part = kept.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("e").toArrow().combine_chunks()
        seen = dict[int, list[np.ndarray]]()
        for b in part.to_batches():
            for d, t in by_length(b, SAMPLE):
                seen.setdefault(d, []).append(matrix(t.column(0), d))
        self.cells, first = dict[int, Cells](), 0
        for r in sizes:      # a row per length
            a, longest = projections(r["d"]), math.sqrt(r["m"])
            sample = lifted(np.concatenate(seen[r["d"]]), longest) @ a if r["d"] in seen else np.zeros((0, PROJECTIONS))
            nodes, boxes = split(sample, min(MOST_CELLS, max(1, -(-r["n"] // CELL_ROWS))))
            self.cells[r["d"]] = Cells(longest, a, nodes, boxes, first)
            first += len(boxes)
        placed = cut_lineage(kept.select("row", "vec_id", "e").mapInArrow(self._place(), "cell int, row long, vec_id long, e array<double>"))
        parts = cut_lineage(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("long").alias("parts")))
        self.parts = parts     # a row per cell
        self.placed = cut_lineage(placed.join(F.broadcast(parts), "cell")
                                  .withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts"))

    def _place(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        cells = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for d, b in by_length(whole, whole.num_rows):
                    c = cells[d]
                    cell = c.first + leaf_of(lifted(matrix(b.column(2), d), c.longest) @ c.a, c.nodes)
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *b.columns], ["cell", "row", "vec_id", "e"])
        return run

    def _route(self, first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """(query, query_id, e, bound) -> a row for every cell to search: the nearest ones, or the others not ruled out."""
        cells, confidence = self.cells, CONFIDENCE

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for d, b in by_length(whole, 512):
                    c = cells[d]
                    q = matrix(b.column(2), d)
                    near = box_distances(projected_queries(q, c.a), c.boxes)
                    rank = np.argsort(np.argsort(near, 1, kind="stable"), 1, kind="stable")
                    if first:
                        go = rank < FIRST_CELLS
                    else:
                        best = np.array([-np.inf if x is None else x for x in b.column(3).to_pylist()])
                        far = np.maximum((q * q).sum(1) + c.longest * c.longest - 2 * best, 1e-300)
                        far[best == -np.inf] = np.inf
                        go = (rank >= FIRST_CELLS) & (chi_square(near / far[:, None]) < confidence)
                    i, cell = np.nonzero(go)
                    t = b.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays([pa.array(c.first + cell, pa.int32()), *t.columns],
                                                     ["cell", "query", "query_id", "e", "bound"])
        return run

    def _search(self, routed: DataFrame, k: int) -> DataFrame:
        """(query, query_id, row, vec_id, score): the best `k` of every part searched."""
        routed = cut_lineage(routed)
        blocks = cut_lineage(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("long").alias("blocks")))
        parts = self.parts.join(F.broadcast(blocks), "cell")   # a row per cell, as `blocks`
        asked = (routed.join(F.broadcast(parts), "cell").withColumn("block", F.pmod(F.xxhash64("query"), "blocks"))
                 .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).drop("parts", "blocks"))
        held = (self.placed.join(F.broadcast(blocks), "cell").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
                .drop("blocks"))
        cells = self.cells
        last = np.iinfo(np.int64).max

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            names = ["query", "query_id", "row", "vec_id", "score"]
            if not left.num_rows or not right.num_rows:
                return pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], names)
            d = len(left.column("e")[0])
            bound = np.array([-np.inf if x is None else x for x in right.column("bound").to_pylist()])
            top = search(pc.fill_null(left.column("vec_id"), last).to_numpy(), left.column("row").to_numpy(), matrix(left.column("e"), d),
                         right.column("query").to_numpy(), matrix(right.column("e"), d), bound, cells[d].longest, cells[d].a, k)
            asked, at = right.take(pa.array(top.q)), left.take(pa.array(top.at))
            return pa.table([asked.column("query"), asked.column("query_id"), at.column("row"), at.column("vec_id"), pa.array(top.scores)], names)
        key = ["cell", "part", "block"]
        return held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
            run, "query long, query_id long, row long, vec_id long, score double")

    def nearest(self, every: int = EVERY, k: int = TOP) -> DataFrame:
        """(query_id, rank, vec_id, score) for each row whose id is divisible by `every`."""
        asked = self.placed.filter(F.col("vec_id") % every == 0).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "e")
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
        kinds = "cell int, query long, query_id long, e array<double>, bound double"
        first = cut_lineage(self._search(asked.withColumn("bound", F.lit(None).cast("double")).mapInArrow(self._route(True), kinds), k)
                            .withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k).drop("_r"))
        kth = first.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
        again = asked.join(kth, "query", "left").select("query", "query_id", "e", "bound").mapInArrow(self._route(False), kinds)
        found = first.union(self._search(again, k))
        return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def op8_stable_projection_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(read(spark, sf_dir, "embeddings")).nearest()
