"""Mixing sources to target weights by balanced sampling (the cube method).

Every source has a target number of words: its weight's share of `share` times all words, at most
`most` times its own, the excess going to the others by weight. A document of a source at rate r is
taken floor(r) times, and once more with probability r - floor(r); the cube method moves these
fractional probabilities inside the null space of two balance constraints (words and documents of the
source) until all are 0 or 1, so both totals of a source come out near their expectation.

A flight on one block of documents keeps three of them fractional at a time and leaves at most two;
these, and a few of the block's documents held back, go into the next round's blocks of the same source,
until one block is left per source. Of several flights of that block, with its last one or two documents
landed either way, the best balanced is taken. A source may hold any number of
documents: blocks are bounded by count, and only (id, size) moves. Draws depend on seed, source, block
and id alone, so reruns and recomputed tasks agree.

Cases: a null text has size 0; a null source is a source of its own, ordered last; rows of equal id and
size are interchangeable, every row gets its own decision; other columns are ignored; no rows, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendersift.llm.texts import read
from tendersift.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)   # by position of the source in code point order, repeating
SHARE = 1.5                 # words of the mix per word of the input
MOST = 2.0                  # a source is used at most so many times over
BLOCK_ROWS = 4000           # documents of one flight
RESERVED = 64               # documents of a block, of all sizes, that wait for the next round
FLIGHTS = 64                # flights tried on the last block of a source
SEED = 17
WORD = "[^\\x20\\x09-\\x0D]+"


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, target): `totals` has one row per source.

    The capped sources are those with the smallest cap per weight, so one pass over the sources in that
    order settles who is capped; the rest share what is left by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rated = totals.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
    order = Window.orderBy((F.col("source_size") / F.col("_w")), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((share * F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
             / F.sum("_w").over(rest))
    tried = rated.withColumns({"_level": level, "_cap": most * F.col("source_size")}) \
        .withColumn("_over", F.col("_level") * F.col("_w") > F.col("_cap"))
    # the first source in order that is not capped sets the level for itself and all after it
    final = F.min(F.when(~F.col("_over"), F.struct(F.col("source_size") / F.col("_w"), "_level"))).over(whole)["_level"]
    return tried.withColumn("_final", final).select(
        "source", "source_size", "n_docs",
        F.coalesce(F.least("_cap", F.col("_final") * F.col("_w")), F.col("_cap")).cast("double").alias("target"))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities `p` in the null space of (x, 1) until at most two are fractional."""
    p = p.astype(float).tolist()
    x = x.astype(float).tolist()
    eps = 1e-9
    live: list[int] = []
    draws = rng.random(len(p) + 1).tolist()
    for nxt in range(len(p)):
        if eps < p[nxt] < 1 - eps:
            live.append(nxt)
        else:
            p[nxt] = float(round(p[nxt]))
        if len(live) < 3:
            continue
        a, b, c = live
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])   # orthogonal to (1, 1, 1) and to the sizes
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(live, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
        step = up if draws[nxt] < down / (up + down) else -down
        still = []
        for i, d in zip(live, u):
            p[i] += step * d
            if eps < p[i] < 1 - eps:
                still.append(i)
            else:
                p[i] = float(round(p[i]))
        live = still
    return np.array(p)


def _generator(*key: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=8).digest(), "little"))


def _flown(seed: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        return _fly(table, seed)
    return run


def _fly(table: pa.Table, seed: int) -> pa.Table:
    """One block: `extra` set to 0 or 1 for decided rows, null for those still open, whose `p` has moved."""
    t = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("p", "ascending"), ("row", "ascending")])
    p, x = t.column("p").to_numpy(), t.column("size").to_numpy()
    rng = _generator(seed, *(t.column(c)[0].as_py() for c in ("source", "block", "level")))
    if t.column("blocks")[0].as_py() == 1:
        p = landed(p, x, rng)
    else:   # some documents of all sizes wait for the next round, where they help to land
        wait = np.zeros(len(p), bool)
        held = max(1, min(RESERVED, len(p) // 4))
        wait[::-(-len(p) // held)] = True
        flown = p.copy()
        flown[~wait] = flight(p[~wait], x[~wait], rng)
        p = flown
    open_ = (p > 0) & (p < 1)
    extra = pa.array(p.round().astype(np.int32), pa.int32(), mask=open_)
    t = t.set_column(t.schema.get_field_index("p"), "p", pa.array(p))
    return t.append_column("extra", extra).select(["row", "doc_id", "source", "size", "p", "extra"])


def landed(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The last block of a source: several flights, each landed both ways; the best balanced one is taken."""
    best, least = p, float("inf")
    for i in range(FLIGHTS):
        order = np.arange(len(p)) if i == 0 else rng.permutation(len(p))
        q = np.empty_like(p)
        q[order] = flight(p[order], x[order], rng)
        at = np.flatnonzero((q > 0) & (q < 1))
        ends = [()] if not len(at) else [(0.0,), (1.0,)] if len(at) == 1 else [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)]
        for end in ends:
            q[at] = end
            off = abs(((q - p) * x).sum()) / max(1.0, x.mean()) + 0.1 * abs((q - p).sum())
            if off < least:
                best, least = q.copy(), off
        if least < 0.05:
            break
    return best


ROW = "row long, doc_id long, source string, size long, p double"


def decide(rows: DataFrame, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(row, doc_id, source, size, extra 0 or 1) for rows of `ROW` with p strictly between 0 and 1."""
    done, level = [], 0
    while True:
        # blocks of a source: counted first, so that a hot source has as many as it needs
        n = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
        blocks = cut_lineage(n.select(F.col("source").alias("_s"), F.ceil(F.col("_n") / block_rows).cast("long").alias("blocks")))
        # one row per source; Spark may broadcast it by its size, or split a hot source's rows
        dealt = (rows.join(blocks, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                 .withColumns({"block": F.pmod(F.xxhash64("doc_id", "size", "row", F.lit(seed + level)), "blocks"),
                               "level": F.lit(level)}))
        out = cut_lineage(dealt.groupBy("source", "block").applyInArrow(
            _flown(seed), ROW + ", extra int"))
        done.append(out.filter("extra is not null").drop("p"))
        rows = out.filter("extra is null").drop("extra")
        if rows.isEmpty():
            break
        level += 1
    result = done[0]
    for d in done[1:]:
        result = result.union(d)
    return result


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED,
          weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, text_hash, row) per row of `docs`."""
    sized = cut_lineage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                                    size_of(text).alias("size"), F.xxhash64(F.col(text)).alias("row")))
    totals = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    wanted = cut_lineage(targets(totals, weights, share, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = (sized.join(wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "n_docs")
             .withColumn("_rate", rate).withColumn("_whole", F.floor("_rate"))
             .withColumn("p", F.col("_rate") - F.col("_whole")))
    sure = rated.filter("p < 1e-9 or p > 1 - 1e-9").withColumn("copies", F.round("_rate").cast("int"))
    open_ = rated.filter("p >= 1e-9 and p <= 1 - 1e-9")
    chosen = decide(open_.select("row", "doc_id", "source", "size", "p"), seed, block_rows)
    per_source = wanted.select(F.col("source").alias("_s"), "source_size", "target",
                               F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).alias("_whole"))
    late = (chosen.join(per_source, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("copies", (F.col("_whole") + F.col("extra")).cast("int")))
    names = ["doc_id", "source", "size", "source_size", "target", "copies", "row"]
    return (sure.select(*names).union(late.select(*names))
            .withColumn("taken", F.col("size") * F.col("copies")))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: object) -> DataFrame:
    """`docs` with every row repeated as often as the mix takes it (0, 1 or 2 times)."""
    plan = mixed(docs, doc_id, text, **settings)
    # rows equal in id and text are one key with the sum of their copies
    copies = cut_lineage(plan.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r"))
                         .agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows")))
    rows = docs.select(F.struct("*").alias("whole"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"))
    # ids are spread by their text's hash, so null ids are no hot key
    met = rows.join(copies, (F.col("hash") == F.col("r")) & F.col("id").eqNullSafe(F.col("d")))
    once = met.filter("rows = 1").select("whole", F.col("n").alias("times"))
    k = F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.lit(0)))
    again = (met.filter("rows > 1").withColumn("k", k)
             .select("whole", (F.floor(F.col("n") / F.col("rows")) + (F.col("k") <= F.col("n") % F.col("rows")).cast("int")).alias("times")))
    return (once.union(again).filter("times > 0").select("whole", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))))
            .select("whole.*"))


def op9_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
