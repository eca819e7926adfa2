"""Near copies by SimHash, for texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Two such sets differ in some ten of the 64 bits of `simhash.fingerprint`, more than ball hashing of whole fingerprints reaches, so
a set has `FINGERPRINTS` fingerprints (`simhash.majority`) and each is cut into blocks of `BLOCK` bits. A block emits its variants
within one bit (`simhash.variants`), so sets with blocks of one number at two or fewer differing bits meet in a bucket. In rounds,
every set meets the first of the leaders of its buckets that are in other groups, verified on the whole sets of shingles; linked
sets are one group. A leader links all of its near copies at once, so a group costs links by its size, not its pairs. The first
leader is the set that shares most, later ones are drawn by hash; a round with few new links ends them.

Exact checks before and after lose no link. In any common order, the first n - 0.8 n + k shingles of a set hold the first k of those it
shares with a near set. So a set is near none, and emits nothing, if it has too few of these, in the order of hashes, in common with
other sets (`asked` of its smallest near set), or if more than a fifth of it is in no other set that is left; only sets that pass are
written whole. What the fingerprints leave apart is settled by an index of rare-first prefixes, first in rounds with the leaders of
its lists, then by the lists' pairs across groups, at places that leave enough shingles to share.

Cases: a null, empty or blank text has no shingles, and all of them are one group; a text of fewer than five
words is one shingle; lower case and white space are those of `simhash.fingerprint`; a null `doc_id`, repeated
ids and repeated rows are rows of their own; other columns are ignored; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift.components import components
from tendersift.llm.hashing import mixed
from tendersift.llm.shared import shared
from tendersift.llm.simhash import LAST_ID, RADIUS, SEED, first_of_groups, majority, variants
from tendersift.scale import sized_broadcast
from tendersift.session import cut_lineage

SHINGLE_WORDS = 5
FINGERPRINTS, BLOCK = 4, 32                # of a set, and the bits of a block of one
FEW = 0.05                                 # of all links so far: a round with fewer new ones is the last, since exact pairs follow
MAY = "9 * least(found, other_found) >= 4 * (n + other_n)"   # no more can be in common than is found elsewhere
PLACED = "9 * least(n - place, other_n - other_place) >= 4 * (n + other_n)"   # and no more than follows the first common shingle
FEW_ROWS = 200_000                         # keys that are broadcast, if they are few bytes too
TEXTS = 500                                # whose sets a worker holds at once
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 63, FINGERPRINTS, dtype=np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the different shingles, sorted."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    k = SHINGLE_WORDS
    runs = zip(*(words[i:] for i in range(k))) if len(words) >= k else [words]
    return np.unique(np.array([digest(join(s), SEED) for s in runs], np.uint64))


def prefix_size(n: int, common: int = 1) -> int:
    """How many shingles of a set, in any order common to all sets, hold `common` of every near set's first ones."""
    return n - -(-4 * n // 5) + common if n else 0


def asked(n: int) -> int:
    """How many of a set's first shingles have to be among another set's first ones, for a prefix of so many more."""
    return min(-(-4 * n // 5), max(16, n // 20))


def _keys(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in sets], np.uint64).view(np.int64))


def blocks(h: np.ndarray) -> list[int]:
    """The blocks of a set's fingerprints, each below its number; the first fingerprint is of the hashes themselves."""
    out = []
    for j in range(FINGERPRINTS if len(h) else 0):
        fp = majority(mixed(h ^ _DRAWN[j]) if j else h)
        for at in range(0, 64, BLOCK):
            out.append((len(out) << BLOCK) | ((fp >> at) & ((1 << BLOCK) - 1)))
    return out


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches, so that a worker holds the sets of few texts."""
    for b in batches:
        for at in range(0, b.num_rows, TEXTS):
            yield b.slice(at, TEXTS)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        h = [shingles(t.as_py() or b"") for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _keys(h), pa.array([len(x) for x in h], pa.int64())],
                                         ["k", "text_hash", "key", "n"])


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        h = [shingles(t.as_py() or b"") for t in b.column(0)]
        first = [x[:prefix_size(len(x), asked(len(x)))] for x in h]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(_keys(h).to_numpy(), [len(x) for x in first])),
                                          pa.array(np.concatenate([*first, np.zeros(0, np.uint64)]).view(np.int64))], ["key", "item"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _few(batches):
        h = [shingles(t.as_py() or b"") for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64())),
                                          pa.array([blocks(x) for x in h], pa.list_(pa.int64()))], ["key", "shingles", "blocks"])


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among `pairs` (key, n, found, other, other_n, other_found) that are near on their whole sets."""
    some = cut_lineage(pairs.filter(f"key <> other AND {MAY}")
                       .select(F.least("key", "other").alias("key"), F.greatest("key", "other").alias("other"), (F.col("n") + F.col("other_n")).alias("both"))
                       .distinct())
    named = cut_lineage(some.select("key").union(some.select("other")).distinct())
    asked_for = sets.join(sized_broadcast(named, FEW_ROWS), "key", "left_semi")   # no other set is shuffled
    return cut_lineage(some.join(asked_for, "key").join(asked_for.toDF("other", "others"), "other")
                       .filter(9 * F.size(F.array_intersect("shingles", "others")) >= 4 * F.col("both"))
                       .select(F.col("key").alias("a"), F.col("other").alias("b")))


def _found(rows: DataFrame, about: int, make: Callable | None = None) -> DataFrame:
    """(key, found): how many items of a key in `rows` (key, item), or in what `make` makes of them, other keys have too."""
    return shared(rows, about, make).groupBy("key").agg(F.count(F.lit(1)).alias("found"))


def _grouped(held: DataFrame, tree: DataFrame) -> DataFrame:
    return held.join(tree.toDF("key", "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def _open(entries: DataFrame, grouped: DataFrame) -> DataFrame:
    """`entries` (bucket, key) of the buckets with several groups, as (bucket, key, n, found, root)."""
    named = entries.join(grouped, "key").select("bucket", "key", "n", "found", "root")
    several = named.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    return cut_lineage(named.join(several, "bucket"))


def _led(entries: DataFrame, order: Column) -> DataFrame:
    """Every set of `entries` (bucket, key, n, found, root) with the first, by `order`, of its buckets' leaders in other groups."""
    own = [F.col(c).alias(a) for c, a in (("key", "other"), ("n", "other_n"), ("found", "other_found"), ("root", "other_root"))]
    heads = entries.groupBy("bucket").agg(F.min(F.struct(order.alias("order"), *own)).alias("h"))
    met = entries.join(heads.select("bucket", "h.*"), "bucket").filter(f"root <> other_root AND {MAY}")
    return (met.groupBy("key", "n", "found").agg(F.min(F.struct("order", "other", "other_n", "other_found")).alias("h"))
            .select("key", "n", "found", "h.*").drop("order"))


def _by_leaders(entries: DataFrame, held: DataFrame, sets: DataFrame, links: DataFrame, tree: DataFrame,
                known: int = 0) -> tuple[DataFrame, DataFrame, int]:
    """(links, their components, their number) with what the leaders of the buckets of `entries` (bucket, key) add, in rounds."""
    turn = 0
    while True:
        entries = _open(entries.select("bucket", "key"), _grouped(held, tree))   # groups only grow, so a closed bucket stays closed
        order = F.col("n") / F.col("found") if turn == 0 else F.xxhash64("key", F.lit(turn)).cast("double")
        new = _near(_led(entries, order), sets)
        met = new.count()
        if met:
            links, known = links.union(new), known + met
            tree = cut_lineage(components(links))
        if met < FEW * known or entries.isEmpty() or turn and not met:
            return links, tree, known
        turn += 1


def _prefixes(held: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, place, shingle) of the rare-first prefixes, without shingles that are in no other set."""
    one = held.select("key").join(sets, "key").select("key", F.explode("shingles").alias("shingle"))
    often = one.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = (one.join(often, "shingle").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("s")))
    return cut_lineage(ranked.select("key", F.posexplode(F.expr("slice(s, 1, size(s) - cast(ceil(4 * size(s) / 5) AS int) + 1)")))
                       .filter("col.often > 1").select("key", F.col("pos").alias("place"), F.col("col.shingle").alias("shingle")))


def _across(prefixes: DataFrame, grouped: DataFrame) -> DataFrame:
    """Pairs of different groups that share a shingle of both prefixes, at places that may do."""
    prefix = cut_lineage(prefixes.join(grouped, "key").select("key", "n", "found", "root", "place", "shingle"))
    largest = (prefix.groupBy("shingle", "root").count().groupBy("shingle")
               .agg(F.max(F.struct("count", "root")).alias("m"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
               .select("shingle", F.col("m.root").alias("largest")))
    lists = cut_lineage(prefix.join(largest, "shingle"))
    other = lists.select("shingle", *[F.col(c).alias(f"other_{c}") for c in ("n", "found", "root", "place")], F.col("key").alias("other"))
    return (lists.filter("root <> largest").join(other, "shingle")
            .filter(f"root <> other_root AND (other_root = largest OR key < other) AND {PLACED} AND {MAY}")
            .select("key", "n", "found", "other", "other_n", "other_found"))


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, text_hash, root), one row per row of `docs`; k is the id, or LAST_ID for none."""
    k = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("k")
    rows = docs.select(k, F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).cast("string").cast("binary").alias("text"))
    marks = cut_lineage(rows.mapInArrow(_marks, "k long, text_hash long, key long, n long"))
    reps = cut_lineage(marks.groupBy("key").agg(F.min(F.struct("k", "text_hash")).alias("m"), F.first("n").alias("n")))
    about = marks.agg(F.coalesce(F.sum(F.expr("n div 5 + least(n, greatest(16, n div 20))")), F.lit(0))).first()[0]
    firsts = _found(rows.select("text"), about, _firsts)
    m = "cast(ceil(4 * n / 5) AS long)"   # the size of the smallest near set, which may ask for less
    wanted = cut_lineage(reps.join(firsts, "key").filter(f"found >= least(cast(ceil(4 * {m} / 5) AS long), greatest(16, {m} div 20))")
                         .select("key", "m.k", "m.text_hash", "n"))
    made = cut_lineage(rows.join(sized_broadcast(wanted.drop("n"), FEW_ROWS), ["k", "text_hash"])
                       .groupBy("key").agg(F.first("text").alias("text")).mapInArrow(_sets, "key long, shingles array<long>, blocks array<long>"))
    about = wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = _found(made.select("key", F.explode("shingles").alias("item")), about)
    held = cut_lineage(wanted.select("key", "n").join(found, "key").filter("5 * found >= 4 * n"))
    sets = cut_lineage(made.join(sized_broadcast(held.select("key"), FEW_ROWS), "key", "left_semi"))
    links = held.sparkSession.createDataFrame([], "a long, b long")
    tree = held.sparkSession.createDataFrame([], "node long, root long")
    balls = variants(sets.select("key", F.explode("blocks").alias("fp")), RADIUS, BLOCK).select("key", F.col("variant").alias("item"))
    met = cut_lineage(shared(balls, held.count() * 2 * FINGERPRINTS * (1 + BLOCK)))
    sets = sets.select("key", "shingles")
    links, tree, known = _by_leaders(met.select("key", F.col("item").alias("bucket")), held, sets, links, tree)
    prefixes = _prefixes(held, sets)
    links, tree, known = _by_leaders(prefixes.select("key", F.col("shingle").alias("bucket")), held, sets, links, tree, known)
    more = _near(_across(prefixes, _grouped(held, tree)), sets)
    if not more.isEmpty():
        tree = cut_lineage(components(links.union(more)))
    named = _grouped(reps.select("key"), tree)
    return marks.select("k", "text_hash", "key").join(cut_lineage(named), "key").select("k", "text_hash", "root")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group: the smallest id (null last), then the smallest text hash."""
    return first_of_groups(docs, linked(docs, doc_id, text), doc_id, text)
