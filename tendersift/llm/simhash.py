"""Near-duplicate detection on SimHash fingerprints by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints within the
radius share a variant half-way between them, and two that share a variant are within the radius, so
the fingerprints of one variant in sorted order form a chain of links: at most 65 per variant, never
all pairs. Copies are one fingerprint before anything is emitted.

Cases: a null or empty text has fingerprint zero and links like any other; a null `doc_id` is kept,
gets a component, and is named as `component_id` only if its component has no other id (null then);
repeated ids and repeated rows are rows of their own; other columns are ignored; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendersift.components import components
from tendersift.llm.texts import read
from tendersift.session import cut_lineage

RADIUS = 2
SEED = 42
SHINGLE_WORDS = 3
LAST_ID = (1 << 63) - 1   # stands for a null id in orders
PIECE = 1 << 15           # shingles whose bits are counted at once


def majority(h: np.ndarray) -> int:
    """The signed number of the bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), PIECE):
        part = h[i:i + PIECE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """Bit i is set when it is set in over half of the shingles' hashes; bytes.lower and split know ASCII only."""
    words = text.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(words[i:] for i in range(k))) if len(words) >= k else [words]
    return majority(np.array([digest(join(s), SEED) for s in shingles], np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(2)
        fp = [fingerprint(t.as_py() or b"") for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])


def variants(fp: DataFrame, radius: int = RADIUS, bits: int = 64) -> DataFrame:
    """The rows of `fp` with every `variant` of their column fp within half the radius (0 or 1 of its lowest `bits` bits)."""
    if radius // 2 > 1:
        raise ValueError("radius up to 3")
    ball = ("array(fp)" if radius < 2 else
            f"transform(sequence(0, {bits}), i -> IF(i = {bits}, fp, fp ^ shiftleft(1L, i)))")
    return fp.select("*", F.explode(F.expr(ball)).alias("variant"))


def links(fp: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b) that connect all fingerprints within `radius` of each other."""
    w = Window.partitionBy("variant").orderBy("fp")
    return (variants(fp, radius).select("fp", F.lag("fp").over(w).alias("before")).filter("before is not null")
            .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("before"))) <= radius)
            .select(F.col("fp").alias("a"), F.col("before").alias("b")))


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per row of `docs`."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(text).cast("string").cast("binary").alias("text"))
    marks = cut_lineage(rows.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long"))
    reps = cut_lineage(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    tree = cut_lineage(components(links(reps.select("fp"), radius)))
    named = reps.join(tree.toDF("fp", "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = cut_lineage(named.join(tree, F.col("fp") == F.col("node"), "left_semi")
                        .groupBy("root").agg(F.min("least").alias("component_id")))
    classes = cut_lineage(named.join(least, "root", "left")
                          .select("fp", "root", F.coalesce("component_id", "least").alias("component_id")))
    return marks.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint of 16 hex digits, component_id) for every row."""
    return linked(docs, doc_id, text, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`docs` with the first row of each root of `found` (k, text_hash, root)."""
    keep = (found.groupBy("root", "k", "text_hash").agg(F.count(F.lit(1)).alias("times"))
            .groupBy("root").agg(F.min(F.struct("k", "text_hash", "times")).alias("m")).select("m.*"))
    rows = docs.select(F.struct("*").alias("whole"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("k"),
                       F.xxhash64(F.col(text)).alias("text_hash"))
    met = rows.join(cut_lineage(keep), ["k", "text_hash"])
    several = met.filter("times > 1").groupBy("k", "text_hash").agg(F.first("whole").alias("whole"))   # rows equal in id and text
    return met.filter("times = 1").select("whole.*").union(several.select("whole.*"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each component: the smallest id (null last), then the smallest text hash."""
    found = linked(docs, doc_id, text, radius).withColumn("k", F.coalesce("doc_id", F.lit(LAST_ID)))
    return first_of_groups(docs, found, doc_id, text)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
