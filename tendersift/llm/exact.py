"""Exact duplicates by two passes over a Bloom filter: only rows whose hash may be repeated are shuffled.

The first pass writes a narrow table (row, id, length, SHA-256) and puts every hash into `PROBES` cells of a filter whose
cells count none, one, or more. A task sends, for each segment of the filter, the cells it met once and those it met more
often, so a text that fills a third of the table sends two cells a task. In the second pass a row with a cell that only one
row met is alone and goes straight to the result; all others are grouped by hash, which decides exactly. A filter has at most
`filter_bytes`, whatever the table: beyond that the narrow table is cut by hash into slices with a filter each.

Two texts are equal when they are identical without the characters `[\\x20\\x09-\\x0D]`. Of equal texts the row with the most
code points stays, then the smallest id (null last); of rows equal in all that, one stays.

Cases: a null text is an empty one, and all texts without other characters are one group; a null id is kept and is named as
`keep_id` if its row stays; repeated rows are rows of their own, of which one stays; a very long text is hashed whole where it is
read and never shuffled by `marked`; other columns, whatever their names, are ignored by `marked` and returned by
`deduplicated`; no rows, no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.texts import read
from tendersift.scale import attach_by_key, lookup
from tendersift.session import cut_lineage, ensure_checkpoint_dir

WHITE = r"[\x20\x09-\x0D]+"
PROBES = 2               # cells of a hash
CELLS_A_ROW = 16         # with two probes some 1.4 % of the rows that are alone look repeated
SEGMENT = 1 << 16        # cells of one merged piece of a filter
FILTER_BYTES = 64 << 20  # most bytes of the filter that travels to the tasks
HELD = 1 << 21           # cells a task holds before it sends them


def digest(text: str) -> Column:
    """SHA-256 of a text without white space, as bytes."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.regexp_replace(body, WHITE, "").cast("binary"), 256))


def code_points(text: str) -> Column:
    return F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).cast("long")


def cells(hashes: pa.Array, size: int) -> np.ndarray:
    """(rows, PROBES) cells of 32-byte hashes in a filter of `size` cells, a power of two."""
    words = np.frombuffer(b"".join(hashes.to_pylist()), np.uint64).reshape(-1, 4)
    return (words[:, :PROBES] & np.uint64(size - 1)).astype(np.int64)


def _partial(size: int):
    """Rows (slice, hash) -> (slice, segment, once, more): offsets in a segment that this task met once, or more often."""
    def send(part: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, n = np.unique(np.concatenate(held), return_counts=True)
        segment = at // SEGMENT
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        once, more = [], []
        for i, j in zip(starts, [*starts[1:], len(at)]):
            low = (at[i:j] % SEGMENT).astype(np.uint16)
            once.append(low[n[i:j] == 1].tobytes())
            more.append(low[n[i:j] > 1].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(starts), pa.int32()), pa.array(segment[starts], pa.int64()),
                                          pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["slice", "segment", "once", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        total = 0
        for b in batches:
            part, at = b.column(0).to_numpy(zero_copy_only=False), cells(b.column(1), size)
            for p in np.unique(part):
                held.setdefault(int(p), []).append(at[part == p].ravel())
            total += at.size
            if total > HELD:
                for p, arrays in held.items():
                    yield from send(p, arrays)
                held, total = {}, 0
        for p, arrays in held.items():
            yield from send(p, arrays)
    return run


def _merged(group: pa.Table) -> pa.Table:
    """All tasks' cells of one segment -> a bit for every cell met more than once."""
    n = np.zeros(SEGMENT, np.int64)
    for name, weight in (("once", 1), ("more", 2)):
        for chunk in group.column(name).to_pylist():
            n[np.frombuffer(chunk, np.uint16)] += weight
    return pa.table({"slice": group.column("slice")[:1], "segment": group.column("segment")[:1],
                     "bits": pa.array([np.packbits(n > 1, bitorder="little").tobytes()], pa.binary())})


def _probe(bits: Broadcast):
    """Rows (row, doc_id, chars, hash) with whether all cells of the hash were met more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            at = cells(b.column(3), 8 * len(table))
            maybe = ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(maybe)], ["row", "doc_id", "chars", "hash", "maybe"])
    return run


def _written(df: DataFrame, by: str, path: str) -> DataFrame:
    df.write.mode("append").partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split(rows: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """`rows` (row, doc_id, chars, hash), a written table, with `maybe`: false only for hashes that one row alone has."""
    spark, folder = rows.sparkSession, f"{ensure_checkpoint_dir(rows.sparkSession)}/tables/{uuid.uuid4().hex}"
    names, n = rows.columns, rows.count()
    slices = -(-n * CELLS_A_ROW // (8 * filter_bytes)) or 1
    size = max(SEGMENT, 1 << (max(1, n // slices) * CELLS_A_ROW - 1).bit_length())
    size = max(SEGMENT, min(size, 8 * filter_bytes))
    part = F.pmod(F.xxhash64("hash"), F.lit(slices)).cast("int")
    if slices > 1:
        rows = _written(rows.withColumn("slice", part), "slice", f"{folder}/slices")
    else:
        rows = rows.withColumn("slice", F.lit(0))
    filters = cut_lineage(rows.select("slice", "hash").mapInArrow(_partial(size), "slice int, segment long, once binary, more binary")
                          .groupBy("slice", "segment").applyInArrow(_merged, "slice int, segment long, bits binary"))
    for s in range(slices):
        bits = np.zeros(size // 8, np.uint8)
        for r in filters.filter(F.col("slice") == s).toLocalIterator():
            bits[r["segment"] * SEGMENT // 8:][:SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
        sent = spark.sparkContext.broadcast(bits.tobytes())
        probed = rows.filter(F.col("slice") == s).select(*names).mapInArrow(
            _probe(sent), "row long, doc_id long, chars long, hash binary, maybe boolean")
        both = _written(probed, "maybe", f"{folder}/probed")
        sent.unpersist()
    return both


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, chars, hash, keep_id, group_size, kept), one row per row of `docs`."""
    rows = cut_lineage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), code_points(text).alias("chars"), digest(text).alias("hash"))
                       .select(F.monotonically_increasing_id().alias("row"), "doc_id", "chars", "hash"))
    both = split(rows, filter_bytes)
    alone = both.filter("NOT maybe").selectExpr("doc_id", "chars", "hash", "doc_id AS keep_id", "1L AS group_size", "true AS kept")
    some = both.filter("maybe").drop("maybe")
    first = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    groups = cut_lineage(some.groupBy("hash").agg(first, F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))
    told = attach_by_key(some, groups, ["hash"], "group_size", "row").select(
        "doc_id", "chars", "hash", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"))
    return alone.unionByName(told)


def marked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    return found(docs, doc_id, text, filter_bytes).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("hash")).alias("text_sha256"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of `docs` that stay, whole. What is known of repeated texts is narrow: broadcast when its size allows, else joined."""
    def tag(name: str, chars: Column, hash_: Column) -> Column:
        return F.concat_ws(":", F.hex(hash_), chars, F.coalesce(F.col(name).cast("long").cast("string"), F.lit("none")))

    known = cut_lineage(found(docs, doc_id, text, filter_bytes).filter("group_size > 1")
                        .groupBy(tag("doc_id", F.col("chars"), F.col("hash")).alias("tag"))
                        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")))
    rows = docs.select(F.struct("*").alias("whole"), tag(doc_id, code_points(text), digest(text)).alias("tag"),
                       F.monotonically_increasing_id().alias("row"))
    told = lookup(rows, known, ["tag"], "row").filter("kept IS NULL OR kept")
    several = told.filter("times > 1").groupBy("tag").agg(F.first("whole").alias("whole"))
    return told.filter("times IS NULL OR times = 1").select("whole.*").union(several.select("whole.*"))


def op11_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(read(spark, sf_dir, "documents"))


OP11_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY chars DESC, doc_id)
"""
