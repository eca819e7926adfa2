"""Building blocks that stay flat when one key holds a large share of the rows.

* `keep_first` / `keep_last`: one row per key; Spark cuts every map task's output to one row per
  key before the shuffle (WindowGroupLimit), so a hot key sends at most one row per task.
* `attach_by_key`: per-key statistics joined back to rows; the heaviest keys are a top-k of fixed
  size and are broadcast, all other keys go through a shuffle join in which no key is hot.
* `number_rows`: 1..n over an order, through ranges of bounded size instead of one global window.
* `sized_broadcast`: a broadcast hint only when a counted bound holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendersift.session import cut_lineage

HOT_KEYS = 1000          # rows of the broadcast side of attach_by_key
SALTS = 256              # spread of already matched rows in the second join
BROADCAST_BYTES = 32 << 20  # most bytes of a broadcast table, as text
BUCKET_WIDTH = 1_000_000  # rows of one numbered range, and seq numbers of a bucket of openers
MOST_RANGES = 256        # numbered ranges before they get wider than asked; their bounds come from a sample that the driver holds


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """WIN1: first row of each key by `order`; `order` must be total for a stable answer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """WIN3: last row of each key."""
    return keep_first(df, keys, [F.col(c).desc() for c in order])


def fits(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """Whether a table has at most so many rows and bytes; reads no more than `max_rows` + 1 rows of it."""
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """`broadcast(df)` when it is small by rows and bytes, else `df` for a shuffle join."""
    return F.broadcast(df) if fits(df, max_rows) else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows spread over all cores when the input has fewer splits than cores, else unchanged.

    For row-wise work on a small table kept in one file; a large table has splits enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A computed text that later filters see as a plain column.

    Catalyst moves a filter below a projection by writing the projected expression into every test,
    so a text tested for forty terms would be lower-cased forty times; it does not do so below a
    generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def attach_by_key(df: DataFrame, stats: DataFrame, keys: Sequence[str], weight: str,
                  spread: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join of `stats` (one row per key) onto `df`, safe for hot and for null keys.

    `weight` is the number of rows of a key. A key with more than 1/hot_keys of all rows is always
    among the `hot_keys` heaviest, so what is left for the shuffle join has no large group. Rows
    already matched, and rows with a null key, take a salt by `spread` and cannot pile up.
    """
    values = [c for c in stats.columns if c not in keys]
    hot = (stats.orderBy(F.col(weight).desc(), *keys).limit(hot_keys)
           .select(*keys, F.struct(*values).alias("_hot")))
    cold = stats.select(*keys, F.struct(*values).alias("_cold"), F.lit(0).alias("_salt"))
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    marked = (df.join(F.broadcast(hot), list(keys), "left")
              .withColumn("_salt", F.when(F.col("_hot").isNotNull() | unknown,
                                          F.lit(1) + F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
                          .otherwise(F.lit(0))))
    both = marked.join(cold, [*keys, "_salt"], "left")
    pick = F.coalesce(F.col("_hot"), F.col("_cold"))
    return both.select(*df.columns, *[pick[c].alias(c) for c in values])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], spread: str,
           max_rows: int = 200_000) -> DataFrame:
    """Left join of a written table with one row per key: broadcast up to `max_rows` rows of bounded size,
    beyond that the hot keys of `df` are set apart as in `attach_by_key`."""
    if fits(table, max_rows):
        return df.join(F.broadcast(table), list(keys), "left")
    weights = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    return attach_by_key(df, table.join(weights, list(keys)), keys, "_weight", spread).drop("_weight")


def number_rows(df: DataFrame, seq: str, out: str, width: int = BUCKET_WIDTH) -> DataFrame:
    """Consecutive numbers 1..n in order of the unique column `seq`, of any type that can be ordered.

    Ranges of `seq` of about `width` rows, cut where the values are, are numbered each by itself and written; the rows before
    a range are the sum of the counts of the ranges before it. So a sparse `seq` has no more ranges than a dense one, and only
    the counts, one per range, are added up in one task. Beyond `MOST_RANGES` ranges, which each cost the driver a sample, they get
    wider, up to BUCKET_WIDTH rows; a range is sorted on disk where it has to be.
    """
    stored = cut_lineage(df)
    rows = stored.count()
    ranges = max(1, min(-(-rows // width), max(MOST_RANGES, -(-rows // BUCKET_WIDTH))))
    parts = cut_lineage(stored.repartitionByRange(ranges, F.col(f"`{seq}`")).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(f"`{seq}`")))
    return (parts.withColumn("_pos", within).join(offsets, "_part")
            .withColumn(out, (F.col("_pos") + F.col("_offset")).cast("long"))
            .drop("_part", "_pos", "_offset"))
