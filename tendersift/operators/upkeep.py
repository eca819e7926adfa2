"""Upkeep of a curated table: merges that never undo human edits, ledgers, versioned publish.

Built-in Parquet tables have no MERGE, so a merge is a full outer join that names an action for
every row; the new version is written beside the old one and a pointer moves last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.rules import RuleBook
from tendersift.scale import keep_first, keep_last, lookup

ADD, UPDATE, KEEP, PROTECTED, SKIP_DELETED, REMOVE = "add", "update", "keep", "protected", "skip_deleted", "remove"


def merge_plan(table: DataFrame, batch: DataFrame, ledger: DataFrame | None = None,
               sources_in_scope: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """INC2–INC4, INC6, SET3, JOI12: the merged columns of every row with an `action`.

    table: id, source, protected and data columns; batch: the same without protected. Null ids are
    skipped; of a repeated id the last row by `order` counts, without `order` the one that sorts
    first by its data. An id of the ledger that is no longer in the
    table was deleted by a human and stays away. Rows of the sources in scope that the batch no
    longer has are removed unless protected; the scope is given, since a batch may be empty.
    """
    data = [c for c in table.columns if c not in ("id", "protected")]
    b = batch.filter(F.coalesce(F.col("id").cast("string"), F.lit("")) != "")
    b = keep_last(b, ["id"], [order]) if order else keep_first(b, ["id"], data)
    b = b.select("id", F.struct(*data).alias("_new"), F.lit(True).alias("_in_batch"))
    t = table.select("id", "protected", F.struct(*data).alias("_old"), F.lit(True).alias("_in_table"))
    m = t.join(b, "id", "full")
    if ledger is not None:
        m = m.join(ledger.select("id", F.lit(True).alias("_known")).distinct(), "id", "left")
    else:
        m = m.withColumn("_known", F.lit(None).cast("boolean"))
    if sources_in_scope is not None:
        scope = sources_in_scope.select(F.col("source").alias("_source")).distinct().withColumn("_scoped", F.lit(True))
        m = lookup(m.withColumn("_source", F.col("_old.source")), scope, ["_source"], "id", 100_000)
    else:
        m = m.withColumn("_scoped", F.lit(None).cast("boolean"))
    guarded = F.coalesce(F.col("protected"), F.lit(False))
    both = F.col("_in_table").isNotNull() & F.col("_in_batch").isNotNull()
    action = (F.when(both & guarded, PROTECTED).when(both, UPDATE)
              .when(F.col("_in_batch").isNotNull() & F.col("_known").isNotNull(), SKIP_DELETED)
              .when(F.col("_in_batch").isNotNull(), ADD)
              .when(F.col("_scoped").isNotNull() & guarded, PROTECTED)
              .when(F.col("_scoped").isNotNull(), REMOVE).otherwise(KEEP))
    m = m.withColumn("action", action)
    row = F.when(F.col("action").isin(ADD, UPDATE, SKIP_DELETED), F.col("_new")).otherwise(F.col("_old"))
    m = m.withColumn("_row", row)
    return m.select("id", *[F.col("_row")[c].alias(c) for c in data], guarded.alias("protected"), "action")


def merged_rows(plan: DataFrame) -> DataFrame:
    """The rows of the next version of the table."""
    return plan.filter(~F.col("action").isin(SKIP_DELETED, REMOVE)).drop("action")


def merge_counts(plan: DataFrame) -> DataFrame:
    """AGG9."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def grown_ledger(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """INC5: every id ever proposed."""
    return ledger.select("id").union(batch.select("id")).filter("id IS NOT NULL").distinct()


def batch_sources(batch: DataFrame) -> DataFrame:
    """Default scope of a removal: the sources of the batch."""
    return batch.filter("source IS NOT NULL").select("source").distinct()


def update_ledger(ledger: DataFrame, items: DataFrame, now: Column) -> DataFrame:
    """INC1 and WIN7: first_seen is never overwritten; verdict and last_check are refreshed.

    Of a url that `items` repeat the last row counts, by `seq` where there is one.
    """
    items = last_of(items.filter("coalesce(cast(url AS string), '') <> ''"), "url")
    fresh = items.select("url", now.alias("first_seen"), now.alias("last_check"), "verdict", "title", "entity",
                         F.lit(1).alias("_n"))
    both = ledger.select("url", "first_seen", "last_check", "verdict", "title", "entity", F.lit(0).alias("_n")).unionByName(fresh)
    last = F.max_by(F.struct("verdict", "title", "entity"), "_n").alias("_v")
    return (both.groupBy("url").agg(F.min("first_seen").alias("first_seen"), F.max("last_check").alias("last_check"), last)
            .select("url", "first_seen", "last_check", "_v.verdict", "_v.title", "_v.entity"))


def last_of(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """One row per key: the last by `order`, or without that column the one that sorts first by its data."""
    if order in rows.columns:
        return keep_last(rows, [key], [order])
    return keep_first(rows, [key], [c for c in rows.columns if c != key] or [key])


def append_new(table: DataFrame, items: DataFrame, key: str = "url", gate: bool = True) -> DataFrame:
    """INC7 and INC9: rows to append. Known rows are not touched, and of the rest only items never
    seen before come in; those the similarity gate puts out are left away, and another verdict than
    a pass replaces the shown one. A key that comes twice comes in once; rows without one stay out, since
    no later run could tell them from new ones."""
    new = last_of(items.filter(f"is_new AND coalesce(cast({key} AS string), '') <> ''"), key)
    new = new.join(table.select(key).distinct(), key, "left_anti")
    sv = F.col("sim_verdict")
    if gate:
        new = new.filter(~F.coalesce(sv == L.S_OUT, F.lit(False)))
    return new.withColumn("verdict", F.when(sv.isNotNull() & (sv != L.S_PASS), sv).otherwise(F.col("verdict")))


def clean_up(table: DataFrame, judged: DataFrame, book: RuleBook, key: str = "url") -> DataFrame:
    """INC8: the table without rows now judged junk and without unjudgeable rows of barred publishers."""
    j = last_of(judged.filter(f"{key} IS NOT NULL"), key).select(key, F.struct("out_of_scope", "sector", "kind").alias("_j"))
    junk = (f"coalesce(_j.out_of_scope, false) OR coalesce(_j.sector = '{L.NO}', false) "
            f"OR coalesce(_j.kind = '{L.HIRING}', false)")
    entity = "concat(' ', lower(coalesce(entity, '')), ' ')"
    barred = f"({book.sql('staff_only', entity)} OR {book.sql('end_client', entity)})"
    drop = F.expr(f"CASE WHEN _j IS NOT NULL THEN {junk} ELSE {barred} END")
    return table.join(j, key, "left").filter(~drop).drop("_j")


def refresh_seen(table: DataFrame, seen: DataFrame, now: Column, key: str = "url", column: str = "last_check") -> DataFrame:
    """INC11: the check date of rows seen again; a missing column is added on the right."""
    t = table if column in table.columns else table.withColumn(column, F.lit(None).cast("timestamp"))
    s = seen.select(key).distinct().withColumn("_seen", F.lit(True))
    return t.join(s, key, "left").withColumn(column, F.when(F.col("_seen"), now).otherwise(F.col(column))).drop("_seen")


def new_in_last_batch(first_batch: Column, current: Column) -> Column:
    """INC10: derived, so nothing has to be cleared."""
    return first_batch == current


def update_status(table: DataFrame, updates: DataFrame, key: str, column: str, order: str = "seq") -> DataFrame:
    """SNK5: one status column of many rows in one write; of a repeated key the last update by `order` counts."""
    u = last_of(updates.filter(f"{key} IS NOT NULL"), key, order).select(key, F.col(column).alias("_new"))
    return table.join(u, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def update_columns(table: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], order: str = "seq") -> DataFrame:
    """SNK6: a group of columns; an empty new value leaves the old one alone; of a repeated key the last update counts."""
    u = last_of(updates.filter(f"{key} IS NOT NULL"), key, order).select(key, *[F.col(c).alias("_n_" + c) for c in columns])
    new = {c: F.coalesce(F.nullif(F.col("_n_" + c), F.lit("")), F.col(c)) for c in columns}
    return table.join(u, key, "left").withColumns(new).drop(*["_n_" + c for c in columns])


def curated_view(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """SNK2: fixed columns, with a default text for what is unknown."""
    return df.select(*[F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(d)).alias(c)
                       for c, d in defaults.items()])


# --- versions on shared storage --------------------------------------------------------------------

POINTER = T.StructType([T.StructField("version", T.LongType()), T.StructField("committed", T.BooleanType())])


def current_version(spark: SparkSession, root: str) -> int | None:
    """Highest version whose commit marker was written; the marker is the pointer."""
    try:
        marks = spark.read.schema(POINTER).parquet(f"{root}/_commits")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return marks.agg(F.max("version")).first()[0]


def read_current(spark: SparkSession, root: str, schema: T.StructType, require_state: bool = False) -> DataFrame:
    """SRC15 and INC14: the current version; a missing one is an error where state must exist."""
    v = current_version(spark, root)
    if v is None:
        if require_state:
            raise FileNotFoundError(f"no committed version below {root}: refusing to treat it as a first run")
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={v}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def publish(df: DataFrame, root: str, partition_by: str | None = None, dry_run: bool = False) -> int | None:
    """SNK1, SNK3, INC12: write a new version, then its commit marker. A dry run commits nothing.

    A version that exists is never overwritten: of two publishers of one number the second fails, and a
    version that a failed run left without a marker is passed over.
    """
    if dry_run:
        return None
    spark = df.sparkSession
    v = (current_version(spark, root) or 0) + 1
    while _exists(spark, f"{root}/v={v}"):
        v += 1
    w = df.write.mode("errorifexists")
    (w.partitionBy(partition_by) if partition_by else w).parquet(f"{root}/v={v}")
    spark.createDataFrame([(v, True)], POINTER).coalesce(1).write.mode("append").parquet(f"{root}/_commits")
    return v


def stage_batch(batch: DataFrame, root: str, batch_id: str) -> str:
    """SNK4: keep the batch before anything else is tried."""
    path = f"{root}/_staged/{batch_id}"
    batch.write.mode("overwrite").parquet(path)
    return path


def apply_batch(spark: SparkSession, root: str, batch_id: str, schema: T.StructType, scope: DataFrame | None = None) -> DataFrame:
    """SNK4 and INC12: merge a staged batch and publish; may be run again after a failed write.

    Order of commits: the table first, then the ledger. The plan's counts are returned.
    """
    batch = spark.read.parquet(f"{root}/_staged/{batch_id}")
    ledger_schema = T.StructType([T.StructField("id", schema["id"].dataType)])
    table = read_current(spark, f"{root}/table", schema)
    ledger = read_current(spark, f"{root}/ledger", ledger_schema)
    plan = merge_plan(table, batch, ledger, scope if scope is not None else batch_sources(batch))
    from tendersift.session import cut_lineage
    plan = cut_lineage(plan)
    publish(merged_rows(plan).select(*schema.fieldNames()), f"{root}/table")
    publish(grown_ledger(ledger, batch), f"{root}/ledger")
    return merge_counts(plan)
