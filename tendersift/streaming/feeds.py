"""The incremental operators on a live feed. The batch code is reused inside each micro-batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tendersift.functions.text import canonical_url
from tendersift.operators import upkeep as U
from tendersift.session import cut_lineage


def new_items(feed: DataFrame, ts: str = "ts", key: str = "url", lateness: str = "1 day") -> DataFrame:
    """STM1: the first event of each key; repeats later than the watermark are not held in state."""
    d = feed.withColumn(key, canonical_url(F.col(key)))
    return d.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def daily_counts(feed: DataFrame, ts: str = "ts", source: str = "source", lateness: str = "1 day") -> DataFrame:
    """STM3: postings per source and day."""
    return (feed.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"), source)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("day"), source, "n"))


RECURRENCE = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])
PARTIAL = "key string, n long, last timestamp"
HELD = {"key": "object", "n": "int64", "last": "int64", "until": "int64"}   # state of one shard, a list each; `until` is when a key is forgotten
SHARDS = 1024


def _partial_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        g = f.groupby("key", sort=False)["ts"].agg(["size", "max"]).reset_index()
        yield g.set_axis(["key", "n", "last"], axis=1)


def recurrence(feed: DataFrame, key: str = "key", ts: str = "ts", days: int = 90, lateness: str = "1 day",
               shards: int = SHARDS) -> DataFrame:
    """STM4: keys seen at least twice; a key is forgotten `days` after its last record, in event time.

    Rows are counted per Arrow batch before the shuffle, so a hot key brings one row per batch. The keys of one of `shards` hash values
    share a row of state and a call, so a key costs a row of a frame and not a call; the state of a shard is that share of all keys.
    """
    partial = (feed.select(F.col(key).alias("key"), F.col(ts).alias("ts")).filter("key IS NOT NULL")
               .mapInPandas(_partial_counts, PARTIAL).withWatermark("last", lateness)
               .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))))

    def count(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = pd.DataFrame(dict(zip(HELD, state.get if state.exists else ([],) * 4))).astype(HELD)
        met = pd.DataFrame(columns=RECURRENCE.names)
        if not state.hasTimedOut:
            new = pd.concat([f[["key", "n", "last"]] for f in frames])
            new["last"] = new["last"].astype("datetime64[ms]").astype("int64")
            both = pd.concat([held.drop(columns="until"), new]).groupby("key", sort=False).agg({"n": "sum", "last": "max"}).reset_index()
            both["until"] = (both["last"] + days * 86_400_000).clip(lower=now + 1)
            met = both[both["key"].isin(new["key"])]
            held = pd.concat([held[~held["key"].isin(new["key"])], met])
        # a key with rows in this batch lives on, however late they come
        held = held[held["until"] >= now]
        if held.empty:
            state.remove()
        else:
            state.update(tuple(held[c].tolist() for c in HELD))
            state.setTimeoutTimestamp(max(int(held["until"].min()), now + 1))
        again = met[met["n"] >= 2]
        if len(again):
            yield again[RECURRENCE.names]

    return partial.groupBy("shard").applyInPandasWithState(
        count, RECURRENCE, "key array<string>, n array<long>, last array<long>, until array<long>", "update", GroupStateTimeout.EventTimeTimeout)


def curated_upsert(feed: DataFrame, root: str, schema: T.StructType, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """STM2: every micro-batch is staged under its number and merged; a repeated number is skipped.

    The numbers of finished batches are stored with the data, so a restart after a crash between
    publish and checkpoint does not merge twice.
    """
    done_schema = T.StructType([T.StructField("batch_id", T.LongType())])

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        done = U.read_current(spark, f"{root}/done", done_schema)
        if not done.filter(F.col("batch_id") == batch_id).isEmpty():
            return
        U.stage_batch(batch, root, f"stream-{batch_id}")
        U.apply_batch(spark, root, f"stream-{batch_id}", schema)
        U.publish(cut_lineage(done.union(spark.createDataFrame([(batch_id,)], done_schema))), f"{root}/done")

    w = feed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
