"""Whole texts as byte slices of bounded size inside tasks, and small helpers all operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20   # text one numpy pass works on; a longer text is a slice of its own


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(doc_id: str, k: int) -> Column:
    """crc32 of the id's decimal text modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % k


def kept(key: object, make: Callable[[], object]) -> object:
    """`make()` once per Python worker: functions travel by value, so module globals do not last between tasks."""
    store = vars(sys.modules["pyspark"]).setdefault("_tendersift_llm", {})
    if key not in store:
        store[key] = make()
    return store[key]


def kept_last(slot: str, key: object, make: Callable[[], object]) -> object:
    """As `kept`, but a worker holds only the latest of a slot: for what every run makes anew."""
    store = vars(sys.modules["pyspark"]).setdefault("_tendersift_llm", {})
    if slot not in store or store[slot][0] != key:
        store[slot] = (key, make())
    return store[slot][1]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about `limit` bytes; null counts as empty."""
    a = pc.fill_null(column, pa.scalar("", column.type)).cast(pa.large_binary())
    n = len(a)
    if not n:
        return
    buffers = a.buffers()
    off = np.frombuffer(buffers[1], np.int64)[a.offset:a.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and off[-1] else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
        stop = min(stop, n)
        yield start, stop, data[off[start]:off[stop]], off[start:stop + 1] - off[start]
        start = stop
