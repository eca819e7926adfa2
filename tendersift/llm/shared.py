"""Rows (key, item) whose item other keys have too, by one shuffle of packed numbers.

A task sorts what it holds. An item that several of its keys have is settled there: its rows go through as they are, and the item
alone is sent as a witness. All other rows go to the segment of their item, packed as items in order of their keys, each key once
a segment; the segment finds those that another task or a witness has. So an item of every key costs a segment one number a task,
and a row some eleven bytes where a shuffled row of its own takes twice that, once instead of for the counts and again for the join.

Cases: a repeated row is one row within a task or segment and may come back more than once; a null key or item is not allowed;
no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tendersift.llm.hashing import mixed

HELD = 1 << 18           # rows a task holds before it sends them
SEGMENT_ROWS = 1 << 19   # of a segment, on average
LEAST_SEGMENTS = 16


def _unique(item: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows in order of item and key, and which of them have an item of several keys."""
    order = np.lexsort((key, item))
    item, key = item[order], key[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (key[1:] != key[:-1])
    item, key = item[new], key[new]
    same = item[1:] == item[:-1]
    several = np.zeros(len(item), bool)
    several[1:] |= same
    several[:-1] |= same
    return item, key, several


def _segment(item: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(item.view(np.uint64)) & np.uint64(segments - 1)).astype(np.int64)


def _packed(segments: int, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None):
    """Rows (key, item), made by `make` of others if given -> (segment, part, item, key, times, seen); part 0 is to be compared, others are settled."""
    def row(segment: int, part: int, item: np.ndarray, key: np.ndarray, seen: np.ndarray) -> dict:
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        times = np.diff(np.append(starts, len(key))).astype(np.uint32)
        return {"segment": segment, "part": part, "item": item.tobytes(), "key": key[starts].tobytes(), "times": times.tobytes(),
                "seen": seen.tobytes()}

    def send(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        item, key, several = _unique(np.concatenate([i for _, i in held]), np.concatenate([k for k, _ in held]))
        mine, seen = item[several], np.unique(item[several])
        out = []
        if len(mine):
            order = np.argsort(key[several], kind="stable")
            for at in range(0, len(order), SEGMENT_ROWS):
                some = order[at:at + SEGMENT_ROWS]
                first = int(key[several][some[0]]) & 0x7FFFFFFF
                out.append(row(first % segments, 1 + first, mine[some], key[several][some], seen[:0]))
        item, key = item[~several], key[~several]
        to, seen_to = _segment(item, segments), _segment(seen, segments)
        order = np.lexsort((key, to))
        item, key, to = item[order], key[order], to[order]
        seen = seen[np.argsort(seen_to, kind="stable")]
        ends = np.searchsorted(to, np.arange(segments + 1))
        seen_ends = np.searchsorted(np.sort(seen_to), np.arange(segments + 1))
        for s in range(segments):
            i, j, u, v = ends[s], ends[s + 1], seen_ends[s], seen_ends[s + 1]
            if j > i or v > u:
                out.append(row(s, 0, item[i:j], key[i:j], seen[u:v]))
        for r in out:
            yield pa.RecordBatch.from_pylist([r], pa.schema([("segment", pa.int64()), ("part", pa.int64()), ("item", pa.binary()),
                                                             ("key", pa.binary()), ("times", pa.binary()), ("seen", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for b in make(batches) if make else batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            total += b.num_rows
            if total > HELD:
                yield from send(held)
                held, total = [], 0
        if total:
            yield from send(held)
    return run


def _met(group: pa.Table) -> pa.Table:
    def read(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)
    item, key = read("item", np.int64), np.repeat(read("key", np.int64), read("times", np.uint32))
    if group.column("part")[0].as_py() == 0:
        item, key, several = _unique(item, key)
        several |= np.isin(item, read("seen", np.int64))
        item, key = item[several], key[several]
    return pa.table({"key": key, "item": item})


def shared(rows: DataFrame, about: int, make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """The rows of `rows` (key long, item long), some `about` of them, whose item another key has too.

    With `make`, the rows are what it makes of the batches of `rows`, in the same Python worker.
    """
    segments = max(LEAST_SEGMENTS, 1 << max(0, about // SEGMENT_ROWS).bit_length())
    return (rows.mapInArrow(_packed(segments, make), "segment long, part long, item binary, key binary, times binary, seen binary")
            .groupBy("segment", "part").applyInArrow(_met, "key long, item long"))
