import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tendersift.llm import shared


def want(rows):
    keys = defaultdict(set)
    for k, i in rows:
        keys[i].add(k)
    return sorted({(k, i) for k, i in rows if len(keys[i]) > 1})


def drawn(seed, n=3000):
    r = random.Random(seed)
    rows = [(r.randrange(-200, 200), r.randrange(-(1 << 63), 1 << 63) if r.random() < 0.6 else r.randrange(500)) for _ in range(n)]
    return rows + [(k, 7) for k in range(-200, 200)] + [(5, 1 << 40)] * 20   # an item of every key, and copies of one key alone


def test_tasks_and_segments_settle_all_items(monkeypatch):
    """Several tasks, each of which sends more than once, meet in the segments: the rows are those of a plain count."""
    monkeypatch.setattr(shared, "HELD", 200)
    rows = drawn(1)
    sent = []
    for part in range(4):
        own = rows[part::4]
        batches = [pa.table({"key": pa.array([k for k, _ in own[i:i + 90]], pa.int64()), "item": pa.array([x for _, x in own[i:i + 90]], pa.int64())})
                   .to_batches()[0] for i in range(0, len(own), 90)]
        sent += list(shared._packed(8, None)(iter(batches)))
    table = pa.Table.from_batches(sent)
    out = set()
    for s, p in {(r["segment"], r["part"]) for r in table.select(["segment", "part"]).to_pylist()}:
        group = table.filter(pa.array([a == s and b == p for a, b in zip(table["segment"].to_pylist(), table["part"].to_pylist())]))
        met = shared._met(group)
        out |= set(zip(met["key"].to_pylist(), met["item"].to_pylist()))
    assert sorted(out) == want(rows)
    times = [np.frombuffer(r["item"], np.int64).tolist().count(7) for r in table.to_pylist() if r["part"] == 0]
    assert sum(times) <= 4   # the common item travels as a witness a task, not as its rows


def test_in_spark(spark):
    rows = drawn(2)
    got = shared.shared(spark.createDataFrame(rows, "key long, item long").repartition(5), len(rows)).distinct().collect()
    assert sorted((r["key"], r["item"]) for r in got) == want(rows)
    assert shared.shared(spark.createDataFrame([], "key long, item long"), 0).count() == 0
