import math

import numpy as np
import pytest

from tendersift.llm import neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, score string, e string"


def brute(rows, k=20, every=20):
    """Per query row (by its id, and its turn among the rows of that id) the nearest other rows of the same length."""
    good = [(i, np.array([float(np.float32(x)) for x in v])) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, (q, x) in enumerate(good):
        if q is not None and q % every == 0:
            near = sorted((-float((x * v).sum()), math.inf if i is None else i) for m, (i, v) in enumerate(good) if m != n and len(v) == len(x))
            out.setdefault(q, []).append([(None if i == math.inf else i, -s_) for s_, i in near[:k]])
    return {(q, n): w for q, v in out.items() for n, w in enumerate(sorted(v, key=str))}


def found(df):
    """As `brute`, for tables whose queries have one row each or the same results."""
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], {}).setdefault(r["rank"], []).append((r["vec_id"], r["score"]))
    got = {}
    for q, ranks in out.items():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
        for n in range(len(ranks[1])):
            got[q, n] = [sorted(ranks[r], key=str)[n] for r in sorted(ranks)]
    return got


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / max(1, sum(map(len, want.values())))


def test_small_table_with_odd_rows(spark):
    rows = [(i, [float(i % 7 - 3), 1.0, float(i % 3)]) for i in range(60)]
    rows += [(100, None), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]), (160, [1.0, None, 1.0]), (180, [float("inf"), 0.0, 0.0]),
             (200, [1.0]), (None, [1.0, 1.0, 1.0]), (None, [0.0, 1.0, 0.0]), (240, [9.0, 9.0, 9.0]), (240, [9.0, 9.0, 9.0]), (220, []),
             (260, [2.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (None, [1.0, 1.0]), (280, [3.0, -1.0]), (2 ** 63 - 1, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got, want = found(nn.Index(df).nearest()), brute(rows)
    assert got.keys() == want.keys() - {(200, 0)}     # no other vector has its length
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])


def test_many_copies_over_parts_and_cells(spark, monkeypatch):
    monkeypatch.setattr(nn, "CELL_ROWS", 100)
    monkeypatch.setattr(nn, "PART_ROWS", 60)
    monkeypatch.setattr(nn, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=8) if i % 3 else np.ones(8)).tolist()) for i in range(900)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got, want = found(nn.Index(df).nearest()), brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    ones = [q for q in want if q[0] % 3 == 0]
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in ones)


def test_two_lengths_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(nn, "CELL_ROWS", 50)
    monkeypatch.setattr(nn, "PART_ROWS", 40)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * (1 if i % 4 else 30)).tolist()) for i in range(600)]
    rows += [(i, rng.normal(size=9).tolist()) for i in range(601, 1000)] + [(i, rng.normal(size=9).tolist()) for i in range(1000, 1200, 20)]
    rows += [(i % 90 + 1, rng.normal(size=6).tolist()) for i in range(300) if (i % 90 + 1) % 20]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got, want = found(nn.Index(df).nearest()), brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_fewer_candidates_than_wanted_and_no_rows(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0], "x", "y"), (3, [1.0, 0.0], "x", "y")], SCHEMA)
    assert found(nn.Index(df).nearest()) == {(20, 0): [(3, 1.0)]}
    assert nn.Index(df.limit(0)).nearest().count() == 0


def test_query_recall(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = found(nn.op8_stable_projection_ann(spark, sf)), brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.95


def test_chi_square():
    assert nn.chi_square(np.array([0.0, 15.507, 20.09]), 8) == pytest.approx([0, 0.95, 0.99], abs=1e-4)
