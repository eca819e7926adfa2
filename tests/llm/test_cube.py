from collections import Counter

import re

import numpy as np
import pytest

from tendersift.llm import cube

SCHEMA = "doc_id long, text string, source string, size string"


def brute_targets(sizes):
    """Source -> target: share by weight, cap, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def check(rows, got):
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(cube.WORD, text or ""))
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["size"] == 0 or r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    return want, taken


def test_targets_and_balance(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.lognormal(4, 1)), ("a", "b", "c", "é", "Z", None)[min(5, int(rng.exponential(1.2)))])
            for i in range(4000)]
    got = cube.mixed(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), block_rows=300)
    first, second = got.collect(), got.collect()
    want, taken = check(rows, first)
    assert sorted(map(str, first)) == sorted(map(str, second))
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60
    assert {r["source"]: r["taken"] for r in first} is not None


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", None), (2, "one two", None), (2, "one two", None), (3, "x " * 5000, "a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    check(rows, cube.mixed(df).collect())
    mix = cube.mixture(df)
    assert mix.columns == ["doc_id", "text", "source", "size"]
    copies = sum(r["copies"] for r in cube.mixed(df).collect())
    assert mix.count() == copies


def test_all_empty_and_no_rows(spark):
    df = spark.createDataFrame([(1, "", "a", "x"), (2, None, "b", "x")], SCHEMA)
    assert [r["taken"] for r in cube.mixed(df).collect()] == [0, 0]
    assert cube.mixed(df.limit(0)).count() == 0 and cube.mixture(df.limit(0)).count() == 0


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    p, x = rng.random(500), rng.integers(1, 900, 500)
    out = cube.flight(p, x, np.random.default_rng(2))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * x).sum() == pytest.approx((p * x).sum())


def test_expectation_is_kept():
    p, x = np.full(6, 0.5), np.array([5, 4, 3, 2, 1, 1])
    runs = np.array([cube.flight(p, x, np.random.default_rng(i)) for i in range(4000)])
    assert np.abs(runs.mean(0) - 0.5).max() < 0.05


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    src = {r[0]: r[2] for r in rows}
    got = [r.asDict() | {"source": src[r["doc_id"]]} for r in cube.op9_cube_mix(spark, sf).collect()]
    want, taken = check(rows, got)
    most = max(r["size"] for r in got)
    assert all(abs(taken[s] - t) <= most for s, t in want.items())


def test_mixture_gives_the_users_columns_back(spark):
    """Columns of names the plan uses, null ids, and one row repeated many times."""
    rows = [(None if i % 4 else i, "w " * (i % 9), "ab"[i % 2], 7, "r", 1.5) for i in range(400)] + [(5, "the same row", "a", 1, "s", 0.0)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _n long, _r string, whole double")
    out = cube.mixture(df)
    assert out.columns == df.columns
    taken = Counter(map(tuple, out.collect()))
    have = Counter(rows)
    assert not taken.keys() - have.keys() and all(taken[r] <= 2 * have[r] for r in taken)
    assert sum(taken.values()) == cube.mixed(df).agg({"copies": "sum"}).first()[0]
