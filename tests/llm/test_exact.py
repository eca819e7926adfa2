import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tendersift.llm import exact


def stays(rows):
    """For every row the row of its group that stays, the group's size and its text without white space."""
    plain = ["".join(c for c in t or "" if c != " " and not "\x09" <= c <= "\x0d") for _, t in rows]
    groups = defaultdict(list)
    for i, p in enumerate(plain):
        groups[p].append(i)
    first = {p: min(at, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i)) for p, at in groups.items()}
    return [(first[p], len(groups[p]), p) for p in plain]


def brute(rows):
    return sorted(((rows[i][0], rows[j][0], n, i == j, hashlib.sha256(p.encode()).hexdigest()) for i, (j, n, p) in enumerate(stays(rows))), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def rows():
    r = random.Random(4)
    rows = [(i, r.choice(["one two", "one  two", "onetwo ", "é è", "x" * 100000, "x " * 100000, None, "", " \t\n", " ", "alone %d" % i]))
            for i in range(300)]
    return rows + [(None, "one two"), (None, None), (7, "repeated row"), (7, "repeated row"), (7, "repeated  row"), (None, "only one")]


def test_against_brute_force(spark, table, rows):
    df = exact.marked(table(rows))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(df) == brute(rows)


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(exact.op11_bloom_exact_dedup(spark, sf)) == brute(rows)


def test_slices_change_nothing(spark, table, rows, monkeypatch):
    """Filters of 8 KB hold 4,096 rows: three slices."""
    rows = rows + [(1000 + i, f"text {i % 6000}") for i in range(10000)]
    monkeypatch.setattr(exact, "HELD", 1000)
    assert got(exact.marked(table(rows), filter_bytes=exact.SEGMENT // 8)) == brute(rows)


def test_filter_passes_no_repeated_hash_and_few_others(spark, table):
    rows = [(i, f"text {i if i % 3 else 0}") for i in range(30000)]
    df = table(rows).select("doc_id", exact.code_points("text").alias("chars"), exact.digest("text").alias("hash"))
    both = exact.split(df.selectExpr("doc_id AS row", "doc_id", "chars", "hash"))
    maybe = {r["doc_id"]: r["maybe"] for r in both.collect()}
    assert len(maybe) == 30000 and all(maybe[i] for i in range(0, 30000, 3))
    assert sum(maybe[i] for i in range(30000) if i % 3) < 0.03 * 20000


def test_deduplicated_returns_whole_rows(spark, rows):
    """Columns of the operator's own names are the user's."""
    names = "doc_id long, text string, hash string, row string, maybe int, tag string, kept string, times long"
    df = spark.createDataFrame([(*r, "h", f"{i % 2}", i % 3, None, "k", 5) for i, r in enumerate(rows)], names)
    out = exact.deduplicated(df)
    assert out.columns == df.columns
    have = out.collect()
    assert not Counter(have) - Counter(df.collect())
    assert Counter((r["doc_id"], r["text"]) for r in have) == Counter(rows[i] for i, (j, _, _) in enumerate(stays(rows)) if i == j)


def test_one_row_repeated_very_often(spark, table):
    df = table([(3, "same text")]).crossJoin(spark.range(100000).select()).union(table([(1, "other"), (2, "same  text")]))
    out = exact.marked(df).groupBy("keep_id", "group_size", "kept").count().collect()
    assert {tuple(r) for r in out} == {(1, 1, True, 1), (2, 100001, True, 1), (2, 100001, False, 100000)}
    assert exact.deduplicated(df).count() == 2


def test_empty_table(spark, table):
    assert exact.marked(table([]).limit(0)).count() == 0
    assert exact.deduplicated(table([]).limit(0)).count() == 0
