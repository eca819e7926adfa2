import itertools
import random

from pyspark.sql import functions as F

import corpus_pipeline
from tendersift.llm import overlap, simhash

SIMILAR = 0.8


def sets(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute(rows):
    """Rows that stay: the first of each group of (id, text) pairs linked at a Jaccard similarity of 0.8."""
    held = [sets(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = held[i], held[j]
        if a == b or a and b and 10 * len(a & b) >= 8 * len(a | b):
            comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, 1 << 63), 1 << 63 if d is None else d)
    return sorted(least.values())


def stay(docs):
    return sorted(1 << 63 if r["doc_id"] is None else r["doc_id"] for r in docs.collect())


def test_stage_drops_near_copies_that_fingerprints_leave(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert stay(corpus_pipeline.near_dedup(spark, docs, sf)) == want


def test_crowded_buckets_lose_no_group(spark, table):
    """Many near copies of one text, texts that share half of it, chains at the bound, nulls and short texts."""
    r = random.Random(7)
    word = lambda: f"w{r.randrange(10**6)}"
    base = [word() for _ in range(150)]
    rows = [(i, " ".join(w if j != r.randrange(150) else word() for j, w in enumerate(base))) for i in range(60)]
    rows += [(100 + i, " ".join(base[:75] + [word() for _ in range(75)])) for i in range(60)]
    chain = list(base[::-1])
    for i in range(40):
        rows.append((200 + i, " ".join(chain)))
        chain[r.randrange(150)] = word()
    rows += [(300, None), (301, ""), (302, " \t"), (303, "six"), (304, "SIX"), (305, "six seven"), (None, "six"), (None, "alone without id")]
    assert stay(overlap.deduplicated(table(rows))) == brute(rows)


def test_bound_is_exact(spark, table):
    a = [f"a{i}" for i in range(94)]   # 90 shingles; 80 of 100 in common is near, 79 of 100 is not
    rows = [(1, " ".join(a)), (2, " ".join(a[:84] + [f"b{i}" for i in range(10)]))]
    rows += [(3, " ".join(a[::-1])), (4, " ".join(a[::-1][:83] + [f"c{i}" for i in range(10)]))]
    assert stay(overlap.deduplicated(table(rows))) == brute(rows) == [1, 3, 4]


def test_many_near_copies_of_two_templates_cost_links(spark, table, monkeypatch):
    """Two large groups whose texts share two thirds: verified pairs stay near the number of texts."""
    r = random.Random(3)
    a = [f"a{i}" for i in range(120)]
    b = a[:80] + [f"b{i}" for i in range(40)]
    rows = [(i, " ".join([*(a, b)[i % 2], f"end{i}"])) for i in range(1500)]
    r.shuffle(rows)
    asked = []
    near = overlap._near

    def counted(pairs, sets):
        asked.append(pairs.filter(f"key <> other AND {overlap.MAY}").select(F.least("key", "other"), F.greatest("key", "other")).distinct().count())
        return near(pairs, sets)
    monkeypatch.setattr(overlap, "_near", counted)
    assert stay(overlap.deduplicated(table(rows))) == [0, 1]
    assert sum(asked) < 4 * len(rows)


def test_prefix_index_finds_what_leaders_leave(spark, table, monkeypatch):
    """Sets that all hold one template, at 0.75 of each other, with a near pair here and there: every link is found."""
    r = random.Random(8)
    base = [f"t{i}" for i in range(104)]
    rows = []
    for i in range(60):
        own = [f"u{i}_{j}" for j in range(14)]
        rows.append((2 * i, " ".join(base + own)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(base + own[:r.randrange(6, 14)])))
    want = brute(rows)
    assert stay(overlap.deduplicated(table(rows))) == want


def test_users_columns_of_any_name_come_back(spark):
    rows = [(i // 3, "one two three four five six", "key", 5, "hash") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, k long, text_hash string")
    out = overlap.deduplicated(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [rows[0]]


def test_empty_table(spark, table):
    assert overlap.deduplicated(table([]).limit(0)).count() == 0


def test_first_fingerprint_is_that_of_the_named_method():
    text = " ".join(f"w{i}" for i in range(200)).encode()
    held = overlap.blocks(overlap.shingles(text))
    assert sum((held[i] & 0xffffffff) << 32 * i for i in (0, 1)) == simhash.fingerprint(text, 5) % (1 << 64)
    assert [b >> 32 for b in held] == list(range(8))


def test_links_come_from_fingerprints(spark, table, monkeypatch):
    """Without the index that follows, blocks within two bits link the near copies."""
    rows = []
    for g in range(60):
        words = [f"g{g}_{i}" for i in range(200)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:197] + ["x", "y", "z"]))]
    prefixes = overlap._prefixes
    monkeypatch.setattr(overlap, "_prefixes", lambda *a: prefixes(*a).limit(0))
    assert len(stay(overlap.deduplicated(table(rows)))) <= 63


def test_pair_at_the_bound_without_a_shared_minimum_hash(spark, table):
    """These two shared no bucket of 30 bands of six minimum hashes, so they were never compared."""
    a = [f"11918a{i}" for i in range(94)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:84] + [f"11918b{i}" for i in range(10)]))]
    assert stay(overlap.deduplicated(table(rows))) == brute(rows) == [1]


def test_sets_are_written_only_where_enough_is_shared(spark, table, monkeypatch):
    """Long texts that share a passage but are no near copies: their whole sets were written and shuffled, now only the copies' are."""
    passage = [f"license{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"own{i}_{j}" for j in range(500)])) for i in range(100)]
    rows += [(200 + i, f"{rows[i][1]} end") for i in range(5)]
    written = []
    cut = overlap.cut_lineage

    def counted(df):
        out = cut(df)
        lists = [F.sum(F.size(c)) for c, kind in out.dtypes if kind == "array<bigint>" and c != "blocks"]
        written.extend(x or 0 for x in out.agg(*lists).first()) if lists else None
        return out
    monkeypatch.setattr(overlap, "cut_lineage", counted)
    assert stay(overlap.deduplicated(table(rows))) == list(range(100))
    assert sum(written) < 2 * 10 * 600   # the sets of five pairs, as made and as held
