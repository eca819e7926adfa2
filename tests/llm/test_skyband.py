import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tendersift.llm import skyband

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, rank string, p string"


def brute(rows, least=30, top=50):
    """Lines of the result for (text, lang, source) rows, by the definition."""
    rows = [tuple(v or "" for v in r) for r in rows]
    low = [TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t, _, _ in rows]
    docs, n = defaultdict(Counter), defaultdict(Counter)
    for words, (_, lang, source) in zip(low, rows):
        docs[lang].update(set(words))
        n[lang, source].update(words)
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, c in docs[lang].items() if c >= least]
        mine = {s: c for (l, s), c in n.items() if l == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        for s in mine:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def rows():
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcéßžÉ語😀") for _ in range(r.randrange(1, 4))) for _ in range(400)] + ["Über", "ÜBER", "don't", "a1b2", "x_y"]
    rows = []
    for i in range(500):
        source = r.choice(["s1", "s2", "S", "é", None, ""])
        words = [vocabulary[min(int(r.expovariate(1 / 60)) + (7 * len(source or "")), 404)] for _ in range(r.randrange(0, 80))]
        rows.append((" ".join(words), r.choice(["en", "fr", None, ""]), source))
    rows += [(None, "en", "empty"), ("", "xx", "one"), (None, None, None), ("rare words only", "yy", "a"), ("seldom seen", "yy", "b")]
    return rows + [("word " * 3000 + "ÉTÉ ÉtÉ", "en", "s1")] * 3 + [("The the THE", "zz", "only")] * 40


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 1, "x", "y", None) for i, r in enumerate(rows)], SCHEMA)


def test_against_brute_force(spark, rows):
    assert got(skyband.divergence(frame(spark, rows))) == brute(rows)


def test_small_blocks_and_stripes_change_nothing(spark, rows, monkeypatch):
    for name, v in (("BLOCK_ROWS", 300), ("STRIPE", 2), ("HELD_TERMS", 50), ("LONG_TEXT", 100), ("BLOCK", 7)):
        monkeypatch.setattr(skyband, name, v)
    assert got(skyband.divergence(frame(spark, rows), least_docs=5, top=7)) == brute(rows, 5, 7)


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang", "source").collect()]
    assert got(skyband.op12_source_divergence(spark, sf)) == brute(rows)


@pytest.mark.parametrize("top", [1, 3, 20])
def test_skyband_is_what_fewer_than_top_others_dominate(top):
    r = np.random.default_rng(top)
    n = 700
    group, lang = r.integers(0, 30, n), r.integers(0, 40, n)
    terms = [f"t{i:03d}é" for i in r.permutation(n)]
    over = [sum(group[j] >= group[i] and lang[j] <= lang[i] and terms[j].encode() < terms[i].encode() for j in range(n)) for i in range(n)]
    assert sorted(skyband.skyband(group, lang, terms, top)) == [i for i in range(n) if over[i] < top]


def test_counts_of_a_huge_corpus_are_exact(spark):
    n = 9_000_000_000_000_000
    df = spark.createDataFrame([(n, n + 12345, 77)], "n long, total long, terms long").select(skyband.share("n", "total", "terms").alias("p"))
    assert df.first()["p"] == 1 + 10**9 * (n + 5) // (n + 12345 + 5 * 77)


def test_long_texts_are_cut_at_blanks():
    text = ("Mot " * 5000 + "é" * 9000 + ", fin").encode()
    whole = skyband.term_counts(text)
    old, skyband.LONG_TEXT = skyband.LONG_TEXT, 1001
    try:
        assert skyband.term_counts(text) == whole
    finally:
        skyband.LONG_TEXT = old


def test_empty_table(spark):
    assert skyband.divergence(frame(spark, []).limit(0)).count() == 0
