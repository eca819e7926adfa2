import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tendersift.llm import maxent

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    toks = [[*WORD.findall(low(t)), None] for _, t in rows]
    c = Counter(x for h, ts in zip(held, toks) if not h for x in ts)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(ts), sum(c[x] > 0 for x in ts), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in ts))
            for (d, _), h, ts in zip(rows, held, toks)]


def compare(got, rows):
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[2], round(r[5], 5))
    for a, b in zip(sorted((tuple(r)[:6] for r in got), key=key), sorted(brute(rows), key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_words_of_one_polynomial_hash_are_told_apart(spark, table):
    a, b = ("".join(letters[bin(i).count("1") % 2] for i in range(2048)) for letters in ("ab", "ba"))
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(held, f"{a} {b} the")] + [(i, f"{a} the") for i in range(100, 120) if zlib.crc32(str(i).encode()) % 7 != 2]
    df = table(rows)
    compare(maxent.scored(df, maxent.Trainer(df.filter(maxent.remainder("doc_id", 7) != 2))).collect(), rows)


def test_counts_and_base_against_brute_force(spark, table, monkeypatch):
    monkeypatch.setattr(maxent, "FREQUENT", 6)     # most words go through the join
    rows = [(i, t) for i, t in enumerate(["The cat the CAT sat", "a b c", "", None, "the É é \x0b x", "the " * 9000, "zz zz yy"] * 4)]
    rows += [(None, "the cat"), (3, "the cat"), (3, "the cat"), (77, "unseen words only here")]
    df = table(rows)
    got = maxent.scored(df, maxent.Trainer(df.filter(maxent.remainder("doc_id", 7) != 2))).collect()
    compare(got, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_probabilities_sum_to_one(spark, table, monkeypatch):
    monkeypatch.setattr(maxent, "FREQUENT", 50)
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.5, 60))) for i in range(200)]
    df = table(rows)
    m = maxent.Trainer(df).model
    counts = Counter(x for _, t in rows for x in [*t.split(), None])
    inside = np.bincount(m.words.classes, 10 ** m.inside, maxent.CLASSES)
    assert np.allclose(inside[np.unique(m.words.classes)], 1)
    frequent = {c for c in m.words.counts.tolist()}
    rest = sorted(counts.values(), reverse=True)[50:]
    other = 10 ** m.other[0] + sum(10 ** (m.other[c] if c <= maxent.RARE_UPTO else math.log10(c) + m.other_rate) for c in rest)
    assert other == pytest.approx(1) and frequent
    rows_ = maxent.features(np.arange(9), np.zeros(9, np.int64), np.array([0, 4, 9]))
    assert np.allclose(np.exp(maxent.class_log_probabilities(m.weights, rows_)).sum(1), 1, atol=1e-5)


def test_query_beats_base_on_held_out_texts(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = maxent.op6_maxent_lm(spark, sf).collect()
    compare(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nothing_to_train_on(spark, table):
    df = table([(1, "a b"), (2, None)])
    got = maxent.scored(df, maxent.Trainer(df.limit(0))).collect()
    assert [r["base_score"] for r in got] == [0.0, 0.0] and all(r["n_known"] == 0 for r in got)
    assert maxent.scored(df.limit(0), maxent.Trainer(df)).count() == 0
