import re

import numpy as np
import pytest

from tendersift.llm import hashing, rules

WORD = re.compile("[^\x20\x09-\x0d]+")
CASES = ["", None, "a", "a b c d e f g h", "a b c d e f g h " * 2, "x a b c d e f g h y a b c d e f g h z", "l\nl\n\n\nl \nl\n \n \nm",
         "a " * 40, "é" * 30 + " ## é|<", "one two\nthree\r\none two\nthree\r", "w\x0bw\x0cw", "# * $ % & | < >", "q " * 30000,
         " ".join(f"w{i}" for i in range(25)), " ".join(f"w{i}" for i in range(25)) + " " + " ".join(f"w{i}" for i in range(9))]


def brute(t):
    t = t or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = {}
    for i in range(len(words) - 7):
        wins.setdefault(tuple(words[i:i + 8]), []).append(i)
    cov = {j for v in wins.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(cov), n < 20 or 100 * len(cov) > 30 * n


def test_counts_against_brute_force(spark, table):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    model = rules.Logistic(np.zeros((2, hashing.WIDTH)), 0.0, 0.0, 20.0)
    got = rules.judged(table(rows), model).collect()
    key = str
    assert sorted(((r[0], *r[1:7]) for r in got), key=key) == sorted(((d, *brute(t)) for d, t in rows), key=key)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert rules.judged(table(rows).limit(0), model).count() == 0


def test_texts_of_one_polynomial_hash_are_told_apart(spark, table):
    a, b = ("".join(letters[bin(i).count("1") % 2] for i in range(2048)) for letters in ("ab", "ba"))
    first, second = ([f"{w}{i}" for i in range(3)] + [w] + ["x"] * 4 for w in (a, b))
    rows = [(1, f"{a}\n{b}\n"), (2, f"{a}\n{b}\n{a}\n"), (3, " ".join(first + second)), (4, " ".join(first + second + first)),
            (5, " ".join("abbabaabbaababba"[i % 16] for i in range(512)))]
    model = rules.Logistic(np.zeros((2, hashing.WIDTH)), 0.0, 0.0, 20.0)
    got = rules.judged(table(rows), model).collect()
    assert sorted(tuple(r[:7]) for r in got) == [(d, *brute(t)) for d, t in rows]


@pytest.mark.parametrize("window", range(1, 12))
def test_windows_of_any_width(window):
    words = np.random.default_rng(window).integers(0, 2, 300).tolist()
    data = np.frombuffer(" ".join(map(str, words)).encode(), np.uint8)
    off = np.array([0, 200, 200, len(data)])
    want = []
    for part in (words[:100], [], words[100:]):
        at = {}
        for i in range(len(part) - window + 1):
            at.setdefault(tuple(part[i:i + window]), []).append(i)
        want.append(len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + window)}))
    assert rules.repeated_words(data, off, hashing.Hashes(data), window)[1].tolist() == want


def test_query(spark, sf):
    docs = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = rules.op10_quality_rules(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[1:7]) == brute(docs[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])
    judged = [r for r in got if r["doc_id"] in truth and not r["base_failed"]]
    assert np.mean([r["kept"] == (truth[r["doc_id"]] == 1) for r in judged]) > 0.9


def test_no_labels(spark, table):
    df = table([(1, "a b")])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judged(df, rules.fit(df, labels)).count() == 1


def test_several_scores_agree():
    b = np.frombuffer("One two two\n### $$$ a\nb".encode(), np.uint8)
    off = np.array([0, 11, len(b)])
    w = np.random.default_rng(1).normal(size=(2, hashing.WIDTH))
    got = hashing.several_scores(b, off, w)
    for k in (0, 1):
        assert np.allclose(got[k], hashing.linear_scores(b, off, w[k]))
