import numpy as np
import pytest

from tendersift.llm import hashing, nbsvm, toxicity
from tendersift.llm.labelled import platt, sigmoid

rng = np.random.default_rng(0)
PLAIN = ["river", "stone", "garden", "window", "paper", "music", "winter", "bread", "letter", "valley"]


def sentence(n):
    return " ".join(rng.choice(PLAIN, n))


def corpus(n):
    docs, labels = [], []
    for i in range(n):
        text = ". ".join(sentence(rng.integers(4, 9)) for _ in range(rng.integers(1, 8)))
        toxic, junk = rng.random() < 0.3, rng.random() < 0.4
        if toxic:
            text += ". you " + rng.choice(["zorgish", "zorgly", "blatt"]) + " " + sentence(3) + "."
        if junk:
            text = " ".join(w + "###" for w in text.split())
        docs.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus(400)
    docs += [(None, "river"), (1000, None), (1001, ""), (0, docs[0][1]), (1002, "word " * 30000)]
    labels += [(None, 1, 1), (5000, None, None), (3, 1, 1), (3, 1, 1)]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


@pytest.mark.parametrize("module,label", [(nbsvm, "quality"), (toxicity, "toxic")])
def test_held_out_rows_are_told_apart(data, module, label):
    d, lab, docs, labels = data
    model = module.fit(d, lab, label)
    rows = module.scored(d, model).collect()
    assert len(rows) == len(docs)
    truth = {i: (q if label == "quality" else t) for i, q, t in labels[:400] if i != 3}
    held = [r for r in rows if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 50
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert [r["score"] for r in rows] == [r["score"] for r in module.scored(d, module.fit(d, lab, label)).collect()]
    same = [r["score"] for r in rows if r["doc_id"] == 0]
    assert len(same) == 2 and same[0] == same[1]
    kept = module.accepted(d, model)
    assert kept.columns == d.columns
    assert kept.count() == sum(r["predicted"] == (1 if label == "quality" else 0) for r in rows)


@pytest.mark.parametrize("module", [nbsvm, toxicity])
def test_no_labels_and_no_rows(data, module):
    d, lab, _, _ = data
    model = module.fit(d, lab.limit(0))
    assert module.scored(d, model).filter("score between 0 and 1").count() == d.count()
    assert module.scored(d.limit(0), model).count() == 0 and module.accepted(d.limit(0), model).count() == 0


def test_offending_sentences_are_located(data):
    d, lab, docs, _ = data
    texts = dict(docs[:400])
    hits = 0
    for r in toxicity.scored(d, toxicity.fit(d, lab)).filter("predicted = 1 and doc_id < 400").collect():
        for o in r["offending"]:
            part = texts[r["doc_id"]].encode()[o["first_byte"]:o["end_byte"]]
            assert b"zorg" in part or b"blatt" in part
            hits += 1
    assert hits > 50


def test_weights_of_whole_and_sliced_batches_agree():
    texts = ["One two two THREE!!", "", "### $$$ a\nb\na\nb", "é" * 50, "x y z " * 20]
    whole = b"".join(t.encode() for t in texts)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    w = np.random.default_rng(1).normal(size=hashing.WIDTH)
    got = hashing.linear_scores(np.frombuffer(whole, np.uint8), off, w)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8)
        alone = hashing.indicators(b, np.array([0, len(b)]))[0]
        assert got[i] == pytest.approx(w[alone].sum())


def test_platt_recovers_a_sigmoid():
    m = np.linspace(-4, 4, 4001)
    y = (np.random.default_rng(2).random(len(m)) < sigmoid(1.7 * m - 0.4)).astype(int)
    slope, shift = platt(m, y, np.ones(len(m)))
    assert abs(slope - 1.7) < 0.2 and abs(shift + 0.4) < 0.15


def test_dual_descent_separates():
    x = [np.array([i % 2, 2 + i % 5], np.int32) for i in range(60)]
    y = np.array([i % 2 for i in range(60)])
    w, b = nbsvm.dual_descent(x, y, np.ones(7), np.ones(60))
    assert all((w[r].sum() + b > 0) == (k == 1) for r, k in zip(x, y))
