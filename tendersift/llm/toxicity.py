"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's probability is logistic in hashed words and word beginnings; a document's is the noisy-or of
its sentences, and only document labels train it: the gradient of the document's log likelihood reaches
each sentence by how much it alone accounts for the label. The sentence scores then locate what offends.
The model is fitted on a bounded sample of labelled rows (`PER_CLASS` of each label, by hash of the
id, each standing for the rows it represents) and has a fixed width.

Cases: a null text is an empty one; a text without a word has no sentence and score 0; a null `doc_id`
is scored; repeated rows are scored alike; other columns are ignored; without labels of both kinds every
text with a word gets the one label seen as its score (0 if there is none); no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.hashing import LOWER, Hashes, mixed, spans
from tendersift.llm.labelled import FOLDS, releasing, sample, sampled_rows, sigmoid
from tendersift.llm.texts import read, remainder, text_slices

PER_CLASS = (2500, 1250)   # labelled rows of label 0 and of label 1 a model is fitted on, at most
THRESHOLD = 0.5
BITS = 18
BEGINNINGS = (4, 6)
LEAST_ROWS = 4         # training rows a feature must be in
SEARCH = (60, 0.5, 3e-4)   # epochs, rate and L1 penalty of the pass that chooses features
REFIT = (600, 1.0, 0.0)    # and of the pass that fits those chosen
LETTERS = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


@dataclass
class Mil:
    """Feature weights and the bias of a sentence."""
    weights: np.ndarray
    bias: float


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features words x 5, sentence of each word, text of each sentence, byte range of each sentence) of a slice.

    A sentence ends after a full stop, mark or line end, and counts if it has a word.
    """
    s, e, row = spans(LETTERS[data], off)
    h = Hashes(LOWER[data])
    cols = [h(s, e)]
    for k in BEGINNINGS:   # a beginning as long as the word is the word once more, with a weight of its own
        cols.append(mixed(h(s, np.minimum(s + k, e)) + np.uint64(k)))
    feats = (np.stack(cols, 1) >> np.uint64(64 - BITS)).astype(np.int32)
    stops = np.concatenate(([0], np.cumsum(STOPS[data])))
    edge = np.ones(len(s), bool)
    if len(s):
        edge[1:] = (stops[s[1:]] != stops[s[:-1]]) | (row[1:] != row[:-1])
    sent = np.cumsum(edge) - 1
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(s)) - 1 if len(s) else first
    return feats, sent, row[first], np.stack((s[first], e[last]), 1) if len(s) else np.zeros((0, 2), np.int64)


def instance_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, y, text) -> (doc_id, y, idx, ends): features of all sentences, and where each sentence ends."""
    for b in batches:
        for lo, hi, data, off in text_slices(b.column(2)):
            feats, sent, text, _ = words(data, off)
            key = np.unique((np.repeat(sent, feats.shape[1]).astype(np.int64) << BITS) | feats.ravel())
            which, idx = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
            ends = np.searchsorted(which, np.arange(len(text)), "right")
            cut = np.searchsorted(text, np.arange(hi - lo + 1))
            at = np.concatenate(([0], ends))[cut]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[lo:hi], b.column(1)[lo:hi],
                 pa.array([idx[at[i]:at[i + 1]] for i in range(hi - lo)], pa.list_(pa.int32())),
                 pa.array([(ends[cut[i]:cut[i + 1]] - at[i]).astype(np.int32) for i in range(hi - lo)], pa.list_(pa.int32()))],
                ["doc_id", "y", "idx", "ends"])


def train(idx: np.ndarray, sent: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int,
          settings: tuple[int, float, float]) -> Mil:
    """Proximal AdaGrad on the weighted noisy-or likelihood. `sent` is the sentence of each feature, `doc` the
    document of each sentence, `y` and `weight` are by document."""
    (epochs, speed, sparsity), n, total = settings, len(y), weight.sum()
    w, b = np.zeros(width), -4.0
    gw, gb = np.full(width, 1e-8), 1e-8
    for _ in range(epochs):
        p = sigmoid(np.bincount(sent, w[idx], len(doc)) + b)
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), n)          # log probability of no toxic sentence
        some = -np.expm1(none)
        pull = np.where(y == 1, -np.exp(none) / np.maximum(some, 1e-12), 1.0) * weight / total
        g = p * pull[doc]                                                        # by sentence, of the negative log likelihood
        grad, gradb = np.bincount(idx, g[sent], width), g.sum()
        gw += grad * grad
        gb += gradb * gradb
        rate = speed / np.sqrt(gw)
        w = w - rate * grad
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparsity, 0)
        b -= speed / np.sqrt(gb) * gradb
    return Mil(w, b)


@releasing
def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
        per_class: tuple[int, int] = PER_CLASS) -> Mil:
    chosen, stands_for = sample(labels, label, per_class)
    t = sampled_rows(docs, chosen, instance_rows, "doc_id long, y int, idx array<int>, ends array<int>", doc_id, text)
    y = t.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return Mil(np.zeros(1 << BITS), 30.0 if len(y) and y[0] == 1 else -60.0)
    idx = t.column("idx").combine_chunks().flatten().to_numpy()
    sizes = np.concatenate([np.diff(np.asarray(r.values), prepend=0) for r in t.column("ends")])
    sent = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    doc = np.repeat(np.arange(len(y), dtype=np.int32), [len(r) for r in t.column("ends")])
    del t
    return fitted(idx, sent, doc, y, np.where(y == 1, stands_for[1], stands_for[0]))


def fitted(idx: np.ndarray, sent: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Mil:
    """Features found with an L1 penalty, then fitted without it: a penalty left on would leave every sentence of
    a long clean text some probability."""
    rows = np.zeros(1 << BITS, np.int64)     # texts with a feature, one text at a time: the sample's features need no second copy
    edges = np.searchsorted(sent, np.searchsorted(doc, np.arange(len(y) + 1)))
    for a, b in zip(edges[:-1], edges[1:]):
        rows[np.unique(idx[a:b])] += 1
    weights, bias = (rows >= LEAST_ROWS).astype(float), 0.0
    for settings in (SEARCH, REFIT):
        known = np.flatnonzero(weights)
        place = np.full(1 << BITS, -1, np.int32)
        place[known] = np.arange(len(known))
        keep = place[idx] >= 0
        part = train(place[idx[keep]], sent[keep], doc, y, weight, len(known), settings)
        weights = np.zeros(1 << BITS)
        weights[known], bias = part.weights, part.bias
    return Mil(weights, bias)


def sentence_scores(model: Mil, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability, text, byte range) of every sentence of a slice; a word beginning counts once a sentence."""
    feats, sent, text, where = words(data, off)
    w = model.weights[feats]
    hit = np.flatnonzero(w.any(1))
    key = np.unique((np.repeat(sent[hit], feats.shape[1]).astype(np.int64) << BITS) | feats[hit].ravel())
    z = np.bincount(key >> BITS, model.weights[key & ((1 << BITS) - 1)], len(text)) + model.bias
    return sigmoid(z), text, where


def noisy_or(p: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-15)), n))


def scorer(model: Mil, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All columns of the batch but its last, the text, with score, predicted and the sentences that offend."""
    kind = pa.list_(pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = b.num_columns - 1
            for lo, hi, data, off in text_slices(b.column(last)):
                p, text, where = sentence_scores(model, data, off)
                score = noisy_or(p, text, hi - lo)
                bad: list[list[dict]] = [[] for _ in range(hi - lo)]
                for i in np.flatnonzero((p >= threshold) & (score[text] >= threshold)):
                    bad[text[i]].append({"first_byte": int(where[i, 0] - off[text[i]]),
                                         "end_byte": int(where[i, 1] - off[text[i]]), "score": float(p[i])})
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i)[lo:hi] for i in range(last)), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32)), pa.array(bad, kind)],
                    [*b.schema.names[:last], "score", "predicted", "offending"])
    return run


RESULT = "score double, predicted int, offending array<struct<first_byte: long, end_byte: long, score: double>>"


def scored(docs: DataFrame, model: Mil, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) per row; `offending` are byte ranges of the UTF-8 text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), (remainder(doc_id, FOLDS) == 0).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scorer(model, threshold), f"doc_id {kind}, held_out boolean, {RESULT}")


def accepted(docs: DataFrame, model: Mil, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score below `threshold`, all columns as they are."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("t", F.col(f"c{names.index(text)}").cast("string"))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return (flat.mapInArrow(scorer(model, threshold), f"{kinds}, {RESULT}").filter("predicted = 0")
            .drop("score", "predicted", "offending").toDF(*names))


def op4_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
