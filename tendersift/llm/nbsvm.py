"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes ratios.

Indicators: hashed words and word pairs of the whole text, and n-grams of character kinds (16 kinds)
that make up at least a given share of it. An indicator's value is the log ratio of its smoothed
frequency in the two classes; the hinge loss is minimised by dual coordinate descent, and margins
become probabilities on rows the machine did not see. The model is fitted on a bounded sample of
labelled rows (`PER_CLASS` of each label, by hash of the id) and has a fixed width.

Cases: a null text is an empty one; empty texts get the score of no indicator; a null `doc_id` is
scored; repeated rows are scored alike; other columns are ignored; without labels of both kinds every
score is the share of label 1 (1.0 if there is none at all); no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.hashing import WIDTH, indicators, several_scores
from tendersift.llm.labelled import FOLDS, platt, releasing, sample, sampled_rows, sigmoid
from tendersift.llm.texts import read, remainder, text_slices

PER_CLASS = (3000, 3000)      # labelled rows of each label a model is fitted on, at most
THRESHOLD = 0.3
SMOOTH = 1.0
COST = 0.5
EPOCHS = 20
LEAST_ROWS = 3        # training rows an indicator must be in


@dataclass
class Linear:
    """Row 0: weights by indicator; row 1: the squares of their scale, which add up to a text's squared length; a bias,
    and the sigmoid that turns margins into probabilities."""
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def indicator_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, y, text) -> (doc_id, y, idx)."""
    for b in batches:
        for lo, hi, data, off in text_slices(b.column(2)):
            idx = pa.array(indicators(data, off), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], b.column(1)[lo:hi], idx], ["doc_id", "y", "idx"])


def log_ratios(rows: list[np.ndarray], y: np.ndarray, width: int = WIDTH, smooth: float = SMOOTH) -> np.ndarray:
    """Log of each indicator's smoothed share in class 1 over that in class 0; 0 where it is rare."""
    counts = [np.bincount(np.concatenate([r for r, k in zip(rows, y) if k == c] or [np.zeros(0, np.int32)]), minlength=width)
              for c in (0, 1)]
    share = [(c + smooth) / ((y == k).sum() + 2 * smooth) for k, c in enumerate(counts)]
    return np.where(counts[0] + counts[1] >= LEAST_ROWS, np.log(share[1] / share[0]), 0.0)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS,
                 seed: int = 5) -> tuple[np.ndarray, float]:
    """(w, bias) of min |w|^2/2 + sum cost_i hinge(y_i (w.x_i + bias)), x_i the scaled indicators of unit length."""
    sign = np.where(y == 1, 1.0, -1.0)
    xs = []
    for r in rows:
        r = r[scale[r] != 0]
        v = scale[r]
        xs.append((r, v / max(np.sqrt((v * v).sum()), 1e-12)))
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, v = xs[i]
            g = sign[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - g / 2.0, 0.0), cost[i])   # the squared length of (x, 1) is 2
            if (d := new - alpha[i]) != 0:
                w[r] += d * sign[i] * v
                bias += d * sign[i]
                alpha[i], worst = new, max(worst, abs(d))
        if worst < 1e-3:
            break
    return w, bias


def unit_lengths(rows: list[np.ndarray], scale: np.ndarray) -> np.ndarray:
    return np.array([max(np.sqrt((scale[r] ** 2).sum()), 1e-12) for r in rows])


@releasing
def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        per_class: tuple[int, int] = PER_CLASS) -> Linear:
    chosen, stands_for = sample(labels, label, per_class)
    t = sampled_rows(docs, chosen, indicator_rows, "doc_id long, y int, idx array<int>", doc_id, text)
    y = t.column("y").to_numpy()
    rows = [np.asarray(r.values, np.int32) for r in t.column("idx")]
    if len(set(y.tolist())) < 2:
        sure = 20.0 if not len(y) or y[0] == 1 else -20.0
        return Linear(np.zeros((2, WIDTH)), 0.0, 0.0, sure)
    weight = np.where(y == 1, stands_for[1], stands_for[0])
    held = np.arange(len(y)) % 4 == 3            # rows that calibrate
    if min((y[held] == c).sum() for c in (0, 1)) == 0 or min((y[~held] == c).sum() for c in (0, 1)) == 0:
        held = np.zeros(len(y), bool)
    train = [r for r, h in zip(rows, held) if not h]
    yt = y[~held]
    scale = log_ratios(train, yt)
    cost = COST * np.where(yt == 1, len(yt) / (2 * (yt == 1).sum()), len(yt) / (2 * (yt == 0).sum()))
    w, bias = dual_descent(train, yt, scale, cost)
    weights = w * scale
    check = rows if not held.any() else [r for r, h in zip(rows, held) if h]
    yc, wc = (y, weight) if not held.any() else (y[held], weight[held])
    m = np.array([weights[r].sum() for r in check]) / unit_lengths(check, scale) + bias
    slope, shift = platt(m, yc, wc)
    return Linear(np.stack((weights, scale ** 2)), bias, slope, shift)


def scorer(model: Linear, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All columns of the batch but its last, the text, with score and predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = b.num_columns - 1
            for lo, hi, data, off in text_slices(b.column(last)):
                z, squares = several_scores(data, off, model.weights)
                m = z / np.sqrt(np.maximum(squares, 1e-24)) + model.bias
                p = sigmoid(model.slope * m + model.shift)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i)[lo:hi] for i in range(last)), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    [*b.schema.names[:last], "score", "predicted"])
    return run


def scored(docs: DataFrame, model: Linear, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of `docs`."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), (remainder(doc_id, FOLDS) == 0).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scorer(model, threshold), f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Linear, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score of at least `threshold`, all columns as they are."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("t", F.col(f"c{names.index(text)}").cast("string"))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return (flat.mapInArrow(scorer(model, threshold), f"{kinds}, score double, predicted int").filter("predicted = 1")
            .drop("score", "predicted").toDF(*names))


def op3_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
