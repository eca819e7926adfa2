"""Quality rules: counted base rules, and a learned rule for what counts cannot express.

The learned rule is a logistic regression on hashed word and character n-gram indicators (words and word
pairs; n-grams of character kinds by the share of a text they make up), of unit length per text, trained
on labelled quality rows and calibrated on rows it did not see. Rules and the probability are held against
fixed thresholds, slice by slice, over whole texts.

Cases: a null text has no words and fails the base rules, as an empty one; a null `doc_id` and repeated
rows are judged like any other; windows and lines never reach from one text into the next; other columns
are ignored; without labels of both kinds the learned rule lets every text pass unless all labels are 0;
no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.hashing import SPACES, WIDTH, Hashes, distinct, repeated_lines, several_scores, spans
from tendersift.llm.labelled import platt, releasing, sample, sampled_rows, sigmoid
from tendersift.llm.nbsvm import indicator_rows
from tendersift.llm.texts import read, text_slices

PER_CLASS = (3000, 3000)   # labelled rows of each label the regression is fitted on, at most
LEAST_WORDS = 20
MOST_REPEATED = 30         # per cent of words in repeated windows
WINDOW = 8
LEAST_PROBABILITY = 0.3
LEAST_ROWS = 3             # training rows an indicator must be in
EPOCHS = 80
RATE = 0.3
RIDGE = 1e-4
SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass
class Logistic:
    """Row 0: weights by indicator; row 1: 1 for indicators that count towards a text's length."""
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def repeated_words(data: np.ndarray, off: np.ndarray, h: Hashes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words, and words in windows of `window` words found twice or more in the text."""
    n = len(off) - 1
    s, e, row = spans(~SPACES[data], off)
    total = np.bincount(row, minlength=n)
    if len(s) <= window:
        return total, np.zeros(n, np.int64)
    same, wide = distinct(data, s, e, h)[1], 1     # equal numbers for equal runs of `wide` words
    while wide < window:
        step = min(wide, window - wide)
        _, same = np.unique(same[:-step] * len(s) + same[step:], return_inverse=True)
        wide += step
    at = np.flatnonzero(row[:len(row) - window + 1] == row[window - 1:])
    _, back, times = np.unique(row[at] * len(s) + same[at], return_inverse=True, return_counts=True)
    hit = at[times[back] > 1]
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return total, np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)


def base_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Texts x COLUMNS."""
    n = len(off) - 1
    text = np.repeat(np.arange(n), np.diff(off))
    space = SPACES[data]
    h = Hashes(data)
    words, repeats = repeated_words(data, off, h)
    return np.stack((words, np.bincount(text[~space & ((data & 0xC0) != 0x80)], minlength=n),
                     np.bincount(text[SYMBOLS[data]], minlength=n), repeated_lines(data, off, h)[1], repeats), 1).astype(np.int64)


def regress(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights, which indicators are used, bias) of a weighted, ridge-penalised regression, by AdaGrad."""
    used = (np.bincount(np.concatenate(rows), minlength=width) >= LEAST_ROWS).astype(float)
    rows = [r[used[r] > 0] for r in rows]
    idx, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    doc = np.repeat(np.arange(len(rows)), sizes)
    value = 1 / np.sqrt(np.maximum(sizes, 1))
    w, b, gw, gb = np.zeros(width), 0.0, np.full(width, 1e-8), 1e-8
    weight = weight / weight.sum()
    for _ in range(EPOCHS):
        p = sigmoid(np.bincount(doc, w[idx], len(rows)) * value + b)
        g = weight * (p - y)
        grad = np.bincount(idx, (g * value)[doc], width) + RIDGE * w
        gw += grad * grad
        gb += g.sum() ** 2
        w -= RATE * grad / np.sqrt(gw)
        b -= RATE * g.sum() / np.sqrt(gb)
    return w, used, b


@releasing
def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        per_class: tuple[int, int] = PER_CLASS) -> Logistic:
    chosen, stands_for = sample(labels, label, per_class)
    t = sampled_rows(docs, chosen, indicator_rows, "doc_id long, y int, idx array<int>", doc_id, text)
    y = t.column("y").to_numpy()
    rows = [np.asarray(r.values, np.int32) for r in t.column("idx")]
    if len(set(y.tolist())) < 2:
        return Logistic(np.zeros((2, WIDTH)), 0.0, 0.0, 20.0 if not len(y) or y[0] == 1 else -20.0)
    weight = np.where(y == 1, stands_for[1], stands_for[0])
    held = np.arange(len(y)) % 4 == 3            # rows that calibrate
    if min(((y == c) & h).sum() for c in (0, 1) for h in (held, ~held)) == 0:
        held = np.zeros(len(y), bool)
    train = ~held
    even = np.where(y == 1, 1 / (y[train] == 1).sum(), 1 / (y[train] == 0).sum())
    w, used, b = regress([r for r, k in zip(rows, train) if k], y[train], even[train], WIDTH)
    check = held if held.any() else train
    m = np.array([w[r].sum() / np.sqrt(max(used[r].sum(), 1)) for r, k in zip(rows, check) if k]) + b
    return Logistic(np.stack((w, used)), b, *platt(m, y[check], weight[check]))


def judge(model: Logistic) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, text) -> (doc_id, COLUMNS, base_failed, probability, kept)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(1)):
                counts = base_counts(data, off)
                failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
                z, length = several_scores(data, off, model.weights)
                p = sigmoid(model.slope * (z / np.sqrt(np.maximum(length, 1)) + model.bias) + model.shift)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(p),
                     pa.array(~failed & (p >= LEAST_PROBABILITY))],
                    ["doc_id", *COLUMNS, "base_failed", "probability", "kept"])
    return run


def judged(docs: DataFrame, model: Logistic, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The base counts, both verdicts and the probability of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = ", ".join(f"{c} long" for c in COLUMNS)
    return rows.mapInArrow(judge(model), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {counts}, "
                                         "base_failed boolean, probability double, kept boolean")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judged(docs, fit(docs, read(spark, sf_dir, "labels")))
