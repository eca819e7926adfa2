"""Bounded training samples of labelled rows, and probabilities from margins."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendersift.llm.texts import remainder
from tendersift.session import cut_lineage

FOLDS = 5


def released() -> None:
    """Give freed memory back to the system. Arrow's pool keeps what tables leave, and glibc what many small arrays leave
    between others that live on; either would stay with the driver for all later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):   # glibc only
        trim(0)


def releasing(fit: Callable) -> Callable:
    """`fit`, which leaves the driver no more than the model: the sample's memory is given back when its last name is gone."""
    @functools.wraps(fit)
    def run(*args: object, **named: object) -> object:
        released()
        try:
            return fit(*args, **named)
        finally:
            released()
    return run


def sample(labels: DataFrame, label: str, per_class: tuple[int, int], doc_id: str = "doc_id") -> tuple[DataFrame, dict[int, float]]:
    """At most `per_class[y]` rows (doc_id, y) of each label y 0 and 1, by the hash of the id, none held out;
    and for each label how many rows one sampled row stands for.

    Rows with a null id or label are left out; an id with several labels counts once, with the smallest.
    """
    known = (labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("doc_id is not null and y in (0, 1)").filter(remainder("doc_id", FOLDS) != 0)
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    known = cut_lineage(known)
    parts = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[y]) for y in (0, 1)]
    chosen = cut_lineage(parts[0].union(parts[1]))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    return chosen, {y: counts[y] / got[y] for y in got}


def sampled_rows(docs: DataFrame, chosen: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema: str, doc_id: str = "doc_id", text: str = "text") -> pa.Table:
    """`work` over (doc_id, y, text) of the sampled documents, on the executors; its rows in the order of their ids.

    `chosen` is bounded by its parameter, so it is broadcast. An id with several documents trains once, on the
    text that sorts first by hash.
    """
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
            .withColumn("_h", F.xxhash64("text")).repartition("doc_id")
            .groupBy("doc_id", "y").agg(F.min(F.struct("_h", "text")).alias("m"))
            .select("doc_id", "y", F.coalesce("m.text", F.lit("")).alias("text")))
    return rows.mapInArrow(work, schema).toArrow().sort_by("doc_id")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the probability sigmoid(slope * margin + shift), by Newton steps on smoothed labels."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack((margin, np.ones_like(margin)), 1)
    theta = np.array([1.0, np.log((pos + 1) / (neg + 1))])

    def loss(th: np.ndarray) -> float:
        z = x @ th
        return float((weight * (np.logaddexp(0, z) - t * z)).sum() + 1e-3 * th @ th)
    now = loss(theta)
    for _ in range(60):
        p = sigmoid(x @ theta)
        grad = x.T @ (weight * (p - t)) + 2e-3 * theta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2)
        step, rate = np.linalg.solve(hess, grad), 1.0
        while rate > 1e-6 and loss(theta - rate * step) > now:
            rate /= 2
        theta = theta - rate * step
        new = loss(theta)
        if now - new < 1e-9:
            break
        now = new
    return float(theta[0]), float(theta[1])
