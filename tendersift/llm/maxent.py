"""Language-model scores of a hashed maximum-entropy model with class-factored softmax.

A token's probability is P(class | context) * P(token | class). Classes are clusters of the frequent
words by the words around them, one class for the end of a text, and one for all other words. The class
softmax adds up hashed weight rows of n-gram and skip features (the word before, the two classes before,
the words two and three back) and a bias row; it is trained by distributed gradient updates: in every
round each task starts from the broadcast weights, steps through its texts by AdaGrad, and the
tasks' rows are averaged by how often each touched them, in blocks, through a shuffle. Inside a class of frequent
words the probability is by count. Inside the class of other words it is by Good-Turing over
counts of counts, so that unseen words share the mass that words seen once had; all unseen words are one token.

Counts cover every training text; words are 63-bit hashes, cryptographic ones beyond `LONG_WORD` bytes. The `FREQUENT` most frequent words travel with the model,
a fixed size. The counts of all others meet the texts in a join: scoring hands on each text's other words, the
join sums their logarithms, and no table of the vocabulary is ever sent to a task or the driver.

Cases: a null text is an empty one, whose only token is its end; a null `doc_id` falls by the checksum of the
empty string; repeated ids and rows are scored one by one; other columns are ignored; if nothing is in
training, every token has probability 1/(V+1) with V = 0; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.hashing import LOWER, SPACES, Hashes, mixed, spans
from tendersift.llm.texts import read, remainder, text_slices
from tendersift.session import cut_lineage

FOLDS, HELD = 7, 2
FREQUENT = 1 << 17      # words with a class of their own kind
ANCHORS = 16            # most frequent words, whose neighbourhood tells classes apart
CLASSES = 32
END_CLASS, OTHER_CLASS = 0, 1
ROWS = 1 << 15          # weight rows
ROUNDS = 2
RATE = 0.15
STEP_TOKENS = 8192
BLOCK = 128             # weight rows that travel together
RARE_UPTO = 40          # counts of counts kept apart
END, START = 0x1234567, 0x7654321   # stand for the end and the outside of a text among word hashes
LONG_WORD = 64          # bytes from which words go by a cryptographic hash
PENDING = 1 << 22       # words a counting task holds before it adds them up


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, offsets of texts); each text's words and then its end."""
    s, e, row = spans(~SPACES[data], off)
    n = len(off) - 1
    low = LOWER[data]
    h = Hashes(low)(s, e)
    for i in np.flatnonzero(e - s > LONG_WORD).tolist():   # long words of a pattern can share a polynomial hash
        h[i] = int.from_bytes(blake2b(low[s[i]:e[i]].tobytes(), digest_size=8).digest(), "little")
    h >>= np.uint64(1)     # a non-negative long
    cut = np.searchsorted(row, np.arange(1, n + 1))
    return np.insert(h, cut, np.uint64(END)).astype(np.int64), np.concatenate(([0], cut + np.arange(1, n + 1)))


def before(x: np.ndarray, off: np.ndarray, k: int, outside: int) -> np.ndarray:
    """The value `k` tokens back in the same text."""
    out = np.full(len(x), outside, x.dtype)
    out[k:] = x[:-k] if k < len(x) else x[:0]
    first = np.repeat(off[:-1], np.diff(off))
    out[np.arange(len(x)) - k < first] = outside
    return out


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (h, n), in parts of bounded size."""
    pending, size = [], 0

    def added() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(pending), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])
    for b in batches:
        for _, _, data, off in text_slices(b.column(0)):
            pending.append(tokens(data, off)[0])
            size += len(pending[-1])
            if size > PENDING:
                yield added()
                pending, size = [], 0
    if size:
        yield added()


@dataclass
class Words:
    """The frequent words, by hash, with their places among the frequent, counts and classes."""
    hashes: np.ndarray
    place: np.ndarray      # of the sorted hashes in order of frequency
    counts: np.ndarray     # by place
    classes: np.ndarray    # by place

    def places(self, h: np.ndarray) -> np.ndarray:
        """Place of each word among the frequent, -1 for others."""
        if not len(self.hashes):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.place[at], -1)


def neighbours(words: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text) -> (cell, n): how often a frequent word stands within two tokens after an anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = words.value
        table = np.zeros((len(w.counts), ANCHORS), np.int64)
        for b in batches:
            for _, _, data, off in text_slices(b.column(0)):
                h, ends = tokens(data, off)
                p = w.places(h)
                for k in (1, 2):
                    q = before(p, ends, k, -1)
                    ok = (p >= 0) & (q >= 0) & (q < ANCHORS)
                    table += np.bincount(p[ok] * ANCHORS + q[ok], minlength=table.size).reshape(table.shape)
        cell = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(table.ravel()[cell])], ["cell", "n"])
    return run


def clusters(table: np.ndarray, counts: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    """Groups 0..k-1 of rows by spherical k-means on the square roots of their smoothed shares, weighted by count."""
    if len(table) <= k:
        return np.arange(len(table))
    share = table.sum(0) / max(table.sum(), 1)
    x = np.sqrt((table + 2 * share) / (table.sum(1, keepdims=True) + 2) / np.maximum(share, 1e-12))
    x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)
    rng = np.random.default_rng(seed)
    top = min(len(x), 8192)
    centres = [x[0]]
    for _ in range(k - 1):      # far from the centres there are, frequent words first
        far = 1 - np.max(x[:top] @ np.array(centres).T, 1)
        weight = np.maximum(far, 0) ** 2 * np.sqrt(counts[:top]) + 1e-12
        centres.append(x[rng.choice(top, p=weight / weight.sum())])
    c = np.array(centres)
    for _ in range(15):
        group = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, group, x * np.sqrt(counts)[:, None])
        length = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(length > 0, total / np.maximum(length, 1e-12), c)
    return (x @ c.T).argmax(1)


def features(h: np.ndarray, cls: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Tokens x 4 weight rows: word before, two classes before, words two and three back; row 0 is the bias."""
    one, two, three = (before(h, off, k, START) for k in (1, 2, 3))
    pair = before(cls, off, 1, CLASSES) * (CLASSES + 1) + before(cls, off, 2, CLASSES)
    keys = [one * 4, pair.astype(np.int64) * 4 + 1, two * 4 + 2, three * 4 + 3]
    return np.stack([(mixed(k.astype(np.uint64)) % np.uint64(ROWS - 1)).astype(np.int64) + 1 for k in keys], 1)


def class_log_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = weights[rows[:, 0]] + weights[0]
    for j in range(1, rows.shape[1]):
        z += weights[rows[:, j]]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def gradient_step(weights: np.ndarray, squares: np.ndarray, touched: np.ndarray, rows: np.ndarray, y: np.ndarray) -> None:
    """One AdaGrad step on a batch of tokens, in place."""
    g = np.exp(class_log_probabilities(weights, rows))
    g[np.arange(len(y)), y] -= 1
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    idx = flat[order]
    first = np.flatnonzero(np.diff(idx, prepend=-1))
    grad = np.add.reduceat(g[order // rows.shape[1]], first, 0)
    for at, step, n in ((idx[first], grad, np.diff(np.append(first, len(idx)))), (np.array([0]), g.sum(0, keepdims=True), [len(y)])):
        squares[at] += step * step
        weights[at] -= RATE * step / np.sqrt(squares[at])
        touched[at] += n


def trained(words: object, weights: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text) -> (block, n, w): the task's rows after its texts, times how often it touched them, by blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = words.value, weights.value.copy()
        squares, touched = np.full(w.shape, 1e-6, np.float32), np.zeros(len(w), np.int64)
        for b in batches:
            for _, _, data, off in text_slices(b.column(0)):
                h, ends = tokens(data, off)
                p = v.places(h)
                cls = np.where(p >= 0, v.classes[p] if len(v.classes) else 0, OTHER_CLASS).astype(np.int64)
                rows = features(h, cls, ends)
                for i in range(0, len(h), STEP_TOKENS):
                    gradient_step(w, squares, touched, rows[i:i + STEP_TOKENS], cls[i:i + STEP_TOKENS])
        blocks = np.flatnonzero(np.add.reduceat(touched, np.arange(0, ROWS, BLOCK)))
        part = [(touched[k * BLOCK:(k + 1) * BLOCK], w[k * BLOCK:(k + 1) * BLOCK]) for k in blocks]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks.astype(np.int32)), pa.array([n.tobytes() for n, _ in part], pa.binary()),
             pa.array([(x * n[:, None]).astype(np.float32).tobytes() for n, x in part], pa.binary())], ["block", "n", "w"])
    return run


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of (block, n, w) by block; holds one sum per block of the partition."""
    total: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for k, n, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            n, w = np.frombuffer(n.as_buffer(), np.int64), np.frombuffer(w.as_buffer(), np.float32).astype(np.float64)
            if k in total:
                total[k][0] += n
                total[k][1] += w
            else:
                total[k] = [n.copy(), w]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([n.tobytes() for n, _ in total.values()], pa.binary()),
         pa.array([w.tobytes() for _, w in total.values()], pa.binary())], ["block", "n", "w"])


@dataclass
class Model:
    words: Words
    weights: np.ndarray
    inside: np.ndarray        # log10 probability of each frequent word inside its class, by place
    total: int                # training tokens
    vocabulary: int           # distinct training tokens
    other: np.ndarray         # log10 probability inside the class of other words, by count up to RARE_UPTO
    other_rate: float         # beyond it: log10(count) plus this


def good_turing(n: np.ndarray, beyond_types: int, beyond_tokens: int) -> tuple[np.ndarray, float]:
    """(log10 probability by count 0..RARE_UPTO, log10 rate beyond): n[r] types were seen r times.

    A word seen r times gets the tokens of words seen r + 1 times, shared by the types seen r times; where counts of
    counts are thin the plain count; all of it normalised. All unseen words are one type.
    """
    types = n.astype(float).copy()
    types[0] = 1
    r = np.arange(len(n), dtype=float)
    rate = np.where(r > 0, r, 0.0)
    for k in range(min(6, len(n) - 1)):
        if n[k + 1] >= 20 and types[k] > 0:
            rate[k] = (k + 1) * n[k + 1] / types[k]
    rate[0] = rate[0] if n[1] >= 20 else max(1.0, n[1])
    whole = (rate * types).sum() + beyond_tokens
    return np.log10(np.maximum(rate, 1e-300) / whole), -float(np.log10(whole))


class Trainer:
    """Counts and model of a table of texts; `counts` (h, c) stays a table."""

    def __init__(self, docs: DataFrame, text: str = "text"):
        spark = docs.sparkSession
        rows = docs.select(F.col(text).cast("string").alias("text"))
        self.counts = cut_lineage(rows.mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("c")))
        sums = self.counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        top = self.counts.orderBy(F.col("c").desc(), "h").limit(FREQUENT).toArrow()     # bounded by FREQUENT
        h, c = top.column("h").to_numpy(), top.column("c").to_numpy()
        order = np.lexsort((h, -c))
        h, c = h[order], c[order]
        by_hash = np.argsort(h)
        words = Words(h[by_hash], by_hash, c, np.zeros(len(h), np.int64))
        first = spark.sparkContext.broadcast(words)
        cells = rows.mapInArrow(neighbours(first), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # FREQUENT x ANCHORS
        table = np.zeros(len(h) * ANCHORS)
        table[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
        words.classes = clusters(table.reshape(-1, ANCHORS), c, CLASSES - 2) + 2
        words.classes[h == END] = END_CLASS
        by_count = {r["r"]: (r["types"], r["tokens"]) for r in self.counts.groupBy(F.least("c", F.lit(RARE_UPTO + 1)).alias("r")).agg(
            F.count(F.lit(1)).alias("types"), F.sum("c").alias("tokens")).collect()}
        n, seen = np.zeros(RARE_UPTO + 1, np.int64), np.bincount(np.minimum(c, RARE_UPTO + 1), minlength=RARE_UPTO + 2)
        for r, (types, _) in by_count.items():
            if r <= RARE_UPTO:
                n[r] = types - seen[r]
        beyond = by_count.get(RARE_UPTO + 1, (0, 0))
        beyond = (beyond[0] - int(seen[RARE_UPTO + 1]), beyond[1] - int(c[c > RARE_UPTO].sum()))
        other, other_rate = good_turing(n, *beyond)
        inside = np.bincount(words.classes, c, CLASSES)
        mass = inside.copy()
        mass[OTHER_CLASS] = sums["n"] - c.sum()
        weights = np.zeros((ROWS, CLASSES), np.float32)
        weights[0] = np.log((mass + 0.5) / (sums["n"] + 0.5 * CLASSES))
        shared = spark.sparkContext.broadcast(words)
        for k in range(ROUNDS if sums["n"] else 0):
            own = rows.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == k)
            parts = (own.mapInArrow(trained(shared, spark.sparkContext.broadcast(weights)), "block int, n binary, w binary")
                     .repartition("block").mapInArrow(summed, "block int, n binary, w binary").toArrow())   # the size of the model
            weights = weights.copy()
            for b, n_, w in zip(*(parts.column(i) for i in range(3))):
                at = np.arange(b.as_py() * BLOCK, (b.as_py() + 1) * BLOCK)
                times = np.frombuffer(n_.as_py(), np.int64)
                got = np.frombuffer(w.as_py(), np.float64).reshape(BLOCK, CLASSES)
                weights[at[times > 0]] = (got[times > 0] / times[times > 0][:, None]).astype(np.float32)
        self.model = Model(words, weights, np.log10(c / np.maximum(inside[words.classes], 1)) if len(c) else np.zeros(0),
                           int(sums["n"]), int(sums["v"]), other, other_rate)


PARTIAL = ("row long, held_out boolean, n_tokens long, n_known long, counts double, score double, other array<long>, times array<int>")


def partial_scores(model: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, held_out, text) -> what frequent words and class probabilities give, and each text's other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        row = TaskContext.get().partitionId() << 36
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(2)):
                h, ends = tokens(data, off)
                n = hi - lo
                text = np.repeat(np.arange(n), np.diff(ends))
                p = m.words.places(h)
                known = p >= 0
                cls = np.where(known, m.words.classes[p] if len(p) and len(m.words.classes) else 0, OTHER_CLASS).astype(np.int64)
                rows = features(h, cls, ends)
                logp = np.empty(len(h))
                for i in range(0, len(h), STEP_TOKENS):
                    part = class_log_probabilities(m.weights, rows[i:i + STEP_TOKENS])
                    logp[i:i + STEP_TOKENS] = part[np.arange(len(part)), cls[i:i + STEP_TOKENS]]
                logp /= np.log(10)
                logp[known] += m.inside[p[known]]
                counts = np.zeros(len(h))
                counts[known] = np.log10(m.words.counts[p[known]] + 1.0)
                rest = np.flatnonzero(~known)
                order = np.lexsort((h[rest], text[rest]))
                rt, rh = text[rest][order], h[rest][order]
                new = np.flatnonzero((np.diff(rt, prepend=-1) != 0) | (np.diff(rh, prepend=-1) != 0))
                times = np.diff(np.append(new, len(rh))).astype(np.int32)
                at = pa.array(np.searchsorted(rt[new], np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(row + np.arange(n)), b.column(1)[lo:hi], pa.array(np.diff(ends)),
                     pa.array(np.bincount(text[known], minlength=n)), pa.array(np.bincount(text, counts, n)), pa.array(np.bincount(text, logp, n)),
                     pa.ListArray.from_arrays(at, pa.array(rh[new])), pa.ListArray.from_arrays(at, pa.array(times))],
                    ["doc_id", "row", "held_out", "n_tokens", "n_known", "counts", "score", "other", "times"])
                row += n
    return run


def scored(docs: DataFrame, trainer: Trainer, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    m = trainer.model
    rows = docs.select(F.col(doc_id).alias("doc_id"), (remainder(doc_id, FOLDS) == HELD).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(m)
    part = cut_lineage(rows.mapInArrow(partial_scores(shared), f"doc_id {kind}, {PARTIAL}"))
    other = part.select("row", F.explode(F.arrays_zip("other", "times")).alias("o")).select("row", F.col("o.other").alias("h"), F.col("o.times").alias("k"))
    c = F.coalesce("c", F.lit(0))
    inside = F.when(c <= RARE_UPTO, F.element_at(F.array(*[F.lit(float(x)) for x in m.other]), F.least(c, F.lit(RARE_UPTO)).cast("int") + 1)) \
        .otherwise(F.log10(c.cast("double")) + m.other_rate)
    met = (other.join(trainer.counts, "h", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known"), F.sum(F.col("k") * F.log10(c + F.lit(1.0))).alias("log_counts"),
        F.sum(F.col("k") * inside).alias("inside")))
    zero = F.lit(0)
    return part.drop("other", "times").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", zero)).cast("long").alias("n_known"),
        F.lit(m.total).cast("long").alias("train_tokens"),
        (F.col("counts") + F.coalesce("log_counts", zero) - F.col("n_tokens") * F.lit(float(np.log10(m.total + m.vocabulary + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce("inside", zero)).alias("score"))


def op6_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, Trainer(docs.filter(remainder("doc_id", FOLDS) != HELD)))
