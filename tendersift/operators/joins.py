"""Lookups with join semantics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift.functions.text import canonical_url, fold
from tendersift.scale import BROADCAST_BYTES, keep_first, lookup, sized_broadcast
from tendersift.session import cut_lineage

BROADCAST_ROWS = 100_000
RUN = 3


def with_ledger(items: DataFrame, ledger: DataFrame, now: Column, spread: str) -> DataFrame:
    """JOI1: first_seen, is_new and last_check from a ledger with one row per canonical url.

    `spread` is a column with many values; it spreads the rows of a url that repeats very often.
    """
    seen = ledger.select("url", F.col("first_seen").alias("_first"), F.lit(True).alias("_known"))
    out = lookup(items.withColumn("url", canonical_url(F.col("url"))), seen, ["url"], spread)
    return out.withColumns({"is_new": F.col("_known").isNull(), "first_seen": F.coalesce("_first", now),
                            "last_check": now}).drop("_first", "_known")


def two_key_lookup(rows: DataFrame, cache: DataFrame, first: str, second: str, columns: Sequence[str],
                   order: str, spread: str) -> DataFrame:
    """JOI2: by the first key, else by the second; the first cached row of a second key wins."""
    by_first = keep_first(cache.filter(F.col(first).isNotNull()), [first], [F.col(order).desc()])
    by_second = keep_first(cache.filter(F.col(second).isNotNull()), [second], [order])
    a = cut_lineage(by_first.select(first, F.struct(*columns).alias("_a")))
    b = cut_lineage(by_second.select(second, F.struct(*columns).alias("_b")))
    out = lookup(lookup(rows, a, [first], spread), b, [second], spread).withColumn("_hit", F.coalesce("_a", "_b"))
    return out.select(*rows.columns, *[F.col("_hit")[c].alias(c) for c in columns])


def not_in(rows: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JOI3."""
    return rows.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def dimension_lookup(rows: DataFrame, dim: DataFrame, key: str, name: str, alias: str, spread: str) -> DataFrame:
    """JOI7: name of a registry entry, null when unknown; `dim` has one row per key."""
    return lookup(rows, dim.select(key, F.col(name).alias(alias)), [key], spread)


def align_answers(batch: DataFrame, answers: DataFrame) -> DataFrame:
    """JOI9: judged item of each batch row by its `id` (the last item of a repeated one), else by its position.

    `batch` has batch_no, pos (from 0) and its own columns; `answers` has batch_no and items, an
    array as read by `answer_items`, and other columns that are kept. Every lookup is inside one row,
    nothing is exploded.
    """
    d = batch.join(answers.drop("raw", "n_items"), "batch_no", "left")
    by_id = F.try_element_at(F.filter("items", lambda i: i["id"].try_cast("int") == F.col("pos")), F.lit(-1))
    return d.withColumn("item", F.coalesce(by_id, F.get("items", F.col("pos").cast("int")))).drop("items")


def detail_work_list(candidates: DataFrame, known: DataFrame, key: str, order: Sequence[str], cap: int) -> DataFrame:
    """JOI11: the candidates without a stored detail, at most `cap` new reads per run."""
    return candidates.join(known.select(key).distinct(), key, "left_anti").orderBy(*order).limit(cap)


def backfill(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """JOI13: new values where there are some, the old ones elsewhere; `key` is unique in `new`."""
    n = new.select(key, *[F.col(c).alias("_n_" + c) for c in columns])
    return (old.join(n, key, "left")
            .withColumns({c: F.coalesce(F.col("_n_" + c), F.col(c)) for c in columns}).drop(*["_n_" + c for c in columns]))


def term_join(texts: DataFrame, rules: DataFrame, key: str, text: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """JOI14: (key, rule_set, term) of every whole-word rule of a rules table that occurs, once per row of `texts`.

    For rule tables too large to be written into an expression. The terms are a trie over words that travels to the tasks and
    is walked from all words of a batch at once; only hits leave a task. A table beyond `max_bytes` is split by the first
    word of its terms, and the texts are read once per part. Null and empty terms never occur.
    """
    wanted = (rules.select("rule_set", F.lower(F.trim("term")).alias("term")).filter("term <> ''").distinct()
              .withColumn("first", F.substring_index("term", " ", 1)))
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0))).first()[0]
    parts = max(1, -(-size // max_bytes))
    words = texts.select(key, F.expr(f"filter(split(lower(`{text}`), '[^\\\\p{{L}}\\\\p{{N}}_]+'), w -> w <> '')").alias("words"))
    schema = T.StructType([T.StructField(key, texts.schema[key].dataType), T.StructField("rule_set", T.StringType()),
                           T.StructField("term", T.StringType())])
    found = []
    for i in range(parts):
        rows = wanted.filter(F.pmod(F.xxhash64("first"), F.lit(parts)) == i).select("rule_set", "term").toArrow()
        trie = texts.sparkSession.sparkContext.broadcast(PhraseTrie(rows.column("rule_set").to_pylist(), rows.column("term").to_pylist()))
        found.append(words.mapInArrow(_phrases(trie), schema))
    return union_sources(found)


class PhraseTrie:
    """Terms as a trie over word numbers in flat arrays: an edge is (state, word) -> state, in order of its key."""

    def __init__(self, sets: list[str], terms: list[str]) -> None:
        self.words = sorted({w for t in terms for w in t.split(" ")})
        number = {w: i for i, w in enumerate(self.words)}
        edges, ends = {}, {}
        for k, t in enumerate(terms):
            at = 0
            for w in t.split(" "):
                at = edges.setdefault(at * len(number) + number[w], len(edges) + 1)
            ends.setdefault(at, []).append(k)
        self.keys = np.array(sorted(edges), np.int64)
        self.to = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.n_ends = np.array([len(ends.get(s, ())) for s in range(len(edges) + 1)], np.int64)
        self.first_end = np.cumsum(self.n_ends) - self.n_ends
        order = [k for s in sorted(ends) for k in ends[s]]
        self.sets, self.terms = [sets[k] for k in order], [terms[k] for k in order]

    def walk(self, word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in `terms`) of every occurrence; `word` is -1 for words of no term."""
        at = np.flatnonzero(word >= 0)
        state, step, rows, hits = np.zeros(len(at), np.int64), 0, [], []
        while len(at) and len(self.keys):
            key = state * len(self.words) + word[at + step]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[place] == key
            at, state = at[alive], self.to[place[alive]]
            n = self.n_ends[state]
            total = np.cumsum(n)
            rows.append(np.repeat(row[at], n))
            hits.append(np.arange(total[-1] if len(total) else 0) - np.repeat(total - n, n) + np.repeat(self.first_end[state], n))
            step += 1
            on = at + step < len(word)
            at, state = at[on], state[on]
            on = (row[at + step] == row[at]) & (word[at + step] >= 0)
            at, state = at[on], state[on]
        return (np.concatenate(rows), np.concatenate(hits)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _phrases(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        words, sets, terms = pa.array(trie.words, pa.string()), pa.array(trie.sets, pa.string()), pa.array(trie.terms, pa.string())
        for b in batches:
            lists = b.column(1)
            word = pc.fill_null(pc.index_in(pc.list_flatten(lists), value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, hits = trie.walk(word, pc.list_parent_indices(lists).to_numpy())
            once = np.unique(rows * max(1, len(terms)) + hits)
            rows, hits = pa.array(once // max(1, len(terms))), pa.array(once % max(1, len(terms)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), sets.take(hits), terms.take(hits)], [b.schema.names[0], "rule_set", "term"])
    return run


def _runs(text: str, k: int) -> Column:
    """The different runs of `k` characters of a text."""
    return F.array_distinct(F.expr(f"transform(filter(sequence(1, greatest(char_length(`{text}`) - {k - 1}, 1)), "
                                   f"i -> i <= char_length(`{text}`) - {k - 1}), i -> substring(`{text}`, i, {k}))"))


def match_by_title_and_entity(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """FLT37: first row, by seq, whose folded title has the query's first word and whose publisher
    contains the query's entity. The words of the titles meet the queries in an equi join.

    Inside a word, wishes meet publishers through an index of the runs of up to three characters of the publishers' names: a wish
    of three characters or fewer is a run itself, a longer one is compared with the publishers that have its rarest run. The index
    holds only runs that occur in a wish. A null title, entity or wish matches nothing, an empty wish every publisher.
    """
    q = queries.select("query_id", F.when(F.col("title").isNotNull(), fold(F.split("title", r"\s+")[0])).alias("word"),
                       F.lower("entity").alias("want"))
    r = rows.select("seq", F.lower("entity").alias("entity"),
                    F.explode(F.array_distinct(F.split(fold(F.col("title")), r"[^\p{L}\p{N}]+"))).alias("word"))
    # the first row per word and publisher, the different wishes per word: no pairs of rows and queries
    first = r.groupBy("word", "entity").agg(F.min("seq").alias("seq"))
    wishes = q.select("word", "want").filter("word is not null and want is not null").distinct()
    short = F.char_length("want") <= RUN
    asked = cut_lineage(wishes.withColumn("run", F.explode(F.when(short, F.array("want")).otherwise(_runs("want", RUN)))))
    every = F.array_distinct(F.concat(F.array(F.lit("")), *[_runs("entity", k) for k in range(1, RUN + 1)]))
    index = cut_lineage(first.withColumn("run", F.explode(every)).join(
        sized_broadcast(asked.select("word", "run").distinct(), BROADCAST_ROWS), ["word", "run"]))
    held = index.groupBy("word", "run").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq"))
    best = cut_lineage(asked.join(held, ["word", "run"], "left").groupBy("word", "want").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run", "seq")).alias("b")).filter("b.n > 0").select("word", "want", "b.*"))
    longer = best.filter(~short).select("word", "want", "run")
    hits = best.filter(short).select("word", "want", "seq").union(
        index.join(sized_broadcast(longer, BROADCAST_ROWS), ["word", "run"]).filter(F.contains("entity", F.col("want")))
        .groupBy("word", "want").agg(F.min("seq").alias("seq")))
    return lookup(q, cut_lineage(hits), ["word", "want"], "query_id").filter("seq IS NOT NULL").select("query_id", "seq")


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """SET1."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def union_passes(passes: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """SET6: insert if absent, passes in order."""
    tagged = [p.withColumn("pass_no", F.lit(i)) for i, p in enumerate(passes)]
    return keep_first(union_sources(tagged), [key], ["pass_no", order])


def merge_reference(scraped: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET2: reference rows join in unless their key or their url is already there."""
    first = keep_first(scraped, list(keys), ["seq"])
    cut = F.substring_index("url", "?", 1)
    urls = first.filter(F.col("url") != "").select(cut.alias("_u")).distinct()
    ref = keep_first(reference, list(keys), ["seq"]).withColumn("_u", cut)
    ref = ref.join(first.select(*keys), list(keys), "left_anti").join(urls, "_u", "left_anti").drop("_u")
    return first.unionByName(ref, allowMissingColumns=True)


def missing_labels(found: DataFrame, label: str, valid: Sequence[str]) -> DataFrame:
    """SET5: valid labels that no found label contains, without regard to case.

    `valid` is the fixed list of a report. Each found label is matched inside its row, so at most
    one row per valid label and task is shuffled.
    """
    names = F.array(*[F.lit(v) for v in valid])
    present = (found.select(F.explode(F.filter(names, lambda v: F.contains(F.lower(label), F.lower(v)))).alias("label")).distinct())
    every = found.sparkSession.createDataFrame([(v,) for v in valid], "label string")
    return every.join(present, "label", "left_anti")
