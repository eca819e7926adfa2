"""How a source's word use differs from that of the other sources and of its whole language, ranked exactly.

Per (lang, source) group and kept term p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)) in whole numbers. The distance of two
sources of a language is the sum of |p - q| over its kept terms; it is added up in blocks of terms, each block a dense matrix of
terms and sources. A group's most telling terms are those with the greatest p - q, q the language's own p. That difference grows
with the group's count and falls with the language's, so a term that `top` others dominate (group count not lower, language count
not higher, earlier in UTF-8) is never among the `top` first: every partition keeps only its `top`-skyband, the skybands are merged
in `PARTS` parts a group, and what is left is ranked by the exact values.

Cases: null text, lang and source count as ''; a term is a run of letters A-Z and characters beyond ASCII, with only A-Z
lower-cased; a very long text or term is counted whole; repeated rows and ids count every time; ties go to the item earlier in
UTF-8; a language without kept terms has pairs of distance 0 and no terms, a language with one source no pairs; other columns
are ignored; no rows, no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tendersift.llm.texts import read
from tendersift.session import cut_lineage

LEAST_DOCS = 30          # documents of a language that hold a kept term
SMOOTH = 5
UNIT = 10**9
TOP = 50
PARTS = 16               # tasks that merge one group's skybands
HELD_TERMS = 300_000     # different terms a counting task holds before it sends them
LONG_TEXT = 1 << 22      # bytes of text counted at once
BLOCK_ROWS = 200_000     # counts in one block of terms
STRIPE = 256             # sources compared with all others in one group
BLOCK = 256              # terms compared with a skyband at once
_LETTERS = np.zeros(256, np.uint8) + 32
_LETTERS[97:123], _LETTERS[65:91], _LETTERS[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)
LETTERS = _LETTERS.tobytes()   # byte -> itself, lower-cased, or a blank


def term_counts(text: bytes) -> Counter[bytes]:
    """Occurrences of every term, over slices that end at a blank."""
    if len(text) <= LONG_TEXT:
        return Counter(text.translate(LETTERS).split())
    out: Counter[bytes] = Counter()
    start = 0
    while start < len(text):
        stop = start + LONG_TEXT
        part = text[start:stop].translate(LETTERS)
        while not part.endswith(b" ") and stop < len(text):
            rest = text[stop:stop + 4096].translate(LETTERS)
            cut = rest.find(b" ")
            part += rest if cut < 0 else rest[:cut + 1]
            stop += len(rest) if cut < 0 else cut + 1
        out.update(part.split())
        start = stop
    return out


COUNTED = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) -> a task's (lang, source, term, n, docs), and a row with an empty term for every group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def send() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1)),
                pa.array([b"", *terms], pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *map(docs.__getitem__, terms)], pa.int64())], ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            one = term_counts(text.as_py())
            before = len(n)
            n.update(one)
            docs.update(one.keys())
            size += len(n) - before
            if size > HELD_TERMS:
                yield from send()
                size = 0
    yield from send()


def counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, with an empty term for every group."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"))]
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text")
    return (docs.select(*filled, body).mapInArrow(_counted, COUNTED)
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: str | Column, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (n + 5) / (total + 5 * terms)), exact for every count a long holds."""
    def wide(c: str | Column) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")
    a, b = wide(n) + F.lit(SMOOTH), wide(total) + F.lit(SMOOTH) * wide(terms)
    return F.lit(1).cast("long") + F.call_function("div", F.lit(UNIT).cast("decimal(11,0)") * a, b)


def skyband(group: np.ndarray, lang: np.ndarray, terms: list[str], top: int) -> np.ndarray:
    """Positions of the terms that fewer than `top` others dominate."""
    key = [t.encode() for t in terms]
    text = np.empty(len(key), np.int64)
    text[sorted(range(len(key)), key=key.__getitem__)] = np.arange(len(key))
    order = np.lexsort((text, lang, -group))       # whoever dominates a term comes before it
    lang, text = lang[order], text[order]
    kept = np.zeros(0, np.int64)
    for i in range(0, len(order), BLOCK):
        at = np.arange(i, min(i + BLOCK, len(order)))
        over = np.zeros(len(at), np.int64)
        for k in range(0, len(kept), 1 << 14):
            some = kept[k:k + (1 << 14)]
            over += ((lang[some] <= lang[at, None]) & (text[some] < text[at, None])).sum(1)
        over += ((lang[at] <= lang[at, None]) & (text[at] < text[at, None]) & (at < at[:, None])).sum(1)
        kept = np.concatenate((kept, at[over < top]))
    return order[kept]


def _skybands(top: int):
    """Rows (lang, source, term, n, lang_n, value) -> those in their partition's skyband of their group."""
    limit = 4 * top + 4096

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.iloc[skyband(frame["n"].to_numpy(), frame["lang_n"].to_numpy(), frame["term"].tolist(), top)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], tuple[pd.DataFrame, int]] = {}
        for frame in frames:
            for key, new in frame.groupby(["lang", "source"], sort=False):
                old, done = held.get(key, (new.iloc[:0], 0))
                both = pd.concat((old, new))
                if len(both) > 2 * done + limit:   # cut again only once it has doubled
                    both = cut(both)
                    done = len(both)
                held[key] = (both, done)
        for both, _ in held.values():
            yield cut(both)
    return run


def _distances(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of |p - q| over one block of terms, of one stripe of a language's sources with all its sources."""
    lang, _, stripe = (k.as_py() for k in key)
    order = np.argsort(groups.column("rank").to_numpy())
    sources = groups.column("source").take(pa.array(order))
    none = groups.column("none").to_numpy()[order]
    mine = np.arange(stripe * STRIPE, min((stripe + 1) * STRIPE, len(none)))
    total = np.zeros((len(mine), len(none)), np.int64)
    terms = rows.column("term").combine_chunks().dictionary_encode()
    code, at, p = terms.indices.to_numpy(), rows.column("rank").to_numpy() - 1, rows.column("p").to_numpy()
    by_term = np.argsort(code, kind="stable")
    code, at, p = code[by_term], at[by_term], p[by_term]
    step = max(1, (1 << 20) // len(none))
    for first in range(0, len(terms.dictionary), step):
        i, j = np.searchsorted(code, (first, first + step))
        dense = np.tile(none, (min(step, len(terms.dictionary) - first), 1))
        dense[code[i:j] - first, at[i:j]] = p[i:j]
        for k, a in enumerate(mine):
            total[k] += np.abs(dense - dense[:, a:a + 1]).sum(0)
    a, b = np.nonzero(mine[:, None] != np.arange(len(none)))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": sources.take(pa.array(mine[a])), "item": sources.take(pa.array(b)),
                     "value": pa.array(total[a, b], pa.int64())})


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS,
               top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` with every other source, part `term` with the `top` first terms."""
    found = cut_lineage(counts(docs, lang, source, text))
    terms = cut_lineage(found.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                        .filter(F.col("docs") >= least_docs).select("lang", "term", "lang_n"))
    rows = cut_lineage(found.filter("term <> ''").select("lang", "source", "term", "n").join(terms, ["lang", "term"]))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = (found.filter("term = ''").select("lang", "source").join(rows.groupBy("lang", "source").agg(F.sum("n").alias("total")),
                                                                      ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"]))
    groups = cut_lineage(groups.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
                         .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
                         .withColumn("none", F.when(F.col("terms") > 0, share(F.lit(0), "total", "terms")).otherwise(F.lit(0))))
    rows = rows.join(groups.select("lang", "source", "total", "terms", "lang_total", "rank", "sources"), ["lang", "source"])
    rows = cut_lineage(rows.select("lang", "source", "term", "n", "lang_n", "rank", "sources", share("n", "total", "terms").alias("p"),
                                   share("lang_n", "lang_total", "terms").alias("q")))
    return _pairs(rows, groups).unionByName(_terms(rows, top))


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    block, stripes = F.pmod(F.xxhash64("term"), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.ceil(F.col("sources") / STRIPE).cast("int") - 1))
    left = rows.select("lang", block.cast("int").alias("block"), stripes.alias("stripe"), "rank", "term", "p")
    right = (groups.select("lang", "source", "rank", "none", "sources", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
             .select("lang", "block", stripes.alias("stripe"), "source", "rank", "none"))
    by = ("lang", "block", "stripe")
    sums = (left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_distances, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(w).alias("rank"))


def _terms(rows: DataFrame, top: int) -> DataFrame:
    some = rows.filter("p > q").select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value"))
    schema = "lang string, source string, term string, n long, lang_n long, value long"
    near = some.mapInPandas(_skybands(top), schema)
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    merged = (near.withColumn("part", part).repartition("lang", "source", "part").drop("part").mapInPandas(_skybands(top), schema))
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    return (merged.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM kept GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(t, 0) AS t, coalesce(v, 0) AS v, coalesce(lt, 0) AS lt
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS t FROM c GROUP BY ALL) USING (lang, source)
      LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.t + 5 * g.v) AS p,
             1 + (1000000000::HUGEINT * (k.ln + 5)) // (g.lt + 5 * g.v) AS q
      FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""
