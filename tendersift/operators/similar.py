"""The similarity cascade: lexical and semantic scores, the gate, judge requests and answers.

The judge itself is a user's function over the request table. Everything before and after it is
columns and joins; nothing is excluded on an estimate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.functions import text as X
from tendersift.functions.numbers import judge_score, lexical_percent
from tendersift.functions.payload import answer_items
from tendersift.functions.text import canonical_url
from tendersift.functions.vectors import best_cosine, percent
from tendersift.rules import RuleBook
from tendersift.operators.joins import align_answers
from tendersift.scale import keep_first, lookup, number_rows
from tendersift.session import cut_lineage


def lexical_score(book: RuleBook, folded_text: str, rule_set: str = "skill") -> Column:
    """SIM1."""
    return book.score(rule_set, folded_text)


def block_vectors(blocks: DataFrame, column: str = "embedding") -> list[list[float]]:
    """The profile's block vectors. A profile is a text written by hand, so it is read whole, as rules are."""
    return [list(r[0]) for r in blocks.select(column).collect()]


def semantic_score(embedding: Column, blocks: list[list[float]]) -> Column:
    """SIM2: 0..100, null without an embedding or without blocks."""
    return percent(best_cosine(embedding, blocks)) if blocks else F.lit(None).cast("int")


def bad_embeddings(vectors: DataFrame, model: str | None = None, min_dim: int = L.MIN_EMBEDDING_DIM) -> DataFrame:
    """SIM11: rows that must be computed again: too few dimensions, another model or signature."""
    bad = F.coalesce(F.size("embedding") < min_dim, F.lit(True))
    if model is not None:
        bad = bad | F.coalesce(F.col("model") != model, F.lit(True))
    return vectors.filter(bad)


def with_judgements(offers: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """JOI8: `judged` is the stored result under the current rules, `in_cache` any stored result.

    offers carry seq and content_hash, copies of one text share a hash; cache has one row per
    (content_hash, rule_version).
    """
    current = F.when(F.col("rule_version") == version, F.struct("score", "verdict", "topic", "reason"))
    known = cut_lineage(cache.groupBy("content_hash").agg(F.max(current).alias("judged"), F.lit(True).alias("_known")))
    out = lookup(offers, known, ["content_hash"], "seq")
    return out.withColumn("in_cache", F.col("_known").isNotNull()).drop("_known")


def gate(offers: DataFrame, threshold: int = L.SEMANTIC_GATE, any_version: bool = True) -> DataFrame:
    """SIM3: `cut` marks offers far from the profile that were not judged before."""
    known = F.col("in_cache") if any_version else F.col("judged").isNotNull()
    low = F.coalesce(F.col("semantic") < threshold, F.lit(False))
    return offers.withColumn("cut", low & ~known)


def cut_results(gated: DataFrame) -> DataFrame:
    """SIM3: the result of the offers the gate cut: out, with the semantic score and the reason."""
    why = F.concat(F.lit(L.CUT_REASON[0]), F.col("semantic"), F.lit(L.CUT_REASON[1]), F.lit(L.SEMANTIC_GATE), F.lit(L.CUT_REASON[2]))
    return gated.filter("cut").select("seq", "content_hash", F.col("semantic").cast("int").alias("score"),
                                      F.lit(L.JUDGED_OUT).alias("verdict"), F.lit("-").alias("topic"), why.alias("reason"))


def cascade(offers: DataFrame, cache: DataFrame, judge: Callable[[str], str], version: str, chars: int | None = None,
            size: int = L.JUDGE_BATCH, judge_name: str = L.JUDGE_NAME) -> tuple[DataFrame, DataFrame]:
    """The whole cascade for offers (seq, content_hash, title, mission, body, semantic, lexical).

    Gate, stored judgements, requests to the judge for the rest, answers, fall-back estimates and
    the decision. Returns (seq, score, verdict, topic, reason, estimated, decision) for every offer, and the
    rows to store. Copies of one text are asked once. The judge is called once per request: its
    answers are written before anything reads them.
    """
    gated = cut_lineage(gate(with_judgements(offers, cache, version)))
    asked = keep_first(pending(gated), ["content_hash"], ["seq"])
    rows = cut_lineage(batches(judge_input(asked, chars).join(asked.select("seq", "content_hash"), "seq"), size=size))
    answers = cut_lineage(read_answers(ask(requests(rows), judge)))
    fresh = cut_lineage(settle(align_answers(rows, answers), judge_name).select("seq", "content_hash", "score", "verdict", "topic", "reason"))
    names = ["score", "verdict", "topic", "reason"]
    judged = keep_first(fresh, ["content_hash"], ["seq"]).select("content_hash", F.struct(*names).alias("_fresh"))
    out = lookup(gated, cut_lineage(judged), ["content_hash"], "seq")
    cut = cut_results(gated).select("seq", F.struct(*names).alias("_cut"))
    out = out.join(cut, "seq", "left").withColumn("_r", F.coalesce("_cut", "judged", "_fresh"))
    out = out.select("seq", "semantic", "lexical", *[F.col("_r")[n].alias(n) for n in names])
    done = with_fallback(out, judge_name)
    return (done.withColumn("decision", similarity_verdict(F.col("score"), F.col("estimated"))).drop("semantic", "lexical"),
            storable(fresh, version))


def pending(offers: DataFrame) -> DataFrame:
    """SIM4."""
    return offers.filter(~F.col("cut") & F.col("judged").isNull())


def judge_input(df: DataFrame, chars: int | None = None) -> DataFrame:
    """STR21 per row, before anything is shuffled: title and the text as the judge takes it, whole unless it can take only `chars`."""
    full = X.judge_text(F.col("title"), F.col("mission"), F.col("body"))
    cut = full if chars is None else F.when(F.length(full) > chars, F.concat(F.substring(full, 1, chars), F.lit(" […]"))).otherwise(full)
    return df.select("seq", X.strip(F.coalesce("title", F.lit(""))).alias("title"), cut.alias("text"))


def batches(df: DataFrame, seq: str = "seq", size: int = L.JUDGE_BATCH) -> DataFrame:
    """WIN4: batch_no and pos, `size` rows per batch in order of `seq`."""
    d = number_rows(df, seq, "_n", width=100_000)
    return d.withColumns({"batch_no": F.floor((F.col("_n") - 1) / size).cast("long"),
                          "pos": ((F.col("_n") - 1) % size).cast("int")}).drop("_n")


def requests(batched: DataFrame) -> DataFrame:
    """SIM5: one row per batch with its numbered items."""
    item = F.concat(F.lit("### OFFRE "), F.col("pos"), F.lit("\nTitre : "), F.col("title"),
                    F.lit("\nAnnonce :\n"), F.col("text"))
    rows = batched.select("batch_no", F.struct("pos", item.alias("item")).alias("_i"))
    return rows.groupBy("batch_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_i")), lambda x: x["item"]), "\n\n").alias("request"),
        F.count(F.lit(1)).alias("n_items"))


ANSWER = T.StructType([T.StructField("batch_no", T.LongType()), T.StructField("raw", T.StringType()),
                       T.StructField("error", T.StringType())])


def ask(request_table: DataFrame, judge: Callable[[str], str]) -> DataFrame:
    """UDF4: the user's judge per request; a failure becomes an error row."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for no, request in zip(f["batch_no"], f["request"]):
                try:
                    rows.append((no, judge(request), None))
                except Exception as e:  # noqa: BLE001 - kept as a row
                    rows.append((no, None, str(e)))
            yield pd.DataFrame(rows, columns=["batch_no", "raw", "error"])
    return request_table.select("batch_no", "request").mapInPandas(run, ANSWER)


def read_answers(answers: DataFrame) -> DataFrame:
    """JSN8: items per batch, null when the answer is not usable."""
    return answers.withColumn("items", answer_items(F.col("raw")))


def settle(aligned: DataFrame, judge_name: str = L.JUDGE_NAME) -> DataFrame:
    """SIM6 and SIM7: score, verdict, topic and reason of every batch row after `align_answers`."""
    c = F.col
    verdict = F.upper(F.trim(F.coalesce(c("item.verdict"), F.lit(""))))
    known = F.when(verdict.isin(L.JUDGED_OK, L.JUDGED_LIMIT, L.JUDGED_OUT), verdict).otherwise(F.lit(L.JUDGED_LIMIT))
    has = c("item").isNotNull()
    why = F.coalesce(c("error"), F.lit("réponse partielle"))
    failed = F.when(c("error").isNotNull(), F.lit(L.JUDGE_UNAVAILABLE)).otherwise(F.lit(L.JUDGE_ERROR))
    prefix = F.when(c("error").isNotNull(), F.lit(f"{judge_name} indisponible: ")).otherwise(F.lit(f"{judge_name}: "))
    return aligned.withColumns({
        "score": F.when(has, judge_score(c("item.score_global"))),
        "verdict": F.when(has, known).otherwise(failed),
        "topic": F.when(has, F.coalesce(F.nullif(F.trim(c("item.pole_principal")), F.lit("")), F.lit("-"))).otherwise(F.lit("-")),
        "reason": F.when(has, F.trim(F.coalesce(c("item.raison"), F.lit(""))))
        .otherwise(F.substring(F.concat(prefix, why), 1, L.REASON_CHARS))}).drop("item")


def storable(judged: DataFrame, version: str) -> DataFrame:
    """SIM8: only settled verdicts, stamped with the rule version."""
    return (judged.filter(~F.col("verdict").startswith(L.JUDGE_PENDING_PREFIX))
            .select("content_hash", F.lit(version).alias("rule_version"), "score", "verdict", "topic", "reason"))


def with_fallback(df: DataFrame, judge_name: str = L.JUDGE_NAME) -> DataFrame:
    """SIM9: without a judged score the semantic one, else the lexical one, marked as estimated."""
    c = F.col
    need = c("score").isNull() & F.coalesce(c("verdict").startswith(L.JUDGE_PENDING_PREFIX), F.lit(True))
    estimate = F.coalesce(c("semantic"), lexical_percent(c("lexical")))
    source = F.when(c("semantic").isNotNull(), F.lit("embeddings")).otherwise(F.lit("lexical"))
    text = F.concat(F.lit(f"Score ESTIMÉ sans {judge_name} ("), source, F.lit(") : "), estimate,
                    F.lit(f"/100 — à confirmer quand {judge_name} sera disponible."))
    return (df.withColumn("estimated", need)
            .withColumns({"reason": F.when(c("estimated"), text).otherwise(c("reason")),
                          "score": F.when(c("estimated"), estimate).otherwise(c("score"))}))


def similarity_verdict(score: Column, estimated: Column) -> Column:
    """CLS16."""
    return (F.when(F.coalesce(estimated, F.lit(False)), L.S_ESTIMATED).when(score.isNull(), L.S_NONE)
            .when(score >= L.SIM_HIGH, L.S_PASS).when(score >= L.SIM_LOW, L.S_VERIFY).otherwise(L.S_OUT))


def apply_similarity(postings: DataFrame, judgements: DataFrame, key: str = "url") -> DataFrame:
    """SIM10: judgements onto the postings that are not rejected; what is missing is to be verified.

    Both sides meet by the canonical url; of a url judged twice the judgement that sorts first counts.
    """
    j = keep_first(judgements.withColumn("_u", canonical_url(F.col(key))).filter("_u IS NOT NULL"), ["_u"],
                   ["score", "sim_verdict", "topic", "reason"])
    j = j.select("_u", F.col("score").alias("sim_score"), F.col("sim_verdict").alias("_v"),
                          F.col("topic").alias("sim_topic"), F.col("reason").alias("sim_reason"))
    live = F.col("verdict") != L.V_OUT
    return (lookup(postings.withColumn("_u", canonical_url(F.col(key))), cut_lineage(j), ["_u"], "seq")
            .withColumn("sim_verdict", F.when(live, F.coalesce("_v", F.lit(L.S_NONE)))).drop("_v", "_u"))


def purge(cache: DataFrame, version: str | None = None) -> DataFrame:
    """SIM12: without a version everything goes, else that version."""
    return cache.filter(F.lit(False)) if version is None else cache.filter(F.col("rule_version") != version)
