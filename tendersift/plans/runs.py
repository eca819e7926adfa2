"""Whole runs: read state, decide, merge, publish. Each is a function of stored tables, rules and a
day, so stored raw data can be classified again at any time (INC13)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.functions.text import canonical_url, fold, judge_text
from tendersift.operators import joins as J
from tendersift.operators import similar as S
from tendersift.operators import upkeep as U
from tendersift.operators.filters import publishable
from tendersift.operators.notices import enrich_survivors
from tendersift.operators.reports import run_summary
from tendersift.plans.screen import screen
from tendersift.rules import RuleBook
from tendersift.scale import keep_last, lookup, once
from tendersift.schema import JUDGEMENT, LEDGER
from tendersift.session import cut_lineage

CURATED = "url string, title string, entity string, verdict string, sim_verdict string, sim_score int, last_check timestamp"


def judged(screened: DataFrame, postings: DataFrame, book: RuleBook, cache: DataFrame, judge: Callable[[str], str],
           semantic: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The cascade for what the screen left (INC13): (seq, url, score, sim_verdict, topic, reason) and the rows to store.

    `screened` has seq, url and verdict, `postings` the texts by seq, `semantic` a score by seq where there is one. The stored
    results in `cache` count while the rules' version is the same, so a posting seen before is not asked again.
    """
    live = cut_lineage(screened.filter(F.col("verdict") != L.V_OUT).select("seq", "url"))
    texts = postings.join(live.select("seq"), "seq", "left_semi").select("seq", "title", "mission", "body")
    whole = judge_text(F.col("title"), F.col("mission"), F.col("body"))
    offers = (once(texts.withColumn("content_hash", F.sha2(whole, 256)), "_folded", F.concat(F.lit(" "), fold(whole), F.lit(" ")))
              .withColumn("lexical", S.lexical_score(book, "_folded")).drop("_folded"))
    if semantic is None:
        offers = offers.withColumn("semantic", F.lit(None).cast("int"))
    else:
        offers = lookup(offers, cut_lineage(semantic.select("seq", F.col("semantic").cast("int").alias("semantic"))), ["seq"], "seq")
    out, fresh = S.cascade(offers, cache, judge, book.version)
    return (live.join(out, "seq").select("seq", "url", F.col("score").cast("int").alias("score"), F.col("decision").alias("sim_verdict"), "topic", "reason"),
            fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JUDGEMENT.fields]))


def run_missions(postings: DataFrame, judgements: DataFrame | None, book: RuleBook, today: Column, root: str,
                 dry_run: bool = False, require_state: bool = False, judge: Callable[[str], str] | None = None,
                 semantic: DataFrame | None = None) -> DataFrame:
    """Screen, similarity, ledger, clean-up, append, publish; the summary per source is returned.

    Of a url that postings repeat the last one counts, and rows without a url are judged but not
    published, so running the same postings again changes nothing. Scores of known rows are filled in.
    The table is published before the ledger, and a dry run publishes neither (INC12). `judgements`
    has one row per url with score, sim_verdict, topic and reason; with a `judge` the run makes them itself, see `judged`, and
    stores what it was told at once, so a run that fails later need not ask again.
    """
    spark = postings.sparkSession
    now = today.cast("timestamp")
    ledger = U.read_current(spark, f"{root}/ledger", LEDGER, require_state)
    table = U.read_current(spark, f"{root}/table", spark.createDataFrame([], CURATED).schema, require_state)
    one = screen(postings, book, today, groups=True).withColumn("url", canonical_url(F.col("url")))
    has_url = F.coalesce(F.col("url"), F.lit("")) != ""
    one = keep_last(one.filter(has_url), ["url"], ["seq"]).unionByName(one.filter(~has_url))
    if judge is not None:
        cache = U.read_current(spark, f"{root}/judgements", JUDGEMENT, require_state)
        answers, fresh = judged(one, postings, book, cache, judge, semantic)
        judgements, fresh = cut_lineage(answers.drop("seq")), cut_lineage(fresh)
        if not fresh.isEmpty():
            U.publish(cache.unionByName(fresh), f"{root}/judgements", dry_run=dry_run)
    items = cut_lineage(J.with_ledger(S.apply_similarity(one, judgements), ledger, now, "seq"))
    kept = U.refresh_seen(U.clean_up(table, items, book), items.filter(publishable(F.col("verdict")) & has_url), now)
    scores = items.filter(has_url & F.col("sim_score").isNotNull()).select("url", F.col("sim_score").cast("int").alias("sim_score"))
    kept = J.backfill(kept, scores, "url", ["sim_score"])
    new = U.append_new(kept, items.filter(publishable(F.col("verdict"))))
    columns = table.columns
    U.publish(kept.select(*columns).unionByName(new.select(*columns)), f"{root}/table", dry_run=dry_run)
    U.publish(U.update_ledger(ledger, items, now), f"{root}/ledger", dry_run=dry_run)
    return run_summary(items, "source")


def run_notices(screened: DataFrame, details: DataFrame, columns: Sequence[str], excluded: Column, root: str, batch_id: str,
                scope: DataFrame | None = None) -> DataFrame:
    """A tender run behind its screen: details for the survivors only, a second filter on what they
    added, the batch staged under `root`, and a merge that removes only rows of the sources in scope.

    `screened` has the columns of `schema.NOTICE` and a domain; `details` has one row per id with
    `columns`; `excluded` is tested after the details came in, and an unknown value never excludes.
    Rows without an id are not stored. Returns the number of rows per action; a repeated batch id replaces its
    staged rows, so a failed run is simply run again.
    """
    found = enrich_survivors(cut_lineage(screened), details, "id", columns, "seq")
    kept = found.filter(~F.coalesce(excluded, F.lit(False)))
    batch = kept.select(F.col("id").cast("string").alias("id"), "source", "subject", "domain", *columns)
    schema = T.StructType([*batch.schema.fields, T.StructField("protected", T.BooleanType())])
    spark = screened.sparkSession
    U.stage_batch(batch, root, batch_id)
    return U.apply_batch(spark, root, batch_id, schema, scope)
