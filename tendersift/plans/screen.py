"""The posting screen: classify, drop duplicates, cross-record signals, verdict, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions.dates import literal_map
from tendersift.operators.classify import classify_postings, verdict_of
from tendersift.operators.cross import (apply_never_qualifying, apply_recurrence, apply_same_item,
                                        drop_duplicates_first, never_qualifying, recurring_groups)
from tendersift.rules import RuleBook
from tendersift.session import cut_lineage


def with_verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("_v", verdict_of()).select(*df.columns, "_v.verdict", "_v.reason")


def screen(postings: DataFrame, book: RuleBook, today: Column, groups: bool = False) -> DataFrame:
    """All postings with their verdict, from the fields of `schema.POSTING`.

    The texts are read once: classification is row by row, and its narrow result is written before
    the cross-record steps use it several times. The net for publishers changes the kind before groups and verdicts are decided; recurrence may
    turn aged into backlog. `groups=True` adds the multi-publisher groups.
    """
    kept = cut_lineage(drop_duplicates_first(classify_postings(postings, book, today)))
    d = apply_recurrence(apply_never_qualifying(kept, never_qualifying(kept)), recurring_groups(kept))
    if groups:
        d = apply_same_item(d)
    return with_verdict(d)


def in_verdict_order(df: DataFrame) -> DataFrame:
    """SRT1: verdict rank, then age with unknown last, then arrival."""
    rank = F.coalesce(literal_map(L.VERDICT_ORDER)[F.col("verdict")], F.lit(9))
    return df.orderBy(rank, F.coalesce(F.col("age"), F.lit(9999)), "seq")
