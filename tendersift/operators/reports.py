"""Counts and orders of a run. Sorting is by range, limits are top-k; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions.dates import literal_map
from tendersift.operators.filters import publishable


def count_by(df: DataFrame, column: str) -> DataFrame:
    """AGG1, AGG2, AGG14: rows per verdict, domain or status."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def verdict_counts(df: DataFrame) -> DataFrame:
    """AGG1: in the fixed order of the verdicts."""
    return count_by(df, "verdict").withColumn("rank", F.coalesce(literal_map(L.VERDICT_ORDER)[F.col("verdict")], F.lit(9))).orderBy("rank")


def tab_counts(df: DataFrame, tab: str, is_new: Column) -> DataFrame:
    """AGG13: rows and new rows per tab."""
    return df.groupBy(F.col(tab).alias("tab")).agg(F.count(F.lit(1)).alias("n"), F.sum(is_new.cast("long")).alias("n_new"))


def with_and_without(df: DataFrame, score: str) -> DataFrame:
    """AGG15: rows with at least one skill and rows with none."""
    s = F.col(score)
    return df.agg(F.sum((s > 0).cast("long")).alias("with_skill"), F.sum((s == 0).cast("long")).alias("without_skill"))


def run_summary(df: DataFrame, by: str) -> DataFrame:
    """AUD9: per country all rows, the publishable ones and the new publishable ones."""
    ok = publishable(F.col("verdict"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(ok.cast("long")).alias("n_publishable"),
                              F.sum((ok & F.col("is_new")).cast("long")).alias("n_new"))


def in_merge_order(df: DataFrame) -> DataFrame:
    """SRT3: reference rows third, unknown age last."""
    rank = F.coalesce(literal_map(L.MERGE_ORDER)[F.col("verdict")], F.lit(9))
    return df.orderBy(rank, F.coalesce(F.col("age"), F.lit(9999)), "seq")


def best_first(df: DataFrame, score: str, *ties: str) -> DataFrame:
    """SRT4."""
    return df.orderBy(F.col(score).desc(), *ties)


def latest(df: DataFrame, day: str, *ties: str, n: int | None = None) -> DataFrame:
    """SRT5 and LIM1: newest first, at most `n` rows when the run has a cap."""
    d = df.orderBy(F.col(day).desc_nulls_last(), *ties)
    return d if n is None else d.limit(n)


def first_matching(df: DataFrame, test: Column, order: Sequence[str], n: int) -> DataFrame:
    """TOP1: the first n rows that pass a test."""
    return df.filter(test).orderBy(*order).limit(n)
