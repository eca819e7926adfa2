"""Registered queries over the test tables and the SQL that states the same result."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.functions.text import TITLE_FILLERS
from tendersift.scale import once, spread  # noqa: F401
from tendersift.plans.sample_rules import (FOLDED_SETS, REGEX_SETS, SUBSTRING_SETS, WORD_SETS, sample_book)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TODAY = "2001-08-02"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL when there is one."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


@functools.cache
def book():
    return sample_book()


def today() -> Column:
    return F.lit(TODAY).cast("date")


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def first_line(c: str = "text") -> Column:
    return F.substring_index(c, "\n", 1)


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read(spark, sf, "documents"), "doc_id").withColumn("title", first_line())


def padded(c: str = "text") -> Column:
    return F.concat(F.lit(" "), F.lower(c), F.lit(" "))


# --- pieces of SQL ---------------------------------------------------------------------------------

def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def s_list(terms: list[str]) -> str:
    return "[" + ", ".join(q(t) for t in terms) + "]"


def s_terms(col: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(t)})" for t in terms) + ")"


def s_any(col: str, rule_set: str) -> str:
    """SQL form of a rule set over a padded lower-case column."""
    if rule_set in SUBSTRING_SETS or rule_set in FOLDED_SETS:
        return s_terms(col, SUBSTRING_SETS.get(rule_set) or FOLDED_SETS[rule_set])
    if rule_set in WORD_SETS:
        return s_word(col, WORD_SETS[rule_set])
    return "(" + " OR ".join(f"regexp_matches({col}, {q(s_bounds(r))}, 'i')" for r in REGEX_SETS[rule_set]) + ")"


def s_bounds(pattern: str) -> str:
    """Word bounds spelled out; the SQL engine's own `\\b` knows ASCII letters only."""
    head, tail = pattern.startswith(r"\b"), pattern.endswith(r"\b")
    core = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return (f"(?:^|[^{W}])" if head else "") + core + (f"(?:$|[^{W}])" if tail else "")


def s_word(col: str, words: list[str]) -> str:
    return f"regexp_matches({col}, {q('(^|[^' + W + '])(' + '|'.join(words) + ')s?($|[^' + W + '])')})"


W = r"\p{L}\p{N}_"
S_TITLE = "split_part(text, chr(10), 1)"
S_PAD = "concat(' ', lower(text), ' ')"
S_PAD_TITLE = f"concat(' ', lower({S_TITLE}), ' ')"


def s_fold(col: str) -> str:
    return f"lower(strip_accents({col}))"


def s_title_key(col: str) -> str:
    """Title key by whole tokens: a token is a run of letters, digits and underscores."""
    t = f"regexp_replace({s_fold(col)}, '\\(.*?\\)', ' ', 'g')"
    t = f"regexp_replace({t}, '(^|[^{W}])h\\s*/?\\s*f($|[^{W}])', '\\1 \\2', 'g')"
    t = f"string_split(regexp_replace({t}, '[^{W}]+', ' ', 'g'), ' ')"
    t = f"array_to_string(list_filter({t}, lambda w: NOT list_contains({s_list(list(TITLE_FILLERS))}, w)), ' ')"
    return f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"
