"""Fields and links from landed pages. Pattern work stays in the JVM; the exact text of a page, which
needs nesting and the full entity table, is taken by the standard library's parser per Arrow batch."""

from __future__ import annotations

import html as html_lib
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift.functions import text as X
from tendersift.operators.filters import generic_document
from tendersift.rules import RuleBook
from tendersift.scale import keep_first

HREF = r'(?is)<a\s[^>]*href\s*=\s*"([^"]*)"[^>]*>'
ANCHOR = r'(?is)<a\s[^>]*href\s*=\s*"[^"]*"[^>]*>(.*?)</a>'
DOCUMENT_EXTENSIONS = ("pdf", "docx", "doc", "zip", "xlsx", "xls")


class _Text(HTMLParser):
    """Visible text: everything but script and style, one blank between pieces."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data: str) -> None:
        if not self.skip and data.strip():
            self.parts.append(data.strip())


def _visible(markup: str | None) -> str:
    p = _Text()
    p.feed(markup or "")
    p.close()
    return " ".join(p.parts)


def page_text(html: Column) -> Column:
    """STR13 and UDF3."""
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(_visible)
    return run(html)


def unescape(c: Column, times: int = 1) -> Column:
    """STR14: all HTML entities; twice for text that was encoded twice."""
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        for _ in range(times):
            s = s.map(html_lib.unescape, na_action="ignore")
        return s
    return run(c)


def tags_out(c: Column) -> Column:
    """Text of a small fragment: tags to blanks, blanks squeezed."""
    return X.squeeze(F.regexp_replace(c, r"(?s)<[^>]*>", " "))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """SRC3 for anchors: (page_id, pos, href, label) in page order."""
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(HREF), 1).alias("href"),
                         F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("label"))
    return (pages.select("page_id", F.posexplode(pairs).alias("pos", "_l"))
            .select("page_id", "pos", "_l.href", tags_out(F.col("_l.label")).alias("label")))


def listing_rows(pages: DataFrame, row: str, fields: dict[str, str], html: str = "html") -> DataFrame:
    """SRC3 for cards, list items and table rows: `row` captures one record's markup, each field's
    pattern captures its value inside; values are unescaped text, missing ones null."""
    d = pages.select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit(row), 1)).alias("pos", "_row"))
    out = {n: F.nullif(tags_out(unescape(F.regexp_extract("_row", p, 1))), F.lit("")) for n, p in fields.items()}
    return d.select("page_id", "pos", *[c.alias(n) for n, c in out.items()])


def label_values(html: str, label: str, value: str) -> Column:
    """SRC4: criteria as a map label -> value, from patterns that capture both in the same order."""
    labels, values = F.regexp_extract_all(html, F.lit(label), 1), F.regexp_extract_all(html, F.lit(value), 1)
    pairs = F.filter(F.arrays_zip(F.transform(labels, lambda x: F.lower(tags_out(x))).alias("k"),
                                  F.transform(values, tags_out).alias("v")),
                     lambda p: p["k"].isNotNull() & (p["k"] != "") & p["v"].isNotNull())
    distinct = F.aggregate(pairs, F.filter(pairs, lambda p: F.lit(False)), lambda acc, p: F.when(
        F.exists(acc, lambda q: q["k"] == p["k"]), acc).otherwise(F.concat(acc, F.array(p))))
    return F.map_from_entries(distinct)


def detail_fields(pages: DataFrame, description: str, applicants: str, closed: Sequence[str], reposted: Sequence[str],
                  label: str, value: str) -> DataFrame:
    """SRC4: text, applicant count, flags by phrase and criteria of landed detail pages."""
    low = F.lower("html")

    def phrase(words: Sequence[str]) -> Column:
        p = F.lit(False)
        for w in words:
            p = p | low.contains(w)
        return p

    return pages.select("page_id", "url", tags_out(F.regexp_extract("html", description, 1)).alias("body"),
                        F.regexp_extract("html", applicants, 1).try_cast("int").alias("applicants"),
                        phrase(closed).alias("closed"), phrase(reposted).alias("reposted"),
                        label_values("html", label, value).alias("criteria"))


def field_by_label(criteria: Column, *fragments: str) -> Column:
    """PRJ12: the first value whose label holds every fragment."""
    def test(e: Column) -> Column:
        p = F.lit(True)
        for f in fragments:
            p = p & e["key"].contains(f)
        return p
    return F.get(F.filter(F.map_entries(criteria), test), F.lit(0))["value"]


def current_section(html: Column, heading: str) -> Column:
    """FLT31: what comes before a heading."""
    return F.substring_index(html, heading, 1)


def document_links(link_table: DataFrame, book: RuleBook, base: Column,
                   extensions: Sequence[str] = DOCUMENT_EXTENSIONS) -> DataFrame:
    """FLT27: absolute links to documents that are not generic, the first of each page's repeats."""
    path = F.substring_index("href", "?", 1)
    absolute = (F.when(F.col("href").rlike("^https?://"), F.col("href"))
                .otherwise(F.concat(F.regexp_extract(base, r"^(https?://[^/?#]+)", 1),
                                    F.when(F.col("href").startswith("/"), "").otherwise("/"), F.col("href"))))
    d = link_table.filter(path.rlike(r"(?i)\.(?:" + "|".join(extensions) + r")$"))
    d = d.withColumns({"link": absolute, "_file": F.substring_index(path, "/", -1)})
    d = d.filter(~generic_document("_file", book))
    return keep_first(d, ["page_id", "link"], ["pos"]).drop("_file")


def last_document_link(html: Column, pattern: str, boilerplate: str) -> Column:
    """FLT30: the last matching link that is not boilerplate."""
    found = F.filter(F.regexp_extract_all(html, F.lit(pattern), 1), lambda x: ~x.contains(boilerplate))
    return F.try_element_at(found, F.lit(-1))
