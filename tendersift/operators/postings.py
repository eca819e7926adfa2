"""Postings from search cards and detail pages, display columns, and the chain of one notice source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift.functions import text as X
from tendersift.operators.filters import same_place
from tendersift.operators.notices import conform
from tendersift.rules import RuleBook
from tendersift.scale import keep_first, lookup
from tendersift.schema import POSTING


def postings_from_cards(cards: DataFrame, details: DataFrame, source: str) -> DataFrame:
    """PRJ1: search cards joined to their detail; only an ISO date counts as published, and a missing
    publisher is read from the url. `details` has one row per url."""
    c = F.col
    extra = [f for f in details.columns if f != "url"]
    d = lookup(cards, details.select("url", F.struct(*extra).alias("_d")), ["url"], "seq")

    def detail(name: str) -> Column:
        return c("_d")[name] if name in extra else F.lit(None)

    iso = F.when(c("published").rlike(r"^\d{4}-\d{2}-\d{2}"), c("published"))
    entity = F.coalesce(F.nullif(F.trim(c("entity")), F.lit("")), X.entity_from_url(c("url")))
    return conform(d, POSTING, seq=c("seq"), source=F.lit(source), url=X.canonical_url(c("url")), title=F.trim(c("title")),
                   entity=entity, place=c("place"), published=iso, posted_relative=c("posted_relative"), body=detail("body"),
                   contract_label=detail("contract_label"), applicants=detail("applicants"),
                   applicants_text=detail("applicants_text"), closed=detail("closed"), reposted=detail("reposted"))


def fill_display(df: DataFrame, book: RuleBook) -> DataFrame:
    """PRJ2: mission, work mode and duration only where they are absent."""
    computed = {"mission": X.first_sentence(F.col("body")), "duration": X.duration_text(F.col("body")),
                "work_mode": book.first_label("work_mode", "lower(coalesce(body, ''))", "NC")}
    return df.withColumns({n: F.coalesce(F.col(n), e) for n, e in computed.items()})


def worth_reading(cards: DataFrame, book: RuleBook, rule_sets: Sequence[str]) -> DataFrame:
    """FLT36: the cheap test on title and publisher, before any detail is read or joined."""
    text = "concat(' ', lower(coalesce(title, '')), ' ', lower(coalesce(entity, '')), ' ')"
    return cards.filter(F.expr(" OR ".join(book.sql(s, text) for s in rule_sets)))


def card_flags(df: DataFrame, book: RuleBook) -> DataFrame:
    """CLS18: the older flags of a card: role, sector and contract words, employer of the sector."""
    offer = "concat(' ', lower(coalesce(title, '')), ' ', lower(coalesce(body, '')), ' ')"
    everything = "concat(' ', lower(coalesce(title, '')), ' ', lower(coalesce(entity, '')), ' ', lower(coalesce(body, '')), ' ')"
    label = "lower(coalesce(contract_label, ''))"
    entity = "concat(' ', lower(coalesce(entity, '')), ' ')"
    return df.withColumns({"is_role": book.hit("domain_ok", offer), "in_sector": book.hit("sector", everything),
                           "contract": F.expr(f"{book.sql('strong', offer)} OR {book.sql('contract_label', label)}"),
                           "sector_employer": book.hit("end_client", entity)})


def source_chain(raw: DataFrame, normalise: Callable[[DataFrame], DataFrame], book: RuleBook, recall: str,
                 country: str | None = None, with_buyer: bool = False) -> DataFrame:
    """FLT38: normalise, drop rows without a subject, country (one feed), recall words, first per id.

    FLT14: the recall words are looked for in the subject, with the buyer when asked.
    """
    d = normalise(raw).filter(F.coalesce(F.trim("subject"), F.lit("")) != "")
    if country is not None:
        d = d.filter(same_place(F.col("place"), country))
    text = "lower(coalesce(subject, ''))" + (" || ' ' || lower(coalesce(buyer, ''))" if with_buyer else "")
    d = d.filter(book.hit(recall, f"translate({text}, {X.quoted(X.APOSTROPHES)}, {X.quoted(chr(39) * 4)})"))
    return keep_first(d, ["id"], ["seq"])
