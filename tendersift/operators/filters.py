"""Predicates. An unknown value never excludes: every exclusion is false on null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions.numbers import amount, amount_range
from tendersift.functions.text import fold, fold_sql, fold_text, quoted
from tendersift.rules import RuleBook

SENTENCE_END = r"[.!?;\n\r]+"


def known(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def enumeration_only_sql(book: RuleBook, text: str, sector: str, others: str, k: int = 3) -> str:
    """FLT5: every sentence that names the sector also names at least `k` other sectors."""
    naming = (f"filter(split({text}, {quoted(SENTENCE_END)}), "
              f"_part -> {book.sql(sector, quoted(' ') + ' || _part || ' + quoted(' '))})")
    folded = f"transform({naming}, _part -> {fold_sql('_part')})"     # each such sentence is folded once
    many = book.at_least_sql(others, "_folded", k)
    return f"(coalesce(array_min(transform({folded}, _folded -> IF({many}, 1, 0))), 0) = 1)"


def out_of_area_sql(book: RuleBook, folded_title: str, place: str) -> str:
    """FLT9: title and place only, never the body."""
    return book.sql("area_out", f"({folded_title} || ' ' || {fold_sql(place)})")


def country_match(place: str, title: str, book: RuleBook, rule_set: str) -> Column:
    """FLT11: the structured place, the title when there is none, never the body."""
    return book.hit(rule_set, f"concat(' ', lower(coalesce(nullif({place}, ''), {title})), ' ')")


def same_place(c: Column, target: str) -> Column:
    """FLT13: containment without regard to accents, case and apostrophe form."""
    wanted = fold_text(target).replace("’", "'").replace("‘", "'")
    return known(F.translate(fold(c), "’‘", "''").contains(wanted) & c.isNotNull())


def deadline_passed(d: Column, today: Column) -> Column:
    """FLT15."""
    return known(d < today)


def deadline_too_soon(d: Column, today: Column, min_days: int = L.DEADLINE_MIN_DAYS) -> Column:
    """FLT16: exactly `min_days` left is kept."""
    return known(F.date_diff(d, today) < min_days)


def date_too_old(d: Column, today: Column, max_days: int = L.DATE_MAX_AGE_DAYS) -> Column:
    """FLT17."""
    return known(F.date_diff(today, d) > max_days)


def framework_too_large(framework: Column, amount_text: Column, limit: float) -> Column:
    """FLT18."""
    return known(framework & (amount(amount_text) > limit))


def amount_too_high(value: Column, limit: float = 1_000_000) -> Column:
    """FLT19."""
    return known(value > limit)


def range_out_of_target(amount_text: Column, limit: float) -> Column:
    """FLT20: the low end, at the limit already out."""
    return known(amount_range(amount_text)["low"] >= limit)


def not_an_open_call(nature: Column, prefix: str = L.OPEN_CALL_PREFIX) -> Column:
    """FLT21."""
    n = F.lower(F.trim(nature))
    return known((n != "") & ~n.startswith(prefix))


def goods_only(market_type: Column) -> Column:
    """FLT22 on a list of types."""
    return known(F.arrays_overlap(market_type, F.array(F.lit(L.GOODS), F.lit(L.WORKS)))
                 & ~F.array_contains(market_type, L.SERVICES))


def goods_only_text(market_type: Column) -> Column:
    """FLT22 on one text: by prefix, service types excepted."""
    t = F.lower(F.trim(market_type))
    goods = t.startswith(L.GOODS_PREFIXES[0]) | t.startswith(L.GOODS_PREFIXES[1])
    return known(goods & ~t.isin(*L.SERVICE_TYPES))


def procedure_check(kind: Column, text: Column, adapted_only: bool) -> Column:
    """FLT23: struct(keep, status); an unknown procedure is kept to be verified."""
    t = F.trim(F.coalesce(text, F.lit("")))
    unknown = F.coalesce(kind, F.lit("")).isin("") | t.isin("", L.PROCEDURE_UNKNOWN)
    adapted = kind == L.PROCEDURE_ADAPTED
    return F.struct((unknown | adapted | F.lit(not adapted_only)).alias("keep"),
                    F.when(unknown, F.lit(L.PROCEDURE_VERIFY)).otherwise(t).alias("status"))


def category_out(category: Column, out: Sequence[str] = L.OUT_CATEGORIES) -> Column:
    """FLT24."""
    return known(F.lower(F.trim(category)).isin(*out))


def code_prefix(codes: Column, prefixes: Sequence[str]) -> Column:
    """FLT25."""
    def test(c: Column) -> Column:
        p = F.lit(False)
        for x in prefixes:
            p = p | c.startswith(x)
        return p
    return known(F.exists(codes, test))


def generic_document(name: str, book: RuleBook, rule_set: str = "generic_document") -> Column:
    """FLT26: the extension is dropped, `_` and `-` read as blanks."""
    return book.hit(rule_set, f"translate(regexp_replace(lower({name}), '(?<=.)[.][^.]*$', ''), '_-', '  ')")


def login_page(html: str, visible_text: str, book: RuleBook, k: int = 2) -> Column:
    """FLT28: a password field, or at least `k` of the indicator phrases in the visible text."""
    field = F.coalesce(F.col(html), F.lit("")).rlike(r"(?i)<input[^>]*type\s*=\s*[\"']?password")
    return field | book.at_least("login_phrase", f"lower(coalesce({visible_text}, ''))", k)


def year_in_name(name: Column, min_year: int, years: int = 5) -> Column:
    """FLT29: four-digit years from `min_year` on decide when present; else two-digit tokens standing alone, of
    which only those of the next `years` years count, since they may as well be days."""
    four = F.regexp_extract_all(name, F.lit(r"(20\d{2})"), 1)
    two = F.regexp_extract_all(name, F.lit(r"(?<!\d)(\d{2})(?!\d)"), 1)
    return F.when(F.size(four) > 0, F.exists(four, lambda y: y.cast("int") >= min_year)).otherwise(
        F.arrays_overlap(two, F.array(*[F.lit(f"{y % 100:02d}") for y in range(min_year, min_year + years)])))


def publishable(verdict: Column, drop_backlog: bool = True) -> Column:
    """FLT32."""
    out = [L.V_OUT, L.V_BACKLOG] if drop_backlog else [L.V_OUT]
    return ~verdict.isin(*out)


def hard_junk(out_of_scope: Column, sector: Column, kind: Column) -> Column:
    """FLT33: age is never a reason to take back a published row."""
    return known(out_of_scope) | known(sector == L.NO) | known(kind == L.HIRING)


def all_terms(text: Column, terms: Sequence[str]) -> Column:
    """FLT34: every descriptor is contained."""
    p = F.lit(True)
    for t in terms:
        p = p & text.contains(t)
    return p


def pending(status: Column, domain: Column, domains: Sequence[str], done: str) -> Column:
    """FLT35: not done yet and in one of the domains."""
    return (F.coalesce(status, F.lit("")) != done) & known(domain.isin(*domains))
