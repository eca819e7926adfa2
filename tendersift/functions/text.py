"""Text expressions; every function maps columns to a column and stays inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tendersift.labels import NC, SNIPPET_CHARS

# fixed values: words carrying no meaning in a title
TITLE_FILLERS = (
    "senior", "junior", "confirme", "confirmee", "expert", "experte", "stagiaire", "debutant",
    "freelance", "mission", "offre", "de", "d", "le", "la", "les", "un", "une", "en", "pour",
    "the", "and",
)
# fixed values: apostrophe look-alikes
APOSTROPHES = "’‘´`"
ELLIPSIS = "…"


@cache
def _fold_table() -> tuple[str, str]:
    """Characters with a one-character base, then the combining marks, which translate() drops."""
    src, dst, drop = [], [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch):
            drop.append(ch)
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src) + "".join(drop), "".join(dst)


def fold_text(s: str | None) -> str:
    """`fold` for driver-side values such as rule terms and column names."""
    src, dst = _fold_table()
    table = {ord(c): (dst[i] if i < len(dst) else None) for i, c in enumerate(src)}
    return (s or "").translate(table).lower()


def fold(c: Column) -> Column:
    """STR2: accents dropped, lower case, null as empty."""
    src, dst = _fold_table()
    return F.lower(F.translate(F.coalesce(c, F.lit("")), src, dst))


def quoted(s: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fold_sql(expr: str) -> str:
    """`fold` as SQL text, for use inside rule expressions and lambdas."""
    src, dst = _fold_table()
    return f"lower(translate(coalesce({expr}, ''), {quoted(src)}, {quoted(dst)}))"


def pad_lower(c: Column) -> Column:
    """STR1: lower case with one space on each side, so `" bi "` also matches at both ends."""
    return F.concat(F.lit(" "), F.lower(F.coalesce(c, F.lit(""))), F.lit(" "))


def pad_raw(c: Column) -> Column:
    """The padding of STR1 for text that is already lower case."""
    return F.concat(F.lit(" "), c, F.lit(" "))


def strip(c: Column) -> Column:
    """Every kind of white space removed at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def drop_invisible(c: Column) -> Column:
    """STR3: format and control characters out, newline and tab kept."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\p{Cf}\p{Cc}&&[^\n\t]]", "")


def plain_apostrophes(c: Column) -> Column:
    """STR15."""
    return F.translate(c, APOSTROPHES, "'" * len(APOSTROPHES))


def title_key(c: Column) -> Column:
    """STR4: the comparable form of a title."""
    return title_key_folded(fold(c))


def title_key_folded(c: Column) -> Column:
    t = F.regexp_replace(c, r"\(.*?\)", " ")
    t = F.regexp_replace(t, r"(?U)\bh\s*/?\s*f\b", " ")
    t = F.regexp_replace(t, r"(?U)\b(?:" + "|".join(TITLE_FILLERS) + r")\b", " ")
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def signature(folded: str, vocabulary: Sequence[str]) -> Column:
    """STR5: the vocabulary terms contained in the folded title column, in alphabetical order."""
    terms = ", ".join(quoted(t) for t in sorted({fold_text(v) for v in vocabulary}))
    return F.expr(f"filter(cast(array({terms}) AS array<string>), _term -> contains({folded}, _term))")


def first_sentence(c: Column) -> Column:
    """STR6."""
    s = strip(F.split(strip(F.coalesce(c, F.lit(""))), r"(?<=[.!?])\s", 2)[0])
    cut = F.concat(F.substring(s, 1, SNIPPET_CHARS), F.lit(ELLIPSIS))
    return F.when(F.length(s) > SNIPPET_CHARS, cut).when(F.length(s) == 0, F.lit(NC)).otherwise(s)


def duration_text(c: Column) -> Column:
    """STR7: a range of months, else one number of months, else the long-term phrase, else NC."""
    t = F.lower(F.coalesce(c, F.lit("")))
    long_term = t.contains("longue durée") | t.contains("longue duree")
    return F.coalesce(
        F.nullif(F.regexp_extract(t, r"\d{1,2}\s*[-/àa]\s*\d{1,2}\s*mois", 0), F.lit("")),
        F.nullif(F.regexp_extract(t, r"\d{1,2}\s*mois", 0), F.lit("")),
        F.when(long_term, F.lit("longue durée")),
        F.lit(NC))


def canonical_url(c: Column) -> Column:
    """STR10."""
    return F.rtrim(F.substring_index(c, "?", 1), F.lit("/"))


def entity_from_url(c: Column) -> Column:
    """STR11: the publisher named in a slug `…-at-<publisher>-<digits>`, empty when absent."""
    slug = F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"-at-([a-z0-9-]+?)-\d{6,}", 1)
    return F.trim(F.replace(slug, F.lit("-"), F.lit(" ")))


def trailing_digits(c: Column) -> Column:
    """STR22: digits at the end of an id or guid, null when there are none."""
    return F.nullif(F.regexp_extract(strip(c), r"(\d+)$", 1), F.lit(""))


def keyword_in_context(column: str, terms: Sequence[str], left: int, right: int,
                       before: str = "...", after: str = "...", past_term: bool = False,
                       always: bool = True) -> Column:
    """STR12: a window around the first term, in list order, that occurs in the text.

    The window starts `left` characters before the hit and ends `right` after its start (after its
    end with `past_term`). Marks go on both sides; with `always=False` only when text was cut off.
    Null without a hit.
    """
    words = ", ".join(quoted(t.strip().lower()) for t in terms)
    # transform over a one-element array names a value that is used more than once
    hit = (f"get(transform(array(lower({column})), _low -> get(filter(transform(array({words}), _term -> named_struct("
           f"'at', instr(_low, _term), 'n', length(_term))), _hit -> _hit.at > 0), 0)), 0)")
    size = f"length({column})"
    span = (f"transform(array({hit}), _hit -> named_struct('lo', greatest(0, _hit.at - 1 - {left}), "
            f"'hi', least({size}, _hit.at - 1 + {right}{' + _hit.n' if past_term else ''}), 'found', _hit IS NOT NULL))")
    cut = f"substring({column}, _span.lo + 1, _span.hi - _span.lo)"
    marked = f"concat({quoted(before)}, {cut}, {quoted(after)})"
    if not always:
        marked = f"CASE WHEN _span.lo = 0 AND _span.hi >= {size} THEN {cut} ELSE {marked} END"
    return F.expr(f"get(transform({span}, _span -> CASE WHEN _span.found THEN {marked} END), 0)")


def strip_label(c: Column, labels: Sequence[str]) -> Column:
    """STR16: a leading `label :` removed; empty becomes null."""
    t = strip(F.regexp_replace(c, r"(?i)^(?:" + "|".join(labels) + r")\s*:\s*", ""))
    return F.nullif(t, F.lit(""))


def untruncate(c: Column) -> Column:
    """STR17: of `cut ... complete` only the complete part."""
    full = strip(F.regexp_extract(strip(c), r"(?s)^.*?\s\.\.\.\s(.*)$", 1))
    return F.coalesce(F.nullif(full, F.lit("")), c)


def reference_head(c: Column) -> Column:
    """STR18: the code before the first ` - `."""
    return F.nullif(strip(F.substring_index(c, " - ", 1)), F.lit(""))


def safe_name(c: Column) -> Column:
    """STR19."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_.-]", "_")


def analysis_text(subject: Column, descriptors: Column, description: Column) -> Column:
    """STR20: all text of a notice, lower case, plain apostrophes."""
    parts = F.concat(F.coalesce(subject, F.lit("")), F.lit(" "),
                     F.coalesce(F.array_join(descriptors, " "), F.lit("")), F.lit(" "),
                     F.coalesce(description, F.lit("")))
    return plain_apostrophes(F.lower(parts))


def judge_text(title: Column, mission: Column, body: Column) -> Column:
    """STR21 (long): title, mission and body, one per line, empty parts left out."""
    parts = [F.nullif(strip(title), F.lit("")), F.nullif(strip(mission), F.lit("")), F.nullif(body, F.lit(""))]
    return strip(F.concat_ws("\n", *parts))


def embed_text(title: Column, mission: Column, body: Column, chars: int | None = None) -> Column:
    """STR21 (short): title and the body, or its first `chars` characters, the mission when there is no body."""
    t = strip(F.coalesce(body, F.lit("")))
    head = F.when(F.length(t) > 0, t if chars is None else F.substring(t, 1, chars)).otherwise(strip(F.coalesce(mission, F.lit(""))))
    return strip(F.concat(strip(F.coalesce(title, F.lit(""))), F.lit(" "), head))


def drop_new_marker(c: Column) -> Column:
    """STR23."""
    return F.regexp_replace(c, r"^[\s★]+", "")


def applicants(number: Column, text: Column) -> Column:
    """STR24: a given count, else the number in front of an applicant word."""
    t = F.translate(F.coalesce(text, F.lit("")), " ", " ")
    found = F.regexp_extract(t, r"(?i)(\d+)\s*(?:premiers?\s+candidats?|candidats?|applicants?)", 1)
    return F.coalesce(number.try_cast("int"), found.try_cast("int"))


def link_from_params(url: Column, pattern: str, base: str, names: Sequence[str]) -> Column:
    """STR25: a link built from captured query parameters, null when they are missing."""
    got = [F.nullif(F.regexp_extract(url, pattern, i + 1), F.lit("")) for i in range(len(names))]
    parts: list[Column] = [F.lit(base)]
    for i, (n, g) in enumerate(zip(names, got)):
        parts += [F.lit(f"{'&' if i else ''}{n}="), g]
    return F.concat(*parts)


def absolute_url(href: Column, base: str) -> Column:
    """STR26: percent-encoded path below `base`; `/'-.()` stay as they are."""
    enc = F.url_encode(href)
    # url_encode is form encoding: space is '+', and the safe marks are escaped
    for a, b in (("+", "%20"), ("%2F", "/"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("*", "%2A"), ("%7E", "~")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    path = F.regexp_replace(enc, "^/+", "")
    return F.when(href.rlike("^https?://"), href).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def column_key(name: str) -> str:
    """STR9: comparable form of a column header."""
    s = fold_text(name.replace("œ", "oe").replace("Œ", "oe")).replace("(j)", "")
    return "".join(ch for ch in s if ch.isascii() and ch.isalnum())


def find_column(columns: Sequence[str], *fragments: str) -> str | None:
    """First column whose key holds every fragment."""
    want = [column_key(f) for f in fragments]
    return next((c for c in columns if all(f in column_key(c) for f in want)), None)


def flatten_map(m: Column) -> Column:
    """SNK7 for maps: `k : v ; k : v`."""
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit(" : "), e["value"])), " ; ")


def flatten_list(a: Column) -> Column:
    """SNK7 for lists."""
    return F.array_join(a, " ; ")


def content_key(version: str, title: Column, mission: Column) -> Column:
    """HSH1."""
    base = F.concat(F.lit(version + "||"), strip(F.coalesce(title, F.lit(""))), F.lit("||"),
                    strip(F.coalesce(mission, F.lit(""))))
    return F.sha1(F.lower(base))


def list_signature(blocks: Column) -> Column:
    """HSH2: first 12 hex digits over the joined blocks."""
    return F.substring(F.sha1(F.array_join(blocks, "||")), 1, 12)


def text_status(c: Column, min_chars: int) -> Column:
    """SRC14."""
    n = F.length(strip(F.coalesce(c, F.lit(""))))
    return (F.when(n == 0, F.lit("vide")).when(n < min_chars, F.lit("PDF probablement scanné"))
            .otherwise(F.lit("ok")))
