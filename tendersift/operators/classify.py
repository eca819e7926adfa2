"""Decision lists over postings: ordered first match, one `when` chain per decision.

Rule sets used: contract_form, strong, weak, reference_code, b2b, b2b_strong, salary, staff_only,
end_client, career / sector, sector_word, sector_generic, sector_specific, sector_negative,
sector_strong, agency, other_sector, sector_list / hard_out, acceptance, acceptance_ok,
narrow_tech, narrow_signal, broad_signal, acronym, title_acronym, infra, certification, regulatory,
core, domain_ok, tech_stack / area_out, blocked_entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import text as X
from tendersift.functions.dates import posting_age
from tendersift.operators.filters import enumeration_only_sql, out_of_area_sql
from tendersift.rules import RuleBook

QUESTION = ("Cette mission est-elle toujours ouverte, et accessible en contractualisation B2B "
            "(société de conseil, facturation au TJM) ?")  # fixed value
CERTIFICATION_MIN = 3

# Lower-case views of a posting, each a plain column computed once per row: title, body and
# publisher padded; title . body; title body publisher; title body.
VIEWS = {
    "_t": "' ' || _lt || ' '", "_b": "' ' || _lb || ' '", "_e": "' ' || _le || ' '",
    "_o": "' ' || _lt || ' . ' || _lb || ' '", "_a": "' ' || _lt || ' ' || _lb || ' ' || _le || ' '",
    "_s": "' ' || _lt || ' ' || _lb || ' '",
}


def with_text_views(df: DataFrame) -> DataFrame:
    """Clean the three texts once, then derive the padded lower-case views below all tests."""
    d = df.withColumns({c: X.drop_invisible(F.col(c)) for c in ("title", "body", "entity")})
    d = d.withColumns({"_lt": F.lower("title"), "_lb": F.lower("body"), "_le": F.lower("entity"),
                       "_ft": X.fold(F.col("title"))})
    return d.withColumns({n: F.expr(e) for n, e in VIEWS.items()})


def first_match(steps: list[tuple[str, tuple]], default: tuple, names: tuple[str, ...]) -> Column:
    """The struct of the first step whose SQL test holds; values are SQL text or plain values."""
    def pack(values: tuple) -> str:
        return "named_struct(" + ", ".join(f"{X.quoted(n)}, {_value(v)}" for n, v in zip(names, values)) + ")"
    whens = " ".join(f"WHEN {test} THEN {pack(values)}" for test, values in steps)
    return F.expr(f"CASE {whens} ELSE {pack(default)} END")


class Sql(str):
    """SQL text among the values of a decision."""


def _value(v: object) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return f"({v})" if isinstance(v, Sql) else X.quoted(str(v))


def contract_signals(b: RuleBook) -> dict[str, Column]:
    """The three signals CLS1 and AGG3 share, computed once per row."""
    return {"_strong": F.expr(f"{b.sql('strong', '_o')} OR {b.sql('reference_code', '_o')}"),
            "_weak": b.hit("weak", "_o"), "_b2b": b.hit("b2b", "_o")}


def engagement(b: RuleBook) -> Column:
    """CLS1 with FLT7: struct(kind, signal). The platform's own label alone never excludes."""
    by_label = Sql(f"coalesce(contains(lower(contract_label), {X.quoted(L.CONTRACT_LABEL)}), false)")
    open_to = f"(_b2b OR {by_label})"
    staff, client = b.sql("staff_only", "_e"), b.sql("end_client", "_e")
    steps = [
        (b.sql("contract_form", "_o"), (L.HIRING, False)),
        (f"{b.sql('salary', '_o')} AND NOT ({b.sql('b2b_strong', '_o')} OR {by_label})", (L.HIRING, False)),
        (f"{staff} AND _strong AND {open_to}", (L.MISSION, True)),
        (staff, (L.HIRING, False)),
        (f"{client} AND _strong AND {open_to}", (L.MISSION, True)),
        (f"{client} AND _strong", (L.TO_CONFIRM, by_label)),
        (client, (L.HIRING, False)),
        ("_strong OR _weak", (L.MISSION, True)),
        (f"{b.sql('career', '_b')} AND NOT {open_to}", (L.HIRING, by_label)),
    ]
    return first_match(steps, (L.TO_CONFIRM, by_label), ("kind", "signal"))


def sector(b: RuleBook) -> Column:
    """CLS2: OUI, PROBABLE or NON."""
    word = b.sql("sector_word", "_a")
    named = f"({b.sql('sector', '_a')} OR {word})"
    denied = f"({b.sql('sector_negative', '_a')} AND NOT {b.sql('sector_strong', '_a')})"
    listed = (f"(NOT {b.sql('sector_generic', '_t')} AND NOT {b.sql('sector_specific', '_a')} AND NOT {word} "
              f"AND {enumeration_only_sql(b, '_a', 'sector_generic', 'sector_list')})")
    steps = [(f"{named} AND ({denied} OR {listed})", (L.NO,)), (named, (L.YES,)),
             (f"{b.sql('agency', '_e')} AND NOT {b.sql('other_sector', '_a')}", (L.LIKELY,))]
    return first_match(steps, (L.NO,), ("v",))["v"]


def scope(b: RuleBook) -> Column:
    """CLS3: struct(core, domain_ok, out); the title decides, the body only confirms."""
    out = (False, False, True)
    narrow, broad = b.sql("narrow_signal", "_s"), b.sql("broad_signal", "_s")
    ok_title, core_body = b.sql("domain_ok", "_t"), b.sql("core", "_b")
    ok_any = f"({ok_title} OR {b.sql('domain_ok', '_b')})"
    steps = [
        (b.sql("hard_out", "_t"), out),
        (f"{b.sql('acceptance', '_t')} AND NOT {b.sql('acceptance_ok', '_t')}", out),
        (f"{b.sql('narrow_tech', '_s')} AND NOT {narrow}", out),
        (f"({b.sql('acronym', '_s')} OR {b.sql('title_acronym', '_t')}) AND NOT {broad}", out),
        (f"{b.sql('infra', '_s')} AND NOT {narrow}", out),
        (b.at_least_sql("certification", "_s", CERTIFICATION_MIN), out),
        (b.sql("regulatory", "_b"), out),
        (b.sql("core", "_t"), (True, Sql(ok_title), False)),
        (b.sql("tech_stack", "_t"), out),
    ]
    default = (Sql(core_body), Sql(ok_any), Sql(f"NOT ({core_body} OR {ok_any})"))
    return first_match(steps, default, ("core", "domain_ok", "out"))


def window_of(age: str, closed: str, reposted: str, open_confirmed: str) -> Column:
    """CLS5. An unknown date is only open when the source says the posting is."""
    sure = f"coalesce({open_confirmed}, false)"
    steps = [
        (f"coalesce({closed}, false)", (L.W_CLOSED,)),
        (f"{age} IS NULL AND {sure}", (L.W_OPEN,)), (f"{age} IS NULL", (L.W_UNKNOWN,)),
        (f"{age} <= {L.NEW_DAYS}", (L.W_NEW,)), (f"{age} <= {L.OPEN_DAYS}", (L.W_OPEN,)),
        (f"coalesce({reposted}, false)", (L.W_REOPENED,)),
        (f"{sure} AND {age} <= {L.BACKLOG_DAYS}", (L.W_BACKLOG,)),
    ]
    return first_match(steps, (L.W_AGED,), ("v",))["v"]


def verdict_of(kind: str = "kind", sector_: str = "sector", window: str = "window", core: str = "core",
               domain_ok: str = "domain_ok", out: str = "out_of_scope", lead: str = "strong_lead") -> Column:
    """CLS6: struct(verdict, reason)."""
    def is_(c: str, *values: str) -> str:
        return f"`{c}` IN ({', '.join(X.quoted(v) for v in values)})"
    mission, to_confirm = is_(kind, L.MISSION), is_(kind, L.TO_CONFIRM)
    steps = [
        (out, (L.V_OUT, L.R_SCOPE)),
        (is_(sector_, L.NO), (L.V_OUT, L.R_SECTOR)),
        (is_(kind, L.HIRING), (L.V_OUT, L.R_HIRING)),
        (is_(window, L.W_CLOSED), (L.V_OUT, L.R_CLOSED)),
        (is_(window, L.W_BACKLOG), (L.V_BACKLOG, L.R_BACKLOG)),
        (is_(window, L.W_AGED), (L.V_OUT, L.R_AGE)),
        (is_(window, L.W_UNKNOWN), (L.V_OUT, L.R_DATE)),
        (f"{mission} AND ({core} OR {lead})", (L.V_TOP, "")),
        (f"{mission} AND {domain_ok}", (L.V_GOOD, "")),
        (f"{to_confirm} AND {is_(sector_, L.LIKELY)} AND {is_(window, L.W_NEW, L.W_OPEN, L.W_REOPENED)}", (L.V_GOOD, "")),
        (to_confirm, (L.V_CONFIRM, "")),
    ]
    return first_match(steps, (L.V_GOOD, ""), ("verdict", "reason"))


def classify_postings(df: DataFrame, book: RuleBook, today: Column, dedup_chars: int | None = None) -> DataFrame:
    """CLS1–CLS5, CLS7 and FLT10 for every posting, in one pass over the texts and without a shuffle.

    The result carries keys and decisions but not the body, so that everything that follows
    (duplicates, recurrence, nets, merges) shuffles narrow rows. `dedup_text` is a hash of the whole
    text, or of its first `dedup_chars` characters where a user asks for looser duplicates.
    """
    body = F.coalesce(F.col("body"), F.lit(""))
    opening = body if dedup_chars is None else F.substring(body, 1, dedup_chars)
    d = df.withColumns({"dedup_text": F.md5(X.strip(opening).cast("binary")), "raw_entity": F.col("entity"), "raw_title": F.col("title")})
    d = with_text_views(d).withColumns(contract_signals(book))
    day, age, src = posting_age(F.col("published"), F.col("posted_relative"), today)
    barred = f"{out_of_area_sql(book, '_ft', place_sql())} OR {book.sql('blocked_entity', '_e')}"
    d = d.withColumns({
        "_type": engagement(book), "sector": sector(book), "_scope": scope(book),
        "strong_lead": book.hit("broad_signal", "_t"), "_barred": F.expr(barred),
        "has_signal": F.expr("_strong OR _weak OR _b2b"),
        "date": day, "age": age, "date_source": src,
        "entity_key": X.strip(F.expr(X.fold_sql("raw_entity"))),
        "title_norm": X.title_key_folded(F.col("_ft")), "dedup_title": X.title_key(F.col("raw_title")),
        "signature": X.signature("_ft", book.terms("signature")),
        "applicants": X.applicants(F.col("applicants"), F.col("applicants_text")),
    })
    return d.select(
        "seq", "url", "title", "entity", "source", "entity_key", "title_norm", "dedup_title", "dedup_text", "signature",
        "_type.kind", "_type.signal", "has_signal", "sector",
        F.expr("_scope.core AND NOT _barred AS core"), F.expr("_scope.domain_ok AND NOT _barred AS domain_ok"),
        F.expr("_scope.out OR _barred AS out_of_scope"), "strong_lead", "date", "age", "date_source", "applicants",
        F.expr("coalesce(closed, false) AS closed"), F.expr("coalesce(reposted, false) AS reposted"),
        window_of("age", "closed", "reposted", "open_confirmed").alias("window"),
        F.when(F.col("_type.kind") == L.TO_CONFIRM, F.lit(QUESTION)).otherwise(F.lit("")).alias("question"))


def place_sql() -> str:
    return "coalesce(nullif(place, ''), work_mode)"
