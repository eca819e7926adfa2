"""Public notices: normalisation to one schema, domain decision lists, screening chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import payload as P
from tendersift.functions import text as X
from tendersift.functions.dates import any_date, date_from_parts, day_first_date, french_date, iso_date, literal_map
from tendersift.operators import filters as K
from tendersift.operators.classify import first_match
from tendersift.rules import RuleBook
from tendersift.scale import lookup, once
from tendersift.schema import FORECAST, NOTICE


def domain_words(b: RuleBook, text: str, prefix: str = "") -> dict[str, str]:
    """The SQL tests that both domain decision lists share; `prefix` names another family of sets."""
    def s(name: str) -> str:
        return b.sql(prefix + name, text)
    supply = f"({s('supply')} AND NOT {s('supply_exempt')})"
    bought = f"(({s('purchase')} OR {supply}) AND {s('goods')})"
    return {"out_first": f"NOT {s('ambiguous')} AND ({bought} OR {s('out_phrase')})",
            "word": f"({s('domain_strong')} OR ({s('ambiguous')} AND {s('domain_context')}))",
            "excluded": s("domain_out"), "ambiguous": s("ambiguous")}


def domain_by_codes_and_words(b: RuleBook, text: str, target: str, excluded: str) -> Column:
    """CLS8: codes are the strong signal, words the weak one; `target` and `excluded` are SQL tests."""
    w = domain_words(b, text)
    steps = [
        (w["out_first"], (L.D_OUT,)),
        (f"{target} AND {excluded}", (L.D_VERIFY,)),
        (f"{target} AND {w['excluded']} AND NOT {w['word']}", (L.D_VERIFY,)),
        (target, (L.D_CONFIRMED,)),
        (f"{excluded} AND {w['word']}", (L.D_VERIFY,)),
        (excluded, (L.D_OUT,)),
        *_word_steps(w),
    ]
    return first_match(steps, (L.D_VERIFY,), ("v",))["v"]


def domain_by_words(b: RuleBook, text: str) -> Column:
    """CLS9: whole words of the subject only, never the buyer's name."""
    w = domain_words(b, text, "w_")
    return first_match([(w["out_first"], (L.D_OUT,)), *_word_steps(w)], (L.D_VERIFY,), ("v",))["v"]


def _word_steps(w: dict[str, str]) -> list:
    return [(f"{w['word']} AND {w['excluded']}", (L.D_VERIFY,)), (w["word"], (L.D_CONFIRMED,)),
            (w["excluded"], (L.D_OUT,)), (w["ambiguous"], (L.D_OUT,))]


def prefix_sql(codes: str, prefixes: Sequence[str]) -> str:
    tests = " OR ".join(f"startswith(_code, {X.quoted(p)})" for p in prefixes)
    return f"coalesce(exists({codes}, _code -> {tests}), false)"


def screen_national(notices: DataFrame, b: RuleBook, today: Column, limit: float, target: Sequence[str],
                    excluded: Sequence[str], adapted_only: bool = False) -> DataFrame:
    """CLS10: framework, goods, deadline, nature and procedure filters, then the domain."""
    c = F.col
    d = notices.filter(~K.framework_too_large(c("framework"), c("amount"), limit)
                       & ~K.goods_only(c("market_type"))
                       & ~K.deadline_too_soon(iso_date(c("deadline")), today)
                       & ~K.not_an_open_call(c("nature")))
    d = d.withColumn("_p", K.procedure_check(c("procedure_type"), c("procedure_text"), adapted_only)).filter("_p.keep")
    d = once(d, "_x", X.analysis_text(c("subject"), c("descriptors"), c("description")))
    d = d.withColumns({"domain": domain_by_codes_and_words(b, "_x", prefix_sql("codes", target),
                                                           prefix_sql("codes", excluded)),
                       "procedure_status": c("_p.status")})
    return d.filter(c("domain") != L.D_OUT).drop("_p", "_x")


def screen_planned(notices: DataFrame, b: RuleBook, today: Column, limit: float, target: Sequence[str],
                   excluded: Sequence[str]) -> DataFrame:
    """CLS11: amount range, category and deadline; the planned publication date never excludes."""
    c = F.col
    d = notices.filter(~K.range_out_of_target(c("amount"), limit) & ~K.category_out(c("category"))
                       & ~K.deadline_too_soon(iso_date(c("deadline")), today))
    d = once(d, "_x", X.analysis_text(c("subject"), c("descriptors"), c("description")))
    d = d.withColumn("domain", domain_by_codes_and_words(b, "_x", prefix_sql("codes", target),
                                                         prefix_sql("codes", excluded)))
    return d.filter(c("domain") != L.D_OUT).drop("_x")


def screen_regional(notices: DataFrame, b: RuleBook, today: Column) -> DataFrame:
    """CLS12: market type by text, deadline, then the domain by whole words."""
    c = F.col
    d = notices.filter(~K.goods_only_text(F.element_at(c("market_type"), 1))
                       & ~K.deadline_too_soon(any_date(c("deadline")), today))
    d = once(d, "_x", X.plain_apostrophes(F.lower(F.coalesce(c("subject"), F.lit("")))))
    return d.withColumn("domain", domain_by_words(b, "_x")).filter(c("domain") != L.D_OUT).drop("_x")


def in_domain_order(df: DataFrame) -> DataFrame:
    """SRT2."""
    return df.orderBy(F.coalesce(literal_map(L.DOMAIN_ORDER)[F.col("domain")], F.lit(1)), "seq")


# --- normalisation ---------------------------------------------------------------------------------

def conform(df: DataFrame, schema=NOTICE, **values: Column) -> DataFrame:
    """Exactly the columns of `schema`, given by `values`; what is not given is null."""
    return df.select(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def as_list(c: Column) -> Column:
    return F.when(c.isNotNull(), F.array(c))


def national_notices(raw: DataFrame) -> DataFrame:
    """PRJ3: columns of the main feed plus its nested payload in `donnees` (text)."""
    c = F.col
    d = raw.withColumn("_n", P.nodes_with_keys(c("donnees"), P.WANTED))
    d = d.withColumn("_m", P.payload_amount(c("_n")))
    return conform(d, seq=c("seq"), id=c("idweb"), source=F.lit("BOAMP"), published=c("dateparution"),
                   deadline=c("datelimitereponse"), buyer=c("nomacheteur"),
                   department=F.array_join(c("code_departement"), ", "), subject=c("objet"),
                   procedure_text=c("procedure_libelle"), procedure_type=c("type_procedure"),
                   market_type=c("type_marche"), nature=c("nature_categorise"),
                   nature_text=c("nature_categorise_libelle"), descriptors=c("descripteur_libelle"),
                   codes=P.payload_codes(c("_n")), amount=c("_m.amount"), currency=c("_m.currency"),
                   framework=P.payload_is_framework(c("_n")), profile_link=P.payload_link(c("_n")),
                   criteria=P.payload_criteria(c("_n")), duration=P.payload_duration(c("_n")),
                   notice_url=c("url_avis"))


def portal_notices(raw: DataFrame, label: str) -> DataFrame:
    """PRJ4: dates come as [day, month, year]; the id is null without a reference."""
    c = F.col

    def day(col: str) -> Column:
        p = c(col)
        return F.date_format(F.when(F.size(p) == 3, date_from_parts(p[0], p[1], p[2])), "yyyy-MM-dd")

    ref = F.nullif(c("reference"), F.lit(""))
    return conform(raw, seq=c("seq"), id=F.concat(F.lit(label + "-"), ref), source=F.lit(label), reference=ref,
                   subject=F.coalesce(F.nullif(c("objet"), F.lit("")), c("intitule")), buyer=c("organisme"),
                   place=c("lieu"), procedure_type=c("procedure_abbr"), procedure_text=c("procedure_libelle"),
                   category=c("categorie"), published=day("date_pub"), deadline=day("date_limite"),
                   notice_url=F.coalesce(F.nullif(c("rc_url"), F.lit("")), c("consult_url")))


def planned_notices(raw: DataFrame) -> DataFrame:
    """PRJ5: the amount stays text."""
    c = F.col
    return conform(raw, seq=c("seq"), id=c("id"), source=F.lit("APProch"), subject=c("objet"),
                   description=c("description"), codes=c("cpv"), amount=c("montant_estime"),
                   category=c("categorie_achat"), buyer=c("acheteur"), deadline=c("date_limite"),
                   published=c("date_publication"))


def text_key(text: Column, chars: int | None = None) -> Column:
    """An id made of a text: a hash of all of it, or its first `chars` characters where those are asked for."""
    return F.md5(text.cast("binary")) if chars is None else F.substring(text, 1, chars)


def make_id(prefix: str, reference: Column, subject: Column, chars: int | None = None) -> Column:
    """Prefix and reference, or the key of the subject when there is no reference."""
    return F.concat(F.lit(prefix), F.coalesce(F.nullif(reference, F.lit("")), text_key(subject, chars)))


def regional_notices(raw: DataFrame, prefix: str, source: str, country: str, currency: str | None = None,
                     need_subject: bool = True, labels: Sequence[str] = ("objet", "acheteur public")) -> DataFrame:
    """PRJ6: labels and doubled tooltip text removed, day-first dates, rows without a subject dropped."""
    c = F.col
    subject = X.untruncate(X.strip_label(c("objet"), labels))
    d = raw.withColumns({"_subject": subject, "_buyer": X.untruncate(X.strip_label(c("acheteur"), labels))})
    if need_subject:
        d = d.filter(F.coalesce(c("_subject"), F.lit("")) != "")
    deadline = F.coalesce(day_first_date(c("date_limite")), french_date(c("date_limite")), iso_date(c("date_limite")))
    published = F.coalesce(day_first_date(c("date_publication")), french_date(c("date_publication")),
                           iso_date(c("date_publication")))
    return conform(d, seq=c("seq"), id=make_id(prefix, c("reference"), c("_subject")), source=F.lit(source),
                   country=F.lit(country), reference=F.coalesce(F.nullif(c("reference"), F.lit("")), F.lit(L.UNSPECIFIED)),
                   subject=c("_subject"), buyer=F.coalesce(c("_buyer"), F.lit(L.UNSPECIFIED)),
                   market_type=as_list(c("categorie")), procedure_text=c("procedure"), place=X.untruncate(c("lieu")),
                   published=F.date_format(published, "yyyy-MM-dd"), deadline=F.date_format(deadline, "yyyy-MM-dd"),
                   currency=F.lit(currency), notice_url=c("detail_url"))


TITLE_PARTS = r"(?s)^([A-Z]{2,4})\s*-\s*([^-]+?)\s*-\s*(.+)$"


def title_parts(c: Column) -> Column:
    """PRJ7: struct(type, country, subject) of `TYPE - Country - Subject`, else only the subject."""
    t = X.strip(c)
    part = [F.nullif(X.strip(F.regexp_extract(t, TITLE_PARTS, i)), F.lit("")) for i in (1, 2, 3)]
    return F.struct(part[0].alias("type"), part[1].alias("country"), F.coalesce(part[2], t).alias("subject"))


def forecasts(rows: DataFrame, source: str, country: str) -> DataFrame:
    """PRJ8: extracted table rows, with columns found by name fragments; no subject or buyer, no row."""
    def col(*fragments: str) -> Column:
        name = X.find_column(rows.columns, *fragments)
        return F.col(f"`{name}`") if name else F.lit(None).cast("string")

    subject, line = col("objet"), F.regexp_replace(F.coalesce(col("ligne", "budgetaire"), F.lit("")), r"(?U)\s+", "")
    buyer = F.coalesce(col("autorite", "contractante"), col("autorit"))
    derived = text_key(F.regexp_replace(F.concat(buyer, subject), r"(?U)\W+", ""))
    d = rows.filter((F.coalesce(subject, F.lit("")) != "") & (F.coalesce(buyer, F.lit("")) != ""))
    return conform(d, FORECAST, seq=F.col("seq"), id=F.concat(F.lit("CI-PPM-"), F.coalesce(F.nullif(line, F.lit("")), derived)),
                   country=F.lit(country), source=F.lit(source), ministry=col("minist"), buyer=X.squeeze(buyer),
                   subject=X.squeeze(subject), funder=col("bailleur"), award_mode=col("mode", "passation"),
                   reference=F.coalesce(F.nullif(col("ligne", "budgetaire"), F.lit("")), F.lit(L.UNSPECIFIED)),
                   market_type=as_list(col("type", "march")), published=col("date", "publication"),
                   amount_note=F.lit("estimation prévisionnelle — à confirmer"))


def document_hits(texts: DataFrame, terms: Sequence[str], prefix: str, chars: int = 150) -> DataFrame:
    """PRJ9: documents in which a term occurs; the subject is the text around the first hit."""
    hit = X.squeeze(X.keyword_in_context("text", terms, chars // 2, chars // 2, "…", "…", past_term=True, always=False))
    return (once(texts, "subject", hit).filter(F.col("subject").isNotNull())
            .select(F.col("id").alias("seq"), F.concat(F.lit(prefix), F.col("id")).alias("id"), "subject"))


def prefilled(synthesis: Column, structured: Column, status: Column) -> tuple[Column, Column]:
    """PRJ10: the synthesis wins over structured data; (value, status)."""
    s = F.nullif(F.trim(synthesis), F.lit(""))
    value = F.coalesce(s, F.nullif(F.trim(structured), F.lit("")))
    st = F.when(F.coalesce(status, F.lit("")) != "", status).when(value.isNotNull(), F.lit("pré-rempli"))
    return value, st


def or_unspecified(c: Column, default: str = L.UNSPECIFIED) -> Column:
    """PRJ11 and SNK2."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def enrich_survivors(survivors: DataFrame, details: DataFrame, key: str, columns: Sequence[str], spread: str) -> DataFrame:
    """JOI10: details only for what is left after the filters; `details` has one row per key."""
    d = details.select(key, *[F.col(x).alias("_d_" + x) for x in columns])
    out = lookup(survivors, d, [key], spread)
    return out.withColumns({x: F.coalesce(F.col("_d_" + x), F.col(x) if x in survivors.columns else F.lit(None))
                            for x in columns}).drop(*["_d_" + x for x in columns])
