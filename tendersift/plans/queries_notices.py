"""Queries for filters, amounts, dates, domain decisions and normalisation of notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import dates as D
from tendersift.functions import numbers as N
from tendersift.functions import text as X
from tendersift.operators import filters as K
from tendersift.operators import notices as O
from tendersift.operators.reports import count_by
from tendersift.plans.registry import (once, S_PAD, S_TITLE, TODAY, book, docs, padded, q, query, read, s_any, s_list, s_terms,
                                       s_word, today)
from tendersift.plans.sample_rules import SUBSTRING_SETS

TODAY_SQL = f"DATE '{TODAY}'"


def orders(spark, sf):
    return read(spark, sf, "orders")


# --- terms -----------------------------------------------------------------------------------------

@query(f"SELECT doc_id FROM documents WHERE {s_any(S_PAD, 'strong')}")
def any_term(spark, sf):
    return docs(spark, sf).transform(once, "_p", padded()).filter(book().hit("strong", "_p")).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE {s_any('lower(text)', 'w_domain_strong')}")
def word_term(spark, sf):
    return docs(spark, sf).filter(book().hit("w_domain_strong", "lower(text)")).select("doc_id")


@query(f"""SELECT doc_id FROM documents
  WHERE len(list_filter({s_list(SUBSTRING_SETS['signature'])}, lambda t: contains({S_PAD}, t))) >= 5""")
def distinct_terms_k(spark, sf):
    d = docs(spark, sf).transform(once, "_p", padded())
    return d.filter(book().at_least("signature", "_p", 5)).select("doc_id")


@query(f"""SELECT doc_id FROM (SELECT doc_id, list_filter(regexp_split_to_array({S_PAD}, '[.!?;\\n\\r]+'),
    lambda p: {s_terms("concat(' ', p, ' ')", SUBSTRING_SETS['sector_generic'])}) AS named FROM documents)
  WHERE len(named) > 0 AND len(list_filter(named, lambda p:
    len(list_filter(['erth','onin','rely','anst','heea','eron','reau','cion','pare'],
        lambda x: contains(lower(strip_accents(p)), x))) < 3)) = 0""")
def enumeration_only(spark, sf):
    d = docs(spark, sf).transform(once, "_p", padded())
    return d.filter(F.expr(K.enumeration_only_sql(book(), "_p", "sector_generic", "sector_list"))).select("doc_id")


@query(f"""SELECT doc_id, array_to_string(list_filter({s_list(SUBSTRING_SETS['strong'])},
    lambda t: contains({S_PAD}, t)), '|') AS found FROM documents WHERE {s_any(S_PAD, 'strong')}""")
def terms_found(spark, sf):
    d = docs(spark, sf).transform(once, "_p", padded()).filter(book().hit("strong", "_p"))
    return d.select("doc_id", F.array_join(book().found("strong", "_p"), "|").alias("found"))


@query(f"""WITH h AS (SELECT doc_id, text, list_filter(list_transform({s_list(SUBSTRING_SETS['recall'])},
    lambda t: instr(lower(text), t)), lambda i: i > 0)[1] AS pos FROM documents)
  SELECT doc_id, concat('...', substring(text, greatest(0, pos - 1 - 45) + 1,
    least(length(text), pos - 1 + 90) - greatest(0, pos - 1 - 45)), '...') AS snippet FROM h WHERE pos IS NOT NULL""")
def keyword_in_context(spark, sf):
    d = once(docs(spark, sf).select("doc_id", "text"), "snippet", X.keyword_in_context("text", SUBSTRING_SETS["recall"], 45, 90))
    return d.filter("snippet IS NOT NULL").select("doc_id", "snippet")


# --- dates and deadlines ---------------------------------------------------------------------------

@query(f"""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'ÉCARTÉE (clôturée)'
    WHEN age IS NULL THEN CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'OUVERTE' ELSE 'INCONNUE' END
    WHEN age <= 7 THEN 'NOUVEAU' WHEN age <= 21 THEN 'OUVERTE' WHEN o_orderpriority = '5-LOW' THEN 'ROUVERTE'
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND age <= 90 THEN 'VIVIER' ELSE 'AGEE' END AS "window"
  FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN CAST({TODAY_SQL} - CAST(o_orderdate AS DATE) AS INTEGER) END AS age
        FROM orders)""")
def freshness_window(spark, sf):
    from tendersift.operators.classify import window_of
    d = orders(spark, sf).withColumns({
        "age": F.when(F.col("o_orderstatus") != "P", F.date_diff(today(), F.col("o_orderdate").cast("date"))),
        "closed": F.col("o_orderpriority") == "1-URGENT", "reposted": F.col("o_orderpriority") == "5-LOW",
        "sure": F.col("o_orderpriority") == "4-NOT SPECIFIED"})
    return d.select("o_orderkey", window_of("age", "closed", "reposted", "sure").alias("window"))


_UNITS = ("jours", "semaines", "mois", "an", "heures", "minutes", "siècles")


@query(f"""SELECT o_orderkey, CAST(CASE u WHEN 'jours' THEN n WHEN 'semaines' THEN 7 * n WHEN 'mois' THEN 30 * n
    WHEN 'an' THEN 365 * n WHEN 'heures' THEN 0 WHEN 'minutes' THEN 0 END AS INTEGER) AS age FROM
  (SELECT o_orderkey, o_custkey % 12 AS n, {s_list(list(_UNITS))}[CAST(o_orderkey % 7 AS INTEGER) + 1] AS u FROM orders)""")
def relative_dates(spark, sf):
    unit = F.array(*[F.lit(u) for u in _UNITS])[(F.col("o_orderkey") % 7).cast("int")]
    text = F.concat(F.lit("Publiée il y a "), F.col("o_custkey") % 12, F.lit(" "), unit)
    return orders(spark, sf).select("o_orderkey", D.relative_days(text).alias("age"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
  FROM orders""")
def mixed_date_formats(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format(d, "dd/MM/yyyy HH:mm"))
            .when(k == 2, F.date_format(d, "dd-MM-yyyy")).when(k == 3, F.date_format(d, "yyyy-MM-dd"))
            .otherwise(F.lit("31/02/2001")))
    return orders(spark, sf).select("o_orderkey", F.date_format(D.any_date(text), "yyyy-MM-dd").alias("day"))


_MONTHS = ("janvier", "Févr.", "mars", "AVRIL", "mai", "juin", "juil.", "août", "sept.", "octobre", "nov.", "décembre")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def month_names(spark, sf):
    d = F.col("o_orderdate")
    name = F.array(*[F.lit(m) for m in _MONTHS])[F.month(d) - 1]
    text = F.concat_ws(" ", F.dayofmonth(d), name, F.year(d))
    return orders(spark, sf).select("o_orderkey", F.date_format(D.french_date(text), "yyyy-MM-dd").alias("day"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '{TODAY}' WHEN o_orderstatus = 'O' THEN '2001-08-01'
    ELSE concat(CASE WHEN strftime(o_orderdate, '%m%d') > '0802' THEN '2000' ELSE '2001' END, strftime(o_orderdate, '-%m-%d'))
    END AS day FROM orders WHERE strftime(o_orderdate, '%m%d') <> '0229'""")
def site_dates(spark, sf):
    text = (F.when(F.col("o_orderstatus") == "P", "Publiée à l'instant").when(F.col("o_orderstatus") == "O", "Publiée hier")
            .otherwise(F.concat(F.lit("Publiée le "), F.date_format("o_orderdate", "dd/MM"))))
    return (orders(spark, sf).filter(F.date_format("o_orderdate", "MMdd") != "0229")
            .select("o_orderkey", F.date_format(D.site_date(text, today()), "yyyy-MM-dd").alias("day")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def feed_dates(spark, sf):
    text = F.concat(F.date_format("o_orderdate", "EEE"), F.lit(", "), F.date_format("o_orderdate", "dd MMM yyyy HH:mm:ss"),
                    F.lit(" +0000"))
    return orders(spark, sf).select("o_orderkey", F.date_format(D.rfc822_date(text), "yyyy-MM-dd").alias("day"))


@query("""SELECT l_orderkey, l_linenumber, coalesce(d < DATE '2000-06-01', false) AS passed,
    coalesce(CAST(d - DATE '2000-06-01' AS INTEGER) < 7, false) AS too_soon,
    coalesce(CAST(DATE '2000-06-01' - d AS INTEGER) > 20, false) AS too_old
  FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem)""")
def deadline_filters(spark, sf):
    t = F.lit("2000-06-01").cast("date")
    d = read(spark, sf, "lineitem").withColumn("d", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("date")))
    return d.select("l_orderkey", "l_linenumber", K.deadline_passed(F.col("d"), t).alias("passed"),
                    K.deadline_too_soon(F.col("d"), t).alias("too_soon"), K.date_too_old(F.col("d"), t).alias("too_old"))


# --- amounts ---------------------------------------------------------------------------------------

@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE o_totalprice END AS amount,
    CASE WHEN o_orderkey % 6 = 5 THEN false ELSE o_totalprice > 250000 AND o_orderstatus = 'F' END AS framework_out FROM orders""")
def amount_parse(spark, sf):
    v, k = F.col("o_totalprice"), F.col("o_orderkey") % 6
    spaced = F.translate(F.format_number(v, 2), ",.", " ,")
    text = (F.when(k == 0, F.concat(spaced, F.lit(" €"))).when(k == 1, F.translate(F.format_number(v, 2), ",", " "))
            .when(k == 5, F.lit("non communiqué")).otherwise(F.format_string("%.2f", v)))
    d = orders(spark, sf).withColumn("t", text)
    return d.select("o_orderkey", N.amount(F.col("t")).alias("amount"),
                    K.framework_too_large(F.col("o_orderstatus") == "F", F.col("t"), 250000).alias("framework_out"))


@query("""WITH r AS (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS v FROM orders)
  SELECT o_orderkey, CASE WHEN k IN (0, 3) THEN v * 1000 WHEN k = 1 THEN v * 1000000 END AS low,
    CASE k WHEN 0 THEN (v + 50) * 1000 WHEN 2 THEN v * 1000 WHEN 3 THEN v * 1000 END AS high,
    CASE WHEN k IN (0, 3) THEN v * 1000 >= 100000 WHEN k = 1 THEN v * 1000000 >= 100000 ELSE false END AS out_of_target FROM r""")
def amount_ranges(spark, sf):
    v, k = F.floor(F.col("o_totalprice") / 1000).cast("string"), F.col("o_orderkey") % 5
    hi = (F.floor(F.col("o_totalprice") / 1000) + 50).cast("string")
    text = (F.when(k == 0, F.concat(v, F.lit("k - "), hi, F.lit("k€"))).when(k == 1, F.concat(F.lit("+ "), v, F.lit("M€")))
            .when(k == 2, F.concat(F.lit("<"), v, F.lit("k"))).when(k == 3, F.concat(v, F.lit(" K €"))).otherwise(F.lit("à définir")))
    d = orders(spark, sf).withColumn("t", text).withColumn("r", N.amount_range(F.col("t")))
    return d.select("o_orderkey", "r.low", "r.high", K.range_out_of_target(F.col("t"), 100000).alias("out_of_target"))


@query("""SELECT o_orderkey, concat(replace(replace(replace(format('{:,.2f}', o_totalprice), ',', ' '), '.', ','), '#', ''), ' MAD')
    AS shown, o_totalprice > 300000 AS too_high FROM orders""")
def amount_display(spark, sf):
    return orders(spark, sf).select("o_orderkey", N.amount_display(F.col("o_totalprice"), "MAD").alias("shown"),
                                    K.amount_too_high(F.col("o_totalprice"), 300000).alias("too_high"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS amount FROM customer""")
def local_amounts(spark, sf):
    text = F.concat(F.format_string("%.2f", F.greatest(F.col("c_acctbal"), F.lit(0.0))), F.lit(" "))
    return read(spark, sf, "customer").select("c_custkey", N.local_amount(F.translate(text, ".", ",")).alias("amount"))


# --- types, codes, procedures, natures -------------------------------------------------------------

@query("""WITH o AS (SELECT l_orderkey, list(DISTINCT CASE l_returnflag WHEN 'R' THEN 'SERVICES' WHEN 'A' THEN 'FOURNITURES'
    ELSE 'TRAVAUX' END) AS t FROM lineitem GROUP BY l_orderkey)
  SELECT l_orderkey, NOT list_contains(t, 'SERVICES') AS goods_only FROM o""")
def supplies_only(spark, sf):
    kind = F.when(F.col("l_returnflag") == "R", L.SERVICES).when(F.col("l_returnflag") == "A", L.GOODS).otherwise(L.WORKS)
    d = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set(kind).alias("t"))
    return d.select("l_orderkey", K.goods_only(F.col("t")).alias("goods_only"))


@query("""SELECT l_orderkey, bool_or(starts_with(CAST(l_partkey AS VARCHAR), '72') OR starts_with(CAST(l_partkey AS VARCHAR), '48'))
    AS target, bool_or(starts_with(CAST(l_partkey AS VARCHAR), '45')) AS excluded FROM lineitem GROUP BY l_orderkey""")
def code_prefixes(spark, sf):
    codes = F.array(F.col("l_partkey").cast("string"))
    return read(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(K.code_prefix(codes, ["72", "48"])).alias("target"), F.bool_or(K.code_prefix(codes, ["45"])).alias("excluded"))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'procédure à vérifier' ELSE o_orderpriority END
    AS status FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '2-HIGH')""")
def procedure_status(spark, sf):
    p = F.col("o_orderpriority")
    kind = F.when(p == "2-HIGH", L.PROCEDURE_ADAPTED).when(p == "4-NOT SPECIFIED", None).otherwise("OUVERT")
    d = orders(spark, sf).withColumn("_p", K.procedure_check(kind, p, adapted_only=True))
    return d.filter("_p.keep").select("o_orderkey", "_p.status")


@query("""SELECT o_orderkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' OR starts_with(o_orderpriority, '1')
    OR starts_with(o_orderpriority, '2')""")
def nature_prefix(spark, sf):
    p = F.col("o_orderpriority")
    nature = F.when(p.startswith("1") | p.startswith("2"), F.concat(F.lit(" APPELOFFRE/"), p)).when(
        p == "4-NOT SPECIFIED", None).otherwise(F.concat(F.lit("attribution/"), p))
    return orders(spark, sf).filter(~K.not_an_open_call(nature)).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE lower(p_type) NOT IN ('promo', 'small')")
def category_set(spark, sf):
    return read(spark, sf, "part").filter(~K.category_out(F.col("p_type"), ("promo", "small"))).select("p_partkey")


@query("""SELECT p_partkey, regexp_matches(lower(p_name), 'anvil|rod') AS generic,
    regexp_replace(concat(p_name, '/', p_brand), '[^A-Za-z0-9_.-]', '_', 'g') AS safe, p_brand AS head,
    p_size % 10 IN (4, 5, 6, 7, 8) AS year_ok FROM part""")
def name_filters(spark, sf):
    c = F.col
    file = F.concat(F.translate(c("p_name"), " ", "_"), F.lit("-x.pdf"))
    dated = F.concat(F.lit("ppm-12-"), F.when(c("p_size") % 2 == 0, F.concat(F.lit("202"), c("p_size") % 10))
                     .otherwise(F.concat(F.lit("2"), c("p_size") % 10)), F.lit(".pdf"))
    d = read(spark, sf, "part").withColumns({"file": file, "dated": dated})
    return d.select("p_partkey", K.generic_document("file", book()).alias("generic"),
                    X.safe_name(F.concat("p_name", F.lit("/"), "p_brand")).alias("safe"),
                    X.reference_head(F.concat("p_brand", F.lit(" - "), "p_name", F.lit(" - x"))).alias("head"),
                    K.year_in_name(c("dated"), 2024).alias("year_ok"))


# --- domain ----------------------------------------------------------------------------------------

def s_domain(text: str, prefix: str, codes: bool) -> str:
    def a(n: str) -> str:
        return s_any(text, prefix + n)
    word = f"({a('domain_strong')} OR ({a('ambiguous')} AND {a('domain_context')}))"
    bought = f"(({a('purchase')} OR ({a('supply')} AND NOT {a('supply_exempt')})) AND {a('goods')})"
    coded = (f"WHEN target AND excluded THEN 'à vérifier' "
             f"WHEN target THEN CASE WHEN {a('domain_out')} AND NOT {word} THEN 'à vérifier' ELSE 'IT confirmé' END "
             f"WHEN excluded THEN CASE WHEN {word} THEN 'à vérifier' ELSE 'hors IT' END ") if codes else ""
    return (f"CASE WHEN NOT {a('ambiguous')} AND ({bought} OR {a('out_phrase')}) THEN 'hors IT' {coded}"
            f"WHEN {word} AND {a('domain_out')} THEN 'à vérifier' WHEN {word} THEN 'IT confirmé' "
            f"WHEN {a('domain_out')} THEN 'hors IT' WHEN {a('ambiguous')} THEN 'hors IT' ELSE 'à vérifier' END")


S_CODED = f"""SELECT doc_id, source, text, lower({S_TITLE}) AS x, concat(lower({S_TITLE}), '  ', lower(text)) AS y, source IN ('src1', 'src2') AS target,
    source IN ('src2', 'src6') AS excluded FROM documents"""


def coded_titles(spark, sf):
    """Titles as subjects, whole texts as descriptions; two sources carry codes in scope, two carry excluded ones."""
    s = F.col("source")
    codes = (F.when(s == "src1", F.array(F.lit("72100"))).when(s == "src2", F.array(F.lit("48000"), F.lit("45000")))
             .when(s == "src6", F.array(F.lit("45200"))))
    return docs(spark, sf).withColumn("codes", codes).transform(once, "_x", X.analysis_text(F.col("title"), F.array().cast("array<string>"), F.col("text")))


@query(f"SELECT doc_id, {s_domain('y', '', True)} AS domain FROM ({S_CODED})")
def notice_domain(spark, sf):
    d = coded_titles(spark, sf)
    return d.select("doc_id", O.domain_by_codes_and_words(
        book(), "_x", O.prefix_sql("codes", ["72", "48"]), O.prefix_sql("codes", ["45"])).alias("domain"))


@query(f"SELECT doc_id, {s_domain('lower(text)', 'w_', False)} AS domain FROM documents")
def notice_domain_words(spark, sf):
    return docs(spark, sf).withColumn("_x", F.lower("text")).select("doc_id", O.domain_by_words(book(), "_x").alias("domain"))


S_NOTICES = f"""SELECT d.*, o_totalprice AS amount, o_orderpriority AS p, o_orderstatus AS st,
    CAST(o_orderdate AS DATE) AS deadline FROM ({S_CODED}) d JOIN orders ON o_orderkey = doc_id"""


def notices(spark, sf):
    """Titles with the fields of the order of the same number, in the notice schema."""
    c = F.col
    o = orders(spark, sf).select(F.col("o_orderkey").alias("doc_id"), "o_totalprice", "o_orderpriority", "o_orderstatus",
                                 "o_orderdate")
    p, st = c("o_orderpriority"), c("o_orderstatus")
    d = coded_titles(spark, sf).join(o, "doc_id")
    return O.conform(
        d, seq=c("doc_id"), id=c("doc_id"), source=c("source"), subject=c("title"), description=c("text"), codes=c("codes"),
        framework=p == "1-URGENT", amount=F.format_string("%.2f €", "o_totalprice"),
        deadline=F.date_format("o_orderdate", "yyyy-MM-dd"),
        market_type=F.when(st == "F", F.array(F.lit(L.GOODS))).when(st == "O", F.array(F.lit(L.GOODS), F.lit(L.SERVICES))),
        nature=F.when(p == "3-MEDIUM", "attribution/x").when(p == "5-LOW", "appeloffre/y"),
        procedure_type=F.when(p == "2-HIGH", "OUVERT"), procedure_text=F.when(p == "2-HIGH", "Procédure ouverte"),
        category=F.when(st == "F", " Travaux"))


@query(f"""SELECT doc_id, domain, CASE WHEN p = '2-HIGH' THEN 'Procédure ouverte' ELSE 'procédure à vérifier' END AS procedure_status
  FROM (SELECT *, {s_domain("y", '', True)} AS domain FROM ({S_NOTICES}))
  WHERE NOT (p = '1-URGENT' AND amount > 200000) AND st <> 'F' AND deadline - DATE '1997-01-01' >= 7 AND p <> '3-MEDIUM'
    AND domain <> 'hors IT'""")
def notice_screening(spark, sf):
    d = O.screen_national(notices(spark, sf), book(), F.lit("1997-01-01").cast("date"), 200000, ["72", "48"], ["45"])
    return O.in_domain_order(d).select(F.col("seq").alias("doc_id"), "domain", "procedure_status")


@query(f"""SELECT doc_id, domain FROM (SELECT *, {s_domain("y", '', True)} AS domain FROM ({S_NOTICES}))
  WHERE NOT amount >= 300000 AND st <> 'F' AND deadline - DATE '1997-01-01' >= 7 AND domain <> 'hors IT'""")
def planned_screening(spark, sf):
    d = O.screen_planned(notices(spark, sf), book(), F.lit("1997-01-01").cast("date"), 300000, ["72", "48"], ["45"])
    return O.in_domain_order(d).select(F.col("seq").alias("doc_id"), "domain")


@query(f"""SELECT doc_id, domain FROM (SELECT *, {s_domain("x", 'w_', False)} AS domain FROM ({S_NOTICES}))
  WHERE st = 'P' AND deadline - DATE '1997-01-01' >= 7 AND domain <> 'hors IT'""")
def regional_screening(spark, sf):
    d = O.screen_regional(notices(spark, sf), book(), F.lit("1997-01-01").cast("date"))
    return O.in_domain_order(d).select(F.col("seq").alias("doc_id"), "domain")


@query(f"""SELECT domain, count(*) AS n FROM (SELECT {s_domain('y', '', True)} AS domain FROM ({S_CODED})) GROUP BY domain""")
def domain_counts(spark, sf):
    return count_by(notice_domain(spark, sf), "domain")


# --- normalisation ---------------------------------------------------------------------------------

@query("""SELECT concat('MA-', CASE WHEN c_custkey % 3 = 0 THEN md5(concat('Objet ', c_name)) ELSE CAST(c_custkey AS VARCHAR) END) AS id,
    CASE WHEN c_custkey % 3 = 0 THEN 'non précisé' ELSE CAST(c_custkey AS VARCHAR) END AS reference,
    concat('Objet ', c_name) AS subject, c_mktsegment AS buyer,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '2024-03-05' END AS deadline FROM customer WHERE c_custkey % 5 <> 4""")
def notice_normalised(spark, sf):
    c, k = F.col, F.col("c_custkey")
    subject = F.concat(F.lit("Objet "), c("c_name"))
    raw = read(spark, sf, "customer").select(
        k.alias("seq"), F.when(k % 3 != 0, k.cast("string")).alias("reference"),
        F.when(k % 5 == 4, "objet :  ").when(k % 2 == 0, F.concat(F.lit("Objet : "), subject))
        .otherwise(F.concat(F.lit("Obj ... "), subject)).alias("objet"),
        F.concat(F.lit("Acheteur public : "), c("c_mktsegment")).alias("acheteur"), F.lit(None).cast("string").alias("categorie"),
        F.lit(None).cast("string").alias("procedure"), F.lit(None).cast("string").alias("lieu"),
        F.lit("05-03-2024").alias("date_publication"),
        F.when(k % 4 == 0, "bientôt").when(k % 4 == 1, "05/03/2024 10:00").otherwise("5 mars 2024").alias("date_limite"),
        F.lit("u").alias("detail_url"))
    return O.regional_notices(raw, "MA-", "PMMP", "Maroc", "MAD").select("id", "reference", "subject", "buyer", "deadline")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'AMI' END AS type, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS country,
    CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' - lot 2') ELSE concat('Ami ', p_name) END AS subject FROM part""")
def title_parts(spark, sf):
    t = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("AMI - "), "p_brand", F.lit(" - "), "p_name", F.lit(" - lot 2"))
               ).otherwise(F.concat(F.lit("Ami "), "p_name"))
    return read(spark, sf, "part").withColumn("t", O.title_parts(t)).select("p_partkey", "t.type", "t.country", "t.subject")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) END AS value,
    CASE WHEN o_orderstatus = 'F' THEN 'ok' WHEN o_orderstatus = 'O' THEN 'pré-rempli' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'non précisé' END AS shown FROM orders""")
def prefilled_fields(spark, sf):
    st = F.col("o_orderstatus")
    syn = F.when(st == "F", F.col("o_orderpriority")).when(st == "O", "  ")
    structured = F.when(st == "O", F.col("o_custkey").cast("string")).when(st == "P", "")
    value, status = O.prefilled(syn, structured, F.when(st == "F", "ok"))
    return orders(spark, sf).select("o_orderkey", value.alias("value"), status.alias("status"), O.or_unspecified(syn).alias("shown"))


@query("""SELECT o_orderkey, o_orderstatus, c_acctbal AS deposit FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_totalprice > 400000""")
def enrich_survivors(spark, sf):
    s = orders(spark, sf).filter("o_totalprice > 400000").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("k"))
    d = read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("deposit"))
    return O.enrich_survivors(s, d, "k", ["deposit"], "o_orderkey").drop("k")


@query(f"""WITH h AS (SELECT doc_id, text, list_filter(list_transform({s_list(SUBSTRING_SETS['recall'])}, lambda t: struct_pack(
    a := instr(lower(text), t), n := length(t))), lambda h: h.a > 0)[1] AS h FROM documents)
  SELECT concat('PPS-', doc_id) AS id, trim(regexp_replace(CASE WHEN lo = 0 AND hi >= length(text) THEN cut ELSE concat('…', cut, '…') END,
    '\\s+', ' ', 'g')) AS subject
  FROM (SELECT doc_id, text, greatest(0, h.a - 1 - 75) AS lo, least(length(text), h.a - 1 + 75 + h.n) AS hi,
    substring(text, greatest(0, h.a - 1 - 75) + 1, least(length(text), h.a - 1 + 75 + h.n) - greatest(0, h.a - 1 - 75)) AS cut
    FROM h WHERE h IS NOT NULL)""")
def document_hits(spark, sf):
    d = docs(spark, sf).select(F.col("doc_id").alias("id"), "text")
    return O.document_hits(d, SUBSTRING_SETS["recall"], "PPS-").select("id", "subject")


@query(f"""SELECT min(doc_id) AS seq, id FROM (SELECT doc_id, concat('S-', doc_id % 300) AS id FROM documents
  WHERE lang IN ('fr', 'de') AND {s_any(f"lower({S_TITLE})", 'recall')}) GROUP BY id""")
def source_chain(spark, sf):
    """One source from raw rows to records: normalise, country, recall words, first per id."""
    from tendersift.operators.postings import source_chain as chain

    def normalise(raw):
        c = F.col
        return O.conform(raw, seq=c("doc_id"), id=F.concat(F.lit("S-"), c("doc_id") % 300), subject=c("title"),
                         place=F.when(c("lang").isin("fr", "de"), "Côte d’Ivoire").otherwise("Togo"))
    return chain(docs(spark, sf), normalise, book(), "recall", country="cote d'ivoire").select("seq", "id")
