"""Queries for the normalisers of single sources, tables read by their headers, card flags and the sniff of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.operators import notices as O
from tendersift.operators import postings as C
from tendersift.plans.queries_notices import _MONTHS, orders
from tendersift.plans.queries_text import payloads
from tendersift.plans.registry import ORACLE, S_TITLE, book, docs, q, query, read, s_any, s_terms
from tendersift.rules import SUBSTRING, Rule
from tendersift.sources import readers

S_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@query(f"""SELECT o_orderkey AS seq, concat('24-', o_orderkey) AS id, 'BOAMP' AS source, {S_DAY} AS published,
    CASE WHEN o_orderstatus <> 'O' THEN {S_DAY} END AS deadline, concat('Client ', o_custkey) AS buyer,
    CASE WHEN o_orderstatus <> 'P' THEN concat(o_custkey % 95, ', 75') END AS department, o_orderpriority AS subject,
    concat(o_orderstatus, '|', o_orderpriority) AS descriptors, 'SERVICES' AS market_type, codes, v.amount, v.currency, framework, link AS profile_link,
    criteria, duration, concat('http://avis/', o_orderkey) AS notice_url, CAST(NULL AS VARCHAR) AS category
  FROM orders JOIN ({ORACLE['payload_values']}) v USING (o_orderkey) JOIN ({ORACLE['criteria_text']}) t USING (o_orderkey)""")
def national_normalised(spark, sf):
    """Rows of the main feed with a nested payload of three schemas, or a broken one."""
    c = F.col
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = payloads(spark, sf, "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate").select(
        c("o_orderkey").alias("seq"), F.concat(F.lit("24-"), "o_orderkey").alias("idweb"), day.alias("dateparution"),
        F.when(c("o_orderstatus") != "O", day).alias("datelimitereponse"), F.concat(F.lit("Client "), "o_custkey").alias("nomacheteur"),
        F.when(c("o_orderstatus") != "P", F.array((c("o_custkey") % 95).cast("string"), F.lit("75"))).alias("code_departement"),
        c("o_orderpriority").alias("objet"), F.lit("Procédure ouverte").alias("procedure_libelle"), F.lit("OUVERT").alias("type_procedure"),
        F.array(F.lit("SERVICES")).alias("type_marche"), F.lit("APPEL_OFFRE").alias("nature_categorise"),
        F.lit("Avis").alias("nature_categorise_libelle"), F.array("o_orderstatus", "o_orderpriority").alias("descripteur_libelle"),
        F.concat(F.lit("http://avis/"), "o_orderkey").alias("url_avis"), c("payload").alias("donnees"))
    d = O.national_notices(raw)
    return d.select("seq", "id", "source", "published", "deadline", "buyer", "department", "subject", F.array_join("descriptors", "|").alias("descriptors"),
                    F.array_join("market_type", "|").alias("market_type"), F.array_join("codes", ",").alias("codes"), "amount", "currency",
                    "framework", "profile_link", "criteria", "duration", "notice_url", "category")


@query(f"""SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 3 > 0 THEN concat('PLACE-', o_orderkey) END AS id, CASE WHEN o_orderkey % 3 > 0 THEN
    CAST(o_orderkey AS VARCHAR) END AS reference, 'PLACE' AS source, CASE WHEN o_orderstatus = 'F' THEN 'Intitulé' ELSE o_orderpriority END AS subject,
    {S_DAY} AS published, CASE WHEN o_orderstatus <> 'P' THEN {S_DAY} END AS deadline,
    CASE WHEN o_custkey % 2 = 0 THEN 'http://rc/' ELSE 'http://consultation/' END || o_orderkey AS notice_url FROM orders""")
def portal_normalised(spark, sf):
    """Portal rows: dates in three parts (two parts are no date), ids only with a reference, the better of two links."""
    c = F.col
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTHS]), F.month("o_orderdate"))
    parts = F.array(F.dayofmonth("o_orderdate").cast("string"), month, F.year("o_orderdate").cast("string"))
    k = c("o_orderkey") % 3
    raw = orders(spark, sf).select(
        c("o_orderkey").alias("seq"), F.when(k == 2, c("o_orderkey").cast("string")).when(k == 1, c("o_orderkey").cast("string")).when(
            c("o_custkey") % 2 == 0, "").alias("reference"), F.when(c("o_orderstatus") == "F", "").otherwise(c("o_orderpriority")).alias("objet"),
        F.lit("Intitulé").alias("intitule"), F.lit("Organisme").alias("organisme"), F.lit("Paris").alias("lieu"), F.lit("AO").alias("procedure_abbr"),
        F.lit("Appel d'offres").alias("procedure_libelle"), F.lit("Services").alias("categorie"), parts.alias("date_pub"),
        F.when(c("o_orderstatus") == "P", F.slice(parts, 1, 2)).otherwise(parts).alias("date_limite"),
        F.when(c("o_custkey") % 2 == 0, F.concat(F.lit("http://rc/"), "o_orderkey")).otherwise("").alias("rc_url"),
        F.concat(F.lit("http://consultation/"), "o_orderkey").alias("consult_url"))
    return O.portal_notices(raw, "PLACE").select("seq", "id", "reference", "source", "subject", "published", "deadline", "notice_url")


@query("""SELECT doc_id AS seq, concat('AP-', doc_id) AS id, 'APProch' AS source, split_part(text, chr(10), 1) AS subject, md5(text) AS description,
    concat('72', doc_id % 10, '|48') AS codes, concat(n_chars, ' euros') AS amount, CAST(NULL AS DOUBLE) AS amount_value, lang AS category,
    source AS buyer, CAST(NULL AS VARCHAR) AS published FROM documents""")
def planned_normalised(spark, sf):
    """Planned purchases with whole descriptions (shown by their digest); the amount stays the text it was."""
    c = F.col
    raw = docs(spark, sf).select(
        c("doc_id").alias("seq"), F.concat(F.lit("AP-"), "doc_id").alias("id"), c("title").alias("objet"), c("text").alias("description"),
        F.array(F.concat(F.lit("72"), c("doc_id") % 10), F.lit("48")).alias("cpv"), F.concat("n_chars", F.lit(" euros")).alias("montant_estime"),
        c("lang").alias("categorie_achat"), c("source").alias("acheteur"), F.lit(None).cast("string").alias("date_limite"),
        F.lit(None).cast("string").alias("date_publication"))
    return O.planned_notices(raw).select("seq", "id", "source", "subject", F.md5(c("description").cast("binary")).alias("description"),
                                         F.array_join("codes", "|").alias("codes"), "amount", "amount_value", "category", "buyer", "published")


HEADERS = ["Objet du marché", "Autorité Contractante", "Ligne Budgétaire", "Bailleur", "Date de publication (j)"]


@query(f"""WITH r AS (SELECT *, max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS h FROM orders),
  v AS (SELECT o_orderkey, CASE WHEN h % 2 = 0 THEN o_orderpriority ELSE concat('Client ', o_custkey) END AS subject,
    CASE WHEN h % 2 = 0 THEN concat('Client ', o_custkey) ELSE o_orderpriority END AS buyer,
    CASE WHEN o_orderkey % 3 > 0 THEN concat('7 1 ', o_orderkey) END AS line, o_orderstatus AS funder, {S_DAY} AS published
    FROM r WHERE h IS NOT NULL AND o_orderstatus <> 'P' AND o_orderkey % 7 <> 0)
  SELECT o_orderkey AS seq, concat('CI-PPM-', coalesce(replace(line, ' ', ''), md5(regexp_replace(concat(buyer, subject), '[^A-Za-z0-9_]+', '', 'g')))) AS id,
    subject, buyer, funder, coalesce(line, {q(L.UNSPECIFIED)}) AS reference, published FROM v""")
def forecast_rows(spark, sf):
    """Extracted table rows under headers that repeat and change order; rows without a header above and short rows go."""
    c = F.col
    swapped = [HEADERS[1], HEADERS[0], *HEADERS[2:]]
    header = F.when(c("o_orderkey") % 2 == 0, F.array(*[F.lit(h) for h in HEADERS])).otherwise(F.array(*[F.lit(h) for h in swapped]))
    line = F.when(c("o_orderkey") % 3 > 0, F.concat(F.lit("7 1 "), "o_orderkey")).otherwise("")
    cells = F.array("o_orderpriority", F.concat(F.lit("Client "), "o_custkey"), line, "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = orders(spark, sf).select(
        c("o_custkey").alias("doc"), c("o_orderkey").alias("row_no"),
        F.when(c("o_orderstatus") == "P", header).when(c("o_orderkey") % 7 == 0, F.slice(cells, 1, 2)).otherwise(cells).alias("cells"))
    found = readers.columns_by_fragment(readers.table_rows(rows, "objet"), {h: [h] for h in HEADERS}, HEADERS)
    return O.forecasts(found.withColumnRenamed("row_no", "seq"), "PPM", "Pays").select(
        "seq", "id", "subject", "buyer", "funder", "reference", "published")


LABEL_TERMS = ["de", "es"]
S_OFFER = f"concat(' ', lower({S_TITLE}), ' ', lower(text), ' ')"
S_CARD = f"concat(' ', lower({S_TITLE}), ' ', lower(source), ' ', lower(text), ' ')"


def cards(spark, sf):
    return docs(spark, sf).select("doc_id", "title", F.col("text").alias("body"), F.col("source").alias("entity"), F.col("lang").alias("contract_label"))


@query(f"""SELECT doc_id, {s_any(S_OFFER, 'domain_ok')} AS is_role, {s_any(S_CARD, 'sector')} AS in_sector,
    ({s_any(S_OFFER, 'strong')} OR {s_terms('lower(lang)', LABEL_TERMS)}) AS contract, {s_any("concat(' ', lower(source), ' ')", 'end_client')} AS sector_employer
  FROM documents""")
def card_flags(spark, sf):
    """The older flags of a card, over whole bodies."""
    return C.card_flags(cards(spark, sf), book().with_set("contract_label", [Rule("contract_label", t, SUBSTRING) for t in LABEL_TERMS])).select("doc_id", "is_role", "in_sector", "contract", "sector_employer")


@query(f"""SELECT doc_id FROM documents WHERE {s_any(f"concat(' ', lower({S_TITLE}), ' ', lower(source), ' ')", 'tech_stack')}
  OR {s_any(f"concat(' ', lower({S_TITLE}), ' ', lower(source), ' ')", 'end_client')}""")
def worth_reading(spark, sf):
    """Cards that title or publisher make worth a detail."""
    return C.worth_reading(cards(spark, sf).drop("body"), book(), ["tech_stack", "end_client"]).select("doc_id")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR (doc_id % 4 = 2 AND starts_with(text, 'F')) THEN 'pdf' WHEN doc_id % 4 = 1 THEN 'zip' ELSE 'type non supporté' END AS kind FROM documents""")
def document_kinds(spark, sf):
    """Whole documents as bytes behind four kinds of first bytes, one cut short of its mark."""
    k = F.col("doc_id") % 4
    mark = F.when(k == 0, F.lit(b"%PDF-1.7\n")).when(k == 1, F.lit(b"PK\x03\x04")).when(k == 2, F.lit(b"%PD")).otherwise(F.lit(b"\x00"))
    d = read(spark, sf, "documents").withColumn("content", F.concat(mark, F.coalesce("text", F.lit("")).cast("binary")))
    return d.select("doc_id", readers.sniff(F.col("content")).alias("kind"))
