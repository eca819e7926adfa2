"""Queries of the posting screen and of cross-record signals, on documents joined to orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.operators import cross as C
from tendersift.operators import reports as R
from tendersift.operators.classify import classify_postings
from tendersift.operators.cross import (apply_never_qualifying, drop_duplicates_first, never_qualifying,
                                        recurring_groups)
from tendersift.plans.registry import (once, S_TITLE, TODAY, W, book, docs, first_line, padded, q, query, read, s_any, s_fold,
                                       s_list, s_title_key, today)
from tendersift.plans.sample_rules import FOLDED_SETS, SUBSTRING_SETS
from tendersift.plans.screen import screen
from tendersift.scale import attach_by_key, keep_last
from tendersift.session import cut_lineage


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as postings. The order with the same number gives the date and the status flags:
    finished orders carry a date, open ones a relative age, pending ones no date at all."""
    o = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published"),
        F.when(F.col("o_orderstatus") == "O",
               F.concat(F.lit("il y a "), F.col("o_custkey") % 120, F.lit(" jours"))).alias("posted_relative"),
        (F.col("o_orderpriority") == "1-URGENT").alias("closed"),
        (F.col("o_orderpriority") == "5-LOW").alias("reposted"),
        (F.col("o_orderpriority") == "4-NOT SPECIFIED").alias("open_confirmed"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "Contrat").alias("contract_label"))
    d = docs(spark, sf).join(o, "doc_id", "left")
    return d.select(
        F.col("doc_id").alias("seq"), "source", F.concat(F.lit("https://x.test/"), "doc_id").alias("url"),
        "title", F.col("source").alias("entity"), F.lit("").alias("place"), "published",
        "posted_relative", F.col("text").alias("body"), "contract_label", F.lit(None).cast("int").alias("applicants"),
        F.lit(None).cast("string").alias("applicants_text"), "closed", "reposted", "open_confirmed",
        F.lit(None).cast("string").alias("mission"), F.lit(None).cast("string").alias("work_mode"),
        F.lit(None).cast("string").alias("duration"))


def _has(col: str, *sets: str) -> str:
    return "(" + " OR ".join(s_any(col, s) for s in sets) + ")"


_CERT = f"len(list_filter({s_list(SUBSTRING_SETS['certification'])}, lambda t: contains(s, t))) >= 3"
_OTHERS = s_list(FOLDED_SETS["sector_list"])
_GENERIC = "(" + " OR ".join(f"contains(p, {q(t)})" for t in SUBSTRING_SETS["sector_generic"]) + ")"

# Views shared by the SQL of this module: postings, texts, decisions per posting, cross signals.
S_POSTINGS = f"""
posting AS (
  SELECT d.doc_id AS seq, d.source AS entity, {S_TITLE.replace('text', 'd.text')} AS title, d.text AS body,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
         WHEN o_orderstatus = 'O' THEN CAST(DATE '{TODAY}' - CAST(o_custkey % 120 AS INTEGER) AS DATE) END AS day,
    coalesce(o_orderpriority = '1-URGENT', false) AS closed, coalesce(o_orderpriority = '5-LOW', false) AS reposted,
    coalesce(o_orderpriority = '4-NOT SPECIFIED', false) AS sure, coalesce(o_orderpriority = '2-HIGH', false) AS label
  FROM documents d LEFT JOIN orders ON o_orderkey = d.doc_id),
views AS (
  SELECT *, concat(' ', lower(title), ' ') AS t, concat(' ', lower(body), ' ') AS b, concat(' ', lower(entity), ' ') AS e,
    concat(' ', lower(title), ' . ', lower(body), ' ') AS o,
    concat(' ', lower(title), ' ', lower(body), ' ', lower(entity), ' ') AS a,
    concat(' ', lower(title), ' ', lower(body), ' ') AS s,
    CAST(DATE '{TODAY}' - day AS INTEGER) AS age,
    trim({s_fold('entity')}) AS entity_key, {s_title_key('title')} AS title_norm, md5(trim(body)) AS dedup_text
  FROM posting),
flags AS (
  SELECT *, {_has('o', 'strong', 'reference_code')} AS strong, {_has('o', 'weak')} AS weak, {_has('o', 'b2b')} AS b2b
  FROM views),
classified AS (
  SELECT seq, entity, title, entity_key, title_norm, dedup_text, age, closed, reposted, sure,
    strong OR weak OR b2b AS has_signal, {_has('t', 'broad_signal')} AS lead,
    CASE WHEN {_has('o', 'contract_form')} THEN 'recrutement'
      WHEN {_has('o', 'salary')} AND NOT ({_has('o', 'b2b_strong')} OR label) THEN 'recrutement'
      WHEN {_has('e', 'staff_only')} THEN CASE WHEN strong AND (b2b OR label) THEN 'mission_regie' ELSE 'recrutement' END
      WHEN {_has('e', 'end_client')} THEN CASE WHEN strong AND (b2b OR label) THEN 'mission_regie'
           WHEN strong THEN 'a_confirmer' ELSE 'recrutement' END
      WHEN strong OR weak THEN 'mission_regie'
      WHEN {_has('b', 'career')} AND NOT (b2b OR label) THEN 'recrutement'
      ELSE 'a_confirmer' END AS kind,
    CASE WHEN {_has('a', 'sector', 'sector_word')} THEN
        CASE WHEN {_has('a', 'sector_negative')} AND NOT {_has('a', 'sector_strong')} THEN 'NON'
          WHEN NOT {_has('t', 'sector_generic')} AND NOT {_has('a', 'sector_specific', 'sector_word')}
            AND len(list_filter(regexp_split_to_array(a, '[.!?;\\n\\r]+'), lambda p: {_GENERIC})) > 0
            AND len(list_filter(regexp_split_to_array(a, '[.!?;\\n\\r]+'), lambda p: {_GENERIC}
                 AND len(list_filter({_OTHERS}, lambda x: contains({s_fold('p')}, x))) < 3)) = 0 THEN 'NON'
          ELSE 'OUI' END
      WHEN {_has('e', 'agency')} THEN CASE WHEN {_has('a', 'other_sector')} THEN 'NON' ELSE 'PROBABLE' END
      ELSE 'NON' END AS sector,
    {_has('t', 'hard_out')} OR ({_has('t', 'acceptance')} AND NOT {_has('t', 'acceptance_ok')})
      OR ({_has('s', 'narrow_tech')} AND NOT {_has('s', 'narrow_signal')})
      OR (({_has('s', 'acronym')} OR {_has('t', 'title_acronym')}) AND NOT {_has('s', 'broad_signal')})
      OR ({_has('s', 'infra')} AND NOT {_has('s', 'narrow_signal')}) OR {_CERT} OR {_has('b', 'regulatory')} AS early_out,
    {_has('t', 'core')} AS core_t, {_has('t', 'domain_ok')} AS ok_t, {_has('t', 'tech_stack')} AS tech_t,
    {_has('b', 'core')} AS core_b, {_has('b', 'domain_ok')} AS ok_b,
    {_has(s_fold("concat(title, ' ')"), 'area_out')} OR {_has('e', 'blocked_entity')} AS barred
  FROM flags),
scoped AS (
  SELECT *, NOT early_out AND NOT barred AND (core_t OR (NOT tech_t AND core_b)) AS core,
    NOT early_out AND NOT barred AND CASE WHEN core_t THEN ok_t ELSE NOT tech_t AND (ok_t OR ok_b) END AS domain_ok,
    early_out OR barred OR (NOT core_t AND (tech_t OR NOT (core_b OR ok_t OR ok_b))) AS out_of_scope,
    CASE WHEN closed THEN 'ÉCARTÉE (clôturée)'
      WHEN age IS NULL THEN CASE WHEN sure THEN 'OUVERTE' ELSE 'INCONNUE' END
      WHEN age <= 7 THEN 'NOUVEAU' WHEN age <= 21 THEN 'OUVERTE' WHEN reposted THEN 'ROUVERTE'
      WHEN sure AND age <= 90 THEN 'VIVIER' ELSE 'AGEE' END AS window0
  FROM classified),
kept AS (
  SELECT * FROM scoped
  QUALIFY row_number() OVER (PARTITION BY entity_key, title_norm, dedup_text ORDER BY seq) = 1),
crossed AS (
  SELECT * REPLACE (CASE WHEN entity_key <> '' AND count(*) OVER pub >= 3
                          AND sum(CAST(has_signal AS INTEGER)) OVER pub = 0 THEN 'recrutement' ELSE kind END AS kind),
    title_norm <> '' AND count(*) OVER (PARTITION BY entity_key, title_norm) >= 2 AS recurring
  FROM kept WINDOW pub AS (PARTITION BY entity_key)),
windowed AS (
  SELECT *, CASE WHEN window0 = 'AGEE' AND recurring AND age <= 90 THEN 'VIVIER' ELSE window0 END AS window_ FROM crossed),
verdicts AS (
  SELECT *, CASE WHEN out_of_scope OR sector = 'NON' OR kind = 'recrutement' OR window_ = 'ÉCARTÉE (clôturée)' THEN 'ÉCARTÉE'
      WHEN window_ = 'VIVIER' THEN 'VIVIER' WHEN window_ IN ('AGEE', 'INCONNUE') THEN 'ÉCARTÉE'
      WHEN kind = 'mission_regie' AND (core OR lead) THEN '★★ MATCH CŒUR'
      WHEN kind = 'mission_regie' AND domain_ok THEN '★ À SAISIR'
      WHEN kind = 'a_confirmer' AND sector = 'PROBABLE' THEN '★ À SAISIR'
      WHEN kind = 'a_confirmer' THEN 'À CONFIRMER' ELSE '★ À SAISIR' END AS verdict,
    CASE WHEN out_of_scope THEN 'hors domaine' WHEN sector = 'NON' THEN 'hors banque'
      WHEN kind = 'recrutement' THEN 'CDI / recrutement interne' WHEN window_ = 'ÉCARTÉE (clôturée)' THEN 'clôturée'
      WHEN window_ = 'VIVIER' THEN 'besoin récurrent du cabinet' WHEN window_ = 'AGEE' THEN 'âge'
      WHEN window_ = 'INCONNUE' THEN 'date inconnue' ELSE '' END AS reason
  FROM windowed)"""


def with_views(select: str) -> str:
    return f"WITH {S_POSTINGS}\n{select}"


@query(with_views("""SELECT seq, entity, kind, sector, core, domain_ok, out_of_scope, age, window_ AS "window", recurring,
  verdict, reason FROM verdicts"""))
def screen_verdicts(spark, sf):
    """The whole screen, one row per kept posting."""
    return screen(postings(spark, sf), book(), today()).select(
        "seq", "entity", "kind", "sector", "core", "domain_ok", "out_of_scope", "age", "window", "recurring",
        "verdict", "reason")


@query(with_views("""SELECT verdict, count(*) AS n, CASE verdict WHEN '★★ MATCH CŒUR' THEN 0 WHEN '★ À SAISIR' THEN 1
  WHEN 'À CONFIRMER' THEN 2 WHEN 'VIVIER' THEN 3 ELSE 4 END AS rank FROM verdicts GROUP BY verdict"""))
def verdict_counts(spark, sf):
    return R.verdict_counts(screen(postings(spark, sf), book(), today()))


@query(with_views("""SELECT source, count(*) AS n, CAST(sum(CAST(verdict NOT IN ('ÉCARTÉE', 'VIVIER') AS INTEGER)) AS BIGINT) AS n_publishable,
  CAST(sum(CAST(verdict NOT IN ('ÉCARTÉE', 'VIVIER') AND v.seq NOT IN (SELECT doc_id FROM labels) AS INTEGER)) AS BIGINT) AS n_new
  FROM verdicts v JOIN documents d ON d.doc_id = v.seq GROUP BY source"""))
def run_summary(spark, sf):
    """Totals of a run per source; labelled documents count as seen before."""
    known = read(spark, sf, "labels").select(F.col("doc_id").alias("seq"), F.lit(True).alias("_k"))
    d = screen(postings(spark, sf), book(), today()).join(known, "seq", "left")
    return R.run_summary(d.withColumn("is_new", F.col("_k").isNull()), "source")


def kept_postings(spark, sf):
    return drop_duplicates_first(classify_postings(postings(spark, sf), book(), today()))


@query(with_views("SELECT seq, entity_key, title_norm FROM kept"))
def dedup_first(spark, sf):
    """First of each (publisher, title, opening of the text)."""
    return kept_postings(spark, sf).select("seq", "entity_key", "title_norm")


@query("""SELECT text_key, max(doc_id) AS last_id, max_by(source, doc_id) AS last_source
  FROM (SELECT doc_id, source, sha256(text) AS text_key FROM documents) GROUP BY text_key""")
def dedup_last(spark, sf):
    """A fresh record replaces the older one of the same key."""
    d = read(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("text_key"))
    return keep_last(d, ["text_key"], ["doc_id"]).select("text_key", F.col("doc_id").alias("last_id"),
                                                         F.col("source").alias("last_source"))


@query("""SELECT user_id, event_type, count(*) AS n_same FROM events WHERE event_type <> '' GROUP BY ALL
  HAVING count(*) >= 2""")
def recurring_need(spark, sf):
    d = read(spark, sf, "events").select(F.col("user_id").cast("string").alias("entity_key"),
                                         F.col("event_type").alias("title_norm"))
    return recurring_groups(d).select(F.col("entity_key").cast("long").alias("user_id"),
                                      F.col("title_norm").alias("event_type"), "n_same")


@query("""SELECT event_id, user_id, n_same IS NOT NULL AS recurring FROM events LEFT JOIN
  (SELECT user_id, event_type, count(*) AS n_same FROM events GROUP BY ALL HAVING count(*) >= 15) s USING (user_id, event_type)""")
def recurring_marked(spark, sf):
    """Group sizes joined back to the rows, hot groups apart."""
    d = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    s = d.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_same")).filter("n_same >= 15")
    return attach_by_key(d, s, ["user_id", "event_type"], "n_same", "event_id").select(
        "event_id", "user_id", F.col("n_same").isNotNull().alias("recurring"))


@query(f"""SELECT source AS entity_key, count(*) AS n_postings, CAST(0 AS BIGINT) AS n_signals
  FROM (SELECT source, {s_any("concat(' ', lower(text), ' ')", "reference_code")} AS sig FROM documents)
  GROUP BY source HAVING count(*) >= 3 AND sum(CAST(sig AS INTEGER)) = 0""")
def never_qualifies(spark, sf):
    """Sources with three or more documents and no signal term in any of them."""
    d = docs(spark, sf).transform(once, "_p", padded()).select(F.col("source").alias("entity_key"),
                                                          book().hit("reference_code", "_p").alias("has_signal"))
    return never_qualifying(d)


_VOCAB = s_list(sorted(SUBSTRING_SETS["signature"]))
S_GROUPS = with_views(f""", elig AS (
  SELECT seq, entity_key, age, row_number() OVER (ORDER BY seq) AS rn, sig FROM (
    SELECT seq, entity_key, age, list_filter({_VOCAB}, lambda v: contains({s_fold('title')}, v)) AS sig FROM kept
    WHERE kind IN ('mission_regie', 'a_confirmer')) WHERE len(sig) >= 2),
edge AS (SELECT a.rn AS i, b.rn AS j FROM elig a JOIN elig b ON a.rn < b.rn AND a.entity_key <> b.entity_key
  AND len(list_intersect(a.sig, b.sig)) >= 2 AND (a.age IS NULL OR b.age IS NULL OR abs(a.age - b.age) <= 15)),
prev AS (SELECT rn, coalesce(js, CAST([] AS BIGINT[])) AS js FROM elig LEFT JOIN
  (SELECT j, list(i) AS js FROM edge GROUP BY j) ON j = rn),
walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS seeds UNION ALL
  SELECT p.rn, CASE WHEN len(list_intersect(p.js, w.seeds)) = 0 THEN list_append(w.seeds, p.rn) ELSE w.seeds END
  FROM walk w JOIN prev p ON p.rn = w.rn + 1),
seed AS (SELECT unnest(seeds) AS rn FROM walk ORDER BY walk.rn DESC LIMIT (SELECT coalesce(max(len(seeds)), 0) FROM walk)),
opener AS (SELECT rn, row_number() OVER (ORDER BY rn) AS group_no FROM seed WHERE rn IN (SELECT i FROM edge)),
tag AS (SELECT rn, rn AS g FROM opener UNION ALL
  SELECT j AS rn, max(i) AS g FROM edge JOIN opener ON i = opener.rn WHERE j NOT IN (SELECT rn FROM seed) GROUP BY j)
SELECT e.seq, s.seq AS group_seed, o.group_no FROM tag JOIN elig e ON e.rn = tag.rn JOIN elig s ON s.rn = tag.g
  JOIN opener o ON o.rn = tag.g""").replace("WITH", "WITH RECURSIVE", 1).replace("\n, elig", ",\nelig")


def eligible(spark, sf):
    d = kept_postings(spark, sf).filter(F.col("kind").isin(L.MISSION, L.TO_CONFIRM))
    return cut_lineage(d.select("seq", "entity_key", "signature", "age"))


@query(S_GROUPS[:S_GROUPS.index(",\nprev AS")] + " SELECT seq FROM elig WHERE rn IN (SELECT i FROM edge UNION SELECT j FROM edge)")
def same_item_matches(spark, sf):
    """Postings that another publisher also has, without listing pairs."""
    return C.same_item_matches(eligible(spark, sf))


@query(S_GROUPS)
def same_item_groups(spark, sf):
    """The same item from several publishers, numbered in the order the groups open."""
    return C.same_item_groups(eligible(spark, sf)).select("seq", "group_seed", "group_no")
