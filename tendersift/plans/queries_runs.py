"""Queries of readers, stored state, the similarity cascade and orders, on tables and files that Spark makes of them."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift.functions import dates as D
from tendersift.functions import payload as P
from tendersift.operators import filters as K
from tendersift.operators import notices as N
from tendersift.operators import postings as O
from tendersift.operators import reports as R
from tendersift.operators import similar as S
from tendersift.operators import upkeep as U
from tendersift.operators.classify import QUESTION, classify_postings
from tendersift.plans.queries_notices import S_NOTICES, notices, s_domain
from tendersift.plans.queries_screen import postings, with_views
from tendersift.plans.registry import S_PAD, S_TITLE, book, docs, padded, q, query, read, s_any, today
from tendersift.plans.sample_rules import SUBSTRING_SETS
from tendersift.plans.runs import judged, run_notices
from tendersift.plans.screen import in_verdict_order, screen
from tendersift.rules import RuleBook
from tendersift.schema import JUDGEMENT
from tendersift.session import ensure_checkpoint_dir
from tendersift.sources import readers


def folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for one query's files or versions."""
    return f"{ensure_checkpoint_dir(spark)}/{name}/{uuid.uuid4().hex}"


# --- the screen ------------------------------------------------------------------------------------

@query(with_views(f"SELECT seq, kind, CASE WHEN kind = 'a_confirmer' THEN {q(QUESTION)} ELSE '' END AS question FROM classified"))
def questions(spark, sf):
    return classify_postings(postings(spark, sf), book(), today()).select("seq", "kind", "question")


_RANK = ("CASE verdict WHEN '★★ MATCH CŒUR' THEN 0 WHEN '★ À SAISIR' THEN 1 WHEN 'À CONFIRMER' THEN 2 WHEN 'VIVIER' THEN 3 "
         "WHEN 'ÉCARTÉE' THEN 4 ELSE 9 END")


@query(with_views(f"SELECT seq, verdict FROM verdicts ORDER BY {_RANK}, coalesce(age, 9999), seq LIMIT 60"))
def best_verdicts(spark, sf):
    """The first rows of the report in its order."""
    return in_verdict_order(screen(postings(spark, sf), book(), today())).limit(60).select("seq", "verdict")


@query(with_views("SELECT seq, verdict FROM verdicts WHERE verdict <> 'ÉCARTÉE' AND age IS NOT NULL ORDER BY age, seq LIMIT 25"))
def first_matches(spark, sf):
    d = screen(postings(spark, sf), book(), today())
    return R.first_matching(d, (F.col("verdict") != "ÉCARTÉE") & F.col("age").isNotNull(), ["age", "seq"], 25).select("seq", "verdict")


@query(f"SELECT doc_id, {s_any(S_PAD, 'core')} AS core, {s_any(S_PAD, 'domain_ok')} AS domain_ok FROM documents")
def rules_from_table(spark, sf):
    """The rule book read back from a stored rules table."""
    rows = [(s, None, 0, t, "substring", False) for s in ("core", "domain_ok") for t in SUBSTRING_SETS[s]]
    path = folder(spark, "rules")
    spark.createDataFrame(rows, "rule_set string, label string, weight int, term string, match_mode string, fold boolean").write.parquet(path)
    b = RuleBook.from_table(spark.read.parquet(path))
    d = docs(spark, sf).withColumn("_p", padded())
    return d.select("doc_id", b.hit("core", "_p").alias("core"), b.hit("domain_ok", "_p").alias("domain_ok"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Une phrase.' END AS mission,
    CASE WHEN c_custkey % 4 = 0 THEN '6 mois' WHEN c_custkey % 4 = 1 THEN '3 à 6 mois' WHEN c_custkey % 4 = 2 THEN 'longue durée' ELSE 'NC' END AS duration FROM customer""")
def display_filled(spark, sf):
    c = F.col("c_custkey")
    body = F.concat(F.lit("Une phrase. "), F.when(c % 4 == 0, "Durée 6 mois").when(c % 4 == 1, "Durée : 3 à 6 mois").when(c % 4 == 2, "Longue durée").otherwise("-"))
    d = read(spark, sf, "customer").select("c_custkey", F.when(c % 3 == 0, F.col("c_name")).alias("mission"), body.alias("body"),
                                           F.lit(None).cast("string").alias("duration"), F.lit("x").alias("work_mode"))
    return O.fill_display(d, book()).select("c_custkey", "mission", "duration")


# --- similarity ------------------------------------------------------------------------------------

_ASKED = """WITH o AS (SELECT doc_id AS seq, md5(text) AS h, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE (doc_id * 37) % 100 END AS sem, doc_id % 18 AS lex,
    md5(text) < '2' AS known FROM documents),
  g AS (SELECT *, coalesce(sem < 35, false) AND NOT known AS cut FROM o),
  asked AS (SELECT h, min(seq) AS s FROM g WHERE NOT cut AND NOT known GROUP BY h),
  n AS (SELECT h, row_number() OVER (ORDER BY s) - 1 AS i FROM asked),
  j AS (SELECT h, CASE WHEN i % 10 = 9 THEN NULL WHEN i % 10 = 0 THEN 95 WHEN i % 10 = 1 THEN 60 WHEN i % 10 = 2 THEN 20 ELSE 80 END AS score FROM n),
  r AS (SELECT seq, CASE WHEN cut THEN sem WHEN known THEN 70 ELSE score END AS score,
      coalesce(sem, least(100, CAST(round_even(lex / 17.0 * 100, 0) AS INTEGER))) AS guess FROM g LEFT JOIN j USING (h))"""


def _judge(request: str) -> str:
    """Scores by position; silent about the last item of ten."""
    at = [int(x) for x in re.findall(r"### OFFRE (\d+)\n", request)]
    return json.dumps([{"id": i, "score_global": {0: 95, 1: 60, 2: 20}.get(i, 80), "verdict": "CONVENABLE"} for i in at if i != 9])


@query(f"""{_ASKED} SELECT seq, coalesce(score, guess) AS score, score IS NULL AS estimated,
    CASE WHEN score IS NULL THEN 'À VÉRIFIER (estimé sans Gemini)' WHEN score >= 75 THEN 'CONVENABLE' WHEN score >= 55 THEN 'À VÉRIFIER (similarité)'
      ELSE 'HORS_PERIMETRE (similarité)' END AS decision FROM r""")
def similarity_cascade(spark, sf):
    """The cascade as one call, with a judge that answers by position and leaves one item of each request out."""
    k = F.col("doc_id")
    h = F.md5(F.col("text").cast("binary"))
    offers = docs(spark, sf).select(k.alias("seq"), h.alias("content_hash"), F.concat(F.lit("t"), k).alias("title"), F.lit("").alias("mission"),
                                    F.col("text").alias("body"), F.when(k % 11 != 0, k * 37 % 100).cast("int").alias("semantic"),
                                    (k % 18).cast("int").alias("lexical"))
    cache = (offers.filter("content_hash < '2'").select("content_hash").distinct()
             .select("content_hash", F.lit("v").alias("rule_version"), F.lit(70).alias("score"), F.lit("LIMITE").alias("verdict"),
                     F.lit("-").alias("topic"), F.lit("").alias("reason")))
    out, _ = S.cascade(offers, cache, _judge, "v")
    return out.select("seq", F.col("score").cast("long").alias("score"), "estimated", "decision")


def _judge_titles(request: str) -> str:
    """A judge that goes by the length of the title."""
    items = re.findall(r"### OFFRE (\d+)\nTitre : (.*)\nAnnonce :", request)
    return json.dumps([{"id": int(i), "score_global": len(t) % 101, "verdict": "CONVENABLE"} for i, t in items])


@query(with_views(f"""SELECT seq, sim_score, CASE WHEN sim_score >= 75 THEN 'CONVENABLE' WHEN sim_score >= 55 THEN 'À VÉRIFIER (similarité)'
    ELSE 'HORS_PERIMETRE (similarité)' END AS sim_verdict
  FROM (SELECT seq, CAST(length(trim({S_TITLE})) % 101 AS INTEGER) AS sim_score FROM verdicts JOIN documents ON doc_id = seq
    WHERE verdict <> 'ÉCARTÉE')"""))
def judged_run(spark, sf):
    """What the screen left, judged inside the run on whole texts."""
    texts = postings(spark, sf)
    cache = spark.createDataFrame([], JUDGEMENT)
    out, _ = judged(screen(texts, book(), today()), texts, book(), cache, _judge_titles)
    return out.select("seq", F.col("score").alias("sim_score"), "sim_verdict")


@query("""SELECT d.doc_id AS seq, CASE WHEN d.doc_id % 4 = 0 THEN NULL WHEN l.doc_id IS NULL THEN 'À VÉRIFIER (Gemini indisponible)'
    WHEN quality = 1 THEN 'CONVENABLE' ELSE 'HORS_PERIMETRE (similarité)' END AS sim_verdict, CAST(l.quality * 90 AS INTEGER) AS sim_score
  FROM documents d LEFT JOIN labels l USING (doc_id)""")
def similarity_applied(spark, sf):
    k = F.col("doc_id")
    p = docs(spark, sf).select(k.alias("seq"), F.concat(F.lit("https://x.test/"), k, F.lit("/?a=1")).alias("url"),
                               F.when(k % 4 == 0, "ÉCARTÉE").otherwise("★ À SAISIR").alias("verdict"))
    j = read(spark, sf, "labels").select(F.concat(F.lit("https://x.test/"), k, F.lit("?b=2")).alias("url"), (F.col("quality") * 90).alias("score"),
                                         F.when(F.col("quality") == 1, "CONVENABLE").otherwise("HORS_PERIMETRE (similarité)").alias("sim_verdict"),
                                         F.lit("-").alias("topic"), F.lit("").alias("reason"))
    return S.apply_similarity(p, j).select("seq", "sim_verdict", F.col("sim_score").cast("int").alias("sim_score"))


@query("SELECT c_custkey FROM customer WHERE c_nationkey <> 3")
def cache_purged(spark, sf):
    d = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("rule_version"))
    return S.purge(d, "3").select("c_custkey")


# --- stored state ----------------------------------------------------------------------------------

_STATE = T.StructType([T.StructField("id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("protected", T.BooleanType())])


def _customers(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("source"), F.lit(name).alias("name"))


@query("""SELECT 1 AS step, 'add' AS action, count(*) AS n FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL SELECT 2, 'add', count(*) FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 2, 'update', count(*) FROM customer WHERE c_custkey % 3 = 1
  UNION ALL SELECT 2, 'remove', count(*) FROM customer WHERE c_custkey % 3 = 2 UNION ALL SELECT 3, 'update', count(*) FROM customer WHERE c_custkey % 3 <> 2""")
def batches_replayed(spark, sf):
    """Two batches of the same sources, the second one applied twice, each with repeated rows."""
    root, out = folder(spark, "state"), None
    first = _customers(spark, sf, "a").filter("id % 3 <> 0")
    second = _customers(spark, sf, "b").filter("id % 3 <> 2")
    U.stage_batch(first.union(first), root, "1")
    U.stage_batch(second.union(second), root, "2")
    for step, batch in enumerate("122", 1):
        counts = U.apply_batch(spark, root, batch, _STATE).filter("n > 0").select(F.lit(step).alias("step"), "action", "n")
        out = counts if out is None else out.union(counts)
    return out


@query("SELECT c_custkey AS id, c_mktsegment AS source FROM customer WHERE c_custkey % 2 = 0")
def version_read_back(spark, sf):
    """Two versions of a table by tab; a dry run leaves no third."""
    root = folder(spark, "versions")
    d = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("source"))
    U.publish(d, root, partition_by="source")
    U.publish(d.filter("id % 2 = 0"), root, partition_by="source")
    U.publish(d.limit(0), root, dry_run=True)
    return U.read_current(spark, root, T.StructType([d.schema["id"], d.schema["source"]]), require_state=True)


# --- readers ---------------------------------------------------------------------------------------

@query("SELECT DISTINCT o_custkey AS k, min(o_orderkey) OVER (PARTITION BY o_custkey) AS o FROM orders")
def page_records(spark, sf):
    """Landed pages of a paged answer: each order's page repeats its customer's record."""
    pages = read(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), F.to_json(F.struct(F.array(F.struct(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("o"))).alias("hits"))).alias("payload"))
    return readers.paged_payload(pages, "payload", "hits", "struct<k:long,o:long>", "k", "page").select("k", "o")


@query("SELECT page_id, concat('Poste ', page_id) AS title FROM pages WHERE page_id % 3 <> 0")
def ld_postings(spark, sf):
    k = F.col("page_id")
    block = F.concat(F.lit('<script type="application/ld+json">{"@type":"'), F.when(k % 3 == 0, "Person").otherwise("JobPosting"),
                     F.lit('","title":"Poste '), k, F.lit('"}</script>'))
    d = readers.json_ld(read(spark, sf, "pages").withColumn("html", F.concat("html", block)), "JobPosting")
    return d.select("page_id", F.get_json_object("posting", "$.title").alias("title"))


@query("""SELECT c_custkey AS page_id, unnest([0, 1]) AS pos, unnest([concat('Un ', c_custkey), 'Deux']) AS title FROM customer WHERE c_custkey % 5 <> 0""")
def rss_feeds(spark, sf):
    k = F.col("c_custkey")
    head = F.concat(F.lit('<rss version="2.0"><channel><item><title>Un '), k, F.lit("</title><link>u</link></item><item><title>Deux</title></item>"))
    d = read(spark, sf, "customer").select(k.alias("page_id"), F.concat(head, F.when(k % 5 == 0, "<broken").otherwise("</channel></rss>")).alias("xml"))
    return readers.rss_items(d).select("page_id", "pos", "title")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ville' WHEN 1 THEN 'Région' WHEN 2 THEN 'Adresse' ELSE '' END AS place,
    CASE WHEN c_custkey % 2 = 0 THEN '2024-01-01' END AS dated, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS objet FROM customer""")
def answer_fields(spark, sf):
    """Place of a posting, sentinel dates and a fenced answer."""
    k = F.col("c_custkey")
    posting = (F.when(k % 4 == 0, '{"jobLocation":{"address":{"addressLocality":"Ville"}}}')
               .when(k % 4 == 1, '{"jobLocation":[{"address":{"addressRegion":"Région"}}]}').when(k % 4 == 2, '{"jobLocation":{"address":"Adresse"}}').otherwise("{}"))
    raw = F.when(k % 3 == 0, "rien").otherwise(F.concat(F.lit('```json\n{"objet":"'), F.col("c_name"), F.lit('"}\n```')))
    return read(spark, sf, "customer").select("c_custkey", P.place_of(posting).alias("place"),
                                              D.unless_sentinel(F.when(k % 2 == 0, "2024-01-01").otherwise("-0001-11-30")).alias("dated"),
                                              P.answer_object(raw, ["objet"])["objet"].alias("objet"))


@query("SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY o_custkey")
def cache_keeps_last(spark, sf):
    """The stored version a later one of the same url replaces."""
    d = read(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("last"), F.concat(F.lit("u"), "o_custkey").alias("url"))
    return U.last_of(d, "url", "last").select("o_custkey", "last")


# --- tender runs -----------------------------------------------------------------------------------

_RUN_STATE = "id string, source string, subject string, domain string, amount_value double, protected boolean"


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS id, domain, CASE WHEN doc_id % 3 <> 0 THEN amount * 2 END AS amount_value
  FROM (SELECT *, {s_domain("y", '', True)} AS domain FROM ({S_NOTICES}))
  WHERE NOT (p = '1-URGENT' AND amount > 200000) AND st <> 'F' AND deadline - DATE '1997-01-01' >= 7 AND p <> '3-MEDIUM'
    AND domain <> 'hors IT' AND (doc_id % 3 = 0 OR amount * 2 <= 400000)""")
def national_run(spark, sf):
    """Screen, amounts of the survivors, second filter, merge; run twice over the same notices."""
    root = folder(spark, "national")
    k = F.col("o_orderkey")
    details = read(spark, sf, "orders").filter(k % 3 != 0).select(k.cast("string").alias("id"), (F.col("o_totalprice") * 2).cast("double").alias("amount_value"))
    for batch in "12":
        found = N.screen_national(notices(spark, sf), book(), F.lit("1997-01-01").cast("date"), 200000, ["72", "48"], ["45"])
        run_notices(found.drop("amount_value"), details, ["amount_value"], K.amount_too_high(F.col("amount_value"), 400000), root, batch)
    table = U.read_current(spark, f"{root}/table", T.StructType.fromDDL(_RUN_STATE), require_state=True)
    return table.select("id", "domain", "amount_value")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS id, domain FROM (SELECT *, {s_domain("x", 'w_', False)} AS domain FROM ({S_NOTICES}))
  WHERE st = 'P' AND deadline - DATE '1997-01-01' >= 7 AND domain <> 'hors IT' AND (doc_id % 2 = 0 OR doc_id % 5 <> 0)""")
def regional_run(spark, sf):
    """The same for regional notices, where the details bring a deadline that may be too soon."""
    root = folder(spark, "regional")
    k, day = F.col("o_orderkey"), F.lit("1997-01-01").cast("date")
    details = read(spark, sf, "orders").filter(k % 2 != 0).select(
        k.cast("string").alias("id"), F.when(k % 5 == 0, "1997-01-03").otherwise("1998-01-01").alias("last_day"))
    late = K.deadline_too_soon(F.col("last_day").cast("date"), day)
    run_notices(N.screen_regional(notices(spark, sf), book(), day), details, ["last_day"], late, root, "1")
    state = T.StructType.fromDDL("id string, source string, subject string, domain string, last_day string, protected boolean")
    return U.read_current(spark, f"{root}/table", state).select("id", "domain")
