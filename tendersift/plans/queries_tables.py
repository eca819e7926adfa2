"""Queries for joins, merges, ledgers, set operators and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions.dates import literal_map
from tendersift.operators import joins as J
from tendersift.operators import reports as R
from tendersift.operators import upkeep as U
from tendersift.plans.registry import once, S_PAD, S_TITLE, book, docs, padded, q, query, read, s_any, s_fold, s_list, s_title_key
from tendersift.plans.sample_rules import WORD_SETS
from tendersift.scale import number_rows
from tendersift.session import cut_lineage

BATCH_DAY = "2024-01-20"


def events(spark, sf):
    return read(spark, sf, "events")


def ledger(spark, sf):
    """What was seen before the day of the last batch, one row per user and event type."""
    key = F.concat_ws("/", "user_id", "event_type")
    return (events(spark, sf).filter(F.col("ts") < BATCH_DAY).groupBy(key.alias("url"))
            .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_check")))


S_LEDGER = f"""seen AS (SELECT concat_ws('/', user_id, event_type) AS url, min(ts) AS first_seen, max(ts) AS last_check
  FROM events WHERE ts < TIMESTAMP '{BATCH_DAY}' GROUP BY ALL),
fresh AS (SELECT event_id, concat_ws('/', user_id, event_type) AS url, ts FROM events WHERE ts >= TIMESTAMP '{BATCH_DAY}')"""


def fresh(spark, sf):
    return (events(spark, sf).filter(F.col("ts") >= BATCH_DAY)
            .select("event_id", F.concat_ws("/", "user_id", "event_type").alias("url"), "ts"))


@query(f"""WITH {S_LEDGER} SELECT event_id, first_seen IS NULL AS is_new,
    strftime(coalesce(first_seen, TIMESTAMP '2024-02-01'), '%Y-%m-%d %H:%M:%S') AS first_seen FROM fresh LEFT JOIN seen USING (url)""")
def ledger_join(spark, sf):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    d = J.with_ledger(fresh(spark, sf), cut_lineage(ledger(spark, sf)), now, "event_id")
    return d.select("event_id", "is_new", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def new_items(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey")
    urgent = read(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return J.not_in(c, urgent.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""WITH a AS (SELECT user_id, arg_max(event_id, event_id) AS e FROM events WHERE event_type = 'purchase' GROUP BY user_id),
  b AS (SELECT user_id % 7 AS m, min(event_id) AS e FROM events WHERE event_type = 'purchase' GROUP BY ALL)
  SELECT c_custkey, coalesce(a.e, b.e) AS event_id FROM customer LEFT JOIN a ON a.user_id = c_custkey LEFT JOIN b ON b.m = c_custkey % 7""")
def two_key_lookup(spark, sf):
    cache = (events(spark, sf).filter("event_type = 'purchase'")
             .select(F.col("user_id").alias("k1"), (F.col("user_id") % 7).alias("k2"), "event_id", F.col("event_id").alias("o")))
    rows = read(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("k1"), (F.col("c_custkey") % 7).alias("k2"))
    return J.two_key_lookup(rows, cache, "k1", "k2", ["event_id"], "o", "c_custkey").select("c_custkey", "event_id")


@query("SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey < 20")
def dimension_lookup(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    n = read(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), "n_name")
    return J.dimension_lookup(s, n, "k", "n_name", "n_name", "s_suppkey").drop("k")


@query(f"""WITH r(term) AS (SELECT unnest({s_list(WORD_SETS['w_domain_strong'] + ['the and', 'of the', 'en la'])})),
  t AS (SELECT doc_id, concat(' ', array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
        lambda w: w <> ''), ' '), ' ') AS w FROM documents)
  SELECT term, count(*) AS n_docs FROM t, r WHERE contains(w, concat(' ', term, ' ')) GROUP BY term""")
def term_join(spark, sf):
    terms = WORD_SETS["w_domain_strong"] + ["the and", "of the", "en la"]
    rules = spark.createDataFrame([("s", t) for t in terms], "rule_set string, term string")
    hits = J.term_join(docs(spark, sf), rules, "doc_id", "text")
    return hits.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))


@query(f"""SELECT doc_id, {s_any(f"concat(' ', lower({S_TITLE}), ' ')", 'core')} AS core FROM documents
  WHERE {s_any(S_PAD, 'recall')}""")
def recall_then_classify(spark, sf):
    """The cheap recall words first, the dearer decision only on what is left."""
    d = docs(spark, sf).transform(once, "_p", padded())
    return d.filter(book().hit("recall", "_p")).select("doc_id", book().hit("core", "concat(' ', lower(title), ' ')").alias("core"))


@query(f"""WITH qs AS (SELECT item_id AS query_id, lower(strip_accents(string_split(text, ' ')[1])) AS word,
    concat('src', item_id % 20) AS want FROM benchmark),
  ws AS (SELECT doc_id, source, unnest(list_distinct(regexp_split_to_array({s_fold(S_TITLE)}, '[^\\p{{L}}\\p{{N}}]+'))) AS word FROM documents)
  SELECT query_id, min(doc_id) AS seq FROM qs JOIN ws USING (word) WHERE contains(source, want) GROUP BY query_id""")
def title_entity_match(spark, sf):
    qs = read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("title"),
                                             F.concat(F.lit("src"), F.col("item_id") % 20).alias("entity"))
    rows = docs(spark, sf).select(F.col("doc_id").alias("seq"), "title", F.col("source").alias("entity"))
    return J.match_by_title_and_entity(qs, rows)


# --- merges ----------------------------------------------------------------------------------------
# table: orders 'F' and 'O' as last published; batch: orders 'O' and 'P' with a new price.

S_MERGE = """t AS (SELECT o_orderkey AS id, o_orderpriority AS source, o_totalprice AS price, o_custkey % 10 = 0 AS protected
    FROM orders WHERE o_orderstatus IN ('F', 'O')),
  b AS (SELECT o_orderkey AS id, o_orderpriority AS source, o_totalprice + 1 AS price FROM orders
    WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority <> '3-MEDIUM'),
  led AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey % 3 = 0),
  m AS (SELECT coalesce(t.id, b.id) AS id, t.source AS tsource, t.price AS tprice, b.price AS bprice, b.source AS bsource,
    coalesce(protected, false) AS guarded, t.id IS NOT NULL AS in_t, b.id IS NOT NULL AS in_b, led.id IS NOT NULL AS known
    FROM t FULL JOIN b ON t.id = b.id LEFT JOIN led ON led.id = coalesce(t.id, b.id))"""


def merge_inputs(spark, sf):
    o = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source"), F.col("o_totalprice").alias("price"),
        (F.col("o_custkey") % 10 == 0).alias("protected"), "o_orderstatus", "o_custkey")
    table = o.filter("o_orderstatus IN ('F', 'O')").select("id", "source", "price", "protected")
    batch = (o.filter("o_orderstatus IN ('O', 'P') AND source <> '3-MEDIUM'")
             .select("id", "source", (F.col("price") + 1).alias("price")))
    return table, batch, o.filter("o_custkey % 3 = 0").select("id")


@query(f"""WITH {S_MERGE} SELECT id, CASE WHEN in_b THEN bprice ELSE tprice END AS price,
    CASE WHEN in_t AND in_b AND NOT guarded THEN 'update' WHEN in_t AND in_b THEN 'protected' WHEN in_b THEN 'add' ELSE 'keep' END AS action
  FROM (SELECT * REPLACE (CASE WHEN guarded AND in_t THEN NULL ELSE bprice END AS bprice) FROM m) WHERE NOT (in_t AND in_b AND guarded)
  UNION ALL SELECT id, tprice, 'protected' FROM m WHERE in_t AND in_b AND guarded""")
def upsert(spark, sf):
    t, b, _ = merge_inputs(spark, sf)
    return U.merge_plan(t, b).select("id", "price", "action")


@query(f"""WITH {S_MERGE}, p AS (SELECT CASE WHEN in_t AND in_b AND guarded THEN 'protected' WHEN in_t AND in_b THEN 'update'
    WHEN in_b AND known THEN 'skip_deleted' WHEN in_b THEN 'add' WHEN tsource IN ('1-URGENT', '3-MEDIUM') AND guarded THEN 'protected'
    WHEN tsource IN ('1-URGENT', '3-MEDIUM') THEN 'remove' ELSE 'keep' END AS action FROM m)
  SELECT action, count(*) AS n FROM p GROUP BY action""")
def merge_counts(spark, sf):
    t, b, led = merge_inputs(spark, sf)
    scope = spark.createDataFrame([("1-URGENT",), ("3-MEDIUM",)], "source string")
    return U.merge_counts(U.merge_plan(t, b, led, scope))


@query(f"""WITH {S_MERGE} SELECT id, CASE WHEN guarded THEN tprice ELSE bprice END AS price, guarded AS protected FROM m
  WHERE in_t AND in_b""")
def upsert_protected(spark, sf):
    t, b, _ = merge_inputs(spark, sf)
    return U.merge_plan(t, b).filter("action IN ('update', 'protected')").select("id", "price", "protected")


@query(f"WITH {S_MERGE} SELECT id FROM m WHERE in_b AND NOT in_t AND known")
def deleted_stay_deleted(spark, sf):
    t, b, led = merge_inputs(spark, sf)
    return U.merge_plan(t, b, led).filter("action = 'skip_deleted'").select("id")


@query(f"""WITH {S_MERGE} SELECT id, CASE WHEN in_b AND NOT guarded THEN bprice ELSE tprice END AS price FROM m
  WHERE NOT (in_b AND NOT in_t AND known)
    AND NOT (NOT in_b AND tsource IN (SELECT source FROM b) AND NOT guarded)""")
def stale_removed(spark, sf):
    t, b, led = merge_inputs(spark, sf)
    return U.merged_rows(U.merge_plan(t, b, led, U.batch_sources(b))).select("id", "price")


@query(f"WITH {S_MERGE} SELECT count(*) AS n_ids FROM (SELECT id FROM led UNION SELECT id FROM b)")
def ledger_growth(spark, sf):
    _, b, led = merge_inputs(spark, sf)
    return U.grown_ledger(led, b).agg(F.count(F.lit(1)).alias("n_ids"))


@query("""SELECT o_orderkey AS url, CASE WHEN o_orderpriority = '1-URGENT' THEN 'À VÉRIFIER (similarité)' ELSE o_orderpriority END AS verdict
  FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 2 = 0 AND o_orderpriority <> '2-HIGH'""")
def append_new_only(spark, sf):
    o, p = read(spark, sf, "orders"), F.col("o_orderpriority")
    table = o.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("url"))
    items = o.select(F.col("o_orderkey").alias("url"), (F.col("o_custkey") % 2 == 0).alias("is_new"), p.alias("verdict"),
                     F.when(p == "1-URGENT", L.S_VERIFY).when(p == "2-HIGH", L.S_OUT).when(p == "5-LOW", L.S_PASS).alias("sim_verdict"))
    return U.append_new(table, items).select("url", "verdict")


@query(f"""SELECT doc_id AS url FROM documents LEFT JOIN labels USING (doc_id)
  WHERE NOT CASE WHEN quality IS NOT NULL THEN toxic = 1 OR quality = 0 ELSE source IN ('src3', 'src4', 'src5', 'src11') END""")
def clean_up_table(spark, sf):
    t = read(spark, sf, "documents").select(F.col("doc_id").alias("url"), F.col("source").alias("entity"))
    judged = read(spark, sf, "labels").select(
        F.col("doc_id").alias("url"), (F.col("toxic") == 1).alias("out_of_scope"),
        F.when(F.col("quality") == 0, L.NO).otherwise(L.YES).alias("sector"), F.lit(L.MISSION).alias("kind"))
    return U.clean_up(t, judged, book()).select("url")


@query("""SELECT o_orderkey, CASE WHEN c_acctbal > 0 THEN concat('ok ', c_mktsegment) ELSE o_orderstatus END AS status,
    CASE WHEN c_acctbal > 0 AND c_custkey % 2 = 0 THEN c_mktsegment ELSE o_orderpriority END AS note
  FROM orders LEFT JOIN customer ON c_custkey = o_orderkey""")
def status_update(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
                                         F.col("o_orderpriority").alias("note"))
    c = read(spark, sf, "customer").filter("c_acctbal > 0")
    st = c.select(F.col("c_custkey").alias("k"), F.concat(F.lit("ok "), "c_mktsegment").alias("status"))
    note = c.select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("note"))
    return U.update_columns(U.update_status(o, st, "k", "status"), note, "k", ["note"]).drop("k")


@query("""SELECT url, strftime(min(first_seen), '%Y-%m-%d %H:%M:%S') AS first_seen,
    strftime(max(last_check), '%Y-%m-%d %H:%M:%S') AS last_check, max_by(verdict, n) AS verdict FROM (
  SELECT user_id AS url, min(ts) AS first_seen, max(ts) AS last_check, 'old' AS verdict, 0 AS n FROM events
    WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id
  UNION ALL SELECT DISTINCT user_id, TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', 'new', 1 FROM events WHERE event_type = 'signup'
    AND ts >= TIMESTAMP '2024-01-20') GROUP BY url""")
def first_last_seen(spark, sf):
    e = events(spark, sf).withColumns({"url": F.col("user_id"), "title": F.lit(""), "entity": F.lit("")})
    old = (e.filter(F.col("ts") < BATCH_DAY).groupBy("url", "title", "entity")
           .agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_check")).withColumn("verdict", F.lit("old")))
    items = (e.filter((F.col("ts") >= BATCH_DAY) & (F.col("event_type") == "signup")).select("url", "title", "entity").distinct()
             .withColumn("verdict", F.lit("new")))
    d = U.update_ledger(old, items, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    fmt = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_seen", "last_check")}
    return d.withColumns(fmt).select("url", "first_seen", "last_check", "verdict")


@query("""SELECT user_id, strftime(min(ts), '%Y-%m-%d') = '2024-01-02' AS is_new FROM events GROUP BY user_id""")
def new_in_last_batch(spark, sf):
    d = events(spark, sf).groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_batch"))
    return d.select("user_id", U.new_in_last_batch(F.col("first_batch"), F.lit("2024-01-02")).alias("is_new"))


@query("""WITH s AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-28')
  SELECT c_custkey AS url, CASE WHEN user_id IS NOT NULL THEN 'now' END AS last_check FROM customer LEFT JOIN s ON user_id = c_custkey""")
def refreshed_checks(spark, sf):
    seen = events(spark, sf).filter("event_type = 'purchase' AND ts >= '2024-01-28'").select(F.col("user_id").alias("url"))
    t = read(spark, sf, "customer").select(F.col("c_custkey").alias("url"))
    now = F.lit("2024-02-01").cast("timestamp")
    return U.refresh_seen(t, seen, now).select("url", F.when(F.col("last_check").isNotNull(), "now").alias("last_check"))


@query("""SELECT v.vec_id, coalesce(l.quality * 100, v.label) AS score FROM embeddings v LEFT JOIN labels l ON l.doc_id = v.vec_id""")
def backfill_scores(spark, sf):
    old = read(spark, sf, "embeddings").select("vec_id", F.col("label").alias("score"))
    new = read(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), (F.col("quality") * 100).alias("score"))
    return J.backfill(old, new, "vec_id", ["score"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY n_chars DESC, doc_id LIMIT 100")
def detail_worklist(spark, sf):
    return J.detail_work_list(read(spark, sf, "documents").select("doc_id", "n_chars"), read(spark, sf, "labels"), "doc_id",
                              [F.col("n_chars").desc(), "doc_id"], 100).select("doc_id")


# --- sets, routes, orders --------------------------------------------------------------------------

S_ROUTE = "CASE WHEN contains(source, 'src1') THEN 'north' WHEN contains(source, 'src2') THEN 'south' WHEN contains(source, 'src5') THEN 'west' ELSE 'rest' END"


@query(f"SELECT doc_id, {S_ROUTE} AS country FROM documents")
def route_country(spark, sf):
    return read(spark, sf, "documents").select("doc_id", book().first_label("country", "source", "rest").alias("country"))


@query(f"""SELECT source, count(*) AS n, count(url) AS n_url FROM (
  SELECT 'documents' AS source, NULL AS url FROM documents UNION ALL SELECT 'pages', url FROM pages
  UNION ALL SELECT 'customer', NULL FROM customer) GROUP BY source""")
def multi_source_union(spark, sf):
    d = J.union_sources([read(spark, sf, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id")),
                         read(spark, sf, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"), "url"),
                         read(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"))])
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("url").alias("n_url"))


@query("""SELECT user_id, min_by(pass_no, (pass_no, event_id)) AS pass_no, min_by(event_id, (pass_no, event_id)) AS event_id FROM (
  SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS pass_no FROM events) GROUP BY user_id""")
def search_passes(spark, sf):
    e = events(spark, sf).select("user_id", "event_id", "event_type")
    parts = [e.filter("event_type = 'purchase'"), e.filter("event_type = 'signup'"),
             e.filter("event_type NOT IN ('purchase', 'signup')")]
    return J.union_passes(parts, "user_id", "event_id").select("user_id", "pass_no", "event_id")


S_KEYED = f"SELECT doc_id AS seq, source AS entity_key, {s_title_key(S_TITLE)} AS title_norm, concat('u', doc_id % 600) AS url, lang FROM documents"


@query(f"""WITH k AS ({S_KEYED}), s AS (SELECT * FROM k WHERE lang <> 'fr' QUALIFY row_number() OVER (PARTITION BY entity_key, title_norm ORDER BY seq) = 1),
  r AS (SELECT * FROM k WHERE lang = 'fr' QUALIFY row_number() OVER (PARTITION BY entity_key, title_norm ORDER BY seq) = 1)
  SELECT seq FROM s UNION ALL SELECT seq FROM r WHERE (entity_key, title_norm) NOT IN (SELECT (entity_key, title_norm) FROM s)
    AND url NOT IN (SELECT url FROM s)""")
def reference_merge(spark, sf):
    from tendersift.functions.text import title_key
    k = docs(spark, sf).select(F.col("doc_id").alias("seq"), F.col("source").alias("entity_key"), title_key(F.col("title")).alias("title_norm"),
                               F.concat(F.lit("u"), F.col("doc_id") % 600).alias("url"), "lang")
    return J.merge_reference(k.filter("lang <> 'fr'"), k.filter("lang = 'fr'"), ["entity_key", "title_norm"]).select("seq")


@query("""SELECT rank, o_orderkey, o_totalprice FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
  ELSE 9 END AS rank, o_orderkey, o_totalprice FROM orders) ORDER BY rank, o_totalprice DESC, o_orderkey LIMIT 50""")
def ranked_top(spark, sf):
    rank = F.coalesce(literal_map({"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2})[F.col("o_orderpriority")], F.lit(9))
    return (read(spark, sf, "orders").select(rank.alias("rank"), "o_orderkey", "o_totalprice")
            .orderBy("rank", F.col("o_totalprice").desc(), "o_orderkey").limit(50))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus <> 'P'")
def numbered_rows(spark, sf):
    d = read(spark, sf, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey")
    return number_rows(d, "o_orderkey", "n", 1000)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS n FROM orders")
def numbered_by_hash(spark, sf):
    """An order whose values are far apart: as many ranges as the rows need."""
    d = read(spark, sf, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("h"))
    return number_rows(d, "h", "n", 1000).select("o_orderkey", "n")


@query("""SELECT event_id, last_value(h IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS header FROM
  (SELECT event_id, user_id, CASE WHEN event_type = 'signup' THEN concat('h', event_id) END AS h FROM events)""")
def header_carry(spark, sf):
    from tendersift.sources.readers import carry_header
    d = events(spark, sf).select("event_id", "user_id", F.when(F.col("event_type") == "signup", F.concat(F.lit("h"), "event_id")).alias("h"))
    return carry_header(d, "user_id", "event_id", "h", "header").select("event_id", "header")


@query("""SELECT seq, verdict FROM (SELECT o_orderkey AS seq, ['★★ MATCH CŒUR', '★ À SAISIR', '★ RÉFÉRENCE', 'À CONFIRMER'][CAST(o_custkey % 4 AS INTEGER) + 1] AS verdict,
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 50 END AS age FROM orders)
  ORDER BY CASE verdict WHEN '★★ MATCH CŒUR' THEN 0 WHEN '★ À SAISIR' THEN 1 WHEN '★ RÉFÉRENCE' THEN 2 ELSE 3 END, coalesce(age, 9999), seq""")
def merge_order(spark, sf):
    """All rows in the order of the published tab."""
    v = F.array(*[F.lit(x) for x in (L.V_TOP, L.V_GOOD, L.V_REFERENCE, L.V_CONFIRM)])[(F.col("o_custkey") % 4).cast("int")]
    d = read(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), v.alias("verdict"),
                                         F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 50).alias("age"))
    return R.in_merge_order(d).select("seq", "verdict")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def latest_first(spark, sf):
    d = R.latest(read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", n=25)
    return d.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""SELECT doc_id AS seq, coalesce(nullif(source, 'src3'), 'big firm') AS entity, CASE WHEN doc_id % 2 = 0 THEN '2024-01-05' END AS published,
    quality IS NOT NULL AS has_body FROM documents LEFT JOIN labels USING (doc_id)""")
def postings_from_cards(spark, sf):
    """Cards joined to their details; labelled documents have one."""
    from tendersift.operators.postings import postings_from_cards as build
    d = docs(spark, sf)
    url = F.concat(F.lit("https://x/view/job-at-big-firm-"), F.lit(1000000) + F.col("doc_id"))
    cards = d.select(F.col("doc_id").alias("seq"), url.alias("url"), "title", F.when(F.col("source") == "src3", "").otherwise(F.col("source")).alias("entity"),
                     F.lit("").alias("place"), F.when(F.col("doc_id") % 2 == 0, "2024-01-05").otherwise("il y a 2 jours").alias("published"),
                     F.lit(None).cast("string").alias("posted_relative"))
    details = d.join(read(spark, sf, "labels").select("doc_id"), "doc_id").select(url.alias("url"), F.col("text").alias("body"))
    return build(cards, details, "s").select("seq", "entity", "published", F.col("body").isNotNull().alias("has_body"))
