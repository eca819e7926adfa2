"""Queries for text functions, pages, payloads and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import payload as P
from tendersift.functions import text as X
from tendersift.functions.dates import display_date
from tendersift.operators import filters as K
from tendersift.operators import pages as G
from tendersift.plans.registry import (once, S_PAD, S_TITLE, W, book, docs, padded, q, query, read, s_any, s_fold, s_list,
                                       s_terms, s_title_key)
from tendersift.plans.sample_rules import SUBSTRING_SETS
from tendersift.scale import spread
from tendersift.session import ensure_checkpoint_dir


def pages(spark, sf):
    return spread(read(spark, sf, "pages"), "page_id")


@query(f"SELECT doc_id, {s_title_key(S_TITLE)} AS key FROM documents")
def title_normalised(spark, sf):
    return docs(spark, sf).select("doc_id", X.title_key(F.col("title")).alias("key"))


@query(f"""SELECT doc_id, array_to_string(list_filter({s_list(sorted(SUBSTRING_SETS['signature']))}, lambda t: contains({s_fold(S_TITLE)}, t)), '|') AS sig FROM documents""")
def title_signature(spark, sf):
    d = docs(spark, sf).withColumn("_f", X.fold(F.col("title")))
    return d.select("doc_id", F.array_join(X.signature("_f", SUBSTRING_SETS["signature"]), "|").alias("sig"))


@query("""SELECT doc_id, CASE WHEN s = '' THEN 'NC' WHEN length(s) > 160 THEN concat(s[1:160], '…') ELSE s END AS snippet FROM
  (SELECT doc_id, regexp_replace(regexp_extract(trim(text, chr(10) || ' '), '^(?s)(.*?[.!?])\\s', 1), '^\\s+|\\s+$', '', 'g') AS s0,
     CASE WHEN s0 = '' THEN trim(text, chr(10) || ' ') ELSE s0 END AS s FROM documents)""")
def first_sentence(spark, sf):
    return docs(spark, sf).select("doc_id", X.first_sentence(F.col("text")).alias("snippet"))


@query(f"SELECT conv_id, turn, {s_fold('text')} AS key FROM conversations")
def folded_key(spark, sf):
    return read(spark, sf, "conversations").select("conv_id", "turn", X.fold(F.col("text")).alias("key"))


@query("SELECT doc_id, concat('l''', replace(text, '`', '''')) AS plain FROM documents")
def apostrophes(spark, sf):
    return docs(spark, sf).select("doc_id", X.plain_apostrophes(F.concat(F.lit("l’"), "text")).alias("plain"))


@query("SELECT doc_id, md5(regexp_replace(text, '[\\p{Cf}\\x00-\\x08\\x0b-\\x1f\\x7f-\\x9f]', '', 'g')) AS clean FROM documents")
def invisible_chars(spark, sf):
    dirty = F.concat(F.lit("\u200e"), F.regexp_replace("text", " ", "\u200b "))
    return docs(spark, sf).select("doc_id", F.md5(X.drop_invisible(dirty)).alias("clean"))


@query("SELECT page_id, rtrim(split_part(url, '?', 1), '/') AS canonical FROM pages")
def url_canonical(spark, sf):
    return pages(spark, sf).select("page_id", X.canonical_url(F.col("url")).alias("canonical"))


@query("""SELECT page_id, concat('firm ', regexp_extract(url, '//([a-z0-9]+)', 1)) AS entity FROM pages""")
def url_slug_entity(spark, sf):
    slug = F.concat(F.lit("https://x/view/job-at-firm-"), F.regexp_extract("url", "//([a-z0-9]+)", 1), F.lit("-"), F.lit(1000000) + F.col("page_id"))
    return pages(spark, sf).select("page_id", X.entity_from_url(slug).alias("entity"))


@query("SELECT page_id, nullif(regexp_extract(url, '(\\d+)$', 1), '') AS tail FROM pages")
def url_ids(spark, sf):
    return pages(spark, sf).select("page_id", X.trailing_digits(F.col("url")).alias("tail"))


@query(f"SELECT doc_id, {s_any(S_PAD, 'sector_word')} AS hit FROM documents")
def short_words(spark, sf):
    return docs(spark, sf).transform(once, "_p", padded()).select("doc_id", book().hit("sector_word", "_p").alias("hit"))


@query(f"SELECT conv_id, turn, {s_any(S_PAD, 'contract_form')} AS hit FROM conversations")
def contract_forms(spark, sf):
    d = read(spark, sf, "conversations").withColumn("_p", F.concat(F.lit(" "), F.lower(X.drop_invisible(F.col("text"))), F.lit(" ")))
    return d.select("conv_id", "turn", book().hit("contract_form", "_p").alias("hit"))


@query(f"SELECT doc_id FROM documents WHERE {s_any(S_PAD, 'reference_code')}")
def reference_codes(spark, sf):
    return docs(spark, sf).transform(once, "_p", padded()).filter(book().hit("reference_code", "_p")).select("doc_id")


@query(f"""SELECT doc_id, {s_terms(s_fold(f"concat({S_TITLE}, ' ')"), SUBSTRING_SETS['area_out'])} AS out_of_area, source = 'src13' AS blocked,
    {s_terms(f"concat(' ', lower(CASE WHEN lang = 'fr' THEN source ELSE {S_TITLE} END), ' ')", SUBSTRING_SETS['strong'])} AS in_country FROM documents""")
def area_and_blocked(spark, sf):
    d = docs(spark, sf).withColumns({"_f": X.fold(F.col("title")), "place": F.when(F.col("lang") == "fr", F.col("source"))})
    return d.select("doc_id", F.expr(K.out_of_area_sql(book(), "_f", "''")).alias("out_of_area"),
                    book().hit("blocked_entity", "concat(' ', lower(source), ' ')").alias("blocked"),
                    K.country_match("place", "title", book(), "strong").alias("in_country"))


@query("SELECT n_nationkey FROM nation WHERE contains(n_name, 'NATION_1')")
def place_match(spark, sf):
    name = F.concat(F.lit("Côte d’"), "n_name")
    return read(spark, sf, "nation").filter(K.same_place(name, "COTE D'nátion_1")).select("n_nationkey")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat(o_custkey % 12 + 1, ' - ', o_custkey % 12 + 6, ' mois') WHEN 1 THEN concat(o_custkey % 24, ' mois')
    WHEN 2 THEN 'longue durée' ELSE 'NC' END AS duration FROM orders""")
def duration_text(spark, sf):
    k, n = F.col("o_orderkey") % 4, F.col("o_custkey")
    t = (F.when(k == 0, F.concat(F.lit("Mission de "), n % 12 + 1, F.lit(" - "), n % 12 + 6, F.lit(" MOIS."))).when(k == 1, F.concat(n % 24, F.lit(" mois renouvelables")))
         .when(k == 2, F.lit("Longue durée")).otherwise(F.lit("à discuter")))
    return read(spark, sf, "orders").select("o_orderkey", X.duration_text(t).alias("duration"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 'O' THEN 'hier' ELSE 'NC' END AS shown,
    concat('T', o_orderkey) AS title FROM orders""")
def display_date_text(spark, sf):
    st = F.col("o_orderstatus")
    d = display_date(F.when(st == "F", F.date_format("o_orderdate", "yyyy-MM-dd")), F.when(st == "O", " hier "))
    return read(spark, sf, "orders").select("o_orderkey", d.alias("shown"), X.drop_new_marker(F.concat(F.lit("★ ★ T"), "o_orderkey")).alias("title"))


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey % 90 END AS INTEGER) AS applicants FROM orders""")
def applicants(spark, sf):
    k = F.col("o_orderkey") % 3
    text = F.when(k == 1, F.concat(F.lit("Faites partie des "), F.col("o_custkey") % 90, F.lit(" premiers candidats"))).otherwise("aucun")
    return read(spark, sf, "orders").select("o_orderkey", X.applicants(F.when(k == 0, F.col("o_custkey")), text).alias("applicants"))


@query("""SELECT doc_id, sha1(lower(concat('7||', regexp_replace(split_part(text, chr(10), 1), '^\\s+|\\s+$', '', 'g'), '||', source))) AS key,
    left(sha1(concat(source, '||', lang)), 12) AS sig FROM documents""")
def content_keys(spark, sf):
    return docs(spark, sf).select("doc_id", X.content_key("7", F.col("title"), F.col("source")).alias("key"),
                                  X.list_signature(F.array("source", "lang")).alias("sig"))


@query("""SELECT item_id, md5(lower(concat(replace(text, '’', ''''), ' a b ', 'x'))) AS analysis, length(trim(concat('T ', text))) AS short_len,
    length(concat('T', chr(10), text)) AS long_len FROM benchmark""")
def analysis_text(spark, sf):
    t = F.lit("T")
    return read(spark, sf, "benchmark").select(
        "item_id", F.md5(X.analysis_text(F.col("text"), F.array(F.lit("a"), F.lit("b")), F.lit("x"))).alias("analysis"),
        F.length(X.embed_text(t, F.lit(None), F.col("text"))).cast("long").alias("short_len"),
        F.length(X.judge_text(t, F.lit(""), F.col("text"))).cast("long").alias("long_len"))


# --- pages -----------------------------------------------------------------------------------------

S_LINKS = """SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href\\s*=\\s*"([^"]*)"[^>]*>', 1)) AS href,
    unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href\\s*=\\s*"[^"]*"[^>]*>(.*?)</a>', 1)) AS label,
    generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*href\\s*=\\s*"([^"]*)"[^>]*>', 1), 1) - 1 AS pos FROM pages"""


@query(f"""SELECT page_id, CAST(pos AS INTEGER) AS pos, href, trim(regexp_replace(regexp_replace(label, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS label FROM ({S_LINKS})""")
def page_links(spark, sf):
    return G.links(pages(spark, sf))


@query(f"""SELECT page_id, min(CAST(pos AS INTEGER)) AS pos, link FROM (SELECT page_id, pos, concat('http://h.test', href, '.pdf?v=1') AS link, lower(href) AS f FROM ({S_LINKS}))
  WHERE f NOT LIKE '%anvil%' AND f NOT LIKE '%rod%' AND starts_with(link, 'http://h.test/') GROUP BY page_id, link""")
def file_links(spark, sf):
    """Links of every page read as documents; the first of repeated ones."""
    d = G.links(pages(spark, sf)).filter(F.col("href").startswith("/")).withColumn("href", F.concat("href", F.lit(".pdf?v=1")))
    return G.document_links(d, book(), F.lit("http://h.test/x/y")).select("page_id", "pos", "link")


@query("SELECT page_id, length(split_part(html, '<footer>', 1)) AS n_before, contains(html, '<h1>') AS has_title FROM pages")
def page_sections(spark, sf):
    return pages(spark, sf).select("page_id", F.length(G.current_section(F.col("html"), "<footer>")).cast("long").alias("n_before"),
                                   F.col("html").contains("<h1>").alias("has_title"))


@query()
def page_text(spark, sf):
    """Visible text of every page; needs a real parser, so no SQL."""
    return pages(spark, sf).select("page_id", G.page_text(F.col("html")).alias("text"))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'),
    '&#(x27|39);?', '''', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS title FROM pages""")
def page_titles(spark, sf):
    rows = G.listing_rows(pages(spark, sf), r"(?s)<head>(.*?)</head>", {"title": r"(?s)<title>(.*?)</title>"})
    return rows.select("page_id", "title")


@query("SELECT page_id, list_filter(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda x: NOT contains(x, 'e'))[-1] AS link FROM pages")
def last_link(spark, sf):
    """The last link of a page; those with an `e` stand for boilerplate."""
    return pages(spark, sf).select("page_id", G.last_document_link(F.col("html"), r'<a href="([^"]*)"', "e").alias("link"))


@query("""SELECT page_id, concat('http://p.test/x?id=', regexp_extract(url, '/(\\d+)', 1), '&org=ab') AS built, concat('http://p.test/a%20', page_id, '/%C3%A9') AS absolute FROM pages
  WHERE regexp_extract(url, '/(\\d+)', 1) <> ''""")
def built_links(spark, sf):
    u = F.concat(F.lit("http://h/?id="), F.regexp_extract("url", r"/(\d+)", 1), F.lit("&amp;org=ab"))
    d = pages(spark, sf).filter(F.regexp_extract("url", r"/(\d+)", 1) != "")
    return d.select("page_id", X.link_from_params(u, r"id=(\d+)&(?:amp;)?org=([a-zA-Z0-9]+)", "http://p.test/x?", ("id", "org")).alias("built"),
                    X.absolute_url(F.concat(F.lit("/a "), "page_id", F.lit("/é")), "http://p.test/").alias("absolute"))


@query("SELECT page_id, page_id % 4 IN (0, 1) AS login FROM pages")
def login_pages(spark, sf):
    """Every fourth page gets a password field, the next two phrases, the next one phrase only."""
    k = F.col("page_id") % 4
    extra = F.when(k == 0, "<form><input name=p type='password'></form>").when(k == 1, "<p>Sign in with your password</p>").when(k == 2, "<p>Log in</p>").otherwise("")
    d = pages(spark, sf).withColumn("html", F.concat(F.coalesce("html", F.lit("")), extra))
    return d.select("page_id", K.login_page("html", "regexp_replace(html, '(?s)<[^>]*>', ' ')", book()).alias("login"))


# --- payloads --------------------------------------------------------------------------------------

def payloads(spark, sf, *extra):
    """Orders as nested payloads in three schemas, by order number, with further columns of orders."""
    c = F.col
    price = F.format_string("%.2f", "o_totalprice")
    prefixed = F.concat(F.lit('{"cac:Project":{"cbc:EstimatedOverallContractAmount":{"@currencyID":"EUR","#text":"'), price,
                        F.lit('"},"list":[{"cbc:ItemClassificationCode":{"@listName":"cpv","#text":"'), c("o_custkey").cast("string"),
                        F.lit('"}},{"cbc:ItemClassificationCode":{"@listName":"nuts","#text":"FR"}},{"cbc:ItemClassificationCode":{"@listName":"cpv","#text":"10"}}],'
                              '"cbc:DurationMeasure":{"@unitCode":"MONTH","#text":"12"},"cbc:ContractingSystemTypeCode":{"@listName":"framework-agreement","#text":"'),
                        F.when(c("o_orderstatus") == "F", "fa-wo-rc").otherwise("none"), F.lit('"}}}'))
    plain = F.concat(F.lit('{"OBJET":{"CPV":{"PRINCIPAL":"'), c("o_custkey").cast("string"), F.lit('"}},"ACCORD_CADRE":{"VALEUR":{"@DEVISE":"MAD","#text":"'), price,
                     F.lit('"}},"DUREE_MOIS":"24","CRITERE":[{"@POIDS":"60","#text":"Prix"},{"#text":"Délai"}]}'))
    short = F.concat(F.lit('{"a":[[{"criterePondere":[{"critere":"Prix","criterePCT":"70"},{"critere":"Valeur"}]}]],"nbMois":"'), c("o_custkey").cast("string"),
                     F.lit('","urlProfilAcheteur":"http://p/'), c("o_orderkey"), F.lit('"}'))
    k = c("o_orderkey") % 4
    return spread(read(spark, sf, "orders"), "o_orderkey").select(
        "o_orderkey", F.when(k == 0, prefixed).when(k == 1, plain).when(k == 2, short).otherwise("{broken").alias("payload"), *extra)


@query("""WITH o AS (SELECT *, o_orderkey % 4 AS k FROM orders)
  SELECT o_orderkey, CASE WHEN k < 2 THEN printf('%.2f', o_totalprice) END AS amount, CASE k WHEN 0 THEN 'EUR' WHEN 1 THEN 'MAD' END AS currency,
    CASE k WHEN 0 THEN array_to_string(list_sort(list_distinct([CAST(o_custkey AS VARCHAR), '10'])), ',') WHEN 1 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS codes,
    CASE k WHEN 0 THEN '12 month' WHEN 1 THEN '24 mois' WHEN 2 THEN concat(o_custkey, ' mois') END AS duration,
    k = 1 OR (k = 0 AND o_orderstatus = 'F') AS framework, CASE WHEN k = 2 THEN concat('http://p/', o_orderkey) END AS link FROM o""")
def payload_values(spark, sf):
    d = payloads(spark, sf).withColumn("_n", P.nodes_with_keys(F.col("payload"), P.WANTED)).withColumn("_m", P.payload_amount(F.col("_n")))
    n = F.col("_n")
    return d.select("o_orderkey", "_m.amount", "_m.currency", F.array_join(P.payload_codes(n), ",").alias("codes"), P.payload_duration(n).alias("duration"),
                    P.payload_is_framework(n).alias("framework"), P.payload_link(n).alias("link"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN 'Prix (60%) ; Délai' WHEN 2 THEN 'Prix (70%) ; Valeur' END AS criteria FROM orders""")
def criteria_text(spark, sf):
    d = payloads(spark, sf).withColumn("_n", P.nodes_with_keys(F.col("payload"), P.WANTED))
    return d.select("o_orderkey", P.payload_criteria(F.col("_n")).alias("criteria"))


@query("""SELECT path, n FROM (SELECT 'k' AS path, count(*) AS n FROM events WHERE props IS NOT NULL)""")
def payload_keys(spark, sf):
    from tendersift.sources.readers import payload_keys as keys
    return keys(read(spark, sf, "events"), "props")


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct([CAST(l_partkey % 9 AS VARCHAR), CAST(l_suppkey % 9 AS VARCHAR), '5',
    CAST(l_orderkey % 9 AS VARCHAR)])), ',') AS codes FROM lineitem""")
def distinct_codes(spark, sf):
    """The codes of one record, given in nested lists."""
    def code(c):
        return (F.col(c) % 9).cast("string")
    nested = F.array(F.array(code("l_partkey"), code("l_suppkey")), F.array(F.lit("5"), code("l_orderkey")))
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(F.array_sort(F.array_distinct(F.flatten(nested))), ",").alias("codes"))


@query("""SELECT c_custkey, concat('segment : ', c_mktsegment, ' ; nation : ', c_nationkey) AS flat, concat(c_name, ' ; ', c_mktsegment) AS listed FROM customer""")
def flattened_values(spark, sf):
    m = F.create_map(F.lit("segment"), "c_mktsegment", F.lit("nation"), F.col("c_nationkey").cast("string"))
    return read(spark, sf, "customer").select("c_custkey", X.flatten_map(m).alias("flat"), X.flatten_list(F.array("c_name", "c_mktsegment")).alias("listed"))


# --- streams ---------------------------------------------------------------------------------------

def feed(spark, sf):
    schema = read(spark, sf, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
            .withColumn("ts", F.col("ts").cast("timestamp")))


def run_once(df, mode: str, root: str | None = None):
    """All available input through the stream into a table of the shared folder, with the batch number; a given `root` goes on where it stopped."""
    spark = df.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", root + "/state").trigger(availableNow=True)
    w.foreachBatch(lambda b, i: b.withColumn("_batch", F.lit(i)).write.mode("overwrite").parquet(f"{root}/out/b={i}")).start().awaitTermination()
    return spark.read.schema(df.schema.add("_batch", "long")).parquet(f"{root}/out/*")


@query("SELECT DISTINCT concat(user_id, '/', event_type) AS url FROM events")
def stream_new_items(spark, sf):
    from tendersift.streaming.feeds import new_items
    d = feed(spark, sf).withColumn("url", F.concat_ws("/", "user_id", "event_type"))
    return run_once(new_items(d, lateness="60 days"), "append").select("url")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark, sf):
    from tendersift.streaming.feeds import daily_counts
    d = run_once(daily_counts(feed(spark, sf), source="event_type", lateness="60 days"), "update")
    last = d.groupBy("day", "event_type").agg(F.max_by("n", "_batch").alias("n"))
    return last.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("""WITH e AS (SELECT event_type, date_trunc('day', ts) AS d, ts, event_id % 3 = 0 AS second FROM events),
  w AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM e WHERE NOT second)
  SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM e, w WHERE NOT second OR d + INTERVAL 1 DAY > mark GROUP BY ALL""")
def stream_late_counts(spark, sf):
    """Events that land in two parts, the stream stopped between them: of the second, days closed by the first's last event are too late."""
    from tendersift.streaming.feeds import daily_counts
    root, events = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}", read(spark, sf, "events")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.filter(part).write.mode("append").parquet(f"{root}/in")
        landed = spark.readStream.schema(events.schema).parquet(f"{root}/in").withColumn("ts", F.col("ts").cast("timestamp"))
        d = run_once(daily_counts(landed, source="event_type", lateness="1 day"), "update", root)
    last = d.groupBy("day", "event_type").agg(F.max_by("n", "_batch").alias("n"))
    return last.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("SELECT concat(user_id, '/', event_type) AS key, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 2")
def stream_recurrence(spark, sf):
    from tendersift.streaming.feeds import recurrence
    d = feed(spark, sf).select(F.concat_ws("/", "user_id", "event_type").alias("key"), "ts")
    return run_once(recurrence(d, lateness="60 days"), "update").groupBy("key").agg(F.max("n").alias("n"))
