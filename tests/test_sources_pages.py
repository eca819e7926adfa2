"""Readers, pages, payloads and notices."""

import hashlib
import json

from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import payload as P
from tendersift.operators import notices as O
from tendersift.operators import pages as G
from tendersift.rules import Rule, RuleBook
from tendersift.schema import NOTICE
from tendersift.sources import readers as R


def test_cached_postings(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps([{"poste": "A", "url": "u", "republication": "", "nb_candidats": "12"}, {"poste": "B", "open_confirme": True, "republication": "oui"}]))
    rows = R.cached_postings(spark, str(path), "feed").orderBy("title").collect()
    assert [(r.title, r.source, r.reposted, r.open_confirmed, r.applicants) for r in rows] == [("A", "feed", False, False, 12), ("B", "feed", True, True, None)]


def test_paged_payload_and_status(spark):
    pages = spark.createDataFrame([(1, '{"results":[{"id":"a","v":"1"},{"id":"b","v":"2"}]}'), (2, '{"results":[{"id":"a","v":"3"}]}'), (3, "oops")], "page int, raw string")
    got = R.paged_payload(pages, "raw", "results", "struct<id:string,v:string>", "id", "page")
    assert {(r.id, r.v) for r in got.collect()} == {("a", "1"), ("b", "2")}
    R.register("ok", lambda s: s.range(2))
    R.register("bad", lambda s: s.read.parquet("/no/such/path"))
    df, status = R.read_all(spark, ["ok", "bad"])
    assert df.count() == 2 and {r.source: r.ok for r in status.collect()} == {"ok": True, "bad": False}


def test_json_ld_and_rss(spark):
    html = '<script type="application/ld+json">{"@type":"Org"}</script><script type="application/ld+json">{"@type":"JobPosting","jobLocation":[{"address":{"addressRegion":"IDF"}}]}</script>'
    d = R.json_ld(spark.createDataFrame([(1, "u", html), (2, "u", "<p>")], "page_id int, url string, html string"), "JobPosting")
    assert [(r.page_id, r.p) for r in d.select("page_id", P.place_of(F.col("posting")).alias("p")).collect()] == [(1, "IDF")]
    rss = '<?xml version="1.0"?><rss><channel><item><title>AMI - Togo - Étude - PERU</title><link>l</link><pubDate>Thu, 30 Jul 2026 18:17:50 +0000</pubDate><guid>n at 12</guid></item><item><title>B</title></item></channel></rss>'
    feeds = spark.createDataFrame([(1, rss), (2, "<rss><channel><item>"), (3, "nope")], "page_id int, xml string")
    rows = R.rss_items(feeds).orderBy("pos").select("page_id", O.title_parts(F.col("title")).alias("t"), "guid").collect()
    assert [(r.page_id, tuple(r.t)) for r in rows] == [(1, ("AMI", "Togo", "Étude - PERU")), (1, (None, None, "B"))]


def test_profile_and_tables(spark, tmp_path):
    f = tmp_path / "p.txt"
    f.write_text("# note\nbloc un\nsuite\n\n  \nPÔLES : a\n\nbloc deux\n")
    assert [(r.text, r.is_topic) for r in R.profile_blocks(spark, str(f)).orderBy("block_id").collect()] == [("bloc un\nsuite", False), ("PÔLES : a", True), ("bloc deux", False)]
    c = tmp_path / "t.csv"
    c.write_text("Poste,x,Entité\nChef,1,ACME\n,,\n")
    assert [tuple(r) for r in R.table_by_position(spark, str(c), {"title": 0, "entity": 2}, "title", ["poste"]).collect()] == [("Chef", "ACME")]
    rows = [("d", 0, ["page de garde"]), ("d", 1, ["MINISTÈRE", "OBJET"]), ("d", 2, ["m1", " o1 "]), ("d", 3, ["court"]),
            ("d", 4, ["Ministere", "Autre", "OBJET"]), ("d", 5, ["m2", "x", "o2"])]
    d = R.table_rows(spark.createDataFrame(rows, "doc string, row_no int, cells array<string>"), "minist").orderBy("row_no").collect()
    assert [r.record for r in d] == [{"MINISTÈRE": "m1", "OBJET": "o1"}, {"Ministere": "m2", "Autre": "x", "OBJET": "o2"}]
    seqs = spark.createDataFrame([("d", i, f"h{i}" if i % 7 == 3 else None) for i in range(50)], "doc string, n int, h string")
    carried = R.carry_header(seqs, "doc", "n", "h", "out", width=5).collect()
    assert all(r.out == (None if r.n < 3 else f"h{(r.n - 3) // 7 * 7 + 3}") for r in carried)


def test_sniff(spark, tmp_path):
    for n, b in (("a.pdf", b"%PDF-1.4"), ("b.docx", b"PK\x03\x04"), ("c.bin", b"\x00")):
        (tmp_path / n).write_bytes(b)
    assert sorted(r.kind for r in R.binary_documents(spark, str(tmp_path)).collect()) == ["pdf", "type non supporté", "zip"]


def test_payload_schemas(spark):
    cases = {
        "e": {"cac:X": [{"cbc:TotalAmount": {"@currencyID": "EUR", "#text": "140000.00"}}, {"cbc:ItemClassificationCode": {"@listName": "cpv", "#text": "72000000"}}],
              "cbc:DurationMeasure": {"@unitCode": "MONTH", "#text": "48"}, "cbc:BuyerProfileURI": "http://p",
              "cbc:ContractingSystemTypeCode": {"@listName": "framework-agreement", "#text": "fa-wo-rc"}},
        "o": {"OBJET": {"CPV": [{"PRINCIPAL": "1"}, {"PRINCIPAL": "2"}]}, "ACCORD_CADRE": {"VALEUR": {"@DEVISE": "EUR", "#text": "9 700 000"}},
              "CRITERE": {"@POIDS": "60", "#text": "Prix"}},
        "m": {"criterePondere": [{"critere": "Prix", "criterePCT": "70"}, {"critere": "Valeur", "criterePCT": "30"}], "nbMois": "12", "VALEUR": {}},
        "x": {"unrelated": 1}, "deep": json.loads('{"a":' * 40 + '{"TotalAmount":"7"}' + "}" * 40)}
    rows = [(k, json.dumps(v)) for k, v in cases.items()] + [("null", None), ("bad", "{")]
    n = F.col("n")
    d = spark.createDataFrame(rows, "k string, raw string").withColumn("n", P.nodes_with_keys(F.col("raw"), P.WANTED)).select(
        "k", P.payload_amount(n).alias("a"), P.payload_codes(n).alias("c"), P.payload_duration(n).alias("d"), P.payload_is_framework(n).alias("f"),
        P.payload_link(n).alias("l"), P.payload_criteria(n).alias("cr"))
    got = {r.k: (tuple(r.a), r.c, r.d, r.f, r.l, r.cr) for r in d.collect()}
    empty = ((None, None), [], None, False, None, None)
    assert got["e"] == (("140000.00", "EUR"), ["72000000"], "48 month", True, "http://p", None)
    assert got["o"] == (("9 700 000", "EUR"), ["1", "2"], None, True, None, "Prix (60%)")
    assert got["m"] == ((None, None), [], "12 mois", False, None, "Prix (70%) ; Valeur (30%)")
    assert got["x"] == got["null"] == got["bad"] == empty and got["deep"][0] == ("7", None)
    keys = R.payload_keys(spark.createDataFrame([('{"a":{"b":1},"c":[{"d":2}]}',)], "raw string"), "raw")
    assert {r.path for r in keys.collect()} == {"a", "a.b", "c", "c.d"}


def test_answers(spark):
    raw = ['```json\n[{"id":0,"score_global":"80"}]\n```', "noise [{\"id\": 1}] noise", "nothing"]
    d = spark.createDataFrame([(r,) for r in raw], "r string").select(P.answer_items(F.col("r")).alias("i"))
    assert [r.i[0].id if r.i else None for r in d.collect()] == ["0", "1", None]
    o = spark.createDataFrame([('```json\n{"budget":"1","x":{"y":2}}\n```',), ("no",)], "r string").select(P.answer_object(F.col("r"), ["budget", "delai"]).alias("o"))
    assert [(r.o.budget if r.o else None) for r in o.collect()] == ["1", None]


def test_pages(spark):
    html = "<html><script>x()</script><p>A&amp;B</p><b>c</b></html>"
    d = spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")
    assert [r.t for r in d.select(G.page_text(F.col("html")).alias("t")).collect()] == ["A&B c", ""]
    li = '<li class="r"><a href="/x?id=1">Avis &eacute;t&eacute;</a><i>2026</i></li><li class="r"><a href="/y">B</a></li><h2>Clos</h2><li class="r">old</li>'
    p = spark.createDataFrame([(1, "u", li)], "page_id int, url string, html string").withColumn("html", G.current_section(F.col("html"), "<h2>"))
    rows = G.listing_rows(p, r'(?s)<li class="r">(.*?)</li>', {"title": r"(?s)<a[^>]*>(.*?)</a>", "day": r"<i>(\d+)</i>"}).orderBy("pos").collect()
    assert [(r.title, r.day) for r in rows] == [("Avis été", "2026"), ("B", None)]
    detail = '<div class="d">Texte <b>gras</b></div><h3>Type</h3><span>CDI</span><h3>Type</h3><span>x</span> 25 candidats. Cette offre n\'accepte plus'
    f = G.detail_fields(spark.createDataFrame([(1, "u", detail)], "page_id int, url string, html string"), r'(?s)<div class="d">(.*?)</div>', r"(\d+) candidats",
                        ["n'accepte plus"], ["republi"], r"<h3>(.*?)</h3>", r"<span>(.*?)</span>").first()
    assert (f.body, f.applicants, f.closed, f.reposted, f.criteria) == ("Texte gras", 25, True, False, {"type": "CDI"})
    book = RuleBook([Rule("generic_document", "guide")])
    links = spark.createDataFrame([(1, 0, "/d/cctp.PDF?x=1"), (1, 1, "https://o/guide_utilisateur.pdf"), (1, 2, "/d/cctp.PDF?x=1"), (1, 3, "/d/page.html")], "page_id int, pos int, href string")
    assert [r.link for r in G.document_links(links, book, F.lit("https://h/a")).collect()] == ["https://h/d/cctp.PDF?x=1"]


def test_notice_domain(spark):
    book = RuleBook([Rule("purchase", "acquisition"), Rule("supply", "fourniture"), Rule("supply_exempt", "fourniture de services"), Rule("goods", "serveurs"),
                     Rule("out_phrase", "maintenance"), Rule("ambiguous", "amoa"), Rule("domain_strong", "logiciel"), Rule("domain_context", "système d'information"), Rule("domain_out", "voirie")])
    cases = [("acquisition de serveurs", "", L.D_OUT), ("fourniture de services serveurs", "", L.D_VERIFY), ("amoa", "", L.D_OUT), ("amoa système d'information", "", L.D_CONFIRMED),
             ("logiciel voirie", "", L.D_VERIFY), ("voirie", "", L.D_OUT), ("x", "72", L.D_CONFIRMED), ("voirie", "72", L.D_VERIFY), ("x", "45", L.D_OUT), ("logiciel", "45", L.D_VERIFY), ("x", "72 45", L.D_VERIFY)]
    df = spark.createDataFrame([(i, t, c.split()) for i, (t, c, _) in enumerate(cases)], "i int, x string, codes array<string>")
    dom = O.domain_by_codes_and_words(book, "x", O.prefix_sql("codes", ["72"]), O.prefix_sql("codes", ["45"]))
    assert [r.d for r in df.select("i", dom.alias("d")).orderBy("i").collect()] == [c[2] for c in cases]


def test_normalisers(spark):
    portal = spark.createDataFrame([(1, "R1", None, "Objet", ["3", "août", "2026"], None, "c"), (2, None, "Intitulé", "", ["3", None, "2026"], "rc", "c")],
                                   "seq int, reference string, intitule string, objet string, date_limite array<string>, rc_url string, consult_url string")
    for c in ("organisme", "lieu", "procedure_abbr", "procedure_libelle", "categorie"):
        portal = portal.withColumn(c, F.lit("x"))
    rows = O.portal_notices(portal.withColumn("date_pub", F.array().cast("array<string>")), "PLACE").orderBy("seq").collect()
    assert [(r.id, r.subject, r.deadline, r.notice_url) for r in rows] == [("PLACE-R1", "Objet", "2026-08-03", "c"), (None, "Intitulé", None, "rc")]
    ppm = spark.createDataFrame([(1, "L 1", "Auto", "Objet  un"), (2, "", "Auto", "Objet deux"), (3, "x", "Auto", "")], "seq int, `LIGNE BUDGÉTAIRE` string, `AUTORITÉ CONTRACTANTE` string, `OBJET DU MARCHÉ` string")
    assert [(r.id, r.subject) for r in O.forecasts(ppm, "s", "c").orderBy("seq").collect()] == [("CI-PPM-L1", "Objet un"), ("CI-PPM-" + hashlib.md5(b"AutoObjetdeux").hexdigest(), "Objet deux")]
    assert NOTICE.fieldNames() == O.portal_notices(portal.withColumn("date_pub", F.array().cast("array<string>")), "P").columns
