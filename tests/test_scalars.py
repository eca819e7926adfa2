"""Text, date and number expressions, with the traps of the contracts."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from tendersift.functions import dates as D
from tendersift.functions import numbers as N
from tendersift.functions import text as X


def all_of(spark, fn, cases):
    """{input: fn(input)} for text inputs, in one job."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, s string")
    return {cases[r["i"]]: r["v"] for r in rows.select("i", fn(F.col("s")).alias("v")).collect()}


def test_fold_matches_unicode_for_latin(spark):
    chars = [chr(c) for c in range(0xC0, 0x250)]
    got = all_of(spark, X.fold, chars)
    for ch in chars:
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(base) == 1:
            assert got[ch] == base.lower(), ch
    assert all_of(spark, X.fold, ["été ÉTÉ", None]) == {"été ÉTÉ": "ete ete", None: ""}


def test_invisible_characters(spark):
    got = all_of(spark, X.drop_invisible, ["a‎b\u0007c\nd\te"])
    assert got["a‎b\u0007c\nd\te"] == "abc\nd\te"


def test_title_key(spark):
    got = all_of(spark, X.title_key, ["Chargé de projet (H/F)", "Data-Analyst H/F Senior", "L'offre d'été pour la mission", None])
    assert list(got.values()) == ["charge projet", "data analyst", "l ete", ""]


def test_sentence_duration_and_markers(spark):
    s = all_of(spark, X.first_sentence, ["Un. Deux.", "x" * 200, "", None])
    assert s["Un. Deux."] == "Un." and s["x" * 200] == "x" * 160 + "…" and s[""] == "NC" and s[None] == "NC"
    d = all_of(spark, X.duration_text, ["de 6 à 12 mois", "6 mois", "Longue durée", "rien"])
    assert list(d.values()) == ["6 à 12 mois", "6 mois", "longue durée", "NC"]
    assert all_of(spark, X.drop_new_marker, ["★ ★ Titre"])["★ ★ Titre"] == "Titre"


def test_urls(spark):
    assert all_of(spark, X.canonical_url, ["http://a/b/?x=1", "http://a/b"]) == {"http://a/b/?x=1": "http://a/b", "http://a/b": "http://a/b"}
    slug = "https://x/view/chef-at-big-firm-1234567"
    assert all_of(spark, X.entity_from_url, [slug, "x", None]) == {slug: "big firm", "x": "", None: ""}
    assert all_of(spark, lambda c: X.absolute_url(c, "https://h/"), ["/d/N° 1 l'été.pdf"]) == {
        "/d/N° 1 l'été.pdf": "https://h/d/N%C2%B0%201%20l'%C3%A9t%C3%A9.pdf"}
    assert all_of(spark, X.untruncate, ["Tra ... Travaux neufs", "simple"]) == {"Tra ... Travaux neufs": "Travaux neufs", "simple": "simple"}
    assert all_of(spark, X.reference_head, ["A/1 - Fourniture - x", "A/2"]) == {"A/1 - Fourniture - x": "A/1", "A/2": "A/2"}


def test_keyword_in_context_takes_list_order(spark):
    df = spark.createDataFrame([("zz beta and alpha",)], ["s"])
    got = df.select(X.keyword_in_context("s", ["alpha", "beta"], 3, 8).alias("a"),
                    X.keyword_in_context("s", ["nope"], 3, 8).alias("b"),
                    X.keyword_in_context("s", ["beta"], 50, 50, "…", "…", True, False).alias("c")).first()
    assert got == ("...nd alpha...", None, "zz beta and alpha")


def test_column_keys():
    assert X.column_key("Œuvre (j) N° 1") == "oeuvren1"
    assert X.find_column(["Autorité contractante", "Objet"], "autorite", "contractante") == "Autorité contractante"


def test_dates(spark):
    iso = all_of(spark, D.iso_date, ["2026-02-30", "2026-02-28T10:00:00+01:00", "garbage", None])
    assert list(iso.values()) == [None, dt.date(2026, 2, 28), None, None]
    rel = all_of(spark, D.relative_days, ["il y a 3 semaines", "Il y a 2 mois", "il y a 5 heures", "hier", None])
    assert list(rel.values()) == [21, 60, 0, None, None]
    today = F.lit("2026-03-01").cast("date")
    site = all_of(spark, lambda c: D.site_date(c, today), ["à l'instant", "hier", "le 15/02", "le 15/12", "le 31/02", "?"])
    assert list(site.values()) == [dt.date(2026, 3, 1), dt.date(2026, 2, 28), dt.date(2026, 2, 15), dt.date(2025, 12, 15), None, None]
    fr = all_of(spark, D.french_date, ["3 août 2026", "3 aout 2026 10:00", "1 sept. 2026", "3 foo 2026", "31 février 2026"])
    assert list(fr.values()) == [dt.date(2026, 8, 3), dt.date(2026, 8, 3), dt.date(2026, 9, 1), None, None]
    feed = all_of(spark, D.rfc822_date, ["Thu, 30 Jul 2026 18:17:50 +0000", "30 Jul 2026 18:17:50 GMT", "x", None])
    assert list(feed.values()) == [dt.date(2026, 7, 30), dt.date(2026, 7, 30), None, None]
    assert list(all_of(spark, D.day_first_date, ["05/03/2024 10:00", "05-03-2024", "31/02/2024"]).values()) == [dt.date(2024, 3, 5)] * 2 + [None]


def test_numbers(spark):
    a = all_of(spark, N.amount, ["9 700 000", "120 000€", "1,5", "n.c.", None])
    assert list(a.values()) == [9_700_000.0, 120_000.0, 1.5, None, None]
    r = all_of(spark, N.amount_range, ["40k - 100k€", "+ 100M€", "<50k", "45000", "abc", None])
    assert [tuple(v) if v else v for v in r.values()] == [(40_000.0, 100_000.0), (100_000_000.0, None), (None, 50_000.0),
                                                          (45_000.0, 45_000.0), (None, None), (None, None)]
    assert all_of(spark, N.local_amount, ["0,00", "354 000,00", "_"]) == {"0,00": None, "354 000,00": 354_000.0, "_": None}
    assert list(all_of(spark, N.judge_score, ["2.5", "101", "-4", "x", None]).values()) == [2, 100, 0, 0, 0]


@pytest.mark.parametrize("lexical,percent", [(None, 0), (17, 100), (30, 100), (1, 6)])
def test_lexical_percent(spark, lexical, percent):
    assert spark.range(1).select(N.lexical_percent(F.lit(lexical).cast("int")).alias("v")).first()["v"] == percent


def test_payload_nodes_as_lists_of_their_rows(spark):
    """Nodes are handed over as one Arrow list array a batch; rows without nodes keep their place, null and bad payloads too."""
    from tendersift.functions import payload as P
    raw = [None, '{"x:VALEUR":{"#text":"1","é":[{"cpv":null,"VALEUR":"2"}]},"nbMois":[3]}', "{broken", '[[{"valeur":""}]]', "[]"]
    assert [kv[0] for kv in P._keyed(P._load(raw[1]))] == [k for _, k, _ in P._items(P._load(raw[1]))] == ["x:VALEUR", "#text", "é", "cpv", "VALEUR", "nbMois"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, p string").repartition(2)
    got = {r.i: [tuple(n) for n in r.n] for r in df.select("i", P.nodes_with_keys(F.col("p"), P.WANTED).alias("n")).collect()}
    assert got == {0: [], 2: [], 4: [], 3: [("VALEUR", '""', None, False)],
                   1: [("VALEUR", '{"#text": "1", "é": [{"cpv": null, "VALEUR": "2"}]}', "1", False), ("CPV", "null", None, False), ("VALEUR", '"2"', "2", False), ("nbMois", "[3]", None, True)]}
