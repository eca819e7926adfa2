"""A whole run over stored state, and the smaller posting operators."""

import json
import re

from pyspark.sql import functions as F

from test_screen import BASE, BOOK, TODAY, postings
from tendersift import labels as L
from tendersift.operators import postings as P
from tendersift.operators import reports as R
from tendersift.operators import upkeep as U
from tendersift.plans.runs import CURATED, run_missions
from tendersift.schema import JUDGEMENT


def test_two_runs(spark, tmp_path):
    root = str(tmp_path / "state")
    day = F.lit(TODAY).cast("date")
    none = spark.createDataFrame([], "url string, score int, sim_verdict string, topic string, reason string")
    judged = spark.createDataFrame([("u0", 90, L.S_PASS, "-", ""), ("u1", 10, L.S_OUT, "-", "")], none.schema)
    schema = spark.createDataFrame([], CURATED).schema
    first = postings(spark, {}, {"title": "AMOA deux"}, {"title": "Cyber"})
    assert run_missions(first, judged, BOOK, day, root, dry_run=True).count() == 1
    assert U.current_version(spark, root + "/table") is None
    summary = run_missions(first, judged, BOOK, day, root).first()
    assert (summary.n, summary.n_publishable, summary.n_new) == (3, 2, 2)
    assert [(r.url, r.verdict) for r in U.read_current(spark, root + "/table", schema).collect()] == [("u0", L.V_GOOD)]
    # the second run finds everything in the ledger: nothing comes back, a known row only gets its check date
    second = run_missions(first, none, BOOK, day, root, require_state=True).first()
    assert second.n_new == 0
    assert [(r.url, r.verdict, r.last_check is not None) for r in U.read_current(spark, root + "/table", schema).collect()] == [("u0", L.V_GOOD, True)]
    # a published row that turned into junk is taken back
    run_missions(postings(spark, {"title": "Cyber"}), none, BOOK, day, root)
    assert U.read_current(spark, root + "/table", schema).count() == 0


def test_three_runs_with_a_judge(spark, tmp_path):
    """The run asks for what the screen left, stores the answers, and asks for nothing it knows."""
    root = str(tmp_path / "state")
    day = F.lit(TODAY).cast("date")
    schema = spark.createDataFrame([], CURATED).schema

    def judge(request):
        parts = re.findall(r"### OFFRE (\d+)\nTitre : (.*)\n", request)
        return json.dumps([{"id": int(i), "score_global": 90 if "deux" not in t else 20, "verdict": "CONVENABLE"} for i, t in parts])

    def absent(request):
        raise RuntimeError("no judge today")

    def table():
        return sorted((r.url, r.sim_score, r.sim_verdict) for r in U.read_current(spark, root + "/table", schema).collect())
    first = postings(spark, {}, {"title": "AMOA deux", "body": BASE["body"] + " deux"}, {"title": "Cyber"})
    run_missions(first, None, BOOK, day, root, judge=judge)
    assert table() == [("u0", 90, L.S_PASS)]
    assert U.read_current(spark, root + "/judgements", JUDGEMENT).count() == 2      # the rejected posting was not asked for
    # nothing is asked again: the stored answers do where the judge fails
    run_missions(first, None, BOOK, day, root, judge=absent, require_state=True)
    assert table() == [("u0", 90, L.S_PASS)] and U.current_version(spark, root + "/judgements") == 1
    # a new posting without an answer is published as an estimate, and asked for again by the next run
    new = postings(spark, {}, {"title": "AMOA deux", "body": BASE["body"] + " deux"}, {"title": "Cyber"}, {"title": "AMOA trois", "body": BASE["body"] + " trois"})
    run_missions(new, None, BOOK, day, root, judge=absent)
    assert U.read_current(spark, root + "/judgements", JUDGEMENT).count() == 2
    run_missions(new, None, BOOK, day, root, judge=judge)
    assert U.read_current(spark, root + "/judgements", JUDGEMENT).count() == 3
    assert [t[1] for t in table()] == [90, 90]


def test_cards_and_display(spark):
    cards = spark.createDataFrame([(1, "https://x/view/a-at-big-firm-1234567?t=1", " T ", "", "Paris", "2026-01-01", None), (2, "u2", "T2", "E", "", "hier", "hier")],
                                  "seq long, url string, title string, entity string, place string, published string, posted_relative string")
    details = spark.createDataFrame([("u2", "Six mois. Suite", "12 candidats")], "url string, body string, applicants_text string")
    d = P.postings_from_cards(cards, details, "feed")
    rows = {r.seq: r for r in P.fill_display(d, BOOK).collect()}
    assert (rows[1].entity, rows[1].title, rows[1].published, rows[1].url) == ("big firm", "T", "2026-01-01", "https://x/view/a-at-big-firm-1234567")
    assert (rows[2].published, rows[2].mission, rows[2].work_mode, rows[2].applicants_text) == (None, "Six mois.", "NC", "12 candidats")
    assert [r.seq for r in P.worth_reading(cards.withColumn("title", F.lit("AMOA")), BOOK, ["domain_ok", "sector"]).collect()] == [1, 2]
    flags = P.card_flags(d.filter("seq = 2").withColumn("entity", F.lit("Grande Banque")), BOOK).first()
    assert (flags.is_role, flags.in_sector, flags.sector_employer) == (False, True, True)


def test_orders(spark):
    df = spark.createDataFrame([(1, L.V_CONFIRM, 1), (2, L.V_REFERENCE, None), (3, L.V_REFERENCE, 5), (4, L.V_TOP, 9)], "seq int, verdict string, age int")
    assert [r.seq for r in R.in_merge_order(df).collect()] == [4, 3, 2, 1]
    assert [r.seq for r in R.first_matching(df, F.col("age").isNotNull(), ["seq"], 2).collect()] == [1, 3]
    assert [r.verdict for r in R.verdict_counts(df).collect()][0] == L.V_TOP
