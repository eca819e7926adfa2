"""Nothing is cut short unless asked, and a second run changes nothing."""

import json

from pyspark.sql import functions as F

from test_screen import BOOK, TODAY, postings
from tendersift import labels as L
from tendersift.operators import filters as K
from tendersift.operators import joins as J
from tendersift.operators import notices as O
from tendersift.operators import similar as S
from tendersift.operators import upkeep as U
from tendersift.plans.runs import CURATED, run_missions
from tendersift.plans.screen import screen
from tendersift.sources import readers as R



def day():
    return F.lit(TODAY).cast("date")


def test_texts_that_differ_late_are_two_postings(spark):
    long = "Mission AMOA banque en régie. " + "x" * 400
    rows = postings(spark, {"body": long + " a"}, {"body": long + " b"}, {"body": long + " b"})
    assert screen(rows, BOOK, day()).count() == 2


def test_notices_without_reference_differ_late(spark):
    same = "s" * 60
    ids = spark.createDataFrame([(same + "a",), (same + "b",), (same + "b",)], "t string").select(O.make_id("X-", F.lit(None).cast("string"), F.col("t")).alias("i"))
    assert ids.distinct().count() == 2


def test_runs_with_repeated_urls_keep_one_row(spark, tmp_path):
    root = str(tmp_path / "state")
    none = spark.createDataFrame([], "url string, score int, sim_verdict string, topic string, reason string")
    judged = spark.createDataFrame([("http://x/1?a=1", 90, L.S_PASS, "-", ""), ("http://x/1", 90, L.S_PASS, "-", "")], none.schema)
    rows = postings(spark, {"url": "http://x/1"}, {"url": "http://x/1?t=2", "title": "AMOA deux"}, {"url": None, "title": "AMOA trois"}, {"url": "", "title": "AMOA quatre"})
    schema = spark.createDataFrame([], CURATED).schema
    for _ in range(3):
        run_missions(rows, judged, BOOK, day(), root)
        table = U.read_current(spark, root + "/table", schema).collect()
        assert [(r.url, r.sim_score) for r in table] == [("http://x/1", 90)]


def test_repeated_updates_keep_one_row(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id int, status string")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "z", 3)], "id int, status string, seq int")
    assert sorted(map(tuple, U.update_status(table, new, "id", "status").collect())) == [(1, "y"), (2, "b")]
    assert sorted(map(tuple, U.update_columns(table, new, "id", ["status"]).collect())) == [(1, "y"), (2, "b")]


def test_a_version_is_never_overwritten(spark, tmp_path):
    root, df = str(tmp_path / "t"), spark.range(2).toDF("id")
    df.write.parquet(f"{root}/v=1")     # of a run that failed before its marker
    assert U.publish(df, root) == 2 and U.current_version(spark, root) == 2


def test_one_unreadable_source_does_not_lose_the_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "REGISTRY", {})
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"url": f"{name}{i}"} for i in range(3)]))
        R.register(name, lambda s, n=name: R.cached_postings(s, str(tmp_path / f"{n}.json"), n))
    (tmp_path / "bad.parquet").write_bytes(b"not parquet")
    R.register("c", lambda s: s.read.schema("url string, seq long").parquet(str(tmp_path / "bad.parquet")))
    rows, status = R.read_all(spark)
    got = rows.orderBy("seq").collect()
    assert [r.url for r in got] == ["a0", "a1", "a2", "b0", "b1", "b2"] and len({r.seq for r in got}) == 6
    assert {r.source: r.ok for r in status.collect()} == {"a": True, "b": True, "c": False}


def test_later_years_count(one):
    assert one(K.year_in_name(F.col("n"), 2024), n="ppm-2031.pdf") and not one(K.year_in_name(F.col("n"), 2024), n="ppm-2023.pdf")


def test_last_answer_of_a_repeated_id(spark):
    batch = spark.createDataFrame([(0, 0), (0, 1)], "batch_no long, pos int")
    answers = S.read_answers(spark.createDataFrame([(0, '[{"id":0,"score_global":1},{"id":0,"score_global":2}]', None)], S.ANSWER))
    assert {r.pos: r["item"]["score_global"] for r in J.align_answers(batch, answers).collect()}[0] in (2, "2", 2.0)


def test_cascade(spark):
    offers = spark.createDataFrame(
        [(1, "h1", "t1", None, "b", 90, 3), (2, "h2", "t2", None, "b", 10, 3), (3, "h3", "t3", None, "b", 90, 3), (4, "h4", "t4", None, "b", None, 3),
         (5, "h5", "t5", None, "b", 10, 3), (6, "h6", "t6", None, "b", 60, 3), (7, "h6", "t6", None, "b", 60, 3)],
        "seq long, content_hash string, title string, mission string, body string, semantic int, lexical int")
    cache = spark.createDataFrame([("h5", "v1", 80, L.JUDGED_OK, "-", "known")], "content_hash string, rule_version string, score int, verdict string, topic string, reason string")
    score = {"t1": 95, "t3": 60, "t6": 20}
    calls = spark.sparkContext.accumulator(0)

    def judge(request):
        calls.add(1)
        if "Titre : t4" in request:
            raise RuntimeError("down")
        title = request.split("Titre : ")[1].split("\n")[0]
        return json.dumps([{"id": 0, "score_global": score[title], "verdict": "HORS_PERIMETRE" if score[title] < 55 else "CONVENABLE"}])
    out, store = S.cascade(offers, cache, judge, "v1", size=1)
    got = {r.seq: r for r in out.collect()}
    assert {k: r.decision for k, r in got.items()} == {1: L.S_PASS, 2: L.S_OUT, 3: L.S_VERIFY, 4: L.S_ESTIMATED, 5: L.S_PASS, 6: L.S_OUT, 7: L.S_OUT}
    assert got[2].score == 10 and got[2].verdict == L.JUDGED_OUT and not got[2].estimated
    assert {r.content_hash for r in store.collect()} == {"h1", "h3", "h6"} and calls.value == 4
