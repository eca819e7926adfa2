"""The similarity cascade with a fake judge, audit reports, and streams."""

import json

import pytest
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions.vectors import best_cosine, cosine
from tendersift.operators import audit as A
from tendersift.operators import joins as J
from tendersift.operators import similar as S
from tendersift.operators import upkeep as U
from tendersift.rules import Rule, RuleBook
from tendersift.streaming import feeds


def test_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0])], "i int, v array<float>")
    got = {r.i: r.s for r in df.select("i", best_cosine(F.col("v"), [[2.0, 0.0], [0.0, 1.0]]).alias("s")).collect()}
    assert got == {1: 1.0, 2: 0.0, 3: 0.0, 4: None, 5: None}
    one = df.filter("i < 4").select("i", cosine(F.col("v"), F.array(F.lit(3.0), F.lit(0.0))).alias("c")).collect()
    assert {r.i: r.c for r in one} == {1: 1.0, 2: -1.0, 3: 0.0}
    assert S.block_vectors(spark.createDataFrame([([1.0],)], "embedding array<float>")) == [[1.0]]


@pytest.mark.parametrize("most", [1, 7, 4096])
def test_exact_bands(spark, most):
    import random
    import statistics
    rnd = random.Random(most)
    rows = [("a", rnd.gauss(0, 1e6)) for _ in range(801)] + [("b", float(rnd.choice([1, 1, 1, 2, 3]))) for _ in range(400)]
    rows += [("c", 5.0), (None, -1.0), (None, 4.0), ("a", None), ("d", None), ("a", float("nan")), ("e", -0.5), ("e", float("inf"))]
    rows += [("f", 7.0)] * 300 + [("f", rnd.random()) for _ in range(300)]
    got = {r[0]: tuple(r)[1:] for r in A.exact_bands(spark.createDataFrame(rows, "k string, v double"), "k", "v", most).collect()}
    want = {}
    for k, v in rows:
        if v is not None and v == v:
            want.setdefault(k, []).append(v)
    assert got == {k: (len(v), min(v), statistics.median(v), max(v)) for k, v in want.items()}
    assert A.exact_bands(spark.createDataFrame([], "k string, v double"), "k", "v").count() == 0


def make_judge():
    def fake_judge(request):
        n = request.count("### OFFRE")
        if "boom" in request:
            raise RuntimeError("quota " + "x" * 300)
        return "```json\n" + json.dumps([{"id": i, "score_global": 80 - i, "verdict": "convenable", "raison": "ok"} for i in range(n)]) + "\n```"
    return fake_judge


def test_judge_round(spark):
    offers = spark.createDataFrame([(i, f"t{i}", "", "boom" if i == 20 else "body") for i in range(25)], "seq int, title string, mission string, body string")
    b = S.batches(S.judge_input(offers))
    req = S.requests(b)
    assert sorted((r.batch_no, r.n_items) for r in req.collect()) == [(0, 10), (1, 10), (2, 5)]
    ans = S.read_answers(S.ask(req, make_judge()))
    settled = S.settle(J.align_answers(b, ans))
    rows = {r.seq: r for r in settled.collect()}
    assert (rows[3].score, rows[3].verdict) == (77, L.JUDGED_OK)
    assert rows[21].score is None and rows[21].verdict == L.JUDGE_UNAVAILABLE and len(rows[21].reason) == L.REASON_CHARS
    kept = S.storable(settled.withColumn("content_hash", F.col("seq").cast("string")), "v1")
    assert kept.count() == 20
    est = S.with_fallback(settled.withColumns({"semantic": F.when(F.col("seq") == 20, 41), "lexical": F.lit(17)}))
    got = {r.seq: (r.score, r.estimated) for r in est.collect()}
    assert got[20] == (41, True) and got[21] == (100, True) and got[0] == (80, False)


def test_cache_version_and_gate(spark):
    offers = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 40), ("e", None)], "content_hash string, semantic int").withColumn("seq", F.col("semantic"))
    cache = spark.createDataFrame([("a", "v1", 1, "x", "-", ""), ("b", "v2", 2, "x", "-", "")], "content_hash string, rule_version string, score int, verdict string, topic string, reason string")
    g = S.gate(S.with_judgements(offers, cache, "v2"))
    assert {r.content_hash: r.cut for r in g.collect()} == {"a": False, "b": False, "c": True, "d": False, "e": False}
    assert {r.content_hash for r in S.pending(g).collect()} == {"a", "d", "e"}
    assert {r.content_hash for r in S.gate(S.with_judgements(offers, cache, "v2"), any_version=False).filter("cut").collect()} == {"a", "c"}
    assert S.purge(cache).count() == 0 and S.purge(cache, "v1").count() == 1


@pytest.mark.parametrize("score,est,want", [(75, False, L.S_PASS), (74, False, L.S_VERIFY), (55, False, L.S_VERIFY), (54, False, L.S_OUT), (None, False, L.S_NONE), (10, True, L.S_ESTIMATED)])
def test_similarity_verdict(spark, score, est, want):
    assert spark.range(1).select(S.similarity_verdict(F.lit(score).cast("int"), F.lit(est)).alias("v")).first().v == want


def test_apply_similarity(spark):
    p = spark.createDataFrame([("a", L.V_GOOD), ("b", L.V_GOOD), ("c", L.V_OUT)], "url string, verdict string")
    j = spark.createDataFrame([("a", 80, L.S_PASS, "t", "r")], "url string, score int, sim_verdict string, topic string, reason string")
    assert {r.url: r.sim_verdict for r in S.apply_similarity(p, j).collect()} == {"a": L.S_PASS, "b": L.S_NONE, "c": None}


def test_alerts(spark):
    book = RuleBook([Rule("salary_wording", "mutuelle"), Rule("freelance_wording", "tjm")])
    schema = "seq int, title string, body string, age int, published string, verdict string, out_of_scope boolean, sector string, kind string"
    rows = [(1, "t", None, None, None, L.V_OUT, True, L.NO, L.HIRING), (2, "t", "la  mutuelle", 46, "2026-01-01", L.V_GOOD, False, L.YES, L.MISSION),
            (3, "tjm", "mutuelle", 45, None, L.V_OUT, False, L.YES, L.HIRING)]
    got = sorted((r.seq, r.alert, r.proof) for r in A.alerts(spark.createDataFrame(rows, schema), book).collect())
    assert [g[:2] for g in got] == [(1, "TEXTE INTROUVABLE"), (2, "AGEE (46 j)"), (2, "CDI PROBABLE"), (3, "NE PASSE PLUS LES FILTRES"), (3, "RECRUTEMENT (non regie)")]
    assert got[2][2] == "...la mutuelle..."


def test_bands_and_documents(spark):
    df = spark.createDataFrame([("p", 10), ("p", 20), ("p", 31), ("p", 40), ("n", 5)], "band string, score int")
    assert {r.band: (r.n, r.low, r.median, r.high) for r in A.score_bands(df, "band", "score").collect()} == {"p": (4, 10, 26, 40), "n": (1, 5, 5, 5)}
    docs = spark.createDataFrame([("x", "CCAP.docx", "ok"), ("x", "notice.pdf", "ok"), ("y", "a.docx", "vide"), ("z", "b_cctp.docx", "ok"), ("z", "rc-1.docx", "ok"), ("w", "arcade.pdf", "ok")],
                                 "id string, name string, st string")
    assert {r.id: (r.name, r["rank"]) for r in A.best_document(docs, "id", "name", "st").collect()} == {"x": ("notice.pdf", 99), "z": ("rc-1.docx", 1), "w": ("arcade.pdf", 99)}


def write_feed(spark, path, rows):
    spark.createDataFrame(rows, "url string, source string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def drain(query):
    assert query.awaitTermination(90), "stream did not finish"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "feed")
    write_feed(spark, src, [("u?1", "a", "2026-01-01 10:00:00"), ("u?2", "a", "2026-01-01 11:00:00"), ("w", "b", "2026-01-02 10:00:00")])
    feed = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)

    def run(df, mode, name):
        drain(df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
        return spark.table(name).collect()

    assert {r.url for r in run(feeds.new_items(feed), "append", "new_items")} == {"u", "w"}
    assert {(str(r.day)[:10], r.source, r.n) for r in run(feeds.daily_counts(feed), "update", "daily")} == {("2026-01-01", "a", 2), ("2026-01-02", "b", 1)}
    assert [(r.key, r.n) for r in run(feeds.recurrence(feed, key="source"), "update", "rec")] == [("a", 2)]


@pytest.mark.parametrize("shards", [1, 8])
def test_recurrence_of_many_keys_takes_a_call_a_shard(spark, tmp_path, shards):
    """Keys of a shard share its state, each is forgotten by its own last record, also while others of its shard get rows."""
    src, out = str(tmp_path / "feed"), str(tmp_path / "out")
    landings = [[("a", "2026-01-01 10:00:00"), ("b", "2026-01-01 11:00:00"), ("b", "2026-01-01 12:00:00"), ("d", "2026-05-01 10:00:00")],
                [("c", "2026-06-01 10:00:00")], [("c", "2026-06-02 10:00:00"), ("d", "2026-06-02 10:00:00")], [("a", "2026-06-02 11:00:00"), ("c", "2026-06-02 11:00:00")]]
    for rows in landings:
        write_feed(spark, src, [("u", k, ts) for k, ts in rows])
        feed = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        w = feeds.recurrence(feed, key="source", shards=shards).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state"))
        drain(w.foreachBatch(lambda b, i: b.write.mode("append").parquet(out)).trigger(availableNow=True).start())
    assert sorted((r.key, r.n) for r in spark.read.parquet(out).collect()) == [("b", 2), ("c", 2), ("c", 3), ("d", 2)]


def test_stream_upsert_is_idempotent(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "cur")
    batch = spark.createDataFrame([("a", "s", "1"), ("b", "s", "1")], "id string, source string, v string")
    batch.coalesce(1).write.parquet(src)
    schema = batch.schema.add("protected", "boolean")
    feed = spark.readStream.schema(batch.schema).parquet(src)
    drain(feeds.curated_upsert(feed, root, schema, str(tmp_path / "ck")))
    assert U.read_current(spark, root + "/table", schema).count() == 2
    before = U.current_version(spark, root + "/table")
    drain(feeds.curated_upsert(feed, root, schema, str(tmp_path / "ck2")))      # same batch number after a lost checkpoint
    assert U.current_version(spark, root + "/table") == before
