"""Merges, ledgers, versions on disk, lookups and set operators."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.operators import joins as J
from tendersift.operators import upkeep as U
from tendersift.rules import Rule, RuleBook

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("id", T.StringType()), ("source", T.StringType()), ("v", T.StringType()), ("protected", T.BooleanType()))])
TABLE = [("a", "s1", "old", False), ("b", "s1", "old", True), ("c", "s1", "old", False), ("d", "s1", "old", True), ("e", "s2", "old", None)]
BATCH = [("a", "s1", "new"), ("b", "s1", "new"), ("f", "s1", "new"), ("g", "s1", "new"), (None, "s1", "x"), ("", "s1", "x")]


def frames(spark, batch=BATCH, ledger=("a", "b", "c", "d", "g")):
    return (spark.createDataFrame(TABLE, SCHEMA), spark.createDataFrame(batch, "id string, source string, v string"),
            spark.createDataFrame([(x,) for x in ledger], "id string"))


def test_merge_cases(spark):
    t, b, led = frames(spark)
    plan = U.merge_plan(t, b, led, U.batch_sources(b))
    got = {r.id: (r.action, r.v) for r in plan.collect()}
    assert got == {"a": ("update", "new"), "b": ("protected", "old"), "c": ("remove", "old"), "d": ("protected", "old"),
                   "e": ("keep", "old"), "f": ("add", "new"), "g": ("skip_deleted", "new")}
    assert {r.id for r in U.merged_rows(plan).collect()} == {"a", "b", "d", "e", "f"}
    assert {r.action: r.n for r in U.merge_counts(plan).collect()}["protected"] == 2
    assert {r.id for r in U.grown_ledger(led, b.filter("id <> ''")).collect()} == set("abcdgf")


def test_empty_batch_with_scope_and_repeated_ids(spark):
    t, b, led = frames(spark, batch=[])
    plan = U.merge_plan(t, b, led, spark.createDataFrame([("s1",)], "source string"))
    assert {r.id for r in U.merged_rows(plan).collect()} == {"b", "d", "e"}
    twice = spark.createDataFrame([("z", "s1", "1", 1), ("z", "s1", "2", 2)], "id string, source string, v string, seq int")
    t2 = t.withColumn("seq", F.lit(0))
    assert [r.v for r in U.merge_plan(t2, twice, order="seq").filter("action = 'add'").collect()] == ["2"]


def test_merge_is_idempotent(spark):
    t, b, led = frames(spark)
    once = U.merged_rows(U.merge_plan(t, b, led, U.batch_sources(b)))
    again = U.merged_rows(U.merge_plan(once, b, U.grown_ledger(led, b), U.batch_sources(b)))
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in again.select(*once.columns).collect()}


def test_publish_replay_and_required_state(spark, tmp_path):
    root = str(tmp_path / "w")
    with pytest.raises(FileNotFoundError):
        U.read_current(spark, root + "/table", SCHEMA, require_state=True)
    assert U.read_current(spark, root + "/table", SCHEMA).count() == 0
    t, b, _ = frames(spark)
    assert U.publish(t, root + "/table", dry_run=True) is None and U.current_version(spark, root + "/table") is None
    assert U.publish(t, root + "/table") == 1
    U.stage_batch(b.filter("id <> ''"), root, "b1")
    counts = {r.action: r.n for r in U.apply_batch(spark, root, "b1", SCHEMA).collect()}
    assert counts == {"update": 1, "protected": 2, "remove": 1, "keep": 1, "add": 2}
    first = {tuple(r) for r in U.read_current(spark, root + "/table", SCHEMA, True).collect()}
    U.apply_batch(spark, root, "b1", SCHEMA).collect()          # replay after a failure
    assert {tuple(r) for r in U.read_current(spark, root + "/table", SCHEMA, True).collect()} == first
    spark.createDataFrame([("x", "s1", "v", False)], SCHEMA).write.parquet(root + "/table/v=99")   # written, never committed
    assert {tuple(r) for r in U.read_current(spark, root + "/table", SCHEMA).collect()} == first


def test_ledger(spark):
    led = spark.createDataFrame([("u", 1, 2, "A", "t", "e")], "url string, first_seen int, last_check int, verdict string, title string, entity string")
    items = spark.createDataFrame([("u", "B", "t2", "e2"), ("w", "C", "t3", "e3")], "url string, verdict string, title string, entity string")
    got = {r.url: tuple(r)[1:4] for r in U.update_ledger(led, items, F.lit(9)).collect()}
    assert got == {"u": (1, 9, "B"), "w": (9, 9, "C")}
    seen = J.with_ledger(items.withColumn("url", F.concat("url", F.lit("/?x=1"))), led, F.lit(9), "verdict")
    assert {r.url: (r.is_new, r.first_seen) for r in seen.collect()} == {"u": (False, 1), "w": (True, 9)}


def test_append_clean_and_updates(spark):
    t = spark.createDataFrame([("u1", "Mega"), ("u2", "x"), ("u3", "Mega")], "url string, entity string")
    items = spark.createDataFrame([("u1", True, "V", None), ("n1", True, "V", L.S_PASS), ("n2", True, "V", L.S_OUT), ("n3", True, "V", L.S_NONE), ("n4", False, "V", None)],
                                  "url string, is_new boolean, verdict string, sim_verdict string")
    assert {(r.url, r.verdict) for r in U.append_new(t, items).collect()} == {("n1", "V"), ("n3", L.S_NONE)}
    judged = spark.createDataFrame([("u1", False, L.YES, L.MISSION), ("u2", True, L.YES, L.MISSION)], "url string, out_of_scope boolean, sector string, kind string")
    book = RuleBook([Rule("staff_only", "mega")])
    assert {r.url for r in U.clean_up(t, judged, book).collect()} == {"u1"}
    upd = spark.createDataFrame([("u1", "done"), ("u2", "")], "url string, entity string")
    assert [r.entity for r in U.update_columns(t, upd, "url", ["entity"]).orderBy("url").collect()] == ["done", "x", "Mega"]
    seen = U.refresh_seen(t, spark.createDataFrame([("u1",), ("u1",)], "url string"), F.lit("2026-01-01").cast("timestamp"))
    assert [r.last_check is not None for r in seen.orderBy("url").collect()] == [True, False, False]
    assert U.curated_view(t.limit(1), {"url": "NC", "entity": "NC"}).columns == ["url", "entity"]


def test_lookups(spark):
    cache = spark.createDataFrame([("k1", "t", "first", 1), ("k2", "t", "second", 2)], "url string, title string, v string, o int")
    rows = spark.createDataFrame([("k2", "zz"), ("nope", "t"), (None, "no")], "url string, title string")
    assert sorted((r.title, r.v) for r in J.two_key_lookup(rows, cache, "url", "title", ["v"], "o", "title").collect()) == [("no", None), ("t", "first"), ("zz", "second")]
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, s int")
    assert {(r.k, r.s) for r in J.backfill(old, spark.createDataFrame([("a", 9)], "k string, s int"), "k", ["s"]).collect()} == {("a", 9), ("b", 2)}
    work = J.detail_work_list(old, spark.createDataFrame([("a",)], "k string"), "k", ["k"], 5)
    assert [r.k for r in work.collect()] == ["b"]
    found = spark.createDataFrame([("Risques de marché",)], "label string")
    assert [r.label for r in J.missing_labels(found, "label", ["risques", "ALM"]).collect()] == ["ALM"]


def test_reference_merge_and_passes(spark):
    schema = "seq int, entity_key string, title_norm string, url string"
    scraped = spark.createDataFrame([(1, "a", "t", "u1?x"), (2, "a", "t", "u2")], schema)
    ref = spark.createDataFrame([(5, "a", "t", "u9"), (6, "b", "t", "u1"), (7, "c", "t", ""), (8, "c", "t", "u8")], schema)
    assert {r.seq for r in J.merge_reference(scraped, ref, ["entity_key", "title_norm"]).collect()} == {1, 7}
    a = spark.createDataFrame([("x", 2)], "id string, o int")
    b = spark.createDataFrame([("x", 1), ("y", 1)], "id string, o int")
    assert {(r.id, r.pass_no) for r in J.union_passes([a, b], "id", "o").collect()} == {("x", 0), ("y", 1)}


def test_title_and_entity_against_a_plain_scan(spark):
    import random
    rnd = random.Random(4)
    names = ["".join(rnd.choice("abé") for _ in range(rnd.randint(0, 6))) for _ in range(120)]
    rows = [(i, rnd.choice(["Achat de bus", "bus urbain", "École bus", ""]), n) for i, n in enumerate(names)] + [(900, None, "ab"), (901, "bus", None)]
    queries = [(i, rnd.choice(["Bus neuf", "ecole", "achat"]), "".join(rnd.choice("ABé") for _ in range(i % 6))) for i in range(60)]
    queries += [(900, None, "a"), (901, "bus", None), (902, "bus", "a" * 40)]
    got = J.match_by_title_and_entity(spark.createDataFrame(queries, "query_id int, title string, entity string"),
                                      spark.createDataFrame(rows, "seq int, title string, entity string"))

    def plain(t):
        return t.lower().replace("é", "e")
    want = []
    for q, t, e in queries:
        hits = [s for s, title, name in rows if None not in (t, e, title, name) and plain(t.split()[0]) in re.split("[^a-z]+", plain(title)) and e.lower() in name]
        want += [(q, min(hits))] if hits else []
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_publishers_and_wishes_of_one_word_make_no_product(spark):
    n = 3000
    rows = spark.range(n).selectExpr("int(id) AS seq", "'bus' AS title", "concat('ville-', id, '-x') AS entity")
    queries = spark.range(n).selectExpr("int(id) AS query_id", "'bus' AS title", "concat('-', id, '-') AS entity")
    got = J.match_by_title_and_entity(queries, rows)
    assert got.filter("query_id <> seq").count() == 0 and got.count() == n


def test_texts_that_raise_no_salary_alert_are_not_quoted(spark):
    from tendersift.operators.audit import wording
    b = RuleBook([Rule("salary_wording", "salaire"), Rule("freelance_wording", "freelance")])
    rows = [(1, "a", "un  salaire\nfixe"), (2, "Freelance", "un salaire fixe"), (3, "a", "rien"), (4, "a", None)]
    got = {r["seq"]: tuple(r)[1:] for r in wording(spark.createDataFrame(rows, "seq long, title string, body string"), b).collect()}
    assert got == {1: (True, True, False, "...un salaire fixe..."), 2: (True, True, True, None), 3: (True, False, False, None),
                   4: (False, False, False, None)}
