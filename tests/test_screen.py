"""The posting screen rule by rule, and the signals across records against plain loops."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.operators import cross as C
from tendersift.operators.classify import classify_postings, window_of
from tendersift.plans.screen import in_verdict_order, screen
from tendersift.rules import REGEX, Rule, RuleBook
from tendersift.scale import attach_by_key, keep_first, keep_last, lookup, number_rows
from tendersift.schema import POSTING

TODAY = "2026-08-01"
BOOK = RuleBook(
    [Rule(s, t) for s, ts in {
        "strong": ["freelance", "tjm"], "weak": ["mission longue"], "b2b": ["freelance", "société de conseil"], "b2b_strong": ["freelance"],
        "salary": ["mutuelle"], "staff_only": ["megacorp"], "end_client": ["grande banque"], "career": ["nos valeurs"],
        "sector": ["banque", "sepa"], "sector_generic": ["banque"], "sector_specific": ["sepa"], "sector_negative": ["crédit d'impôt"],
        "sector_strong": ["sepa"], "agency": ["placeur"], "other_sector": ["télécom"], "hard_out": ["cyber"], "acceptance": ["recette"],
        "acceptance_ok": ["chargé de recette"], "infra": ["réseau"], "narrow_signal": ["pmo"], "broad_signal": ["pmo", "chef de projet"],
        "certification": ["itil", "cobit", "togaf"], "regulatory": ["fatca"], "core": ["data"], "domain_ok": ["amoa", "recette"],
        "tech_stack": ["java"], "blocked_entity": ["badco"], "signature": ["pmo", "amoa", "data", "risque"]}.items() for t in ts]
    + [Rule("area_out", "madrid", fold=True), Rule("sector_list", "energie", fold=True), Rule("sector_list", "luxe", fold=True),
       Rule("sector_list", "sante", fold=True), Rule("contract_form", r"type de contrat\s*:\s*stage", REGEX),
       Rule("reference_code", r"\bref[\s:_-]*\d{2,}\b", REGEX)])
BASE = dict(title="Consultant AMOA", entity="Cabinet X", place="", body="mission en freelance pour une banque", published="2026-07-30",
            posted_relative=None, contract_label="", closed=False, reposted=False, open_confirmed=False, source="s", url="u")


def postings(spark, *rows):
    data = []
    for i, r in enumerate(rows):
        full = {**BASE, "url": f"u{i}", **r}
        data.append(tuple(i if f.name == "seq" else full.get(f.name) for f in POSTING.fields))
    return spark.createDataFrame(data, POSTING)


def classified(spark, *rows):
    d = classify_postings(postings(spark, *rows), BOOK, F.lit(TODAY).cast("date"))
    return [r.asDict() for r in d.orderBy("seq").collect()]


def test_engagement(spark):
    bodies = ["freelance", "mutuelle", "mutuelle et freelance", "nos valeurs", "rien", "mission longue", "type de contrat :‎ stage freelance", "ref 123"]
    got = [r["kind"] for r in classified(spark, *[{"body": b} for b in bodies])]
    assert got == [L.MISSION, L.HIRING, L.MISSION, L.HIRING, L.TO_CONFIRM, L.MISSION, L.HIRING, L.MISSION]
    by_entity = classified(spark, {"entity": "MegaCorp"}, {"entity": "MegaCorp", "body": "tjm"}, {"entity": "Grande Banque", "body": "tjm"},
                           {"entity": "Grande Banque", "body": "x"}, {"entity": "Grande Banque", "body": "tjm", "contract_label": "Contrat"})
    assert [r["kind"] for r in by_entity] == [L.MISSION, L.HIRING, L.TO_CONFIRM, L.HIRING, L.MISSION]


def test_sector(spark):
    rows = [{"body": b, "entity": e} for b, e in [
        ("une banque", "x"), ("crédit d'impôt banque", "x"), ("crédit d'impôt banque sepa", "x"), ("banque, energie, luxe, santé", "x"),
        ("banque, energie, luxe, santé. client banque", "x"), ("rien", "Placeur"), ("télécom", "Placeur"), ("rien", "x")]]
    assert [r["sector"] for r in classified(spark, *rows)] == [L.YES, L.NO, L.YES, L.NO, L.YES, L.LIKELY, L.NO, L.NO]


def test_scope(spark):
    rows = [{"title": t, "body": b} for t, b in [
        ("Data cyber", ""), ("Recette", ""), ("Chargé de recette", ""), ("Chef de projet réseau", ""), ("PMO réseau", "amoa"),
        ("AMOA", "itil cobit togaf"), ("AMOA", "fatca"), ("Data engineer java", ""), ("Java", "amoa"), ("Consultant", "amoa"), ("Consultant", "x")]]
    got = [r["out_of_scope"] for r in classified(spark, *rows)]
    assert got == [True, True, False, True, False, True, True, False, True, False, True]
    barred = classified(spark, {"title": "Data à Mádrid"}, {"entity": "BadCo"}, {"place": "Madrid", "title": "Data"})
    assert all(r["out_of_scope"] and not r["core"] for r in barred)


@pytest.mark.parametrize("age,closed,reposted,sure,want", [
    (7, False, False, False, L.W_NEW), (21, False, False, False, L.W_OPEN), (22, False, False, False, L.W_AGED), (22, False, True, False, L.W_REOPENED),
    (90, False, False, True, L.W_BACKLOG), (91, False, False, True, L.W_AGED), (None, False, False, True, L.W_OPEN),
    (None, None, None, None, L.W_UNKNOWN), (1, True, False, True, L.W_CLOSED)])
def test_window(spark, age, closed, reposted, sure, want):
    df = spark.createDataFrame([(age, closed, reposted, sure)], "a int, c boolean, r boolean, s boolean")
    assert df.select(window_of("a", "c", "r", "s")).first()[0] == want


def test_whole_screen(spark):
    p = postings(spark, {}, {"title": "Consultant AMOA (H/F)"}, {"title": "Data", "url": "d"}, {"published": "2026-06-01", "title": "AMOA risque", "body": "freelance banque 1"},
                 {"published": "2026-06-02", "title": "AMOA risque", "body": "freelance banque 2"}, {"published": None, "title": "AMOA seul"},
                 *[{"entity": "Jamais", "body": f"banque {i}", "title": f"AMOA {i}"} for i in range(3)])
    rows = {r.seq: r for r in screen(p, BOOK, F.lit(TODAY).cast("date")).collect()}
    assert 1 not in rows                                        # same publisher, same comparable title, same opening
    assert rows[0].verdict == L.V_GOOD and rows[2].verdict == L.V_TOP
    assert rows[3].window == rows[4].window == L.W_BACKLOG and rows[3].recurring
    assert (rows[5].verdict, rows[5].reason) == (L.V_OUT, L.R_DATE)
    assert {rows[i].reason for i in (6, 7, 8)} == {L.R_HIRING}   # never any contract signal from this publisher
    order = [r.seq for r in in_verdict_order(screen(p, BOOK, F.lit(TODAY).cast("date"))).collect()]
    assert order[:2] == [2, 0] and order[2:4] == [4, 3]


def test_dedup_does_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(20), rnd.randrange(3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "seq int, a int, b int")
    want = {}
    for s, a, b in rows:
        want.setdefault((a, b), s)
    for n in (1, 7):
        assert {r.seq for r in keep_first(df.repartition(n), ["a", "b"], ["seq"]).collect()} == set(want.values())
    assert {r.seq for r in keep_last(df, ["a", "b"], ["seq"]).collect()} == set({(a, b): s for s, a, b in rows}.values())


def test_attach_with_hot_and_null_keys(spark):
    rows = [(i, None if i % 5 == 0 else (0 if i % 3 == 0 else i % 40)) for i in range(2000)]
    df = spark.createDataFrame(rows, "seq int, k int")
    stats = df.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("seq").alias("m"))
    want = {r["k"]: (r["n"], r["m"]) for r in stats.collect()}
    for hot in (1, 3, 1000):
        got = attach_by_key(df, stats, ["k"], "n", "seq", hot_keys=hot).collect()
        assert len(got) == 2000 and all((r.n, r.m) == want.get(r.k, (None, None)) for r in got)
    for limit in (1, 1000):
        got = lookup(df, stats, ["k"], "seq", max_rows=limit).collect()
        assert len(got) == 2000 and all((r.n, r.m) == want.get(r.k, (None, None)) for r in got)


def test_number_rows(spark):
    seqs = random.Random(1).sample(range(-500, 10**6), 500)
    got = number_rows(spark.createDataFrame([(s,) for s in seqs], "seq long"), "seq", "n", 1000).collect()
    assert {r.seq: r.n for r in got} == {s: i + 1 for i, s in enumerate(sorted(seqs))}


def test_number_rows_of_sparse_values(spark):
    """Hash values and texts as order: as many ranges as the rows need, not the values."""
    rnd = random.Random(2)
    seqs = list({rnd.randrange(-2**62, 2**62) for _ in range(3000)})
    for kind, values in (("long", seqs), ("string", [f"k{s}" for s in seqs])):
        df = number_rows(spark.createDataFrame([(s, 7) for s in values], f"seq {kind}, _n int"), "seq", "n", 500)
        assert df.columns == ["seq", "_n", "n"]
        assert {r.seq: r.n for r in df.collect()} == {s: i + 1 for i, s in enumerate(sorted(values))}
    assert number_rows(spark.range(0).toDF("seq"), "seq", "n").count() == 0


def test_number_rows_asks_for_a_bounded_sample(spark, monkeypatch):
    """A narrow width on a long table: no more ranges than MOST_RANGES, since each one sends a sample to the driver."""
    kind, asked = type(spark.range(0)), []
    plain = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda d, n, *c: asked.append(n) or plain(d, n, *c))
    df = spark.range(3000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    got = {r.h: r.n for r in number_rows(df, "h", "n", 3).collect()}
    assert asked == [256] and got == {h: i + 1 for i, h in enumerate(sorted(got))} and len(got) == 3000


def scan(rows, days=15):
    """Group numbers by the plain scan over all later records."""
    tag, n = {}, 0
    for i, (si, ei, gi, ai) in enumerate(rows):
        if si in tag:
            continue
        hit = [sj for sj, ej, gj, aj in rows[i + 1:] if ei != ej and len(set(gi) & set(gj)) >= 2
               and (ai is None or aj is None or abs(ai - aj) <= days)]
        if hit:
            n += 1
            for s in [si, *hit]:
                tag[s] = (si, n)
    return tag


@pytest.mark.parametrize("seed,n,ages,rounds,bound", [
    (1, 60, 40, 0, C.SCAN_COMBINATIONS), (2, 120, 300, C.OPEN_ROUNDS, C.SCAN_COMBINATIONS), (3, 90, 10, 1, 20)])
def test_same_item_groups_equal_the_scan(spark, monkeypatch, seed, n, ages, rounds, bound):
    """By components at once, by rounds, and with components too large for one task, which go on in rounds."""
    monkeypatch.setattr(C, "OPEN_ROUNDS", rounds)
    rnd = random.Random(seed)
    vocab = ["a", "b", "c", "d", "e"]
    rows = [(i * 3, f"p{rnd.choice([0, 0, 0, 1, 2, 3])}", sorted(rnd.sample(vocab, rnd.choice([2, 2, 3]))),
             None if rnd.random() < 0.1 else rnd.randrange(ages)) for i in range(n)]
    df = spark.createDataFrame(rows, "seq long, entity_key string, signature array<string>, age int").repartition(5)
    got = {r.seq: (r.group_seed, r.group_no) for r in C.same_item_groups(df, width=50, scan=bound).collect()}
    assert got == scan(rows)
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1:] if a[1] != b[1] and len(set(a[2]) & set(b[2])) >= 2
             and (a[3] is None or b[3] is None or abs(a[3] - b[3]) <= 15)]
    assert {r.seq for r in C.same_item_matches(df).collect()} == {x[0] for p in pairs for x in p}


def test_same_item_rounds_do_not_grow_with_a_chain(spark, monkeypatch):
    plain, asked = C._best_match, []
    monkeypatch.setattr(C, "_best_match", lambda *a: asked.append(1) or plain(*a))
    rounds = {}
    for n in (12, 1000):
        asked.clear()
        rows = [(i, f"p{i}", sorted([f"t{i:04d}", f"u{i:04d}", f"t{i + 1:04d}", f"u{i + 1:04d}"]), i % 5) for i in range(n)]
        df = spark.createDataFrame(rows, "seq long, entity_key string, signature array<string>, age int")
        got = {r.seq: (r.group_seed, r.group_no) for r in C.same_item_groups(df).collect()}
        assert got == scan(rows)
        rounds[n] = len(asked)
    assert rounds[12] == rounds[1000]


def test_same_item_chain_and_empty(spark):
    rows = [(0, "x", ["a", "b"], 0), (1, "y", ["a", "b", "c", "d"], 0), (2, "z", ["c", "d"], 0)]
    schema = "seq long, entity_key string, signature array<string>, age int"
    got = {r.seq: r.group_no for r in C.same_item_groups(spark.createDataFrame(rows, schema)).collect()}
    assert got == {0: 1, 1: 1}            # the third only matches a record that is already in a group
    assert C.same_item_groups(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("width", [3, 1000])
def test_latest_opener_of_another_publisher(spark, width):
    """One key in all, so a target of unknown age brings one row a combination and not one for every age."""
    rnd = random.Random(5)
    openers = [("ab", rnd.choice("PQR"), s) for s in range(0, 60, 2)]
    targets = [("ab", rnd.choice("PQRS"), s) for s in range(1, 60, 2)] + [("cd", "P", 61)]
    kind = "combo string, e string, seq long"
    got = C._latest_of_others(spark.createDataFrame(openers, kind), spark.createDataFrame(targets, kind), ["combo"], width).collect()
    want = {s: max((o for k, p, o in openers if k == c and p != e and o < s), default=None) for c, e, s in targets}
    assert len(got) == len(targets) and {r.seq: r.g for r in got} == want


def test_second_best_does_not_sort_for_every_candidate(spark):
    """A second publisher last of many candidates: the best is found once."""
    n = 20_000
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(
        (n - i).alias("v"), F.when(i == 1, "q").otherwise("p").alias("e"))).alias("c"))
    start = time.monotonic()
    assert [tuple(x) for x in df.repartition(2).select(C._two_best(F.col("c")).alias("b")).first().b] == [(0, "p"), (n - 1, "q")]
    assert time.monotonic() - start < 20
