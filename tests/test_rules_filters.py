"""Rule compilation and the null rule of every filter."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tendersift.functions import text as X
from tendersift.operators import filters as K
from tendersift.operators import joins as J
from tendersift.rules import RULES_SCHEMA, REGEX, WORD, Rule, RuleBook


def hits(spark, book, rule_set, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("p", X.pad_lower(F.col("s")))
    return [r["v"] for r in df.select(book.hit(rule_set, "p").alias("v")).collect()]


def test_modes(spark):
    b = RuleBook([Rule("a", " bi "), Rule("w", "voirie", WORD), Rule("w", "matériel ", WORD), Rule("r", r"\bcib\b", REGEX),
                  Rule("q", "it's 100% [x] \\d"), Rule("plus", "c++", WORD)])
    assert hits(spark, b, "a", ["BI", "bio", "une BI forte", None]) == [True, False, True, False]
    assert hits(spark, b, "w", ["ivoirienne", "Voirie", "matériels", "immatériel"]) == [False, True, True, False]
    assert hits(spark, b, "r", ["cible", "CIB", "écib"]) == [False, True, False]
    assert hits(spark, b, "q", ["It's 100% [x] \\d", "its"]) == [True, False]
    assert hits(spark, b, "none", ["x"]) == [False]


def test_long_lists_and_counts(spark):
    b = RuleBook([Rule("big", f"term{i:03d}") for i in range(100)] + [Rule("k", t) for t in ("cobit", "cobit 5", "itil")])
    assert hits(spark, b, "big", ["has term042", "no"]) == [True, False]
    df = spark.createDataFrame([(" cobit 5 itil ",), (" cobit ",)], "p string")
    assert [r[0] for r in df.select(b.at_least("k", "p", 3)).collect()] == [True, False]


def test_scores_labels_and_first_label(spark):
    b = RuleBook([Rule("s", "aa", label="one", weight=3), Rule("s", "bb", label="one", weight=3), Rule("s", "cc", label="two", weight=2)])
    df = spark.createDataFrame([(" aa bb cc ",), (" cc ",), ("",)], "p string")
    got = [tuple(r) for r in df.select(b.score("s", "p"), F.array_join(b.labels("s", "p"), "|"), b.first_label("s", "p", "NC")).collect()]
    assert got == [(5, "one|two", "one"), (2, "two", "two"), (0, "", "NC")]


def test_table_round_trip_and_version(spark):
    rules = [Rule("a", "x", label="l", weight=2), Rule("b", "Été", fold=True)]
    df = spark.createDataFrame([("a", "l", 2, "x", "substring", False), ("b", None, 0, "Été", "substring", True)], RULES_SCHEMA)
    b = RuleBook.from_table(df)
    assert b.terms("b") == ["ete"] and b.version == RuleBook(rules).version
    assert b.version != b.with_set("a", [Rule("a", "y")]).version
    with pytest.raises(ValueError):
        RuleBook([Rule("a", "  ")])
    with pytest.raises(ValueError):
        RuleBook([Rule("a", "x", "fuzzy")])


def test_enumeration_only(spark):
    b = RuleBook([Rule("sector", "banque")] + [Rule("others", t, fold=True) for t in ("énergie", "luxe", "santé", "retail")])
    texts = ["nous servons banque, energie, luxe et sante", "banque, energie, luxe, sante. notre client est une banque", "rien"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.expr(K.enumeration_only_sql(b, "t", "sector", "others"))).collect()] == [True, False, False]


def test_unknown_never_excludes(spark):
    d, t = F.lit(None).cast("date"), F.lit("2026-01-01").cast("date")
    s, n, a = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("array<string>")
    tests = [K.deadline_passed(d, t), K.deadline_too_soon(d, t), K.date_too_old(d, t), K.framework_too_large(F.lit(True), s, 1.0),
             K.amount_too_high(n), K.range_out_of_target(s, 1.0), K.not_an_open_call(s), K.goods_only(a), K.goods_only_text(s),
             K.category_out(s), K.code_prefix(a, ["1"]), K.hard_junk(F.lit(None).cast("boolean"), s, s)]
    row = spark.range(1).select(*[x.alias(f"c{i}") for i, x in enumerate(tests)]).first()
    assert not any(row)


def test_edges(spark):
    def v(c):
        return spark.range(1).select(c.alias("v")).first()["v"]
    t = F.lit("2026-01-01").cast("date")
    assert not v(K.deadline_too_soon(F.lit("2026-01-08").cast("date"), t)) and v(K.deadline_too_soon(F.lit("2026-01-07").cast("date"), t))
    assert not v(K.date_too_old(F.lit("2025-12-12").cast("date"), t)) and v(K.date_too_old(F.lit("2025-12-11").cast("date"), t))
    assert v(K.range_out_of_target(F.lit("100k - 500k€"), 100_000)) and not v(K.framework_too_large(F.lit(True), F.lit("100000"), 100_000))
    assert v(K.goods_only_text(F.lit("Fourniture de bureaux"))) and not v(K.goods_only_text(F.lit("Prestations intellectuelles")))
    assert v(K.not_an_open_call(F.lit("Attribution/x"))) and not v(K.not_an_open_call(F.lit(" APPELOFFRE/y")))
    p = v(K.procedure_check(F.lit("OUVERT"), F.lit("Procédure NC"), True))
    assert p.keep and p.status == "procédure à vérifier"
    assert not v(K.procedure_check(F.lit("OUVERT"), F.lit("Ouverte"), True)).keep
    assert v(K.year_in_name(F.lit("ppm-27-06-2023.pdf"), 2026)) is False and v(K.year_in_name(F.lit("ppm 27.pdf"), 2026))
    assert v(K.same_place(F.lit("Côte d’Ivoire - Abidjan"), "cote d'ivoire"))


def test_login_page(spark):
    b = RuleBook([Rule("login_phrase", t) for t in ("mot de passe", "identifiant")])
    df = spark.createDataFrame([("<input type='password'>", ""), ("<p>", "Identifiant et mot de passe"), ("<p>", "identifiant")], "h string, t string")
    assert [r[0] for r in df.select(K.login_page("h", "t", b)).collect()] == [True, True, False]


def test_term_join(spark):
    texts = spark.createDataFrame([(1, "Le cœur de projet, chef de projet"), (2, "projet"), (3, "")], "id int, t string")
    rules = spark.createDataFrame([("a", "Chef de projet"), ("b", "projet"), ("c", "proj")], "rule_set string, term string")
    got = {(r.id, r.rule_set) for r in J.term_join(texts, rules, "id", "t").collect()}
    assert got == {(1, "a"), (1, "b"), (2, "b")}
    long = spark.createDataFrame([("d", "le cœur de projet chef de projet")], "rule_set string, term string")
    assert [r.id for r in J.term_join(texts, long, "id", "t").collect()] == [1]


def test_term_join_equals_the_plain_search(spark):
    """Terms that begin, end and hold each other, of up to forty words, in two sets, split into many parts."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["été", "x_1", "語"]
    terms = [(f"s{i % 3}", " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 1, 2, 3, 5, 40])))) for i in range(400)]
    texts = [(i, rnd.choice(["", "!? "]).join(rnd.choice(words) + rnd.choice([" ", ", ", "\n"]) for _ in range(rnd.randrange(60)))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, terms[5][1].upper()), (202, terms[5][1]), (None, "w1 w2")]
    padded = [(i, f" {' '.join(re.findall('[^ ,!?' + chr(10) + ']+', (t or '').lower()))} ") for i, t in texts]
    want = Counter((i, s, t) for i, p in padded for s, t in set(terms) if f" {t} " in p)
    df = spark.createDataFrame(texts, "id int, t string")
    rules = spark.createDataFrame(terms + terms[:9] + [("s0", None), ("s0", " ")], "rule_set string, term string")
    for bound in (1 << 20, 500):
        assert Counter(map(tuple, J.term_join(df, rules, "id", "t", bound).collect())) == want
    assert J.term_join(df, rules.limit(0), "id", "t").count() == 0


def test_term_join_with_many_terms_emits_hits_only(spark):
    rules = spark.range(100_000).select(F.lit("s").alias("rule_set"), F.concat(F.lit("number "), F.col("id").cast("string"), F.lit(" of many")).alias("term"))
    texts = spark.createDataFrame([(1, "the number 77 of many, number 5 of few"), (2, "number 99999 of many")], "id int, t string")
    assert {tuple(r) for r in J.term_join(texts, rules, "id", "t").collect()} == {(1, "s", "number 77 of many"), (2, "s", "number 99999 of many")}
