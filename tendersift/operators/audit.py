"""Audit of published rows, calibration of thresholds, effect of rule changes, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tendersift import labels as L
from tendersift.functions import text as X
from tendersift.rules import RuleBook
from tendersift.scale import keep_first, sized_broadcast
from tendersift.session import cut_lineage

MOST_VALUES = 4096    # rows of a band between two bounds that are sorted by value in one task
SPLITTERS = 64
MOST_BANDS = 100_000    # bands whose ranges may travel to the tasks


def wording(df: DataFrame, book: RuleBook) -> DataFrame:
    """What the alerts need of a text, row by row: (seq, has_text, salaried, free, proof). Nothing wide goes on.

    The proof is null, and its text is not looked at, where the wording raises no alert.
    """
    body = "concat(' ', lower(coalesce(body, '')), ' ')"
    offer = "concat(' ', lower(coalesce(title, '')), ' ', lower(coalesce(body, '')), ' ')"
    tested = df.select("seq", "body", F.col("body").isNotNull().alias("has_text"), book.hit("salary_wording", body).alias("salaried"),
                       book.hit("freelance_wording", offer).alias("free"))
    flat = tested.withColumn("_flat", F.when(F.col("salaried") & ~F.col("free"), X.squeeze(F.col("body"))))
    proof = X.keyword_in_context("_flat", book.terms("salary_wording"), 45, 90)
    return flat.select("seq", "has_text", "salaried", "free", proof.alias("proof"))


def alerts(df: DataFrame, book: RuleBook) -> DataFrame:
    """AUD1 and AUD2: `alerts_of` for rows (seq unique) that carry their title and body."""
    return alerts_of(df.drop("title", "body").join(wording(df, book), "seq"))


def alerts_of(d: DataFrame) -> DataFrame:
    """AUD1 and AUD2: one row per alert (seq, kind, proof) of published rows joined to their postings.

    Input: seq, age, published, verdict, out_of_scope, sector, kind, and the columns of `wording`, where `has_text`
    is false when the posting is unknown.
    """
    c = F.col
    have = F.coalesce(c("has_text"), F.lit(False))

    def alert(test: Column, kind: Column | str, why: Column | str) -> Column:
        k = kind if isinstance(kind, Column) else F.lit(kind)
        w = why if isinstance(why, Column) else F.lit(why)
        return F.when(test, F.struct(k.alias("alert"), w.alias("proof")))

    motive = (F.when(c("out_of_scope"), "hors perimetre").when(c("sector") == L.NO, "pas bancaire").otherwise(c("verdict")))
    found = F.array(
        alert(~have, "TEXTE INTROUVABLE", "offre absente du cache : impossible a re-verifier"),
        alert(have & c("salaried") & ~c("free"), "CDI PROBABLE", F.coalesce(c("proof"), F.lit(""))),
        alert(have & (c("age") > L.AUDIT_MAX_AGE), F.concat(F.lit("AGEE ("), c("age"), F.lit(" j)")),
              F.concat(F.lit("publiee le "), F.coalesce(c("published"), F.lit("?")))),
        alert(have & ((c("verdict") == L.V_OUT) | c("out_of_scope") | (c("sector") == L.NO)), "NE PASSE PLUS LES FILTRES", motive),
        alert(have & (c("kind") == L.HIRING), "RECRUTEMENT (non regie)", ""))
    return d.select("seq", F.explode(F.array_compact(found)).alias("_a")).select("seq", "_a.alert", "_a.proof")


def score_bands(df: DataFrame, band: str, score: str) -> DataFrame:
    """AGG6: n, min, median, max per band; scores are whole numbers 0..100, so a median needs 101 counts."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(band, score).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(band).orderBy(score)
    run = counts.withColumns({"_hi": F.sum("_c").over(w), "_n": F.sum("_c").over(Window.partitionBy(band))})
    run = run.withColumn("_lo", F.col("_hi") - F.col("_c"))

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("_lo") < k) & (k <= F.col("_hi")), F.col(score)))

    n = F.col("_n")
    left, right = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    return run.groupBy(band).agg(F.max("_n").alias("n"), F.min(score).alias("low"),
                                 F.bround((at(left) + at(right)) / 2).cast("int").alias("median"), F.max(score).alias("high"))


def exact_bands(df: DataFrame, band: str, score: str, most: int = MOST_VALUES) -> DataFrame:
    """AGG6 for any numeric score: (band, n, low, median, high), the median exact as a double.

    The two middle rows of each band are bracketed by refining ranges. A round takes approximate splitters of what lies
    strictly inside a band's range, counts exactly how many rows fall between and on them, and goes on with the stretch that
    holds the middle; splitters that are off cost a round, never a wrong value. Rows that repeat one value are counted before
    the shuffle. Ranges with at most `most` rows inside are counted by value. Null and NaN scores are left out; a null band is
    a band; no rows, no rows.
    """
    d = df.select(F.col(band).alias("_b"), F.col(score).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    whole = cut_lineage(d.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")))
    left, right = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    ranges = cut_lineage(whole.select("_b", "n", F.col("low").alias("lo"), F.col("high").alias("hi"),
                                      F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")))

    def within(r: DataFrame) -> DataFrame:
        r = sized_broadcast(r.withColumnRenamed("_b", "_k"), MOST_BANDS)
        return d.join(r, F.col("_b").eqNullSafe(F.col("_k"))).filter("_v between lo and hi").drop("_k")

    grid = F.array(*[F.lit(k / SPLITTERS) for k in range(SPLITTERS + 1)])
    running = Window.partitionBy("_b").orderBy("_at")
    each = Window.partitionBy("_b")
    while (ranges.agg(F.max("inside")).first()[0] or 0) > most:
        cuts = (within(ranges).filter("_v > lo and _v < hi").groupBy("_b").agg(F.percentile_approx("_v", grid, 10_000).alias("cuts"))
                .withColumnRenamed("_b", "_k"))
        cut = cut_lineage(ranges.join(cuts, F.col("_b").eqNullSafe(F.col("_k")), "left").drop("_k").withColumn(
            "cuts", F.expr("array_sort(array_distinct(concat(coalesce(cuts, array()), array(lo, hi))))")))
        # 2 * k between the splitters k - 1 and k, 2 * k + 1 on splitter k
        at = F.expr("2 * size(filter(cuts, x -> x < _v)) + int(array_contains(cuts, _v))").alias("_at")
        counts = within(cut).groupBy("_b", at).agg(F.count(F.lit(1)).alias("_c"), F.first("n").alias("n"), F.first("below").alias("below"),
                                                   F.first("cuts").alias("cuts"))
        ranks = counts.withColumn("_upto", F.col("below") + F.sum("_c").over(running))
        held = ranks.withColumns({"_l": F.min(F.when(F.col("_upto") >= left, F.col("_at"))).over(each),
                                  "_r": F.min(F.when(F.col("_upto") >= right, F.col("_at"))).over(each)})
        held = held.withColumns({"_l": F.expr("(_l - 1) div 2"), "_r": F.expr("_r div 2")})
        ranges = cut_lineage(held.groupBy("_b", "n", F.expr("cuts[int(_l)]").alias("lo"), F.expr("cuts[int(_r)]").alias("hi")).agg(
            (F.first("below") + F.sum(F.when(F.col("_at") < 2 * F.col("_l") + 1, F.col("_c")).otherwise(0))).alias("below"),
            F.sum(F.when((F.col("_at") > 2 * F.col("_l") + 1) & (F.col("_at") < 2 * F.col("_r") + 1), F.col("_c")).otherwise(0)).alias("inside")))
    values = within(ranges).groupBy("_b", F.col("_v").alias("_at")).agg(F.count(F.lit(1)).alias("_c"), F.first("n").alias("n"), F.first("below").alias("below"))
    ranks = values.withColumn("_upto", F.col("below") + F.sum("_c").over(running))
    middle = ranks.groupBy("_b").agg(((F.min(F.when(F.col("_upto") >= left, F.col("_at")))
                                       + F.min(F.when(F.col("_upto") >= right, F.col("_at")))) / 2).alias("median")).withColumnRenamed("_b", "_k")
    return whole.join(middle, F.col("_b").eqNullSafe(F.col("_k"))).select(F.col("_b").alias(band), "n", "low", "median", "high")


def threshold_sweep(df: DataFrame, positive: str, score: str, lo: int = 60, hi: int = 85, step: int = 5) -> DataFrame:
    """AGG7: kept positives, leaked negatives and the rate per threshold, in one aggregation."""
    steps = list(range(lo, hi + 1, step))
    pos, above = F.col(positive), F.col(score)
    n_pos = F.sum(pos.cast("long"))
    rows = df.agg(n_pos.alias("n_pos"), *[F.sum((pos & (above >= t)).cast("long")).alias(f"k{t}") for t in steps],
                  *[F.sum((~pos & (above >= t)).cast("long")).alias(f"l{t}") for t in steps])
    each = F.array(*[F.struct(F.lit(t).alias("threshold"), F.coalesce(F.col(f"k{t}"), F.lit(0)).alias("kept"),
                              F.coalesce(F.col(f"l{t}"), F.lit(0)).alias("leaked")) for t in steps])
    d = rows.select("n_pos", F.explode(each).alias("s")).select("n_pos", "s.*")
    return d.select("threshold", "kept", "leaked", F.when(F.col("n_pos") > 0, F.bround(F.col("kept") / F.col("n_pos") * 100, 1)).alias("rate"))


def disagreements(df: DataFrame, positive: str, score: str, threshold: int = L.SIM_HIGH) -> DataFrame:
    """AUD4: positives below the threshold, negatives at or above it."""
    pos, s = F.col(positive), F.col(score)
    return df.filter(s.isNotNull() & ((pos & (s < threshold)) | (~pos & (s >= threshold))))


def rule_diff(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """AUD5: how many rows moved from which value to which, over two runs."""
    a, b = before.select(key, F.col(column).alias("old")), after.select(key, F.col(column).alias("new"))
    return a.join(b, key, "full").groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"))


def keep_and_leak(df: DataFrame, expected: str, kept: str) -> DataFrame:
    """AGG8."""
    return df.groupBy(expected).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(kept).cast("long")).alias("n_kept"))


def border_rows(df: DataFrame, score: str, threshold: int, order: str, k: int = 5) -> DataFrame:
    """WIN6: the k rows nearest the threshold on each side; two top-k sorts."""
    low = df.filter(F.col(score) < threshold).orderBy(F.col(score).desc(), order).limit(k).withColumn("side", F.lit("out"))
    high = df.filter(F.col(score) >= threshold).orderBy(score, order).limit(k).withColumn("side", F.lit("kept"))
    return low.unionByName(high)


def fired_terms(df: DataFrame, book: RuleBook, text: str, rule_sets: Sequence[str], key: str) -> DataFrame:
    """AUD6: (key, rule_set, terms) of the rule sets with a hit."""
    hits = F.array(*[F.struct(F.lit(s).alias("rule_set"), F.array_join(book.found(s, text), "|").alias("terms")) for s in rule_sets])
    return df.select(key, F.explode(hits).alias("h")).select(key, "h.rule_set", "h.terms").filter("terms <> ''")


def labelled_by_descriptors(df: DataFrame, descriptors: dict[str, Sequence[str]], text: str, seq: str) -> DataFrame:
    """AUD3 and FLT34: for each descriptor the first record that holds all its terms."""
    tests = F.array(*[F.when(F.expr(" AND ".join(f"contains({text}, {X.quoted(X.fold_text(t))})" for t in terms)), F.lit(name))
                      for name, terms in descriptors.items()])
    hits = df.select(seq, F.explode(F.array_compact(tests)).alias("descriptor"))
    return hits.groupBy("descriptor").agg(F.min(seq).alias(seq))


def counts_with_zero(found: DataFrame, label: str, valid: DataFrame) -> DataFrame:
    """AGG5: counts per label, valid labels without a row as 0."""
    n = found.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return valid.select(label).join(n, label, "left").select(label, F.coalesce("_n", F.lit(0)).alias("n"))


def skill_report(df: DataFrame, book: RuleBook, text: str) -> DataFrame:
    """AUD7: score, skills and topics of rows with at least one skill, best first."""
    d = df.withColumns({"score": book.score("skill", text), "skills": F.array_join(book.labels("skill", text), ", "),
                        "topics": F.array_join(book.labels("topic", text), "/")})
    return d.filter("score > 0")


def new_rows_report(items: DataFrame, ledger: DataFrame, key: str, score: str) -> DataFrame:
    """AUD8: items not in the ledger with their similarity decision, best first."""
    from tendersift.operators.similar import similarity_verdict
    new = items.join(ledger.select(key).distinct(), key, "left_anti")
    return new.withColumn("decision", similarity_verdict(F.col(score), F.lit(False))).orderBy(F.col(score).desc_nulls_last(), key)


def best_document(docs: DataFrame, notice: str, name: str, text_status: str,
                   priority: Sequence[Sequence[str]] = L.DOCUMENT_PRIORITY) -> DataFrame:
    """CLS17 and WIN5: per notice a PDF before a DOCX, then by the priority of its name, then by name.

    A DOCX counts only with readable text. Partial minima are taken before the shuffle.
    """
    stem = F.regexp_replace(F.lower(name), r"\.[^.]*$", "")
    tokens = F.split(stem, r"(?U)[^\p{L}0-9]+")

    def has(*words: str) -> Column:
        return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))

    rank = F.coalesce(*[F.when(has(*words), i) for i, words in enumerate(priority)], F.lit(L.DOCUMENT_OTHER))
    kind = F.when(F.lower(name).endswith(".pdf"), 0).when(F.lower(name).endswith(".docx") & (F.col(text_status) == "ok"), 1)
    best = F.min(F.struct(F.col("_kind"), F.col("_rank"), F.col(name).alias("_name")))
    return (docs.withColumns({"_kind": kind, "_rank": rank}).filter("_kind IS NOT NULL").groupBy(notice)
            .agg(best.alias("_b")).select(notice, F.col("_b._name").alias(name), F.col("_b._rank").alias("rank")))
