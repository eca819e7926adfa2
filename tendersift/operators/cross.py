"""Signals across records: duplicates, recurring needs, publishers that never qualify, same item
from several publishers. All work on narrow rows and none holds a whole group in one task."""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tendersift import labels as L
from tendersift.components import components
from tendersift.scale import BUCKET_WIDTH, attach_by_key, keep_first, lookup, number_rows
from tendersift.session import cut_lineage

UNKNOWN_AGE = -1_000_000   # stands for a null age inside join keys
SEPARATOR = "\u0001"
CLASS = ["signature", "entity_key", "age_key"]
OPEN_ROUNDS = 3               # rounds over all open classes before what is left is taken by its components
SCAN_COMBINATIONS = 1_000_000  # most combinations of a component that one task scans; larger ones go on in rounds


def drop_duplicates_first(df: DataFrame) -> DataFrame:
    """WIN1 on postings: same publisher, same title, same text."""
    return keep_first(df, ["entity_key", "dedup_title", "dedup_text"], ["seq"])


def never_qualifying(df: DataFrame, min_postings: int = 3) -> DataFrame:
    """AGG3: publishers with enough postings and no contract signal in any of them."""
    return (df.filter(F.col("entity_key") != "").groupBy("entity_key")
            .agg(F.count(F.lit(1)).alias("n_postings"), F.sum(F.col("has_signal").cast("int")).alias("n_signals"))
            .filter((F.col("n_postings") >= min_postings) & (F.col("n_signals") == 0)))


def apply_never_qualifying(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Postings of the publishers in `stats` count as hiring."""
    marked = attach_by_key(df, stats, ["entity_key"], "n_postings", "seq")
    hit = F.col("n_postings").isNotNull()
    return marked.withColumns({
        "kind": F.when(hit, F.lit(L.HIRING)).otherwise(F.col("kind")),
        "signal": F.col("signal") & ~hit}).drop("n_postings", "n_signals")


def recurring_groups(df: DataFrame) -> DataFrame:
    """AGG4: (publisher, title) seen at least twice, empty titles left out."""
    return (df.filter(F.col("title_norm") != "").groupBy("entity_key", "title_norm")
            .agg(F.count(F.lit(1)).alias("n_same")).filter(F.col("n_same") >= 2))


def apply_recurrence(df: DataFrame, stats: DataFrame) -> DataFrame:
    """WIN2: a recurring need that is aged but not older than 90 days becomes backlog."""
    marked = attach_by_key(df, stats, ["entity_key", "title_norm"], "n_same", "seq")
    young = f"coalesce(age <= {L.BACKLOG_DAYS}, false)"
    window = f"CASE WHEN window = '{L.W_AGED}' AND recurring AND {young} THEN '{L.W_BACKLOG}' ELSE window END"
    return (marked.withColumn("recurring", F.col("n_same").isNotNull())
            .withColumn("window", F.expr(window)).drop("n_same"))


# --- the same item from several publishers -------------------------------------------------------
#
# Two records match when they share at least two tokens, come from different publishers and their
# ages are at most 15 days apart or one age is unknown. Sharing two tokens means sharing one
# two-token combination, so combinations are the join key. Pairs of records are never built: for a
# combination and an age only the best two candidates of different publishers are kept, which is
# enough to answer "is there a match that is not from my own publisher, and which is the best".

def combinations(signature: Column) -> Column:
    """All two-token combinations of a sorted signature."""
    return F.flatten(F.transform(signature, lambda x, i: F.transform(
        F.slice(signature, i + 2, F.size(signature)), lambda y: F.concat(x, F.lit(SEPARATOR), y))))


def _two_best(values: Column) -> Column:
    """The best candidate and the best one of another publisher, from structs (v, e); the best is bound once, not sought for every value."""
    def with_second(head: Column) -> Column:
        return F.array_compact(F.array(head, F.array_min(F.filter(values, lambda x: x["e"] != head["e"]))))

    return F.flatten(F.transform(F.array(F.array_min(values)), with_second))


def _top_two(have: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, v, e) of the two smallest v of different publishers, for each value of `keys`."""
    best_first = Window.partitionBy(*keys).orderBy("v", "e")
    best = have.groupBy(*keys, "e").agg(F.min("v").alias("v"))
    return best.withColumn("r", F.row_number().over(best_first)).filter("r <= 2").drop("r")


def _candidate_table(classes: DataFrame, targets: DataFrame, value: str, days: int) -> DataFrame:
    """(signature, age) of every target -> up to two best candidates among the matching classes."""
    combo = F.explode(combinations(F.col("signature"))).alias("combo")
    have = classes.select(combo, "age_key", F.col("entity_key").alias("e"), F.col(value).alias("v"))
    two = cut_lineage(_top_two(have, ["combo", "age_key"]))
    asked = targets.select("signature", "age_key").distinct().select("signature", "age_key", combo)
    # one row per (combo, age): at most as many rows per combination as there are different ages, each with two candidates
    pair = F.when(F.col("v").isNotNull(), F.struct("v", "e"))
    points = (two.select("combo", "age_key", pair.alias("p"))
              .unionByName(asked.select("combo", "age_key", F.lit(None).cast(T.StructType([
                  T.StructField("v", classes.schema[value].dataType), T.StructField("e", T.StringType())])).alias("p")).distinct())
              .groupBy("combo", "age_key").agg(F.collect_list("p").alias("c")))
    near = Window.partitionBy("combo").orderBy("age_key").rangeBetween(-days, days)
    # what records of unknown age meet is cut to two candidates before it is joined, whatever the number of ages
    all_ages = _top_two(two, ["combo"]).groupBy("combo").agg(F.collect_list(pair).alias("all_c"))
    undated = two.filter(F.col("age_key") == UNKNOWN_AGE).groupBy("combo").agg(F.collect_list(pair).alias("undated_c"))
    reach = (points.select("combo", "age_key", F.flatten(F.collect_list("c").over(near)).alias("near_c"))
             .join(all_ages, "combo", "left").join(undated, "combo", "left")
             .select("combo", "age_key", F.when(F.col("age_key") == UNKNOWN_AGE, F.col("all_c"))
                     .when(F.col("undated_c").isNull(), F.col("near_c"))
                     .otherwise(F.concat("near_c", "undated_c")).alias("c"))
             .select("combo", "age_key", _two_best(F.col("c")).alias("c")))
    return (asked.join(reach, ["combo", "age_key"]).groupBy("signature", "age_key")
            .agg(F.flatten(F.collect_list("c")).alias("c")).select("signature", "age_key", _two_best(F.col("c")).alias("cands")))


def _best_match(classes: DataFrame, targets: DataFrame, value: str, days: int) -> DataFrame:
    """Targets with `best`: the smallest value among matching classes of other publishers, or null."""
    table = cut_lineage(_candidate_table(classes, targets, value, days))
    t = lookup(targets, table, ["signature", "age_key"], "class_id")
    mine = F.filter(F.col("cands"), lambda x: x["e"] != F.col("entity_key"))
    return t.withColumn("best", F.get(mine, F.lit(0))["v"]).drop("cands")


def _classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows with their key columns, one class per publisher, signature and age."""
    base = df.select("seq", "entity_key", F.array_sort(F.array_distinct("signature")).alias("signature"),
                     F.coalesce(F.col("age"), F.lit(UNKNOWN_AGE)).alias("age_key")).filter(F.size("signature") >= 2)
    return base, cut_lineage(base.groupBy(*CLASS).agg(F.min("seq").alias("class_id"), (-F.max("seq")).alias("_neg_last")))


def same_item_matches(df: DataFrame, days: int = L.SAME_ITEM_DAYS) -> DataFrame:
    """JOI4 and SET4: seq of every record that has a match at another publisher, without the pairs."""
    base, classes = _classes(df)
    hit = cut_lineage(_best_match(classes, classes, "class_id", days).filter("best IS NOT NULL").select(*CLASS, F.lit(True).alias("hit")))
    return lookup(base, hit, CLASS, "seq").filter("hit").select("seq")


def same_item_groups(df: DataFrame, days: int = L.SAME_ITEM_DAYS, width: int = BUCKET_WIDTH,
                     scan: int = SCAN_COMBINATIONS) -> DataFrame:
    """JOI5: (seq, group_seed, group_no) of the records that belong to a group.

    Input: seq, entity_key, signature (sorted tokens), age; only records that may form groups.
    Scanning in `seq` order, a record without a group that has later matches starts a group and
    puts itself and those matches into it; a later group overwrites.

    Records with equal publisher, signature and age have the same matches and never match each
    other, so the scan is solved on such classes: a class starts groups when no matching class
    with an earlier first record does. Each round settles every class that is first among its
    open matches and then closes the matches of those. What is open after a few rounds falls into
    components that no match crosses; each is scanned in order by one task, so a long chain of matches
    takes no more rounds than a short one. A component of more than `scan` combinations goes on in
    rounds, which tear it apart, and is looked at again after some more of them.
    """
    base, classes = _classes(df)
    key = CLASS
    open_, starters, rounds = classes, [], 0
    while not open_.isEmpty():
        if rounds == OPEN_ROUNDS:
            settled, open_ = _settle_components(open_, days, scan)
            starters.append(settled)
            rounds = 0
            continue
        rounds += 1
        ranked = cut_lineage(_best_match(open_, open_, "class_id", days))
        first = ranked.filter(F.col("best").isNull() | (F.col("best") > F.col("class_id"))).drop("best")
        rest = ranked.filter(F.col("best") < F.col("class_id")).drop("best")
        starters.append(first)
        open_ = cut_lineage(_best_match(first, rest, "class_id", days).filter(F.col("best").isNull()).drop("best"))
    if not starters:
        return base.select("seq", F.col("seq").alias("group_seed"), F.col("seq").alias("group_no")).limit(0)
    seeds = starters[0]
    for s in starters[1:]:
        seeds = seeds.unionByName(s)
    seeds = cut_lineage(seeds)

    # a starting record opens a group only if some match comes later
    reach = _best_match(classes, seeds, "_neg_last", days).filter(F.col("best").isNotNull())
    reach = reach.select(*key, (-F.col("best")).alias("last_match"), F.lit(True).alias("starts"))
    rows = cut_lineage(lookup(base, cut_lineage(classes.select(*key).join(reach, key, "left")), key, "seq"))
    openers = rows.filter(F.col("starts") & (F.col("seq") < F.col("last_match"))).select(*key, "seq")
    numbered = cut_lineage(number_rows(openers, "seq", "group_no", width))
    joined = _last_opener(numbered, rows.filter(F.col("starts").isNull()).select(*key, "seq"), days, width)
    tags = numbered.select("seq", F.col("seq").alias("group_seed")).unionByName(joined)
    return tags.join(numbered.select(F.col("seq").alias("group_seed"), "group_no"), "group_seed")


def _component_links(classes: DataFrame, days: int) -> DataFrame:
    """Links (a, b) of class ids under which all classes that match are connected, a few for each combination.

    Classes of one combination and age meet in the first of them; the first ones of an age and the next age within reach
    meet, and all ages of a combination meet in its records of unknown age.
    """
    rows = classes.select("class_id", "age_key", F.explode(combinations(F.col("signature"))).alias("combo"))
    firsts = rows.groupBy("combo", "age_key").agg(F.min("class_id").alias("hub"))
    undated = firsts.filter(F.col("age_key") == UNKNOWN_AGE).select("combo", F.col("hub").alias("u"))
    # one row per combination and age: a group is as long as there are different ages
    by_age = Window.partitionBy("combo").orderBy("age_key")
    reach = firsts.withColumns({"next_hub": F.lead("hub").over(by_age), "gap": F.lead("age_key").over(by_age) - F.col("age_key")})
    links = [rows.join(firsts, ["combo", "age_key"]).select(F.col("class_id").alias("a"), F.col("hub").alias("b")),
             reach.filter(F.col("gap") <= days).select(F.col("hub").alias("a"), F.col("next_hub").alias("b")),
             firsts.join(undated, "combo").select(F.col("hub").alias("a"), F.col("u").alias("b"))]
    return links[0].unionByName(links[1]).unionByName(links[2])


def _starts_in_order(component: pd.DataFrame, days: int) -> pd.DataFrame:
    """The classes of one component that no starting class before them matches, by a scan in order of class id."""
    dated: dict[tuple[str, str], dict[int, str]] = {}      # combination -> age -> the publisher that starts there
    anyone: dict[tuple[str, str], set[str]] = {}           # combination -> publishers that start there at any age
    kept = []
    component = component.sort_values("class_id")
    for i, (signature, publisher, age) in enumerate(zip(component["signature"], component["entity_key"], component["age_key"])):
        combos = list(itertools.combinations(signature, 2))
        if age == UNKNOWN_AGE:
            found = any(p != publisher for c in combos for p in anyone.get(c, ()))
        else:
            ages = [UNKNOWN_AGE, *range(age - days, age + days + 1)]
            found = any(at.get(a, publisher) != publisher for c in combos if (at := dated.get(c)) for a in ages)
        if found and publisher is not None:
            continue
        kept.append(i)
        if publisher is not None:
            for c in combos:
                dated.setdefault(c, {})[age] = publisher
                anyone.setdefault(c, set()).add(publisher)
    return component.iloc[kept]


def _settle_components(open_: DataFrame, days: int, scan: int) -> tuple[DataFrame, DataFrame]:
    """(starting classes of all components of at most `scan` combinations, classes of the larger ones)."""
    roots = components(_component_links(open_, days)).toDF("class_id", "root")
    n = F.size("signature").cast("long")
    sized = cut_lineage(open_.join(roots, "class_id", "left")
                        .withColumns({"root": F.coalesce("root", "class_id"), "n_combos": n * (n - 1) / 2}))
    sizes = cut_lineage(sized.groupBy("root").agg(F.sum("n_combos").alias("n_root")))
    sized = lookup(sized, sizes, ["root"], "class_id")
    small = sized.filter(F.col("n_root") <= scan).select(*open_.columns, "root")
    settled = small.groupBy("root").applyInPandas(
        lambda pdf: _starts_in_order(pdf, days).drop(columns="root"), open_.schema)
    return cut_lineage(settled), cut_lineage(sized.filter(F.col("n_root") > scan).select(*open_.columns))


def _last_opener(openers: DataFrame, targets: DataFrame, days: int, width: int) -> DataFrame:
    """For every target the latest earlier opener that matches it, as (seq, group_seed).

    Openers that share a combination and an age come from one publisher, so (combination, age)
    names the publisher. A target of known age looks up the openers of its combinations at every age within
    reach, at most 2·days+2 keys per combination; one of unknown age, which all ages match, looks up the combination alone.
    """
    combo = F.explode(combinations(F.col("signature"))).alias("combo")
    o = cut_lineage(openers.select(combo, F.col("age_key").alias("o_age"), F.col("entity_key").alias("e"), "seq"))
    dated = targets.filter(F.col("age_key") != UNKNOWN_AGE)
    keys = o.groupBy("combo", "o_age").agg(F.min("e").alias("o_entity"))
    # the ages present per combination: as many as there are different ages, not records
    present = keys.groupBy("combo").agg(F.collect_list(F.struct("o_age", "o_entity")).alias("present"))
    near = F.filter("present", lambda p: (p["o_entity"] != F.col("entity_key")) & (
        (p["o_age"] == UNKNOWN_AGE) | (F.abs(p["o_age"] - F.col("age_key")) <= days)))
    shape = dated.select("signature", "age_key", "entity_key").distinct()
    reach = (shape.select("signature", "age_key", "entity_key", combo).join(present, "combo")
             .select("signature", "age_key", "entity_key", F.explode(
                 F.transform(near, lambda p: F.struct(F.col("combo").alias("combo"), p["o_age"].alias("o_age")))).alias("k"))
             .groupBy("signature", "age_key", "entity_key").agg(F.collect_set("k").alias("ks")))
    t = lookup(dated, cut_lineage(reach), ["signature", "age_key", "entity_key"], "seq")
    t = t.select("seq", F.col("entity_key").alias("e"), F.explode("ks").alias("k")).select("seq", "e", "k.combo", "k.o_age")
    undated = targets.filter(F.col("age_key") == UNKNOWN_AGE).select("seq", F.col("entity_key").alias("e"), combo)
    hit = _latest_of_others(o, t, ["combo", "o_age"], width).unionByName(_latest_of_others(o.drop("o_age"), undated, ["combo"], width))
    return hit.groupBy("seq").agg(F.max("g").alias("group_seed")).filter(F.col("group_seed").isNotNull())


def _latest_of_others(openers: DataFrame, targets: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(seq, g) for every row (keys, e, seq) of `targets`: the latest earlier one of `openers` with its keys and another publisher.

    It is found inside buckets of `width` numbers: either the latest opener there or the latest of another publisher than that
    one's. The same two of all earlier buckets are carried in.
    """
    both = (openers.withColumn("opener", F.struct("seq", "e"))
            .unionByName(targets.withColumn("opener", F.lit(None).cast(T.StructType([
                T.StructField("seq", T.LongType()), T.StructField("e", T.StringType())]))))
            .withColumn("bucket", F.floor(F.col("seq") / width)))
    bucket = [*keys, "bucket"]
    inside = Window.partitionBy(*bucket).orderBy("seq")
    upto, until = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("opener").over(until)
    ranked = (both.withColumn("before", before)
              .withColumn("turn", F.when(F.col("opener").isNotNull() & (F.col("before")["e"] != F.col("e")), F.col("before")))
              .withColumns({"last": F.max("opener").over(upto), "other": F.max("turn").over(upto)}).filter("opener IS NULL"))
    neg = openers.select(*keys, F.floor(F.col("seq") / width).alias("bucket"), "e", (-F.col("seq")).alias("v"))
    pairs = (_top_two(neg, bucket).groupBy(*bucket).agg(F.collect_list(F.struct((-F.col("v")).alias("seq"), "e")).alias("two"))
             .unionByName(targets.select(*keys, F.floor(F.col("seq") / width).alias("bucket")).distinct()
                          .withColumn("two", F.array().cast("array<struct<seq:bigint,e:string>>"))))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (pairs.groupBy(*bucket).agg(F.flatten(F.collect_list("two")).alias("two"))
             .select(*bucket, F.flatten(F.collect_list("two").over(earlier)).alias("carry")))
    found = F.filter(F.concat(F.array("last", "other"), F.coalesce("carry", F.array().cast("array<struct<seq:bigint,e:string>>"))),
                     lambda x: x["e"] != F.col("e"))
    return ranked.join(carry, bucket, "left").select("seq", F.array_max(F.transform(found, lambda x: x["seq"])).alias("g"))


def apply_same_item(df: DataFrame, days: int = L.SAME_ITEM_DAYS) -> DataFrame:
    """Adds multi_publisher and its group label `G<n>` to classified postings."""
    eligible = df.filter(F.col("kind").isin(L.MISSION, L.TO_CONFIRM))
    tags = same_item_groups(eligible, days).select("seq", F.concat(F.lit("G"), F.col("group_no")).alias("group"))
    out = df.join(tags, "seq", "left")
    return out.withColumns({"multi_publisher": F.col("group").isNotNull(),
                            "group": F.coalesce(F.col("group"), F.lit(""))})
