import itertools

import xxhash

from tendersift.llm import simhash
from tendersift.components import components

WORDS = ["one two three four five", "one two three four five", "One TWO three four five", "six", "", None, "a b",
         "\x0b\x0c \t", "é è ê é b", "one two three four five" + " six seven" * 400]


def brute_fingerprint(text):
    words, cur = [], []
    for ch in (text or ""):
        ch = ch.lower() if "A" <= ch <= "Z" else ch
        if ch == " " or "\x09" <= ch <= "\x0d":
            if cur:
                words.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    if cur:
        words.append("".join(cur))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 2:
            comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=str)


def test_against_brute_force(spark, table):
    rows = [(i, t) for i, t in enumerate(WORDS)] + [(None, "six"), (3, "six"), (None, "quite alone here now")]
    got = simhash.near_duplicates(table(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, simhash.op2_simhash_near_dedup(spark, sf).collect()), key=str) == brute(rows)


def test_ball_finds_every_pair_within_two_bits(spark):
    base = 0x0123456789ABCDEF
    fps = [base, base ^ 1, base ^ 3, base ^ 7, base ^ (1 << 63), 0]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")))
    root = {r["node"]: r["root"] for r in got.collect()}
    assert len({root[s] for s in signed[:5]}) == 1 and signed[5] not in root


def test_long_chain_takes_few_rounds(spark):
    links = spark.range(1, 3000).selectExpr("id AS a", "id - 1 AS b")
    got = components(links)
    assert got.count() == 3000 and got.filter("root <> 0").count() == 0


def test_deduplicated_keeps_one_row_of_each_group(spark, table):
    rows = [(5, "same words in here"), (2, "same words in here"), (2, "same words in here"), (None, "same words in here"),
            (None, "alone with no id at all"), (None, "another without id now"), (9, None), (8, "")]
    got = simhash.deduplicated(table(rows))
    assert got.columns == ["doc_id", "text", "score", "fp"]
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(
        [(2, "same words in here"), (None, "alone with no id at all"), (None, "another without id now"), (8, "")], key=str)


def test_empty_table(spark, table):
    assert simhash.near_duplicates(table([]).limit(0)).count() == 0
    assert simhash.deduplicated(table([]).limit(0)).count() == 0
