"""Each stage of the pipeline against a plain version of what it should do with its own input."""

from collections import Counter
from pathlib import Path

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tendersift.llm import bpe
from test_bpe import expected
from test_cube import brute_targets
from test_overlap import brute
from test_rules import WORD


@pytest.fixture(scope="module")
def sf():
    """A table with labels enough to learn from."""
    path = "/root/testdata/sf0.01"
    if not Path(path).exists():
        pytest.skip("test tables not present")
    return path


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """(name, rows in, rows out) of every stage, each result written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs.collect(), docs.columns
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        out.append((name, before, docs.collect()))
    return out


@pytest.mark.parametrize("i,label,wanted", [(0, "quality", 1), (1, "toxic", 0)])
def test_filters_keep_what_labels_call_good(spark, sf, steps, i, label, wanted):
    name, before, after = steps[i]
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = Counter(before)
    assert not Counter(after) - rows                    # whole rows, unchanged
    kept = {r["doc_id"] for r in after}
    known = [r["doc_id"] for r in before if r["doc_id"] in truth]
    right = sum((d in kept) == (truth[d] == wanted) for d in known)
    assert right >= 0.93 * len(known)
    good = [d for d in known if truth[d] == wanted]
    assert sum(d in kept for d in good) >= 0.95 * len(good)


def test_one_row_of_each_group_stays(steps):
    _, before, after = steps[2]
    assert sorted(r["doc_id"] for r in after) == brute([(r["doc_id"], r["text"]) for r in before])
    assert not Counter(after) - Counter(before)


def test_mix_takes_documents_whole(steps):
    _, before, after = steps[3]
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in before}
    source = {r["doc_id"]: r["source"] for r in before}
    assert set(after) <= set(before) and max(Counter(after).values()) <= 2
    sizes, taken = Counter(), Counter()
    for d, s in source.items():
        sizes[s] += size[d]
    for r in after:
        taken[r["source"]] += size[r["doc_id"]]
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= max(size[d] for d in size if source[d] == s)


def test_tokens(steps):
    _, before, after = steps[4]
    library = Tokenizer.from_file(bpe.default_tokenizer())
    assert sorted(map(tuple, after), key=str) == expected(library, [(r["doc_id"], r["text"]) for r in before])


def test_run_gives_the_last_stage(spark, sf, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str) == sorted(map(tuple, steps[-1][2]), key=str)


def test_nulls_empty_and_no_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word " * 30000, None, None, 5)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for df in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, sf).count() <= 2 * df.count()
