import glob
import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tendersift.llm import bpe, order


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection(n):
    slots = order.permuted(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.permuted(slots, n, 7, inverse=True) == np.arange(n)).all()


def test_permutation_depends_on_key_and_mixes():
    a, b = order.permuted(np.arange(5000), 5000, 1), order.permuted(np.arange(5000), 5000, 2)
    assert (a != b).mean() > 0.99
    assert abs(np.corrcoef(np.arange(5000), a)[0, 1]) < 0.05


def expected_sequences(parts, seq_len, library, layout):
    out = []
    for texts in parts:
        stream = []
        for t in texts:
            stream += [*library.encode(t or "", add_special_tokens=False).ids, layout.end]
        out += [stream[i:i + seq_len] for i in range(0, len(stream), seq_len)]
    return out


def check(spark, df, folder, seq_len, shard_rows):
    layout = order.materialise(df, folder, seq_len=seq_len, shard_rows=shard_rows, key=5)
    library = Tokenizer.from_file(bpe.default_tokenizer())
    parts = df.select("text").rdd.glom().collect()
    want = expected_sequences([[r[0] for r in p] for p in parts], seq_len, library, layout)
    assert layout.n == len(want)
    files = sorted(glob.glob(f"{folder}/part-*"))
    assert len(files) == layout.shards
    slots = order.permuted(np.arange(layout.n), max(layout.n, 1), 5)
    for i, slot in enumerate(slots.tolist()):
        shard, first = layout.place(slot)
        with open(files[shard], "rb") as f:
            f.seek(first)
            assert layout.ids(f.read(layout.stride)).tolist() == want[i]
    got = {r["slot"]: r for r in order.records(spark, folder, layout).collect()}
    assert sorted(got) == list(range(layout.n))
    for i, slot in enumerate(slots.tolist()):
        r = got[slot]
        raw = np.array(want[i] + [layout.pad] * (seq_len - len(want[i])), f"<u{layout.id_bytes}").tobytes()
        assert (r["shard"], r["position"], r["n_tokens"]) == (slot // shard_rows, slot % shard_rows, len(want[i]))
        assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest()


def test_shards_against_brute_force(spark, table, tmp_path):
    rows = [(i, "word " * (i % 40) + "<|endoftext|> é\n" * (i % 3)) for i in range(120)] + [(None, None), (3, ""), (3, ""), (9, "x" * 30000)]
    df = table(rows).repartition(3)
    path = str(tmp_path / "in")
    df.write.parquet(path)
    check(spark, spark.read.parquet(path), str(tmp_path / "out"), 16, 50)


def test_query(spark, sf):
    got = order.op1_training_order(spark, sf).collect()
    again = order.op1_training_order(spark, sf).collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got))) and sorted(map(str, got)) == sorted(map(str, again))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    library = Tokenizer.from_file(bpe.default_tokenizer())
    assert sum(r["n_tokens"] for r in got) == sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_no_rows(spark, table, tmp_path):
    df = table([]).limit(0)
    layout = order.materialise(df, str(tmp_path / "none"))
    assert layout.n == 0 and order.records(spark, str(tmp_path / "none"), layout).count() == 0
