import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tendersift.llm import bpe, hashing, lexicon

TEXTS = ["", None, " ", "  ", "\n", " \n x", "a  b", "it's we'll they'RE 's 'll x'", "don'tx ''s \"'s '́s", " x  y", "12 ab34½Ⅷ²",
         "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>c", "<|endoftext", "é́ 漢字かな 🙂🙂 ß", "tab\tx\r\n\r\n  end  ",
         "'s", " 's", "\n's", "'re", "'ve've", "a'", "'", "l'l 'l 'll", "aaaa" * 4000, "x" * 70 + " y", "\x00\x1c\x85z", "a​b", "_under score_"]


def thue_morse(n, letters="ab"):
    """A word and, with the letters exchanged, its partner: their polynomial hashes modulo 2**64 agree from 1,024 letters on."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_pieces_of_one_hash_keep_their_own_ids(spark, table, library):
    rows = [(1, thue_morse(2048) + " " + thue_morse(2048, "ba") + " the " + thue_morse(2048)), (2, thue_morse(1024, "ba") + thue_morse(1024)),
            (3, " " + thue_morse(2048, "ba"))]
    df = table(rows)
    assert sorted(map(tuple, bpe.Codec(df).round_trip(df).collect()), key=str) == expected(library, rows)


def test_ranges_are_compared_by_their_bytes():
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    a, b, n = r.integers(0, 2900, 5000), r.integers(0, 2900, 5000), r.integers(0, 40, 5000)
    want = [data[i:i + k].tobytes() == data[j:j + k].tobytes() for i, j, k in zip(a, b, n)]
    assert hashing.same_bytes(data, a, b, n).tolist() == want
    start = np.arange(0, 2990, 3)
    at, back = hashing.distinct(data, start, start + 7)
    assert len(at) == len({data[s:s + 7].tobytes() for s in start}) and (data[start[at][back][:, None] + np.arange(7)] == data[start[:, None] + np.arange(7)]).all()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


def expected(library, rows):
    out = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("words", [0, 40])
def test_same_as_the_library(spark, table, library, words):
    rnd = random.Random(4)
    marks = ["'s", "'", " ", "  ", "\n", "a", "b1", "é", ".", "!?", "<|endoftext|>", "'ll", "　", "5"]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (1, "x"), (1, "x")]
    rows += [(1000 + i, "".join(rnd.choices(marks, k=rnd.randint(1, 12)))) for i in range(600)]
    df = table(rows)
    codec = bpe.Codec(df, lexicon_words=words)
    got = codec.round_trip(df)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(library, rows)
    back = {r["doc_id"]: r["text"] for r in codec.decode(codec.encode(df.filter("doc_id >= 2"))).collect()}
    assert all(back[d] == t for d, t in rows if d is not None and d >= 2)


def test_query(spark, sf, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, bpe.op7_bpe_round_trip(spark, sf).collect()), key=str) == expected(library, rows)


def test_no_rows(spark, table):
    df = table([]).limit(0)
    assert bpe.Codec(df).round_trip(df).count() == 0


def test_automaton_numbers_words_in_order(tmp_path):
    words = sorted({w.encode() for w in "tap taps top tops stop stops a ab é".split()})
    path = tmp_path / "x.bin"
    path.write_bytes(lexicon.build(words))
    lex = lexicon.Lexicon(str(path))
    probe = [*words, b"t", b"topss", b"z", b"", b"st", b"\xc3"]
    data = np.frombuffer(b"".join(probe), np.uint8)
    ends = np.cumsum([len(p) for p in probe])
    assert lex.numbers(data, ends - [len(p) for p in probe], ends).tolist() == [*range(len(words)), -1, -1, -1, -1, -1, -1]
    assert len(lex.finals) < 2 + sum(map(len, words))   # suffixes are shared
