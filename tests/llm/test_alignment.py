import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tendersift.llm import alignment

PATHS = alignment.default_tokenizers()


def byte_of():
    """The byte-level alphabet from its definition: bytes that print stand for themselves."""
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out[chr(b)] = b
        else:
            out[chr(256 + n)] = b
            n += 1
    return out


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), byte_of()


def tokens(library, text):
    a, b, alphabet = library
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == want == b"".join(bytes_b) else None


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(library, rows):
    """Expected lines of (doc_id, text) rows, every token of one side against every token of the other."""
    held, docs = [], Counter()
    for _, text in rows:
        t = tokens(library, text) if text else None
        if t is None:
            held.append(None)
            continue
        ids_a, bytes_a, ids_b, bytes_b = t
        sa, sb = spans(bytes_a), spans(bytes_b)
        pairs, j0 = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][0] < e:
                pairs.append((ids_a[i], ids_b[j]))
                j += 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, before = [], 0
        for e in ends:
            groups.append(",".join(str(x) for x, s in zip(ids_a, sa) if before < s[1] <= e) + "|"
                          + ",".join(str(x) for x, s in zip(ids_b, sb) if before < s[1] <= e))
            before = e
        held.append((len(ids_a), len(ids_b), len(ends), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        docs.update(set(pairs))
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (d, _), h in zip(rows, held):
        out.append((d, 0, 0, 0, 0, 0, 0, "") if h is None else
                   (d, *h[:3], len(h[3]), sum(docs[p] == most[p[0]] for p in h[3]), sum(docs[p] for p in h[3]), h[4]))
    return sorted(out, key=str)


@pytest.fixture
def rows():
    r = random.Random(6)
    words = ["the", "Éléphant", "naïve", "don't", "  ", "\n", " ", "語学", "😀", "x1y22", "ﬁn", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
             "▁", "Å", "\t", "...", "​", "antidisestablishment", "\x85", "\x1f", "ÜBER", "\r\n", "\x00"]
    rows = [(i, r.choice(["", " "]).join(r.choice(words[:20] if i % 4 else words) for _ in range(r.randrange(0, 30)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " "), (403, "  "), (404, "a"), (None, "the null id"), (405, "the same row"), (405, "the same row")]
    return rows + [(406, "wordé " * 3000), (407, "a" * 5000), (408, " ".join(f"w{i}" for i in range(3000)))]


def got(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 0])
def test_against_brute_force(spark, table, library, rows, max_pairs):
    want = brute(library, rows)
    assert sum(w[1] > 0 for w in want) > 100 and sum(w[1] == 0 for w in want) > 20
    assert got(alignment.aligned(table(rows), max_pairs=max_pairs)) == want


def test_small_parts_change_nothing(spark, table, library, rows, monkeypatch):
    for name, v in (("PART_BYTES", 500), ("MEMO_PARTS", 20), ("MEMO_TOKENS", 100), ("RUN_PARTS", 3)):
        monkeypatch.setattr(alignment, name, v)
    assert got(alignment.aligned(table(rows))) == brute(library, rows)


def test_query_against_brute_force(spark, sf, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(alignment.op13_token_alignment(spark, sf)) == brute(library, rows)


def test_empty_table(spark, table):
    for max_pairs in (0, 10):
        assert alignment.aligned(table([]).limit(0), max_pairs=max_pairs).count() == 0
    assert got(alignment.aligned(table([(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
