"""How the tokens of two tokenizers line up in every document, with corpus-wide counts of linked id pairs.

Texts are cut before each single blank between two other characters, where no token of either tokenizer crosses. The parts'
ids are looked up in a memo of parts met before in the task, others are encoded in one call. The rest is Arrow work on whole
columns: ids by list flatten, their documents by parent indices, byte offsets by cumulative sums of token lengths, which start
again at every document; offsets where both end by an Acero hash join on (document, end). A token's link to the other side is
the token that covers its last byte, so a document has one link for every different end. Distinct links of a document, the
documents that hold a pair (`Table.group_by` in every batch, added up by Spark) and the two results per document that need those
counts follow. The table of pairs travels to the tasks if it has at most `max_pairs` rows; a larger one is joined to the documents'
links, its most frequent pairs apart.

A text counts if the joined bytes of both tokenizers' tokens are a blank and the text; others, null and empty texts have no tokens:
zeros, and '' for their groups. Strings of special tokens are plain text.

Cases: a null id is kept; repeated rows and ids are documents of their own, and count as such; a very long text is worked on in parts of
`PART_BYTES`, cut where no group crosses (a run without such a place is one part); ties in a count are all best; other columns are
ignored; no rows, no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tendersift.llm.texts import kept, read
from tendersift.scale import lookup
from tendersift.session import ensure_checkpoint_dir

PART_BYTES = 1 << 20     # text one pass works on
MEMO_PARTS = 300_000     # encoded parts a task remembers
MEMO_TOKENS = 3_000_000  # and their tokens
MAX_PAIRS = 4_000_000    # rows of the table of pairs that travels to the tasks, 20 bytes each
RUN_PARTS = 256          # new parts encoded as one text
CUT = re.compile(r"(?<=\S) (?=\S)")
BITS = 32                # a pair is a << BITS | b
SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<int>")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Lists:
    """A growing list of int lists, read as an Arrow list array."""

    def __init__(self) -> None:
        self.values, self.sizes, self.total = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values.append(values.astype(np.int32))
        self.sizes.append(sizes)
        self.total += len(values)

    def array(self) -> pa.ListArray:
        self.values, self.sizes = [np.concatenate(self.values)], [np.concatenate(self.sizes)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(self.sizes[0]), pa.int32()), pa.array(self.values[0]))


class Pair:
    """Both tokenizers, the bytes of their tokens, and a memo of encoded parts."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b, to_byte = self.a.get_vocab_size(), self.b.get_piece_size(), byte_level()
        self.bytes_a = [bytes(to_byte[c] for c in self.a.id_to_token(i)) if all(c in to_byte for c in self.a.id_to_token(i) or "\0") else b""
                        for i in range(size_a)]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(size_b)]
        self.len_a = pa.array([len(x) for x in self.bytes_a], pa.int64())
        self.len_b = pa.array([len(x) for x in self.bytes_b], pa.int64())
        self.both = ((self.bytes_a, self.len_a.to_numpy()), (self.bytes_b, self.len_b.to_numpy()))
        self.names = pa.array([str(i) for i in range(max(size_a, size_b))])
        with open(path_a) as f:
            kind = (json.load(f).get("pre_tokenizer") or {}).get("type")
        self.cuts = kind == "ByteLevel" and not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(size_b))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids_a, self.ids_b, self.right = Lists(), Lists(), []

    def parts(self, text: str) -> list[str]:
        return CUT.split(text) if self.cuts else [text]

    def ids(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        return zip((x.ids for x in a), self.b.encode(texts, num_threads=1))

    def learn(self, parts: list[str]) -> None:
        """Encode new parts, many in one text: a blank between two parts is a place where both cut."""
        whole = [p for p in parts if p == p.strip()] if self.cuts else []
        runs = [whole[i:i + RUN_PARTS] for i in range(0, len(whole), RUN_PARTS)]
        single = [p for p in parts if p != p.strip()] if self.cuts else parts
        for run, found in zip(runs, self.ids([" ".join(r) for r in runs])):
            ends = np.cumsum([len(p.encode()) + 1 for p in run])
            want, cut = b" " + " ".join(run).encode(), []
            for ids, (bytes_, lengths) in zip(found, self.both):
                at = np.searchsorted(own := np.cumsum(lengths[ids]), ends)
                if b"".join(map(bytes_.__getitem__, ids)) == want and (own[at] == ends).all():
                    cut.append((np.array(ids), np.diff(at, prepend=-1)))
            if len(cut) < 2:
                single = single + run
                continue
            self.note(run, cut, True)
        for p, found in zip(single, self.ids(single)):
            want = b" " + p.encode()
            right = all(b"".join(map(bytes_.__getitem__, ids)) == want for ids, (bytes_, _) in zip(found, self.both))
            self.note([p], [(np.array(ids, np.int32), np.array([len(ids)])) for ids in found], right)

    def note(self, parts: list[str], found: list[tuple[np.ndarray, np.ndarray]], right: bool) -> None:
        self.known.update(zip(parts, range(len(self.right), len(self.right) + len(parts))))
        self.right += [right] * len(parts)
        self.ids_a.add(*found[0])
        self.ids_b.add(*found[1])

    def encode(self, parts: list[str]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """The two lists of ids of every part, and whether their bytes are a blank and the part."""
        if len(self.known) > MEMO_PARTS or self.ids_a.total > MEMO_TOKENS:
            self.forget()
        self.learn(list(set(parts).difference(self.known)))
        at = np.array([*map(self.known.__getitem__, parts)])
        where = pa.array(at)
        return self.ids_a.array().take(where), self.ids_b.array().take(where), np.array(self.right, bool)[at]


def tokenizers(paths: tuple[str, str]) -> Pair:
    return kept(("alignment", paths), lambda: Pair(*paths))


def tokens(ids: pa.Array, doc: np.ndarray, lengths: pa.Array) -> tuple[pa.Table, np.ndarray]:
    """Table (at, id, doc, end) of the tokens of all parts, `doc` naming each part's document, and their ends over the whole table."""
    flat, of = pc.list_flatten(ids), doc[pc.list_parent_indices(ids).to_numpy()]
    ends = pc.cumulative_sum(lengths.take(flat)).to_numpy()
    first = np.flatnonzero(np.diff(of, prepend=-1))
    before = np.concatenate(([0], ends))[first]              # bytes before a document's first token
    own = ends - np.repeat(before, np.diff(np.append(first, len(of))))
    return pa.table({"at": np.arange(len(flat)), "id": flat, "doc": of, "end": own}), ends


def links(a: pa.Table, b: pa.Table, a_end: np.ndarray, b_end: np.ndarray, b_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, pair) of every link: the token that covers a token's last byte, shared ends once."""
    alone = np.flatnonzero(~b_cut)
    to_b, to_a = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end[alone])
    id_a, id_b = a.column("id").to_numpy().astype(np.int64), b.column("id").to_numpy().astype(np.int64)
    doc = a.column("doc").to_numpy()
    return (np.concatenate((doc, doc[to_a])),
            np.concatenate((id_a << BITS | id_b[to_b], id_a[to_a] << BITS | id_b[alone])))


def group_texts(a: pa.Table, b: pa.Table, a_cut: np.ndarray, b_cut: np.ndarray, docs: int, names: pa.Array) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of every document."""
    group_a, group_b = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut    # cuts before a token
    last_a, last_b = np.append(-1, np.flatnonzero(a_cut)), np.append(-1, np.flatnonzero(b_cut))
    at_a = np.arange(len(group_a)) + last_b[group_a] + 1
    at_b = np.arange(len(group_b)) + last_a[group_b + 1] + 1
    n = len(at_a) + len(at_b)
    ids, marks, doc = np.empty(n, np.int32), np.zeros(n, np.int8), np.empty(n, np.int64)
    ids[at_a], ids[at_b] = a.column("id").to_numpy(), b.column("id").to_numpy()
    doc[at_a], doc[at_b] = a.column("doc").to_numpy(), b.column("doc").to_numpy()
    marks[at_a], marks[at_b] = a_cut, 2 * b_cut
    off = np.searchsorted(doc, np.arange(docs + 1))
    marks[off[1:][off[1:] > off[:-1]] - 1] = 3                               # nothing after a document's last token
    words = pc.binary_join_element_wise(names.take(pa.array(ids)), pa.array([",", "|", ";", ""]).take(pa.array(marks)), "")
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(off, pa.int64()), words), "")


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[off[1:]] - c[off[:-1]]


class Batch:
    """Results of the documents of one Arrow batch, filled part by part."""

    def __init__(self, n: int) -> None:
        self.counts = np.zeros((4, n), np.int64)             # a, b, groups, links
        self.wrong = np.zeros(n, bool)
        self.digests: dict[int, hashlib._Hash] = {}
        self.found: list[pa.Table] = []

    def add(self, both: Pair, doc: np.ndarray, parts: list[str], which: list[int]) -> None:
        """Parts of texts, `doc` giving each part's place in `which`, the documents in order."""
        ids_a, ids_b, right = both.encode(parts)
        bad = np.zeros(len(which), bool)
        bad[doc[~right]] = True
        self.wrong[np.array(which)[bad]] = True
        good = pa.array(~bad[doc])
        doc = doc[~bad[doc]]
        (a, a_end), (b, b_end) = tokens(ids_a.filter(good), doc, both.len_a), tokens(ids_b.filter(good), doc, both.len_b)
        shared = a.join(b, keys=["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
        a_cut, b_cut = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_cut[shared.column("at").to_numpy()], b_cut[shared.column("at_b").to_numpy()] = True, True
        of, pair = links(a, b, a_end, b_end, b_cut)
        where = np.array(which)
        self.found.append(pa.table({"doc": where[of], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]))
        n = len(which)
        numbers = [np.bincount(t.column("doc").to_numpy(), minlength=n) for t in (a, b, shared)]
        self.counts[:, where] += np.array([*numbers, np.bincount(of, minlength=n)])
        for i, text in zip(which, group_texts(a, b, a_cut, b_cut, n, both.names)):
            text = text.as_py()
            if text:
                if i in self.digests:
                    self.digests[i].update(b";" + text.encode())
                else:
                    self.digests[i] = hashlib.sha256(text.encode())

    def columns(self) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups_sha256, pairs, times."""
        n = len(self.wrong)
        self.counts[:, self.wrong] = 0
        digests = ["" if w or i not in self.digests else self.digests[i].hexdigest() for i, w in enumerate(self.wrong)]
        if not self.found:
            none = pa.ListArray.from_arrays(pa.array([0] * (n + 1), pa.int32()), pa.array([], pa.int64()))
            return [*map(pa.array, self.counts), pa.array(digests), none, none.cast(pa.list_(pa.int32()))]
        all_ = pa.concat_tables(self.found).group_by(["doc", "pair"], use_threads=False).aggregate([("count_all", "sum")])
        all_ = all_.filter(pa.array(~self.wrong[all_.column("doc").to_numpy()])).sort_by([("doc", "ascending"), ("pair", "ascending")])
        off = pa.array(np.searchsorted(all_.column("doc").to_numpy(), np.arange(n + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(off, all_.column(c).combine_chunks().cast(kind)) for c, kind in (("pair", pa.int64()), ("count_all_sum", pa.int32()))]
        return [*map(pa.array, self.counts), pa.array(digests), *lists]


def _some(both: Pair, texts: pa.Array) -> list[pa.Array]:
    """The result columns of some texts, worked on in parts of about PART_BYTES."""
    out = Batch(len(texts))
    doc, parts, which, size = [], [], [], 0
    for i, text in enumerate(texts.to_pylist()):
        cut = both.parts(text) if text else []
        step = max(1, len(cut) * PART_BYTES // max(len(text), PART_BYTES)) if cut else 1   # parts of a share of a long text
        for at in range(0, len(cut), step):
            some = cut[at:at + step]
            doc += [len(which)] * len(some)
            parts += some
            which.append(i)
            size += min(len(text), PART_BYTES)
            if size >= PART_BYTES:
                out.add(both, np.array(doc), parts, which)
                doc, parts, which, size = [], [], [], 0
    if parts:
        out.add(both, np.array(doc), parts, which)
    return out.columns()


def _aligned(paths: tuple[str, str]):
    """Rows (row, doc_id, text) -> SCHEMA, a few parts' worth of texts at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(paths)
        for b in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = np.append(np.flatnonzero(np.diff(size // (4 * PART_BYTES), prepend=-1)), b.num_rows)
            for i, j in zip(edges[:-1], edges[1:]):
                some = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *_some(both, some.column(2))],
                                                 [f.split()[0] for f in SCHEMA.split(", ")])
    return run


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of pairs -> the documents of a batch that hold each pair."""
    for b in batches:
        counted = pa.table({"pair": pc.list_flatten(b.column(0))}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        yield from counted.select(["pair", "count_all"]).rename_columns(["pair", "docs"]).to_batches()


def _rated(sent: Broadcast):
    """Rows of SCHEMA -> the document's columns with n_best and count_sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = sent.value
        for b in batches:
            off = b.column(7).offsets.to_numpy()
            at = np.searchsorted(pair, b.column(7).flatten().to_numpy())
            times, off = b.column(8).flatten().to_numpy().astype(np.int64), off - off[0]
            yield pa.RecordBatch.from_arrays([*b.columns[1:6], pa.array(_sums(times * best[at], off)), pa.array(_sums(times * docs[at], off)),
                                              b.column(6)], RESULT)
    return run


RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _stored(df: DataFrame) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold a pair, and whether no pair of the same first id has more."""
    counts = _stored(aligned.select("pairs").mapInArrow(_partial_counts, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")))
    most = counts.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("docs").alias("most"))
    return _stored(counts.join(most, F.shiftright("pair", BITS) == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))


def alignments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """SCHEMA for every row of `docs`, written: counts, digest of the groups, the different links and how often each occurs."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _stored(rows.mapInArrow(_aligned(paths or default_tokenizers()), SCHEMA))


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None,
            max_pairs: int = MAX_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs`."""
    rows = alignments(docs, doc_id, text, paths)
    counts = pair_counts(rows)
    if counts.count() <= max_pairs:
        table = counts.orderBy("pair").toArrow()
        sent = docs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "docs", "best")))
        return rows.mapInArrow(_rated(sent), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times").toDF("row", "pair", "times")
    told = lookup(each, counts, ["pair"], "row", 0)
    sums = told.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    return rows.join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"]).select(*RESULT)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(read(spark, sf_dir, "documents"))
