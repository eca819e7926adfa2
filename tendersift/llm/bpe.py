"""Byte-level BPE encoding and decoding of whole texts with a lexicon of the corpus's frequent words.

Texts are cut into pieces (contractions, letters, numbers, other characters, each with a space before it,
and white space) on arrays of character kinds. The pieces most frequent in the corpus are encoded once and
compiled into a shared-suffix automaton with id outputs, which tasks map into memory; all other pieces are
merged exactly, so the lexicon changes the work, never the ids. Counting covers all texts; a task
passes on the pieces it met at least twice since its table was last emptied.

Cases: a null text is an empty one and has no ids; a special token's own string in a text is that token;
a null `doc_id` and repeated rows are encoded like any other; other columns are ignored; a piece of any
length is merged; no rows, no rows.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm import lexicon
from tendersift.llm.hashing import Hashes, distinct
from tendersift.llm.lexicon import Lexicon
from tendersift.llm.texts import kept, kept_last, read, text_slices
from tendersift.session import cut_lineage, ensure_checkpoint_dir

LEXICON_WORDS = 32768
LONGEST_WORD = 24        # bytes of a lexicon word
TABLE_WORDS = 150_000    # pieces a counting task holds at once
MEMO_WORDS = 250_000     # merged pieces a task remembers
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The characters with Unicode's White_Space property.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def default_tokenizer() -> str:
    """The public byte-level vocabulary of 50,257 ids, where it is installed."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def kinds() -> np.ndarray:
    t = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))[0]
        if k == "L":
            t[c] = LETTER
        elif k == "N":
            t[c] = NUMBER
    t[WHITE] = SPACE
    return t


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write visible bytes as themselves and the others from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE vocabulary of the tokenizers library's JSON, whose merges are in the order of ids."""

    def __init__(self, definition: str):
        d = json.loads(definition)
        back = byte_of_character()
        ids = {bytes(back[c] for c in w): i for w, i in d["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"]]
        made = [ids[bytes(back[c] for c in a + b)] for a, b in merges]
        if made != sorted(made) or len(ids) != 256 + len(set(made)):
            raise ValueError("the merges of this vocabulary are not in the order of its ids")
        self.special = {t["content"].encode(): t["id"] for t in d["added_tokens"] if t["special"]}
        if any(t[k] for t in d["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with conditions are not supported")
        plain = {w: i for w, i in ids.items() if w not in self.special}
        self.size = max([*plain.values(), *self.special.values()]) + 1
        self.words = [b""] * self.size
        for w, i in (plain | self.special).items():
            self.words[i] = w
        self.decimals = [str(i) for i in range(self.size)]
        self.merge = tiktoken.Encoding("byte_bpe", pat_str="(?s).+", mergeable_ranks=plain, special_tokens={})._core_bpe.encode_single_piece

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.words.__getitem__, ids)).decode("utf-8", "replace")


def segments(data: np.ndarray, off: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, dict[int, int]]:
    """(offsets of texts cut at special tokens, start of each special token -> its id)."""
    raw, found = data.tobytes(), {}
    cuts = [off]
    for word, token in special.items():
        i = raw.find(word)
        while i >= 0:
            row = int(np.searchsorted(off, i, "right")) - 1
            if i + len(word) <= off[row + 1]:
                found[i] = token
                cuts.append(np.array([i, i + len(word)]))
                i = raw.find(word, i + len(word))
            else:
                i = raw.find(word, i + 1)
    return (np.unique(np.concatenate(cuts)) if found else np.unique(off)), found


def pieces(data: np.ndarray, seg: np.ndarray, found: dict[int, int]) -> np.ndarray:
    """Byte starts of the pieces of a slice, which they cover without gaps; no piece crosses an offset in `seg`."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = kept("kinds", kinds)[points]
    n = len(at)
    new = np.zeros(n + 1, bool)                      # a segment begins, or the slice ends
    new[np.searchsorted(at, seg)] = True
    run = new[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    white, blank = kind == SPACE, points == 32
    start = np.zeros(n + 1, bool)
    first = np.flatnonzero(run)
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1] & ~new[1:n]
    start[first] = white[first] | ~after_blank[first]
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~new[1:n])
    start[last] = True                               # the last white space before other text stands alone or joins it
    quote = np.flatnonzero((points[:-1] == 39) & start[:n - 1] & run[:-1] & run[1:] & (kind[1:] == LETTER) & ~new[1:n])
    if len(quote):
        a = points[quote + 1]
        b = np.where((quote + 2 < n) & ~new[np.minimum(quote + 2, n)], points[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        for q, size in [(quote[one], 2), (quote[two & ~one], 3)]:
            start[q + 1] = False
            start[q + size] = True
    out = at[np.flatnonzero(start[:n])]
    if found:                                        # a special token is one piece
        inside = np.zeros(len(data) + 1, np.int8)
        ends = seg[np.searchsorted(seg, list(found)) + 1]
        inside[np.array(list(found)) + 1] += 1
        inside[ends] -= 1
        out = out[np.cumsum(inside)[out] == 0]
    return out


class Encoder:
    """Encodes slices; holds a vocabulary, an optional lexicon with the ids of its words, and a bounded memo."""

    def __init__(self, vocabulary: Vocabulary, words: Lexicon | None, ids: np.ndarray, ends: np.ndarray):
        self.v, self.lexicon, self.pool, self.ends = vocabulary, words, ids, ends
        self.memo: dict[bytes, bytes] = {}

    def merged(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        """The ids of each piece as int32 bytes; a special token is a piece of its own."""
        raw, memo, merge, special = data.tobytes(), self.memo, self.v.merge, self.v.special
        words = [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]
        coded = list(map(memo.get, words))
        for i, w in enumerate(words):
            if coded[i] is None:
                coded[i] = c = array("i", [special[w]] if w in special else merge(w)).tobytes()
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                if len(w) <= 64:
                    memo[w] = c
        return coded

    def count(self, data: np.ndarray, off: np.ndarray) -> int:
        """How many ids the texts have together, without making them."""
        start = pieces(data, *segments(data, off, self.v.special))
        end = np.append(start[1:], len(data)) if len(start) else start
        at, back = distinct(data, start, end)
        times = np.bincount(back, minlength=len(at))
        return int(sum(len(c) * n for c, n in zip(self.merged(data, start[at], end[at]), times.tolist())) >> 2)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        seg, found = segments(data, off, self.v.special)
        start = pieces(data, seg, found)
        end = np.append(start[1:], len(data)) if len(start) else start
        number = self.lexicon.numbers(data, start, end) if self.lexicon else np.full(len(start), -1, np.int64)
        missing = np.flatnonzero(number < 0)
        at, back = distinct(data, start[missing], end[missing])    # every different piece is merged once a slice
        coded = self.merged(data, start[missing[at]], end[missing[at]])
        pool = np.concatenate((self.pool, np.frombuffer(b"".join(coded), np.int32)))
        sizes = np.array([len(c) >> 2 for c in coded], np.int64)
        size, first = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        known = number >= 0
        k = number[known]
        first[known], size[known] = self.ends[k], self.ends[k + 1] - self.ends[k]
        first[missing], size[missing] = (len(self.pool) + np.cumsum(sizes) - sizes)[back], sizes[back]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = pool[np.repeat(first - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, off)]


def encoder(definition: object, name: str | None, pairs: object) -> Encoder:
    """The task's encoder, made once per worker and held until another corpus's takes its place. `definition` and `pairs` are broadcast, `name` is a file of Spark's."""
    def make() -> Encoder:
        v = Vocabulary(definition.value)
        if name is None:
            return Encoder(v, None, np.zeros(0, np.int32), np.zeros(1, np.int64))
        ids, ends = pairs.value
        return Encoder(v, Lexicon(SparkFiles.get(name)), ids, ends)
    return kept_last("encoder", name or hash(definition.value), make)


def counter(definition: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text) -> (word, n) of the pieces met at least twice, in parts of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = kept(("vocabulary", hash(definition.value)), lambda: Vocabulary(definition.value))
        table: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            out = [(w, n) for w, n in table.items() if n > 1]
            table.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.binary()), pa.array([n for _, n in out], pa.int64())],
                                              ["word", "n"])
        for b in batches:
            for _, _, data, off in text_slices(b.column(0)):
                seg, found = segments(data, off, v.special)
                start = pieces(data, seg, found)
                end = np.append(start[1:], len(data)) if len(start) else start
                fit = end - start <= LONGEST_WORD
                fit &= ~np.isin(start, list(found)) if found else True
                s, e = start[fit], end[fit]
                _, at, n = np.unique(Hashes(data)(s, e), return_index=True, return_counts=True)
                raw = data.tobytes()
                for i, j, k in zip(s[at].tolist(), e[at].tolist(), n.tolist()):
                    w = raw[i:j]
                    table[w] = table.get(w, 0) + k
                if len(table) > TABLE_WORDS:
                    yield flushed()
        yield flushed()
    return run


def shared_file(spark: SparkSession, content: bytes) -> str:
    """Write `content` to the shared folder and hand it to every executor; its name for SparkFiles."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/lexicons/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        for i in range(0, len(content), 1 << 22):
            out.write(bytearray(content[i:i + (1 << 22)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


class Codec:
    """Encoding and decoding of a corpus: vocabulary, and the lexicon of the given documents' frequent pieces."""

    def __init__(self, docs: DataFrame, text: str = "text", tokenizer: str | None = None, lexicon_words: int = LEXICON_WORDS):
        spark = docs.sparkSession
        definition = open(tokenizer or default_tokenizer(), encoding="utf-8").read()
        self.definition = spark.sparkContext.broadcast(definition)
        self.vocabulary = Vocabulary(definition)
        self.name, self.pairs = None, None
        if lexicon_words:
            counts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(counter(self.definition), "word binary, n long")
            top = (counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "word")
                   .limit(lexicon_words))   # the bound of what the driver holds
            words = sorted(bytes(r["word"]) for r in cut_lineage(top).select("word").collect())
            ids = [self.vocabulary.merge(w) for w in words]
            self.name = shared_file(spark, lexicon.build(words))
            ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)
            self.pairs = spark.sparkContext.broadcast((np.array([t for i in ids for t in i], np.int32), ends))

    def _coder(self) -> Callable[[], Encoder]:
        definition, name, pairs = self.definition, self.name, self.pairs
        return lambda: encoder(definition, name, pairs)

    def encode(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, ids array<int>) per row."""
        coder = self._coder()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code = coder()
            for b in batches:
                for lo, hi, data, off in text_slices(b.column(1)):
                    ids, ends = code(data, off)
                    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], lists], ["doc_id", "ids"])
        return self._rows(docs, doc_id, text).mapInArrow(run, f"doc_id {self._kind(docs, doc_id)}, ids array<int>")

    def decode(self, coded: DataFrame, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
        """(doc_id, text) per row; invalid bytes become replacement characters, null ids a null text."""
        definition = self.definition

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = kept(("vocabulary", hash(definition.value)), lambda: Vocabulary(definition.value))
            for b in batches:
                texts = [None if x is None else v.decode(x) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
        return coded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
            run, f"doc_id {coded.schema[doc_id].dataType.simpleString()}, text string")

    def round_trip(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: both directions in one pass."""
        coder = self._coder()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code = coder()
            v = code.v
            for b in batches:
                for lo, hi, data, off in text_slices(b.column(1)):
                    ids, ends = code(data, off)
                    shown, back = [], []
                    for i in range(hi - lo):
                        own = ids[ends[i]:ends[i + 1]].tolist()
                        shown.append(hashlib.sha256(",".join(map(v.decimals.__getitem__, own)).encode()).hexdigest())
                        back.append(hashlib.sha256(v.decode(own).encode()).hexdigest())
                    yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(np.diff(ends)), pa.array(shown), pa.array(back)],
                                                     ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return self._rows(docs, doc_id, text).mapInArrow(
            run, f"doc_id {self._kind(docs, doc_id)}, n_tokens long, ids_sha256 string, decoded_sha256 string")

    @staticmethod
    def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    @staticmethod
    def _kind(docs: DataFrame, doc_id: str) -> str:
        return docs.schema[doc_id].dataType.simpleString()


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return Codec(docs).round_trip(docs)
