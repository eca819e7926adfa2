"""Training-order materialisation: token sequences at the slots of a keyed permutation, in fixed-stride shards.

Documents are encoded, each ended by the end-of-text id, and the stream of every input partition is cut
into sequences of `seq_len` ids, the last one padded. Sequences are numbered through partition counts;
a Feistel network with a key permutes the numbers, walking its cycles until it is back inside the range,
so every sequence has one global slot and every slot one sequence. Slots are dealt by range: shard k holds slots
k * shard_rows and on, in order, as records of `seq_len` little-endian ids and one line feed. Slot s is thus
at a known byte of a known file: reading in training order is sequential and resumes anywhere.

Two passes encode the texts, the first only to count, so that no second copy of the ids is ever stored. The
second pass checks the counts of the first: give it a table that is read, not one computed on the way.
Slots depend on the key, the table and how its files are split.

Cases: a null or empty text is a document with no ids but its end; ids in `doc_id` do not matter, so null and
repeated ones are as good as any; other columns are ignored; no rows, no shards.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendersift.llm.bpe import Codec
from tendersift.llm.texts import read, text_slices
from tendersift.session import ensure_checkpoint_dir

SEQ_LEN = 1024
SHARD_ROWS = 4096
KEY = 20240229
ROUNDS = 6
SLICE = 3 << 19          # bytes of text encoded at once
END = "<|endoftext|>"


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def round_keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{key}:{i}".encode(), digest_size=8).digest(), "little") for i in range(ROUNDS)]


def permuted(index: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """Slot of each index below `n` (or the index of each slot): a bijection of range(n) given by `key`."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    keys = round_keys(key)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_round(left, k) & low), left
            else:
                left, right = right, left ^ (_round(right, k) & low)
        return (left << half) | right
    out = once(index.astype(np.uint64))
    while (outside := np.flatnonzero(out >= n)).size:   # at most four values in a cycle are outside for one inside
        out[outside] = once(out[outside])
    return out.astype(np.int64)


class Layout:
    """Where a slot is."""

    def __init__(self, n: int, seq_len: int, shard_rows: int, id_bytes: int, pad: int, end: int):
        self.n, self.seq_len, self.shard_rows, self.id_bytes, self.pad, self.end = n, seq_len, shard_rows, id_bytes, pad, end
        self.stride = seq_len * id_bytes + 1
        self.shards = -(-n // shard_rows)

    def place(self, slot: int) -> tuple[int, int]:
        """(shard, first byte)."""
        return slot // self.shard_rows, slot % self.shard_rows * self.stride

    def ids(self, record: bytes) -> np.ndarray:
        """The ids of a record, without padding."""
        got = np.frombuffer(record, f"<u{self.id_bytes}", self.seq_len)
        return got[got != self.pad]


def materialise(docs: DataFrame, folder: str, text: str = "text", tokenizer: str | None = None, seq_len: int = SEQ_LEN,
                shard_rows: int = SHARD_ROWS, key: int = KEY) -> Layout:
    """Write the shards of `docs` to `folder` (part-00000... in order of shards) and return their layout."""
    codec = Codec(docs, text, tokenizer, lexicon_words=0)
    end, size = codec.vocabulary.special[END.encode()], codec.vocabulary.size
    id_bytes = 2 if size < 1 << 16 else 4
    pad = (1 << 8 * id_bytes) - 1
    coder = codec._coder()
    rows = docs.select(F.col(text).cast("string").alias("text"))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        code = coder()
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(0), SLICE):
                ids, ends = code(data, off)
                yield np.insert(ids, ends[1:], end)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n = coder(), 0
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(0), SLICE):
                n += code.count(data, off) + hi - lo
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])
    counts = sorted((r["part"], r["n"]) for r in rows.mapInArrow(count, "part int, n long").collect())   # a row per task
    first, offsets = 0, {}
    for part, n in counts:
        offsets[part] = (first, n)
        first += -(-n // seq_len)
    layout = Layout(first, seq_len, shard_rows, id_bytes, pad, end)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, expected = offsets.get(TaskContext.get().partitionId(), (0, 0))
        rest, seen, n = np.zeros(0, np.int64), 0, layout.n

        def records(x: np.ndarray, k: int) -> pa.RecordBatch:
            raw = x.astype(f"<u{id_bytes}").tobytes()
            step = seq_len * id_bytes
            slots = permuted(np.arange(at, at + k), n, key)
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array([raw[i * step:(i + 1) * step] for i in range(k)], pa.binary())],
                                              ["slot", "ids"])
        for x in streams(batches):
            seen += len(x)
            rest = np.concatenate((rest, x))
            if k := len(rest) // seq_len:
                yield records(rest[:k * seq_len], k)
                rest, at = rest[k * seq_len:], at + k
        if len(rest):
            yield records(np.concatenate((rest, np.full(seq_len - len(rest), pad))), 1)
        if seen != expected:
            raise RuntimeError(f"the input's partitions changed between two reads: {seen} ids, {expected} counted; write it as a table first")
    if layout.n:
        (rows.mapInArrow(place, "slot long, ids binary")
         .repartitionById(layout.shards, F.floor(F.col("slot") / shard_rows).cast("int")).sortWithinPartitions("slot")
         .select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\n").text(folder))
    return layout


def records(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """(slot, shard, position, n_tokens, n_ends, ids_sha256) of every record on disk; the digest is of the record's bytes."""
    schema = "slot long, shard int, position int, n_tokens int, n_ends int, ids_sha256 string"
    if not layout.n:
        return spark.createDataFrame([], schema)
    stride, rows, pad, end, width = layout.stride, layout.shard_rows, layout.pad, layout.end, layout.id_bytes

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw = content.as_buffer()
                shard = int(re.search(r"part-(\d+)-[^/]*$", path)[1])
                n = raw.size // stride
                table = np.frombuffer(raw, np.uint8).reshape(n, stride)
                if (table[:, -1] != 10).any():
                    raise RuntimeError(f"{path} is not a shard of stride {stride}")
                ids = np.ascontiguousarray(table[:, :-1]).view(f"<u{width}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard * rows + np.arange(n)), pa.array(np.full(n, shard), pa.int32()), pa.array(np.arange(n), pa.int32()),
                     pa.array((ids != pad).sum(1), pa.int32()), pa.array((ids == end).sum(1), pa.int32()),
                     pa.array([hashlib.sha256(memoryview(r)).hexdigest() for r in ids])],
                    ["slot", "shard", "position", "n_tokens", "n_ends", "ids_sha256"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(digest, schema)


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all `documents` in the shared folder, and a digest row for every slot, read back from them."""
    folder = f"{ensure_checkpoint_dir(spark)}/shards/{uuid.uuid4().hex}"
    return records(spark, folder, materialise(read(spark, sf_dir, "documents"), folder))
