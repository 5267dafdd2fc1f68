"""Token ids in shards, each one wavelet matrix in one compressed file.

A shard holds the ids of documents that follow each other in ascending ``doc_id`` (nulls first,
equal ones by text). Plane k has one bit per token: bit k from the top of the ids, ordered as the
planes above left them, zeros before ones. With the number of ones before every 512th bit, a
token can be read, counted in a range, or found by its n-th occurrence from the planes alone,
without ever unpacking the ids.

The files are Parquet files of one row, written by Spark's own committed writer, so that they can
lie in any store and a lost executor costs its running shards only. Offsets over all shards come
from a sum over shards, not over documents. A null text counts as empty. An empty table makes no
shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tokens import slices, tokenizer_cache

SHARD_TOKENS = 1 << 23
BLOCK = 512

#: Text encoded at once, and chunks remembered twice over: about 250 MB of a worker.
SLICE_TEXT, CACHED_CHUNKS = 16 << 20, 500_000

SHARD = (
    "part int, shard int, n_tokens bigint, n_docs bigint, doc_ids array<bigint>, lengths binary, "
    "bits int, planes binary, zeros binary, ranks binary"
)
ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("bits", pa.int32()), ("planes", pa.binary()),
    ("zeros", pa.binary()), ("ranks", pa.binary()),
])


class WaveletMatrix:
    """Bit planes of a sequence of ids, with the ones counted before each block."""

    def __init__(self, n: int, bits: int, planes: np.ndarray, zeros: np.ndarray, ranks: np.ndarray):
        self.n, self.bits, self.planes, self.zeros, self.ranks = n, bits, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        top = int(ids.max()) if n else 0
        bits = max(1, top.bit_length())
        left = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        width = -(-n // BLOCK) * BLOCK // 8
        planes = np.zeros((bits, width), dtype=np.uint8)
        zeros, ranks = np.zeros(bits, np.int64), np.zeros((bits, width * 8 // BLOCK), np.uint32)
        for k in range(bits):
            one = (left & left.dtype.type(1 << (bits - 1 - k))) != 0
            packed = np.packbits(one, bitorder="little")
            planes[k, : len(packed)] = packed
            ranks[k] = cls._before(planes[k])
            first = left[~one]
            zeros[k] = len(first)
            left = np.concatenate([first, left[one]])
        return cls(n, bits, planes, zeros, ranks)

    @staticmethod
    def _before(plane: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        return np.cumsum(ones, dtype=np.uint32) - ones

    @classmethod
    def load(cls, n: int, bits: int, planes: bytes, zeros: bytes, ranks: bytes) -> WaveletMatrix:
        rows = lambda raw, kind: np.frombuffer(raw, dtype=kind).reshape(bits, -1)
        return cls(n, bits, rows(planes, np.uint8), np.frombuffer(zeros, "<i8"), rows(ranks, "<u4"))

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``k``."""
        block = min(i // BLOCK, self.ranks.shape[1] - 1)
        if block < 0:
            return 0
        at, end = block * BLOCK // 8, i // 8
        ones = int(self.ranks[k, block]) + int(np.bitwise_count(self.planes[k, at:end]).sum())
        return ones + (int(self.planes[k, end]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else ones

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(self.bits):
            bit, ones = int(self.planes[k, i // 8]) >> i % 8 & 1, self._ones(k, i)
            value = value * 2 + bit
            i = int(self.zeros[k]) + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int, j: int) -> tuple[int, int]:
        for k in range(self.bits):
            a, b = self._ones(k, i), self._ones(k, j)
            if token >> (self.bits - 1 - k) & 1:
                i, j = int(self.zeros[k]) + a, int(self.zeros[k]) + b
            else:
                i, j = i - a, j - b
        return i, j

    def count(self, token: int, i: int = 0, j: int | None = None) -> int:
        """Occurrences of ``token`` among places ``i`` up to ``j``."""
        if token < 0 or token >> self.bits or not self.n:
            return 0
        a, b = self._range(token, i, self.n if j is None else j)
        return b - a

    def _find(self, k: int, nth: int, bit: int) -> int:
        """Place of the ``nth`` (from 0) bit of that value in plane ``k``."""
        before = self.ranks[k].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        at = block * BLOCK // 8
        inside = np.unpackbits(self.planes[k, at : at + BLOCK // 8], bitorder="little") == bit
        return block * BLOCK + int(np.flatnonzero(inside)[nth - int(before[block])])

    def select(self, token: int, nth: int) -> int:
        """Place of the ``nth`` occurrence (from 0) of ``token``; -1 where there are fewer."""
        if nth < 0 or nth >= self.count(token):
            return -1
        at = self._range(token, 0, self.n)[0] + nth
        for k in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - k) & 1
            at = self._find(k, at - int(self.zeros[k]) if bit else at, bit)
        return at

    def ids(self) -> np.ndarray:
        """All ids: the sorting of every plane undone, from the last plane up."""
        left = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in reversed(range(self.bits)):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            upper, z = np.empty_like(left), int(self.zeros[k])
            upper[~one] = left[:z]
            upper[one] = left[z:] | left.dtype.type(1 << (self.bits - 1 - k))
            left = upper
        return left


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode every document, append ``end_id``, and write the shards to ``path``.

    A shard is closed at the first document that brings it to ``shard_tokens``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, shard = tokenizer_cache(tokenizer, CACHED_CHUNKS), TaskContext.get().partitionId(), 0
        docs_in: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            tree = WaveletMatrix.build(np.concatenate(ids))
            names, counts = pa.concat_arrays(docs_in), np.concatenate(lengths)
            row = [
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([tree.n], pa.int64()),
                pa.array([len(counts)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.array([counts.tobytes()], pa.binary()), pa.array([tree.bits], pa.int32()),
                pa.array([tree.planes.tobytes()], pa.binary()), pa.array([tree.zeros.tobytes()], pa.binary()),
                pa.array([tree.ranks.tobytes()], pa.binary()),
            ]
            for held in (docs_in, lengths, ids):
                held.clear()
            return pa.RecordBatch.from_arrays(row, schema=ARROW)

        for batch in slices(batches, 1, SLICE_TEXT):
            starts, found = cache.texts(batch.column(1))
            ended = np.insert(found, starts[1:], end_id)
            counts = np.diff(starts) + 1
            ends, done = np.cumsum(counts), 0
            while done < len(counts):
                # Rows up to the first that fills the shard.
                base = int(ends[done - 1]) if done else 0
                to = min(int(np.searchsorted(ends, base + shard_tokens - size)) + 1, len(counts))
                docs_in.append(pa.concat_arrays([batch.column(0).slice(done, to - done)]))
                lengths.append(counts[done:to])
                ids.append(ended[base : int(ends[to - 1])].astype(np.uint32))
                size += int(ends[to - 1]) - base
                done = to
                if size >= shard_tokens:
                    yield close()
                    shard, size = shard + 1, 0
        if docs_in:
            yield close()

    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(encode, SHARD)
    rows.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids in all shards before each; one row per shard goes through the one-task window."""
    sizes = spark.read.schema(SHARD).parquet(path).select("part", "shard", "n_tokens")
    before = W.orderBy("part", "shard").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"))


def _open(batch: pa.RecordBatch, i: int) -> WaveletMatrix:
    value = lambda name: batch.column(name)[i].as_py()
    return WaveletMatrix.load(*[value(c) for c in ("n_tokens", "bits", "planes", "zeros", "ranks")])


def with_start(rows: DataFrame, path: str) -> DataFrame:
    """``start`` (ids before the document in all shards) instead of its place within its shard."""
    placed = rows.join(shard_starts(rows.sparkSession, path), ["part", "shard"])
    start = (F.col("shard_start") + F.col("start_in_shard")).alias("start")
    others = [c for c in rows.columns if c not in ("part", "shard", "doc_id", "start_in_shard")]
    return placed.select("doc_id", start, *others)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document: part and shard, doc_id, start_in_shard, n_tokens, and the ids as
    little-endian unsigned 32-bit integers. See :func:`with_start`; what needs no ids any more
    should be selected before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _open(batch, i).ids().astype("<u4")
                lengths = np.frombuffer(batch.column("lengths")[i].as_py(), "<i8")
                names = batch.column("doc_ids")[i].values
                ends = np.cumsum(lengths)
                at = 0
                while at < len(lengths):
                    # At most about a million ids leave at once.
                    base = int(ends[at] - lengths[at])
                    to = max(at + 1, int(np.searchsorted(ends, base + (1 << 20))))
                    n = to - at
                    offsets = np.append(ends[at:to] - lengths[at:to], ends[to - 1]) - base
                    raw = np.ascontiguousarray(ids[base : int(ends[to - 1])])
                    data = [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(raw)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                            pa.array(np.full(n, batch.column("shard")[i].as_py(), np.int32)),
                            names.slice(at, n),
                            pa.array(ends[at:to] - lengths[at:to]),
                            pa.array(lengths[at:to]),
                            pa.Array.from_buffers(pa.binary(), n, data),
                        ],
                        names=["part", "shard", "doc_id", "start_in_shard", "n_tokens", "ids"],
                    )
                    at = to

    return spark.read.schema(SHARD).parquet(path).mapInArrow(
        read, "part int, shard int, doc_id bigint, start_in_shard bigint, n_tokens bigint, ids binary"
    )


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """Occurrences of each given id in all shards, counted on the planes: token, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = _open(batch, i)
                found = [tree.count(t) for t in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(found, pa.int64())], names=["token", "n"])

    counted = spark.read.schema(SHARD).parquet(path).mapInArrow(count, "token bigint, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Places of an id over all shards in order of the ids: place. Found by select on the planes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = _open(batch, i)
                places = [tree.select(token, n) for n in range(tree.count(token))]
                keys = [pa.array(np.full(len(places), batch.column(c)[i].as_py(), np.int32)) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(places, pa.int64())], names=["part", "shard", "at"])

    found = spark.read.schema(SHARD).parquet(path).mapInArrow(find, "part int, shard int, at bigint")
    return found.join(shard_starts(spark, path), ["part", "shard"]).select((F.col("shard_start") + F.col("at")).alias("place"))
