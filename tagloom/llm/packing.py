"""Packing into fixed windows with a controlled mixture of sources.

Documents are first dealt out in an order of *turns*, in which every stretch holds each source in
its target share, however the table is sorted: a document has an even place among those of its
source, and its turn is where a packing at the targets would have come that far into the source.
A source that ends early leaves its share to the others; sources without a target come last.

Encoding writes *segments*: rows of about four million ids with their documents, in that order, so
that one holds all sources about as its windows ask for them. Inside a segment
every source has a queue. For each window a source earns its target share of the window in
credit, and the sources take turns: one that has earned a piece of a useful length sends that
many ids from the head of its queue, cutting a document where its credit ends; the rest of the
window goes to the source with the most credit. Credit that was not spent, or was overdrawn, is
carried to the next window and, because it depends only on how many ids of each source the
earlier segments hold, through a running sum to the next segment, whichever task packs it.

All windows are full but the last of a segment, whose ids are cut at powers of two, so nothing is
padded. A document is its ids and ``end_id``; a null text counts as empty, a null source is a
source of its own. Repeated rows are packed as often as they occur. An empty table gives no piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tokens import SLICE_BYTES, slices, tokenizer_cache
from tagloom.session import materialize

SEGMENT_TOKENS = 1 << 22
#: Entries of segments and sources that are broadcast, about a hundred bytes each.
MOST_BROADCAST = 100_000
GOLDEN = (5**0.5 - 1) / 2

SEGMENT = (
    "part int, segment int, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, doc_source array<int>, "
    "sources array<string>, source_tokens array<bigint>, ids binary"
)
ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("doc_source", pa.list_(pa.int32())), ("sources", pa.list_(pa.string())),
    ("source_tokens", pa.list_(pa.int64())), ("ids", pa.binary()),
])

PIECE = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "source string, ids binary"
)


def schedule(totals: dict[str, float], targets: dict[str, float]) -> list[tuple[str, float, float, float, float]]:
    """(source, share of it from, to, turn at from, turns per share): how far packing at the
    targets is into each source, until it ends. Turns run from 0; at ``sum(totals)`` all end."""
    left = {s: 1.0 for s, t in targets.items() if t > 0 and totals.get(s, 0) > 0}
    out, turn = [], 0.0
    while left:
        every = sum(targets[s] for s in left)
        pace = {s: targets[s] / every / totals[s] for s in left}  # share of the source per turn
        first = min(left, key=lambda s: left[s] / pace[s])
        taken = left[first] / pace[first]
        for s in list(left):
            upto = 0.0 if s == first else max(0.0, left[s] - taken * pace[s])
            out.append((s, 1.0 - left[s], 1.0 - upto, turn, 1.0 / pace[s]))
            left[s] = upto
            if not upto:
                del left[s]
        turn += taken
    return out


def in_turns(rows: DataFrame, targets: dict[str, float] | None) -> DataFrame:
    """``rows(source, text, ..)`` over tasks and inside them in the order of their turns.

    A place is a multiple of the golden ratio by the row's position in its input partition, so rows
    in a run, or at every n-th position, lie more evenly than random ones. It is not of its columns,
    so no key or copy gathers; ``rows`` has to be read from a stored table. Only sums of the sources with targets
    reach the driver; sizes are bytes, since nothing is encoded yet.
    """
    row, file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)), F.xxhash64(F.spark_partition_id())
    placed = rows.withColumn("turn", F.pmod(row * F.lit(GOLDEN) + F.shiftrightunsigned(file, 11) / F.lit(float(1 << 53)), F.lit(1.0)))
    if targets is not None:
        weight = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("double")
        some = rows.where(F.col("source").isin(list(targets))).groupBy("source").agg(F.sum(weight).alias("n")).collect()
        totals = {r["source"]: r["n"] for r in some}
        steps = rows.sparkSession.createDataFrame(
            schedule(totals, targets), "of string, low double, high double, since double, pace double"
        )
        fits = (F.col("source") == F.col("of")) & (F.col("turn") >= F.col("low")) & (F.col("turn") < F.col("high"))
        turn = F.col("since") + (F.col("turn") - F.col("low")) * F.col("pace")
        last = F.lit(sum(totals.values()) + 1.0) + F.col("turn")
        placed = placed.join(F.broadcast(steps), fits, "left").select(*rows.columns, F.coalesce(turn, last).alias("turn"))
    return placed.repartitionByRange("turn").sortWithinPartitions("turn").drop("turn")


def write_segments(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_tokens: int = SEGMENT_TOKENS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", targets: dict[str, float] | None = None,
) -> None:
    """Encode every document and write the segments; ids of 16 bits where the vocabulary allows.

    ``targets``: those that ``pack`` will be given.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part, segment = tokenizer_cache(tokenizer), TaskContext.get().partitionId(), 0
        names: list = []
        lengths: list[int] = []
        of: list[str | None] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            sources = sorted(set(of), key=lambda s: (s is not None, s))
            number = {s: i for i, s in enumerate(sources)}
            doc_source = np.fromiter((number[s] for s in of), np.int32, len(of))
            totals = np.bincount(doc_source, weights=lengths, minlength=len(sources)).astype(np.int64)
            flat = np.concatenate(ids)
            raw = flat.astype("<u2" if flat.max() < 1 << 16 else "<u4").tobytes()
            row = [part, segment, len(flat), list(names), list(lengths), doc_source, sources, totals, raw]
            for held in (names, lengths, of, ids):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW, strict=True)], schema=ARROW)

        size = 0
        for batch in slices(batches, 2, min(SLICE_BYTES, segment_tokens)):
            starts, found = cache.texts(batch.column(2))
            ids.append(np.insert(found, starts[1:], end_id))
            names += batch.column(0).to_pylist()
            of += batch.column(1).to_pylist()
            lengths += (np.diff(starts) + 1).tolist()
            size += len(ids[-1])
            if size >= segment_tokens:
                yield close()
                segment, size = segment + 1, 0
        if names:
            yield close()

    chosen = [F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source")]
    rows = in_turns(docs.select(*chosen, F.col(f"`{text}`").alias("text")), targets).mapInArrow(encode, SEGMENT)
    rows.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def carried(spark: SparkSession, path: str, window: int, targets: dict[str, float] | None) -> DataFrame:
    """Per segment what packing it must know of the others: its first sequence number and, for
    each of the sources, target share and credit from the segments before it.

    Without ``targets`` every source's target is its share of all ids. Sizes of segments and
    sources only; no documents.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    sizes = segments.select("part", "segment", "n_tokens")
    sequences = F.floor(F.col("n_tokens") / window) + F.bit_count(F.col("n_tokens") % window)
    earlier = W.orderBy("part", "segment").rowsBetween(W.unboundedPreceding, -1)
    placed = sizes.select(
        "part", "segment",
        F.coalesce(F.sum(sequences).over(earlier), F.lit(0)).cast("bigint").alias("first_sequence"),
        F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).cast("bigint").alias("tokens_before"),
    )
    supplied = segments.select("part", "segment", F.explode(F.arrays_zip("sources", "source_tokens")).alias("s")).select(
        "part", "segment", F.col("s.sources").alias("source"), F.col("s.source_tokens").alias("supply")
    )
    totals = supplied.groupBy("source").agg(F.sum("supply").alias("total"))
    if targets is None:
        every = totals.agg(F.sum("total")).first()[0] or 1
        shares = totals.select("source", (F.col("total") / F.lit(every)).alias("target"))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in targets.items()], "source string, target double")
        shares = totals.select("source").join(given, "source", "left").fillna(0.0, ["target"])
    # A segment asks only for the sources it holds, so the running sums need no row for others.
    until = W.partitionBy("source").orderBy("part", "segment").rowsBetween(W.unboundedPreceding, -1)
    known = supplied.join(placed, ["part", "segment"])
    of = shares.withColumnRenamed("source", "of")
    at_all = known.join(of, F.col("source").eqNullSafe(F.col("of")))
    before = F.coalesce(F.sum("supply").over(until), F.lit(0))
    credit = F.col("target") * F.col("tokens_before") - before
    lines = at_all.select("part", "segment", "first_sequence", "source", "target", credit.alias("credit"))
    return lines.groupBy("part", "segment").agg(
        F.first("first_sequence").alias("first_sequence"), F.collect_list(F.struct("source", "target", "credit")).alias("mix")
    )


def take_turns(
    supply: list[list[tuple[int, int]]], target: list[float], credit: list[float], window: int, piece: int
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length). ``supply`` has per source its documents
    with their lengths, in order; ``credit`` is what each source has earned before."""
    queues = [deque(docs) for docs in supply]
    left = [sum(n for _, n in docs) for docs in supply]
    start = [0] * len(queues)  # in the document at the head
    credit, total, turn = list(credit), sum(left), 0

    def send(s: int, n: int, into: list[tuple[int, int, int]]) -> None:
        left[s] -= n
        credit[s] -= n
        while n:
            doc, length = queues[s][0]
            cut = min(n, length - start[s])
            into.append((doc, start[s], cut))
            n -= cut
            start[s] += cut
            if start[s] == length:
                queues[s].popleft()
                start[s] = 0

    while total:
        size = window if total >= window else 1 << (total.bit_length() - 1)
        room, filled = size, []
        for s, share in enumerate(target):
            credit[s] += share * size
        for k in range(len(queues)):
            s = (turn + k) % len(queues)
            n = min(int(credit[s]), left[s], room)
            if n >= min(piece, left[s], room) and n > 0:
                send(s, n, filled)
                room -= n
        while room:
            s = max((s for s in range(len(queues)) if left[s]), key=lambda s: credit[s])
            n = min(left[s], room)
            send(s, n, filled)
            room -= n
        turn = (turn + 1) % len(queues)
        total -= size
        yield filled


def pack(
    spark: SparkSession, path: str, window: int = 2048, piece: int = 256, targets: dict[str, float] | None = None
) -> DataFrame:
    """Pieces of the documents in the segments at ``path``, with their ids.

    ``piece``: a source with less credit than this waits, unless its queue is shorter. ``targets``
    must be those that the segments were written with.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("window must be a power of two")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                raw, n = row["ids"], row["n_tokens"]
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                lengths = np.asarray(row["lengths"], np.int64)
                begins = np.cumsum(lengths) - lengths
                mix = {m["source"]: m for m in row["mix"]}
                supply: list[list[tuple[int, int]]] = [[] for _ in row["sources"]]
                for d, (s, length) in enumerate(zip(row["doc_source"], row["lengths"], strict=True)):
                    supply[s].append((d, length))
                mine = [mix[s] for s in row["sources"]]
                windows = take_turns(supply, [m["target"] for m in mine], [m["credit"] for m in mine], window, piece)
                out: list[tuple] = []
                for sequence, filled in enumerate(windows, row["first_sequence"]):
                    offset = 0
                    for d, start, length in filled:
                        out.append((d, start, length, sequence, offset))
                        offset += length
                    if len(out) >= 4096:
                        yield emit(row, out, ids, lengths, begins)
                        out = []
                if out:
                    yield emit(row, out, ids, lengths, begins)

    def emit(row: dict, out: list[tuple], ids: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> pa.RecordBatch:
        doc, start, length, sequence, offset = np.asarray(out, np.int64).T
        at = begins[doc] + start
        cuts = [ids[a:b].tobytes() for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
        names = pa.array(row["doc_ids"], pa.int64()).take(pa.array(doc))
        sources = pa.array(row["sources"], pa.string()).take(pa.array(np.asarray(row["doc_source"], np.int32)[doc]))
        columns = [names, *map(pa.array, (start, length, lengths[doc], sequence, offset)), sources, pa.array(cuts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECE.split(", ")])

    segments = spark.read.schema(SEGMENT).parquet(path)
    # A few numbers per segment and source; if there were very many, Spark decides how to join them.
    known = materialize(carried(spark, path, window, targets))
    if (known.agg(F.sum(F.size("mix"))).first()[0] or 0) <= MOST_BROADCAST:
        known = F.broadcast(known)
    joined = segments.join(known, ["part", "segment"])
    return joined.mapInArrow(fill, PIECE)
