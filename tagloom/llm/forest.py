"""Nearest neighbours by inner product with a forest of hash prefixes.

Vectors get one more component that makes them all equally long, so that the largest inner
product is the smallest angle. Each tree gives every vector a string of 32 bits, the sides of
random hyperplanes it lies on, and holds the strings sorted: vectors that share the first x bits
are one range. A query descends to the deepest prefix at which a tree still holds ``first``
vectors; the best of all trees' vectors bound its k-th score from below. Two vectors at the angle
of that score share a bit with a known chance p, so a neighbour at least as near is missed by all
trees at depth x with a chance of (1 - p^x)^trees. All trees then ascend together to the deepest x
at which that is at most ``miss``, and every vector in those ranges is scored exactly. How far a
query ascends follows from the data, not from a limit; data without near neighbours ascends far.

A tree is dealt out over tasks by the first bits of the strings, about ``part_size`` vectors each;
a part that turns out to hold more (near-equal vectors, or all others beside a very long one) is cut
into as many blocks as its size asks for. A query goes to all blocks of the one part of a tree that
its prefix lies in, or, where it ascends above the parts' bits, of all parts under its prefix. Equal
vectors are one: only the k + 1 smallest ids of each can be among the results, so a vector with a
third of all rows is one entry. Scores are sums in double precision over the original components,
in their order.

A task orders its candidates by score and then smallest id: matrix products find what may be among
the first k + 1, by a margin for their rounding, and those are summed up in order. So k + 1 of
each block, and of all blocks together, are enough whatever ties there are.

Rows whose vector is null, empty, of another length than most, zero or not finite take no part.
Equal scores go to the smaller id. Repeated ids count once per vector they have. Vectors so long
that their square overflows are compared with everything; a score that overflows to no number
counts as minus infinity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.tokens import ragged
from tagloom.session import scratch_path

TREES, BITS = 32, 32
FIRST, MISS = 256, 0.05
PART_SIZE = 1 << 17
#: Rows of a matrix product: entries of a block, and queries.
BLOCK, ASKERS = 16384, 128


def _planes(tree: int, size: int) -> np.ndarray:
    return np.random.default_rng((7, tree)).standard_normal((BITS, size)).astype(np.float32)


def _hashes(vectors: np.ndarray, extra: np.ndarray, tree: int) -> np.ndarray:
    planes = _planes(tree, vectors.shape[1] + 1)
    with np.errstate(over="ignore", invalid="ignore"):
        sides = vectors.astype(np.float32) @ planes[:, :-1].T + extra[:, None].astype(np.float32) * planes[:, -1]
    return (sides > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part: (vec_id, v), v an array of doubles."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), v.alias("v")).where(good & F.col("vec_id").isNotNull())


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def nearest(asked: np.ndarray, vectors: np.ndarray, names: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of ``asked`` the places and scores of the first ``most`` vectors by score and name."""
    with np.errstate(over="ignore", invalid="ignore"):
        rough = asked @ vectors.T
        length = np.sqrt((asked * asked).sum(axis=1)) * np.sqrt((vectors * vectors).sum(axis=1).max())
        margin = 4 * asked.shape[1] * np.finfo(np.float64).eps * length
        least = np.partition(rough, -most, axis=1)[:, -most] if most < len(vectors) else np.full(len(asked), -np.inf)
        # Not a number, where something overflowed, is looked at as well.
        open_ = ~(rough < (least - margin)[:, None])
        for q, some in zip(asked, open_):
            place = np.flatnonzero(some)
            score = np.cumsum(q * vectors[place], axis=1)[:, -1]
            score[np.isnan(score)] = -np.inf
            first = np.lexsort((names[place], -score))[:most]
            yield place[first], score[first]


def search(
    candidates: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, first: int = FIRST, miss: float = MISS,
    part_size: int = PART_SIZE, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, itself left out."""
    spark = candidates.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = usable(candidates, vec_id, vector).withColumn("size", F.size("v"))
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return empty
    size = sizes["size"]
    rows = rows.where(F.col("size") == size).drop("size")
    # Equal vectors as one entry with its smallest ids. Halves of the ids are cut down before
    # they meet, so a vector with very many rows is never gathered.
    salted = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).agg(F.collect_set("vec_id").alias("ids"))
    least = F.slice(F.array_sort("ids"), 1, k + 1)
    entries = salted.select("v", least.alias("ids")).groupBy("v").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    entries = entries.select(F.element_at(least, 1).alias("entry"), least.alias("ids"), "v")
    entries = stored(entries.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))), "entries")
    asked = usable(queries, vec_id, vector).where(F.size("v") == size)
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct(), "asked")
    known = entries.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).first()
    n, longest = known["n"], known["longest"]
    kind = "float" if dict(candidates.select(F.col(f"`{vector}`").alias("v")).dtypes)["v"] == "array<float>" else "double"
    number = np.float32 if kind == "float" else np.float64
    deal = max(0, min(BITS, math.ceil(math.log2(max(1, n) / part_size))))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                vectors = _matrix(batch.column(2))
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = np.sqrt((vectors * vectors).sum(axis=1))
                    extra = np.sqrt(np.maximum(longest * longest - norm * norm, 0))
                copies = _lists(vectors.astype(number))
                for tree in range(trees):
                    code = _hashes(vectors, extra, tree)
                    columns = [pa.array(np.full(len(code), tree, np.int32)), pa.array(code >> (BITS - deal)), pa.array(code)]
                    kept = [batch.column(0), batch.column(1), copies]
                    yield pa.RecordBatch.from_arrays([*columns, *kept], names=["tree", "part", "code", "entry", "ids", "v"])

    # The copies of the trees are as wide as the given vectors, so nothing is rounded.
    forest = stored(
        entries.select("entry", "ids", "v").mapInArrow(
            hashed, f"tree int, part bigint, code bigint, entry bigint, ids array<bigint>, v array<{kind}>"
        ), "forest",
    )
    # Parts of more rows than asked for, with the blocks to cut them into.
    blocks = F.ceil(F.col("count") / part_size).cast("int").alias("blocks")
    large = stored(forest.groupBy("tree", "part").count().where(F.col("count") > part_size).select("tree", "part", blocks), "large")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                vectors = _matrix(batch.column(1))
                for tree in range(trees):
                    code = pa.array(_hashes(vectors, np.zeros(len(vectors)), tree))
                    names = ["tree", "code", "query_id", "q", "depth"]
                    columns = [pa.array(np.full(len(vectors), tree, np.int32)), code, batch.column(0), batch.column(1), batch.column(2)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    def visits(depths: DataFrame) -> DataFrame:
        """Where each query goes in each tree, for ``depths(query_id, q, depth)``; depth -1: still
        to be found by descending."""
        at = depths.mapInArrow(coded, "tree int, code bigint, query_id bigint, q array<double>, depth int")
        above = F.greatest(F.lit(0), F.lit(deal) - F.when(F.col("depth") < 0, F.lit(deal)).otherwise(F.col("depth")))
        lowest = F.call_function("shiftleft", F.call_function("shiftright", F.col("code"), F.lit(BITS - deal) + above), above)
        span = F.call_function("shiftleft", F.lit(1).cast("bigint"), above)
        placed = at.withColumn("part", F.explode(F.sequence(lowest, lowest + span - 1)))
        placed = placed.join(large, ["tree", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        return placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def visit(depths: DataFrame) -> DataFrame:
        """The best entries that each query meets in the parts it goes to: query_id, entry, ids, score."""
        own = forest.join(large, ["tree", "part"], "left").select(
            "tree", "part", F.coalesce(F.pmod(F.xxhash64("entry"), "blocks"), F.lit(0)).cast("int").alias("block"),
            F.lit(0).alias("asks"), "code", "entry", "ids", F.col("v").cast("array<double>").alias("v"), F.lit(0).alias("depth"),
            F.lit(1).alias("blocks"),
        )
        ask = visits(depths).select(
            "tree", "part", "block", F.lit(1).alias("asks"), "code", F.col("query_id").alias("entry"),
            F.array().cast("array<bigint>").alias("ids"), F.col("q").alias("v"), "depth", "blocks",
        )
        dealt = own.union(ask).repartition("tree", "part", "block").sortWithinPartitions("tree", "part", "block", "asks", "code")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, codes, entries_in, ids_in, vectors = None, [], [], [], []
            sorted_part = None
            for whole in batches:
                for at in range(0, whole.num_rows, 2048):
                    batch = whole.slice(at, 2048)
                    tree, part, piece_of, asks = (batch.column(c).to_numpy() for c in ("tree", "part", "block", "asks"))
                    change = (tree[1:] != tree[:-1]) | (part[1:] != part[:-1]) | (piece_of[1:] != piece_of[:-1]) | (asks[1:] != asks[:-1])
                    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
                    for a, b in zip(cuts, cuts[1:]):
                        if (tree[a], part[a], piece_of[a]) != key:
                            key, sorted_part = (tree[a], part[a], piece_of[a]), None
                            codes, entries_in, ids_in, vectors = [], [], [], []
                        piece = batch.slice(a, b - a)
                        if not asks[a]:
                            codes.append(piece.column("code").to_numpy())
                            entries_in.append(piece.column("entry").to_numpy())
                            ids_in.append(piece.column("ids"))
                            vectors.append(_matrix(piece.column("v")))
                        elif codes:
                            if sorted_part is None:
                                sorted_part = (np.concatenate(codes), np.concatenate(entries_in), pa.concat_arrays(ids_in), np.concatenate(vectors))
                                codes, entries_in, ids_in, vectors = [True], [], [], []
                            yield from score(sorted_part, piece)

        def score(part: tuple, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            codes, names, ids, vectors = part
            code, depth = piece.column("code").to_numpy(), piece.column("depth").to_numpy().copy()
            asked_of, asker = _matrix(piece.column("v")), piece.column("entry").to_numpy()

            def ranges(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                low = code >> (BITS - depth) << (BITS - depth)
                return np.searchsorted(codes, low), np.searchsorted(codes, low + (np.int64(1) << (BITS - depth)))

            open_ones = np.flatnonzero(depth < 0)
            depth[open_ones] = BITS
            # A block holds its share of the vectors under a prefix.
            enough = np.minimum(-(-first // piece.column("blocks").to_numpy()), len(codes))
            while len(open_ones):
                a, b = ranges(depth)
                open_ones = open_ones[(b - a)[open_ones] < enough[open_ones]]
                open_ones = open_ones[depth[open_ones] > deal]
                depth[open_ones] -= 1
            a, b = ranges(depth)
            # Queries of one range are scored together.
            order = np.lexsort((b, a))
            cuts = np.flatnonzero(np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for group in np.split(order, cuts[1:]):
                lo, hi = int(a[group[0]]), int(b[group[0]])
                for block in range(lo, hi, BLOCK):
                    end = min(hi, block + BLOCK)
                    for some in range(0, len(group), ASKERS):
                        who = group[some : some + ASKERS]
                        for asks, (place, score) in zip(who, nearest(asked_of[who], vectors[block:end], names[block:end], k + 1)):
                            out.append((np.full(len(place), asker[asks]), place + block, score))
            if out:
                who, which, value = (np.concatenate(c) for c in zip(*out))
                columns = [pa.array(who), pa.array(names[which]), ids.take(pa.array(which)), pa.array(value)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "entry", "ids", "score"])

        return dealt.mapInArrow(run, "query_id bigint, entry bigint, ids array<bigint>, score double")

    def best(found: DataFrame) -> DataFrame:
        """The first k + 1 entries of each query over all trees."""
        once = found.groupBy("query_id", "entry").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "entry")
        return once.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)

    start = stored(best(visit(asked.select("query_id", "q", F.lit(-1).alias("depth")))), "start")
    # The k-th other id of a query: entries count with all their ids.
    counted = W.partitionBy("query_id").orderBy("at")
    others = F.size(F.array_remove("ids", F.col("query_id")))
    reach = start.withColumn("upto", F.sum(others).over(counted)).where(F.col("upto") >= k)
    bound = reach.groupBy("query_id").agg(F.max("score").alias("bound"))
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x))
    cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("bound") / (norm * longest)))
    same = 1 - F.acos(cosine) / math.pi
    depth = F.floor(F.log(F.lit(1 - miss ** (1 / trees))) / F.log(F.least(same, F.lit(0.999999))))
    depth = F.when(F.col("bound").isNull() | (same <= 0), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(BITS), depth)))
    deeper = asked.join(bound, "query_id", "left").select("query_id", "q", depth.cast("int").alias("depth"))
    found = best(visit(stored(deeper, "depths")).union(start.select("query_id", "entry", "ids", "score")))
    listed = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id").distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
