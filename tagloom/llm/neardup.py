"""Near copies by a chosen-path similarity join over word shingles.

Every document is the set of its five-word shingles. Documents with equal sets are one class from
the start. A class is described by 128 minwise tokens (the token of position i is the shingle
that hash function i puts first). A tree starts with all classes and, at each node, chooses
positions so that 1/0.75 are chosen on average; the members of the node branch by their tokens at
each chosen position. Two classes of similarity J stay together on J/0.75 branches on average, so
at or above 0.75 a pair does not die out, while others part quickly. Nodes of at most
``node_size`` classes are compared exhaustively, larger ones branch again, and ``trees``
independent trees are grown. A pair at exactly the threshold is missed by all twelve first levels
with a probability under 1e-7; every further level costs a tree about half of what it still finds.

Comparing takes two steps, so that a group of k near copies does not cost k*k pairs. First each
member is compared with the smallest of its node. Then only pairs that these links have not joined
into one component yet are compared, inside the task that holds their node: what leaves it is the
members that have a partner, and then the links that join components, never the pairs. A pair that
shares several first-level nodes is looked at in the first one. Candidates need 0.56 of the low bytes of their minwise
tokens in common (five standard deviations below 0.75); links are then confirmed on the full sets.
Nodes that cannot be branched any further are compared in blocks, pair of blocks by pair of blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer than five words make one shingle; a
document without words or text is linked with nothing. Rows with the same id are one document.
Without an id, a document takes no part: its component is null and it is kept. Further columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.components import components
from tagloom.llm.tokens import release, slices
from tagloom.llm.words import STEP, mix, word_hashes
from tagloom.session import scratch_path

POSITIONS = 128
WORDS = 5
#: Least 100 * |both| / |either| of a link.
SIMILAR = 75
#: Positions of 128 that must agree before a pair is looked at: 0.75 less five standard deviations.
AGREE = 72
TREES, NODE_SIZE, DEPTH = 12, 4096, 8
#: Broadcast at most so many ids of documents to be read again (16 bytes each, 64 MB); beyond,
#: their texts are found by a shuffled join.
BROADCAST_IDS = 4_000_000

_random = np.random.default_rng(20240)
_PLACE = _random.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = (_random.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, of = word_hashes(texts, fold=True)
    none = np.zeros(0, np.uint64)
    if not len(words):
        return [none] * len(texts)
    padded = np.concatenate([words, np.zeros(WORDS - 1, np.uint64)])
    shingles = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        shingles += padded[k : k + len(words)] * _PLACE[k]
    shingles = mix(shingles)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= WORDS:
            found = np.sort(shingles[a : b - WORDS + 1])
            keep = np.ones(len(found), bool)
            keep[1:] = found[1:] != found[:-1]
            out.append(found[keep])
        elif b > a:
            out.append(mix((words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(none)
    return out


def minwise(found: np.ndarray) -> np.ndarray:
    """Low 32 bits of the shingle that each hash function puts first."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[None, at : at + 2048] * _FACTOR).min(axis=1), out=least)
    return (mix(least) & np.uint64(0xFFFFFFFF)).astype("<u4")


def _roots(trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots of the trees; tree and position of every first branch."""
    root = mix(np.arange(1, trees + 1, dtype=np.uint64))
    tree, position = np.nonzero(_chosen(root))
    return root, tree, position


def describe(docs: DataFrame, trees: int) -> DataFrame:
    """Per document: n_shingles, a 128-bit hash of the set in two longs, minwise tokens, as ``key``
    the low byte of each, and as ``roots`` those at the positions of the first branches."""
    position = _roots(trees)[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, 1, 1 << 20):
            sets = shingle_sets(batch.column(1))
            with np.errstate(over="ignore"):
                h1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
                h2 = np.array([mix(s ^ STEP).sum(dtype=np.uint64) for s in sets], np.uint64)
            tokens = [minwise(s) if len(s) else None for s in sets]
            columns = [
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1.view(np.int64)),
                pa.array(h2.view(np.int64)), pa.array([None if t is None else t.tobytes() for t in tokens], pa.binary()),
                pa.array([None if t is None else t.astype(np.uint8).tobytes() for t in tokens], pa.binary()),
                pa.array([None if t is None else t[position].tobytes() for t in tokens], pa.binary()),
            ]
            names = ["doc_id", "n_shingles", "h1", "h2", "tokens", "key", "roots"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, tokens binary, key binary, roots binary"
    )


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, POSITIONS)


def _chosen(node: np.ndarray) -> np.ndarray:
    """Which positions each node chooses: each with a chance of 1 / (0.75 * 128), by its own hash."""
    draws = mix(node[:, None] * _FACTOR[:, 0][None, :] ^ STEP)
    return draws < np.uint64(int((1 << 64) / (SIMILAR / 100 * POSITIONS)))


def _child(node: np.ndarray, position: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(node + position.astype(np.uint64) * STEP) ^ token.astype(np.uint64))


def branch(rows: DataFrame, roots: int = 0) -> DataFrame:
    """``rows(rep, tokens[, node])`` -> ``(node, rep, place)`` one level down. ``roots``: the number
    of trees whose first level to make, whose branches ``place`` numbers; without it, each row
    branches at its node, and place is -1."""

    root, tree, position = _roots(roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                tokens, reps = _tokens(batch.column(1)), batch.column(0).to_numpy()
                if roots:
                    child = _child(root[tree], position, tokens[:, position]).ravel()
                    row = np.repeat(np.arange(len(reps)), len(position))
                    place = np.tile(np.arange(len(position)), len(reps))
                else:
                    node = batch.column(2).to_numpy().view(np.uint64)
                    row, places = np.nonzero(_chosen(node))
                    child = _child(node[row], places, tokens[row, places])
                    place = np.full(len(row), -1)
                columns = [pa.array(child.view(np.int64)), pa.array(reps[row]), pa.array(place.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "rep", "place"])

    columns = ["rep", "tokens"] if roots else ["rep", "tokens", "node"]
    return rows.select(*columns).mapInArrow(run, "node bigint, rep bigint, place int")


def _similar(pairs: DataFrame) -> DataFrame:
    """Pairs whose low bytes agree often enough; ``pairs(a, b, na, nb, ka, kb)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                sides = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, POSITIONS) for k in (2, 3)]
                good = (sides[0] == sides[1]).sum(axis=1) >= AGREE
                yield batch.select([0, 1]).filter(pa.array(good))

    sized = pairs.where(100 * F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb"))
    return sized.select("a", "b", "ka", "kb").mapInArrow(run, "a bigint, b bigint")


LEAF = (
    "node bigint, i int, j int, block int, rep bigint, comp bigint, n bigint, place int, large bigint, key binary, roots binary"
)


class _Leaf:
    """The members of a node, or of two blocks of one, and the pairs to look at."""

    def __init__(self, group: pa.Table):
        value = lambda c: group.column(c).to_numpy()
        bytes_of = lambda c, kind: np.frombuffer(b"".join(group.column(c).to_pylist()), kind).reshape(group.num_rows, -1)
        self.rep, self.n, self.block = (value(c) for c in ("rep", "n", "block"))
        self.comp = value("comp").copy()
        self.i, self.j, self.place = (value(c)[0] for c in ("i", "j", "place"))
        self.keys = bytes_of("key", np.uint8)
        # Earlier first-level nodes that a pair may share. It is looked at there, and only there,
        # unless that node was too large and branched further.
        earlier = np.arange(max(self.place, 0))
        self.roots = bytes_of("roots", "<u4")[:, : len(earlier)]
        self.small = (value("large")[:, None] >> earlier[None, :] & 1) == 0

    def partners(self, x: int) -> np.ndarray:
        """Later members of other components that are similar enough by size and keys."""
        if self.i == self.j:
            other = np.arange(x + 1, len(self.rep))
        elif self.block[x] == self.i:
            other = np.flatnonzero(self.block == self.j)
        else:
            return np.zeros(0, np.int64)
        other = other[self.comp[other] != self.comp[x]]
        other = other[100 * np.minimum(self.n[other], self.n[x]) >= SIMILAR * np.maximum(self.n[other], self.n[x])]
        other = other[(self.keys[other] == self.keys[x]).sum(axis=1) >= AGREE]
        if self.place > 0 and len(other):
            other = other[~((self.roots[other] == self.roots[x]) & self.small[x]).any(axis=1)]
        return other


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows, one table per (node, i, j)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(c).to_numpy() for c in ("node", "i", "j")])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if last is not None and tuple(ids[:, a]) != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            last = tuple(ids[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def with_partners(rows: DataFrame) -> DataFrame:
    """Of the members of leaves those that have anyone to be compared with; no pair leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            leaf, keep = _Leaf(group), np.zeros(group.num_rows, bool)
            for x in range(group.num_rows):
                other = leaf.partners(x)
                if len(other):
                    keep[x] = True
                    keep[other] = True
            yield from group.filter(pa.array(keep)).to_batches()

    return rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j").mapInArrow(run, LEAF)


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids and texts of the documents with these ids, so that no other text is shuffled."""
    ids = ids.toDF("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")


def links_inside(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between different components inside leaves, by full sets: no more of a leaf than
    join its components."""
    texts = _only(docs, rows.select("rep")).join(rows, F.col("doc_id") == F.col("rep")).drop("doc_id")
    columns = [c.split()[0] for c in LEAF.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            leaf = _Leaf(group)
            sets: list[np.ndarray] = []
            for part in slices(iter(group.select(["text"]).to_batches()), 0, 1 << 20):
                sets += shingle_sets(part.column(0))
            found = []
            for x in range(group.num_rows):
                for y in leaf.partners(x).tolist():
                    if leaf.comp[y] != leaf.comp[x] and _linked(sets[x], sets[y]):
                        found.append((leaf.rep[x], leaf.rep[y]))
                        leaf.comp[leaf.comp == leaf.comp[y]] = leaf.comp[x]
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    dealt = texts.select(*columns, "text").repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "rep")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def confirm(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are links by their full sets.

    The partners of ``a`` are split into runs of about 128, each with a row of ``a`` itself, so
    that a document with many partners is many small groups, and its set is made once for each.
    """
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"))
    runs = F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / 128)).cast("int")
    members = pairs.join(many, "a").select("a", "b", runs.alias("run"))
    needed = members.select(F.col("b").alias("needed"), "a", "run").union(
        members.select("a", "run").distinct().select(F.col("a").alias("needed"), "a", "run")
    )
    spark = docs.sparkSession
    path = scratch_path(spark, "needed")
    needed.write.parquet(path)
    needed = spark.read.parquet(path)
    rows = _only(docs, needed.select("needed")).join(needed, F.col("doc_id") == F.col("needed"))
    rows = rows.select("a", "run", "doc_id", (F.col("doc_id") != F.col("a")).alias("partner"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        group, own = None, []
        for batch in slices(batches, 4, 1 << 20):
            a, r, ids = (batch.column(k).to_numpy() for k in (0, 1, 2))
            partner, found, linked = batch.column(3).to_pylist(), shingle_sets(batch.column(4)), []
            for k, s in enumerate(found):
                if (a[k], r[k]) != group:
                    group, own = (a[k], r[k]), []
                if not partner[k]:
                    own.append(s)
                elif any(_linked(s, o) for o in own):
                    linked.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(ids[linked])], names=["a", "b"])

    dealt = rows.repartition("a", "run").sortWithinPartitions("a", "run", "partner")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < SIMILAR * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


def near_duplicates(docs: DataFrame, trees: int = TREES, node_size: int = NODE_SIZE, depth: int = DEPTH) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, n_shingles, component_id, kept, class_id; one row per row.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id reachable
    over links.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    described = stored(describe(docs, trees), "described")
    named = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("h1", "h2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("tokens", "key", "roots")]
    )
    reps = stored(classes, "classes")

    # First levels of all trees; nodes of one member are done.
    first = stored(branch(reps, roots=trees), "first")
    shared = first.groupBy("node").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("size"))
    nodes = stored(first.join(shared.where("leader <> last").drop("last"), "node"), "nodes")

    keys = reps.select("rep", F.col("n_shingles").alias("n"), "key", "roots")

    # Step one: every member with the smallest of its node.
    star = nodes.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    sided = star.join(keys.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("key").alias("ka")), "a")
    sided = sided.join(keys.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("key").alias("kb")), "b")
    links = stored(confirm(docs, stored(_similar(sided), "star")), "links")
    joined = components(links)

    # Step two: inside nodes that still hold several components, all pairs of different ones.
    def parted(rows: DataFrame) -> DataFrame:
        of = rows.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        of = of.select("node", "rep", "place", F.coalesce("component", "rep").alias("comp"))
        sizes = of.groupBy("node").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("size"))
        return of.join(sizes.where("c0 <> c1").select("node", "size"), "node")

    open_nodes = stored(parted(nodes.select("node", "rep", "place")), "parted")
    small = [open_nodes.where(F.col("size") <= node_size)]
    large = open_nodes.where(F.col("size") > node_size)
    for _ in range(depth):
        if large.isEmpty():
            break
        deeper = branch(large.join(reps.select("rep", "tokens"), "rep")).distinct()
        level = stored(parted(deeper), "level")
        small.append(level.where(F.col("size") <= node_size))
        large = level.where(F.col("size") > node_size)
    else:
        small.append(large)
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.union(more)
    branched = open_nodes.where(F.col("size") > node_size)
    branched = branched.groupBy("rep").agg(F.expr("bit_or(shiftleft(1L, place))").alias("large"))
    blocks = F.ceil(F.col("size") / node_size).cast("int")
    dealt = leaves.join(keys, "rep").join(branched, "rep", "left").fillna(0, ["large"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    dealt = dealt.select("node", i, j, "block", "rep", "comp", "n", "place", "large", "key", "roots")
    further = stored(links_inside(stored(with_partners(dealt), "partners"), docs), "links")

    merged = components(links.union(further))
    of_class = reps.select("h1", "h2", "n_shingles", "rep").join(merged.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.select("h1", "h2", "n_shingles", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component"))
    placed = described.drop("tokens", "key", "roots").join(of_class, ["h1", "h2", "n_shingles"], "left")
    alone = F.col("doc_id").isNull()
    component = F.when(~alone, F.coalesce("component", "doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.when(~alone, F.coalesce("class_id", "doc_id")).alias("class_id"),
    )
