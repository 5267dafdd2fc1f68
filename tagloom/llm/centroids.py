"""Lloyd's rounds over integer vectors, exact, with ns-bounds.

A vector keeps, for its own centroid, an upper bound of the distance, and for every centroid a
lower bound, each with the round in which it was evaluated. The history of all centroids is kept
too (rounds times k vectors, which travels with the tasks), so a bound is loosened by the norm of
the total displacement of its centroid since then; summing what it moved in each round would loosen
it more. Centroids whose bounds don't exclude them are evaluated again, in integers, ties to the
smaller number: the outcome is that of comparing everything.

A task reads its part of the vectors with their state and writes them with the next state, and one
row of sums per cluster with them, so a round is one pass and the sums are as exact as its output.
Sums are merged in two steps of bounded size; the driver sees k centroids.

Vectors without exactly ``size`` components, or with null or non-finite ones, take no part. Of
the k first centroids the vectors with the smallest hash of ``<seed>:<id>`` are taken, of rows
with one id the smaller vector first; a row without an id takes part but never starts a cluster.
Fewer vectors than k start fewer clusters; no vector gives no rows. Components of any size are
handled in whole numbers, beyond 2**27 in Python's; a distance or sum beyond 64 bits is null.
Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import release
from tagloom.session import drop_scratch, scratch_path

SIZE, CLUSTERS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
#: Whole numbers up to this are squared and added up in 64 bits.
NARROW = 1 << 27
#: Rows of a step inside a task.
STEP_ROWS = 4096
#: Partial sums are merged in so many tasks, then in one.
MERGES = 256
#: Bounds are widened by this share, far beyond the rounding of a square root.
SLACK = 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 * x): 64-bit integers, or Python's where one of them is large."""
    with np.errstate(over="ignore"):
        y = np.floor(x * SCALE)
    if not y.size or np.abs(y).max() <= NARROW:
        return y.astype(np.int64)
    whole = [int(v) * SCALE if abs(v) > 1e16 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(x.shape)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.array([math.sqrt(s) if s < 1 << 1000 else 1e150 for s in squares.tolist()]) if squares.dtype == object else np.sqrt(squares)


def displacements(history: list[list[list[int]]]) -> np.ndarray:
    """For every round and centroid the distance to where it is now, rounded up."""
    now = history[-1]
    squares = [[sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(then, now)] for then in history]
    return np.array([[math.sqrt(s) * (1 + SLACK) if s < 1 << 1000 else math.inf for s in row] for row in squares])


class State:
    """Of some vectors: cluster, bounds, and the rounds in which these were evaluated."""

    def __init__(self, n: int, k: int):
        self.cluster = np.zeros(n, np.int32)
        self.upper, self.upper_at = np.full(n, np.inf), np.zeros(n, np.uint8)
        self.lower, self.lower_at = np.full((n, k), -np.inf), np.zeros((n, k), np.uint8)


def assign(x: np.ndarray, state: State, history: list[list[list[int]]]) -> int:
    """Move every vector of ``x`` to its nearest centroid; returns how many distances that took."""
    k, now = len(history[-1]), len(history) - 1
    moved = displacements(history)
    wide = x.dtype == object or max(abs(v) for c in history[-1] for v in c) > NARROW
    centroids = np.array(history[-1], dtype=object if wide else np.int64)
    x = x.astype(object) if wide else x
    low = state.lower - moved[state.lower_at, np.arange(k)]
    up = state.upper + moved[state.upper_at, state.cluster]
    open_ = low <= up[:, None]
    open_[np.arange(len(x)), state.cluster] = False
    rows = np.flatnonzero(open_.any(axis=1))
    if not len(rows):
        return 0

    def distances(of: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        gap = x[of] - centroid
        return (gap * gap).sum(axis=1)

    def evaluated(of: np.ndarray, j: np.ndarray | int, square: np.ndarray) -> None:
        root = _root(square)
        state.lower[of, j], state.lower_at[of, j] = root * (1 - SLACK), now

    # First the own centroid alone: that often settles it.
    own = state.cluster[rows]
    square = distances(rows, centroids[own])
    evaluated(rows, own, square)
    tight = _root(square) * (1 + SLACK)
    state.upper[rows], state.upper_at[rows] = tight, now
    fails = open_[rows] & (low[rows] <= tight[:, None])
    best, nearest = square.copy(), own.copy()
    for j in np.flatnonzero(fails.any(axis=0)):
        some = np.flatnonzero(fails[:, j])
        found = distances(rows[some], centroids[j])
        evaluated(rows[some], j, found)
        better = (found < best[some]) | ((found == best[some]) & (j < nearest[some]))
        best[some[better]], nearest[some[better]] = found[better], j
    changed = nearest != own
    state.cluster[rows] = nearest
    state.upper[rows[changed]] = _root(best[changed]) * (1 + SLACK)
    return len(rows) + int(fails.sum())


def own_distance(x: np.ndarray, state: State, centroids: list[list[int]]) -> list[int]:
    wide = x.dtype == object or max(abs(v) for c in centroids for v in c) > NARROW
    kind = object if wide else np.int64
    gap = x.astype(kind) - np.array(centroids, dtype=kind)[state.cluster]
    return (gap * gap).sum(axis=1).tolist()


STATE = (
    "cluster int, distance bigint, upper double, upper_at int, lower binary, lower_at binary, evaluated bigint, "
    "n bigint, total array<string>"
)


def _round(rows: DataFrame, history: list[list[list[int]]], kind: str, last: bool) -> DataFrame:
    """One assignment of ``rows(vec_id, x[, state])``. The rows of sums have ``n`` and ``total``."""
    k, size = len(history[0]), len(history[0][0])
    vec_id = dict(rows.dtypes)["vec_id"]
    columns = ["vec_id", "x"] if len(history) == 1 else ["vec_id", "x", "cluster", "upper", "upper_at", "lower", "lower_at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sums = [[0] * size for _ in range(k)]
        counts = np.zeros(k, np.int64)
        ids = values = None
        for whole in batches:
            ids, values = whole.schema.field("vec_id").type, whole.schema.field("x").type
            for at in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(at, STEP_ROWS)
                x = scaled(batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))
                state = State(len(x), k)
                if len(history) > 1:
                    state.cluster = batch.column("cluster").to_numpy().copy()
                    state.upper, state.upper_at = (batch.column(c).to_numpy().copy() for c in ("upper", "upper_at"))
                    state.lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), "<f8").reshape(-1, k).copy()
                    state.lower_at = np.frombuffer(b"".join(batch.column("lower_at").to_pylist()), np.uint8).reshape(-1, k).copy()
                taken = assign(x, state, history)
                counts += np.bincount(state.cluster, minlength=k)
                order = np.argsort(state.cluster, kind="stable")
                first = np.flatnonzero(np.diff(state.cluster[order], prepend=-1))
                for j, part in zip(state.cluster[order[first]].tolist(), np.add.reduceat(x[order], first).tolist()):
                    sums[j] = [a + b for a, b in zip(sums[j], part)]
                far = [d if d < 1 << 63 else None for d in own_distance(x, state, history[-1])] if last else [None] * len(x)
                evaluations = np.zeros(len(x), np.int64)
                evaluations[0] = taken
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), batch.column("x"), pa.array(state.cluster), pa.array(far, pa.int64()), pa.array(state.upper),
                    pa.array(state.upper_at.astype(np.int32)), pa.array([r.tobytes() for r in state.lower], pa.binary()),
                    pa.array([r.tobytes() for r in state.lower_at], pa.binary()), pa.array(evaluations),
                    pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.list_(pa.string())),
                ], names=["vec_id", "x", *NAMES])
        some = np.flatnonzero(counts)
        if len(some):
            blank = [pa.nulls(len(some), t) for t in (pa.int64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(some), ids), pa.nulls(len(some), values), pa.array(some.astype(np.int32)), *blank,
                pa.array(counts[some]), pa.array([[str(v) for v in sums[j]] for j in some], pa.list_(pa.string())),
            ], names=["vec_id", "x", *NAMES])

    return rows.select(*columns).mapInArrow(run, f"vec_id {vec_id}, x {kind}, {STATE}")


NAMES = [c.strip().split()[0] for c in STATE.split(",")]


def _merged(sums: DataFrame, parts: int) -> DataFrame:
    """Rows of sums, added up per cluster within each of so many tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for j, n, total in zip(*(batch.column(c).to_pylist() for c in ("cluster", "n", "total"))):
                own = [int(v) for v in total]
                m, old = held.get(j, (0, [0] * len(own)))
                held[j] = (m + n, [a + b for a, b in zip(old, own)])
        if held:
            columns = [
                pa.array(list(held), pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()),
                pa.array([[str(v) for v in t] for _, t in held.values()], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    return sums.select("cluster", "n", "total").repartition(parts).mapInArrow(run, "cluster int, n bigint, total array<string>")


def cluster(vectors: DataFrame, size: int = SIZE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``vectors(vec_id, embedding, ...)`` -> vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256, cluster_size; one row per vector that takes part."""
    if not 0 < rounds < 255:
        raise ValueError("rounds must be between 1 and 254")
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["embedding"]
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where((F.size("embedding") == size) & finite).select("vec_id", F.col("embedding").alias("x"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = rows.where("vec_id IS NOT NULL").orderBy(order, "x").limit(k).select("x").collect()
    history = [scaled(np.array([r["x"] for r in starts], dtype=np.float64).reshape(-1, size)).tolist()]
    if not starts:
        return spark.createDataFrame([], f"vec_id {dict(vectors.dtypes)['vec_id']}, {RESULT}")
    old = None
    for t in range(rounds + 1):
        path = scratch_path(spark, "assigned")
        _round(rows, history, kind, last=t == rounds).write.parquet(path)
        written = spark.read.parquet(path)
        rows = written.where("total IS NULL")
        if old:
            drop_scratch(spark, old)
        old = path
        if t < rounds:
            sums = written.where("total IS NOT NULL")
            parts = min(MERGES, sums.count() // (8 * k))
            sums = _merged(_merged(sums, parts) if parts > 1 else sums, 1).collect()
            history.append([list(c) for c in history[-1]])
            for r in sums:
                history[-1][r["cluster"]] = [int(v) // r["n"] for v in r["total"]]
    fits = "CASE WHEN count(distance) = count(*) THEN try_cast(sum(CAST(distance AS DECIMAL(38, 0))) AS BIGINT) END"
    tally = rows.groupBy("cluster").agg(F.expr(fits).alias("inertia"), F.count(F.lit(1)).alias("n")).collect()
    whole = None if any(r["inertia"] is None for r in tally) else sum(r["inertia"] for r in tally)
    whole = whole if whole is not None and whole < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1]]
    found = [(r["cluster"], r["inertia"], whole, digest[r["cluster"]], r["n"]) for r in tally]
    # At most k rows.
    named = F.broadcast(spark.createDataFrame(found, RESULT.replace("distance bigint, ", "")))
    names = [c.strip().split()[0] for c in RESULT.split(",")]
    return rows.join(named, "cluster").select("vec_id", *names)


RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, cluster_size bigint"


def oracle_sql(size: int = SIZE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same rounds in SQL, comparing everything."""
    steps = [f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v AS w
    FROM kept WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k}
)"""]
    gap = "list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
    SELECT r, vec_id, v, c, CAST(d AS BIGINT) AS d FROM (
        SELECT r, vec_id, v, c, {gap} AS d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM kept, c{t}
    ) WHERE place = 1
)""")
        if t < rounds:
            steps.append(f"""
c{t + 1} AS MATERIALIZED (
    SELECT c, coalesce(m, w) AS w FROM c{t} LEFT JOIN (
        SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS m FROM (
            SELECT c, pos, sum(x) AS total, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{t}) GROUP BY c, pos
        ) GROUP BY c
    ) USING (c)
)""")
    return f"""WITH {','.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS "cluster", d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256, count(*) OVER (PARTITION BY c) AS cluster_size
FROM a{rounds} JOIN c{rounds} USING (c)"""
