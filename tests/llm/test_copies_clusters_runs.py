"""Exact copies, clusters and periodic runs against plain versions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import difference, duck
from conftest import TESTDATA
from pyspark.sql import functions as F
from tables import no_documents, odd_documents, write_documents, write_table  # noqa: F401

from tagloom.llm import centroids, exact, runs
from tagloom.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("name", ["op11_exact_copies", "op12_ns_bounds"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, name, sf):
    assert difference(QUERIES[name](spark, f"{TESTDATA}/{sf}"), duck(f"{TESTDATA}/{sf}"), ORACLES[name]) is None


# Exact copies


def plain_copies(rows):
    """(doc_id, keep_id, group_size, kept, sha256) of (doc_id, text), as sorted rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def copies_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def test_op11_odd_rows(spark, odd_documents, no_documents):  # noqa: F811
    folder, rows = odd_documents
    assert copies_of(QUERIES["op11_exact_copies"](spark, folder)) == plain_copies([r[:2] for r in rows])
    assert QUERIES["op11_exact_copies"](spark, no_documents).count() == 0


def clashing(spark):
    texts = ["a b", "a  b", "a\tb", "b a", "c", "c ", None, "", "A b", "dd", "dd", "dd"]
    rows = [(k % 7 if k % 5 else None, t, f"s{k}", k) for k, t in enumerate(texts * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, h long"), [r[:2] for r in rows]


@pytest.mark.parametrize("weak", [lambda t: F.unhex(F.md5(F.length(t).cast("string"))), lambda t: F.unhex(F.md5(F.lit("x")))])
def test_collisions_change_nothing(spark, weak, monkeypatch):
    """Hashes that collide, groups dealt out over salts, with and without a list of hashes to broadcast."""
    docs, rows = clashing(spark)
    for most in (exact.BROADCAST_HASHES, 0):
        monkeypatch.setattr(exact, "BROADCAST_HASHES", most)
        assert copies_of(exact.exact_copies(docs, hashed=weak, hot_rows=10)) == plain_copies(rows)
        assert copies_of(exact.exact_copies(docs, hot_rows=10)) == plain_copies(rows)


def test_rows_that_stay(spark):
    docs, rows = clashing(spark)
    left = exact.without_copies(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    want = sorted((i, digest) for i, _, _, kept, digest in plain_copies(rows) if kept)
    assert sorted((r[0], hashlib.sha256(re.sub(r"\s+", " ", r[1] or "").encode()).hexdigest()) for r in left.collect()) == want


def test_copies_stay_in_the_jvm(spark):
    plan = QUERIES["op11_exact_copies"](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|MapInArrow|MapInPandas|Window|Cartesian|NestedLoop", plan)


# Clusters


def plain_clusters(rows, k, rounds):
    """vec_id, cluster, distance of (vec_id, vector of whole numbers), with the last centroids."""
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)
    cents = [list(v) for _, v in named[:k]]
    for t in range(rounds + 1):
        dist = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents] for _, v in rows]
        at = [d.index(min(d)) for d in dist]
        if t < rounds:
            for j in range(len(cents)):
                own = [v for (_, v), a in zip(rows, at) if a == j]
                if own:
                    cents[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, a, d[a]) for (i, _), a, d in zip(rows, at, dist)), key=repr), cents


def whole(v):
    return [int(np.floor(np.float64(np.float32(x)) * 256)) if abs(x) < 1e30 else int(np.float32(x)) * 256 for x in v]


@pytest.mark.parametrize("far", [0.0, 3e5, 1e36])
def test_clusters_with_ties_repeats_and_far_vectors(spark, far):
    rng = np.random.default_rng(int(far) % 97)
    rows = [(i, (rng.integers(-3, 4, 4) / 256).tolist()) for i in range(300)]
    rows += rows[:20] + [(None, [0.5, -0.5, 0.25, 0.0])] + [(900 + i, (far * rng.standard_normal(4)).tolist()) for i in range(4)]
    odd = [(800, None), (801, []), (802, [1.0] * 3), (803, [1.0, None, 0.0, 0.0]), (804, [float("nan"), 0.0, 0.0, 0.0]), (805, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], VECTORS).withColumnRenamed("label", "cluster")
    got = centroids.cluster(df, size=4, k=12, rounds=5).collect()
    want, cents = plain_clusters([(i, whole(v)) for i, v in rows], 12, 5)
    fits = lambda d: d if d < 1 << 63 else None
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(((i, a, fits(d)) for i, a, d in want), key=repr)
    totals = [sum(d for _, a, d in want if a == j) for j in range(12)]
    for r in got:
        assert r["cluster_inertia"] == fits(totals[r["cluster"]]) and r["inertia"] == fits(sum(totals))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()


def test_bounds_spare_most_distances():
    """On clustered vectors the later rounds evaluate few distances; the displacement of a centroid
    that goes and comes back loosens nothing."""
    rng = np.random.default_rng(5)
    spots = rng.integers(-4000, 4000, (20, 16))
    x = spots[rng.integers(0, 20, 3000)] + rng.integers(-300, 300, (3000, 16))
    history = [x[:20].tolist()]
    state, taken = centroids.State(len(x), 20), []
    for t in range(6):
        taken.append(centroids.assign(x, state, history))
        dist = ((x[:, None, :] - np.array(history[-1])[None]) ** 2).sum(axis=2)
        assert (state.cluster == dist.argmin(axis=1)).all()
        groups = [x[state.cluster == j] for j in range(20)]
        history.append([(g.sum(axis=0) // len(g)).tolist() if len(g) else c for g, c in zip(groups, history[-1])])
    assert taken[0] == 3000 * 20 and sum(taken[3:]) < 3 * 3000 * 20 / 5
    there, back = [[0, 0], [9, 9]], [[5, 0], [9, 9]]
    assert centroids.displacements([there, back, there])[:, 0].tolist()[0] == 0.0


def test_many_sums_are_merged_in_steps(spark, monkeypatch):
    monkeypatch.setattr(centroids, "MERGES", 3)
    rows = [(i, [i % 7 / 16, i % 5 / 16]) for i in range(400)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(60)
    got = centroids.cluster(df, size=2, k=3, rounds=3).collect()
    want, _ = plain_clusters([(i, whole(v)) for i, v in rows], 3, 3)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == want


def test_no_vectors(spark, tmp_path):
    folder = write_table(spark, tmp_path, "embeddings", [(1, [1.0], 0), (2, None, 0)], VECTORS)
    assert QUERIES["op12_ns_bounds"](spark, folder).count() == 0
    given = QUERIES["op12_ns_bounds"](spark, f"{TESTDATA}/sf0.001")
    assert QUERIES["op12_ns_bounds"](spark, folder).dtypes == given.dtypes


# Periodic runs


def plain_runs(words):
    """Every period, every stretch of words that equal those a period further on."""
    names = {w: k for k, w in enumerate(dict.fromkeys(words))}
    w, found = np.array([names[x] for x in words], dtype=np.int64), {}
    for q in range(1, len(w) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]])))
        for s, e in edges.reshape(-1, 2).tolist():
            if e - s + q >= max(6, 4 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def strings(rng, many):
    for _ in range(many):
        kind, n = rng.integers(0, 4), int(rng.integers(0, 400))
        if kind == 0:
            yield rng.integers(0, 2, n)
        elif kind == 1:
            yield np.resize(rng.integers(0, 3, rng.integers(1, 60)), n)
        elif kind == 2:
            parts = [np.resize(rng.integers(0, 4, rng.integers(1, 40)), rng.integers(1, 200)) for _ in range(4)]
            yield np.concatenate(parts)
        else:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield np.array(b)


def test_runs_equal_brute_force():
    rng = np.random.default_rng(13)
    for _ in range(60):
        texts = [np.asarray(t, dtype=np.int64) for t in strings(rng, 6)]
        for t, found in zip(texts, runs.find_runs(texts)):
            assert [tuple(r) for r in found.tolist()] == sorted(plain_runs(t.tolist()), key=lambda r: (r[0], r[2]))


def test_extensions_equal_brute_force():
    rng = np.random.default_rng(3)
    for t in strings(rng, 40):
        words, _, _ = runs.framed([np.asarray(t, dtype=np.int64)])
        i, j = rng.integers(0, len(words), (2, 300))
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
                k += 1
            want.append(k)
        assert runs.Extensions(words).common(i, j).tolist() == want


def test_one_long_run_and_one_long_text():
    n = 200_000
    assert runs.find_runs([np.zeros(n, np.int64)])[0].tolist() == [[0, n, 1]]
    text = np.concatenate([np.arange(100, 100_100), np.resize(np.arange(40_000), 170_000), [7]])
    assert runs.find_runs([text])[0].tolist() == [[100_000, 170_000, 40_000]]


def plain_judged(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if plant and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in found)),
        sha(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


def test_op13(spark, odd_documents, no_documents):  # noqa: F811
    given = f"{TESTDATA}/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "text").collect()]
    for folder, docs in ((given, rows), (odd_documents[0], [r[:2] for r in odd_documents[1]])):
        got = sorted((tuple(r)[:8] for r in QUERIES["op13_periodic_runs"](spark, folder).collect()), key=repr)
        assert got == sorted((plain_judged(i, t, True) for i, t in docs), key=repr)
        assert folder != given or sum(r[1] > 0 for r in got) > 50
    assert QUERIES["op13_periodic_runs"](spark, no_documents).count() == 0


def test_list_of_runs(spark, tmp_path):
    rows = [(3, "x a b a b a b a b a b y", "en", None), (None, "z z z z z z", "en", None), (4, "no runs here", None, None), (5, None, None, None)]
    docs = spark.read.parquet(f"{write_documents(spark, tmp_path, rows)}/documents.parquet")
    assert sorted((tuple(r) for r in runs.list_runs(docs).collect()), key=repr) == [(3, 1, 10, 2), (None, 0, 6, 1)]
