"""Neighbours, hosts and the pipeline against plain versions."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from tables import DOCUMENTS, no_documents, odd_documents, write_documents, write_table  # noqa: F401

import corpus_pipeline
from tagloom.llm import forest, hostrank
from tagloom.llm.queries import QUERIES, RULES

VECTORS = "vec_id long, embedding array<float>, label int"


def exact_search(ids, vectors, queries, k):
    out = {}
    for q in queries:
        scores = vectors @ vectors[ids == q][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def listed(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(found, want):
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_op4(spark, sf):
    rows = spark.read.parquet(f"{TESTDATA}/{sf}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    want = exact_search(ids, vectors, ids[ids % 20 == 0].tolist(), 20)
    found = listed(QUERIES["op4_prefix_forest"](spark, f"{TESTDATA}/{sf}").collect())
    assert set(found) == set(want) and all(len(x) == len(want[q]) for q, x in found.items())
    assert recall(found, want) >= 0.93
    for q, x in found.items():
        true = dict(zip(ids.tolist(), vectors @ vectors[ids == q][0]))
        assert [s for _, s in x] == pytest.approx([true[i] for i, _ in x], abs=1e-12)


def test_forest_dealt_out_over_parts(spark):
    """Lengths differ, parts are small, clusters are near: queries visit several parts of a tree."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 16))
    vectors = (centres[rng.integers(0, 40, 1500)] + 0.3 * rng.standard_normal((1500, 16))) * rng.uniform(0.2, 2, (1500, 1))
    vectors = vectors.astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, VECTORS)
    found = listed(forest.search(df, df.where("vec_id % 50 = 0"), k=5, first=32, part_size=100).collect())
    want = exact_search(np.arange(1500), vectors.astype(float), range(0, 1500, 50), 5)
    assert recall(found, want) >= 0.93


def test_forest_orders_ties_by_id(spark):
    """0/1 vectors: hundreds of different vectors share every score."""
    rows = [(i, [float(i >> b & 1) for b in range(13)], 0) for i in range(1, 8192)]
    df = spark.createDataFrame(rows, VECTORS)
    vectors = np.array([v for _, v, _ in rows])
    ids = np.arange(1, 8192)
    found = listed(forest.search(df, df.where("vec_id % 100 = 0")).collect())
    assert len(found) == 81
    for q, x in found.items():
        scores = vectors @ vectors[q - 1]
        scores[q - 1] = -1
        order = np.lexsort((ids, -scores))[:20]
        assert [i for i, _ in x] == ids[order].tolist() and [s for _, s in x] == scores[order].tolist()


def test_forest_cuts_large_parts(spark):
    """A very long vector gives all others one string, and a third of them are nearly equal: eighteen
    blocks of a tree together find what one would."""
    rng = np.random.default_rng(8)
    near = rng.standard_normal(8) + 1e-4 * rng.standard_normal((600, 8))
    vectors = np.concatenate([near, rng.standard_normal((1200, 8)), [[1e6] + [0.0] * 7]])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, VECTORS.replace("array<float>", "array<double>"))
    found = listed(forest.search(df, df.where("vec_id % 60 = 0"), k=5, trees=8, first=40, part_size=100).collect())
    want = exact_search(np.arange(1801), vectors, range(0, 1801, 60), 5)
    assert recall(found, want) >= 0.9


def test_forest_vectors_whose_square_overflows(spark):
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((60, 4)) * 10.0 ** rng.integers(150, 200, 60)[:, None]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], VECTORS.replace("array<float>", "array<double>"))
    found = listed(forest.search(df, df.where("vec_id % 20 = 0"), k=3, trees=4).collect())
    with np.errstate(over="ignore", invalid="ignore"):
        for q, x in found.items():
            scores = np.nan_to_num(np.cumsum(vectors * vectors[q], axis=1)[:, -1], nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            order = [i for i in np.lexsort((np.arange(60), -scores)) if i != q][:3]
            assert [i for i, _ in x] == order


def test_forest_odd_rows(spark, tmp_path):
    same = [1.0, 2.0, 0.5]
    rows = [(i, same, 0) for i in range(60)]
    rows += [(100, [0.0, 0.0, 0.0], 0), (120, None, 0), (140, [1.0, None, 2.0], 0), (160, [float("nan"), 1.0, 1.0], 0)]
    rows += [(180, [float("inf"), 1.0, 1.0], 0), (200, [], 0), (220, [1.0, 1.0], 0), (None, same, 0), (240, [3.0, 1.0, 1.0], 0)]
    rows += [(0, same, 0)]
    folder = write_table(spark, tmp_path, "embeddings", rows, VECTORS)
    found = listed(QUERIES["op4_prefix_forest"](spark, folder).collect())
    assert set(found) == {0, 20, 40, 240}
    assert [i for i, _ in found[0]] == [240, *range(1, 20)] and [i for i, _ in found[20]] == [240, *range(19)]
    assert [i for i, _ in found[240]] == list(range(20))


def test_forest_no_rows(spark, tmp_path):
    folder = write_table(spark, tmp_path, "embeddings", [], VECTORS)
    assert QUERIES["op4_prefix_forest"](spark, folder).count() == 0


# Hosts

PAGES = "page_id long, url string, html string, host string"


def brute_rule(url):
    _, found, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest)[0] if found else ""
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if found else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, ruling in RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, ruling)
    return host, path, best


ODD_URLS = [
    None, "", "nothing", "http://", "http://Example.ORG/es/x?y#z", "https://a.example.org/en/1", "http://a.example.org/en/2", "x://org",
    "http://org?/es/", "http://com/de/", "http://x.com/de", "http://notcom/de/", "http://ÄB.com/fr/ü\nz", "http://a.com:80/de/", "a://b://c.com/fr/",
]


def test_op10(spark, tmp_path):
    rows = [(i, u, None if i % 3 else "<a href='//x.com/'>", "clash") for i, u in enumerate(ODD_URLS)]
    given = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet").select("page_id", "url").collect()]
    for folder, pages in ((write_table(spark, tmp_path, "pages", rows, PAGES), [r[:2] for r in rows]), (f"{TESTDATA}/sf0.01", given)):
        found = {r["page_id"]: r for r in QUERIES["op10_host_trust"](spark, folder).collect()}
        assert len(found) == len(pages)
        for i, url in pages:
            host, path, best = brute_rule(url)
            r = found[i]
            assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
            assert r["verdict"] == best[1] if best else r["verdict"] in ("allow", "block")


def brute_rank(links, seeds, rounds, damping):
    out = defaultdict(float)
    for (a, _), n in links.items():
        out[a] += n
    scores = dict(seeds)
    for _ in range(rounds):
        got = defaultdict(float)
        for (a, b), n in links.items():
            got[b] += scores.get(a, 0.0) * n / out[a]
        back = 1 - damping * sum(got.values())
        scores = {h: seeds.get(h, 0.0) * back + damping * got[h] for h in {*seeds, *got}}
    return scores


def test_trust_is_carried_along_links(spark):
    links = {"good.org": ["near.net", "near.net", "mid.net"], "near.net": ["mid.net"], "spam.net": ["bad.com"], "farm.net": ["spam.net"],
             "mid.net": ["good.org"], "bad.com": []}
    rows = []
    for k, (host, to) in enumerate(links.items()):
        html = "".join(f'<p><A class=x HREF="https://{t}/p?q">x</a><a href="/own">y</a>' for t in to)
        path = "/de/" if host == "bad.com" else "/x"
        rows.append((k, f"http://{host}{path}", html, None))
    rows.append((90, "http://lonely.net/", None, None))
    judged = hostrank.judge(spark.createDataFrame(rows, PAGES), RULES)
    found = {r["host"]: r for r in judged.collect()}
    assert {h: r["verdict"] for h, r in found.items()} == {
        "good.org": "allow", "near.net": "allow", "mid.net": "allow", "bad.com": "block", "spam.net": "block", "farm.net": "block", "lonely.net": "allow",
    }
    counted = defaultdict(int)
    for a, to in links.items():
        for b in to:
            counted[a, b] += 1
    trust = brute_rank(counted, {"good.org": 1.0}, hostrank.ROUNDS, hostrank.DAMPING)
    distrust = brute_rank({(b, a): n for (a, b), n in counted.items()}, {"bad.com": 1.0}, hostrank.ROUNDS, hostrank.DAMPING)
    for h, r in found.items():
        assert r["trust"] == pytest.approx(trust.get(h, 0.0), abs=1e-12) and r["distrust"] == pytest.approx(distrust.get(h, 0.0), abs=1e-12)


def test_trust_reaches_the_end_of_a_chain(spark):
    """Twenty hosts in a row to a blocked one, with a loop in the middle, against the solved equations."""
    chain = [*(f"h{k}.net" for k in range(20)), "bad.com"]
    links = {(a, b): 1 for a, b in zip(chain, chain[1:])} | {("h9.net", "h5.net"): 2, ("good.org", "h3.net"): 1}
    hosts = [*chain, "good.org"]
    rows = []
    for k, host in enumerate(hosts):
        html = "".join(f'<a href="http://{b}/">x</a>' * n for (a, b), n in links.items() if a == host)
        rows.append((k, f"http://{host}/{'de/' * (host == 'bad.com')}", html, None))
    found = {r["host"]: r for r in hostrank.judge(spark.createDataFrame(rows, PAGES), RULES).collect()}
    assert found["h0.net"]["trust"] == 0 and found["h0.net"]["distrust"] > 0 and found["h0.net"]["verdict"] == "block"
    for name, edges, seed in (("trust", links, "good.org"), ("distrust", {(b, a): n for (a, b), n in links.items()}, "bad.com")):
        steps = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in edges.items():
            steps[hosts.index(b), hosts.index(a)] = n / sum(m for (x, _), m in edges.items() if x == a)
        want = np.linalg.solve(np.eye(len(hosts)) - hostrank.DAMPING * steps, np.eye(len(hosts))[hosts.index(seed)])
        want /= want.sum()
        assert [found[h][name] for h in hosts] == pytest.approx(want.tolist(), rel=1e-10, abs=1e-300)


def test_no_pages(spark, tmp_path):
    folder = write_table(spark, tmp_path, "pages", [], PAGES)
    assert QUERIES["op10_host_trust"](spark, folder).count() == 0


# The pipeline


def test_stages_keep_columns_and_drop_what_they_judge(spark, tmp_path):
    given = [tuple(r)[:4] for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()]
    # Prose, not one of the planted texts of letters and symbols.
    text = next(t for _, t, lang, _ in given if lang == "en" and 100 < len(t.split()) < 400 and not set("|*%&$#") & set(t))
    more = [(20_001, None, "en", "s"), (20_002, "12 34", "en", "s"), (20_003, text + " 4012888888881881", None, None), (None, text, "en", "s")]
    folder = write_documents(spark, tmp_path, [*given, *more, given[5]])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.selectExpr("*", "1 AS kept", "2 AS score", "3 AS n_words", "4 AS replaced", "5 AS lang_pred", "6 AS _group")
    ids = lambda df: sorted((r[0] for r in df.select("doc_id").collect()), key=str)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        path = f"{tmp_path}/{name}"
        made.write.parquet(path)
        made = spark.read.parquet(path)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        gone = set(ids(docs)) - set(ids(made))
        if name == "language":
            assert gone == {20_001, 20_002}
        if name == "near_copies":
            left = ids(made)
            assert len(left) == len(set(left)) and 20_003 in gone
        if name == "personal_data":
            assert not gone and made.where("n_chars <> length(text)").isEmpty()
        docs = made
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(ids(docs))


def test_rows_of_one_id_are_chosen_by_their_content(spark, tmp_path):
    """Whatever order they come in."""
    words = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(6)]
    rows = [(k % 4, words[k], "en", f"s{k}") for k in range(6)] + [(1, words[1], "en", "s9"), (None, words[0], "en", "s")]
    want = None
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, lang, s, 1) for i, t, lang, s in order], DOCUMENTS).repartition(3)
        left = sorted((tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()), key=repr)
        assert [r[0] for r in left] == [*sorted({r[0] for r in left if r[0] is not None}), None] and (want is None or left == want)
        want = left


def test_language_rejects_text_of_no_learned_language(spark, tmp_path):
    rng = random.Random(6)
    given = [tuple(r)[:4] for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()]
    words = defaultdict(list)
    for _, text, lang, _ in given:
        words[lang] += text.split()
    noise = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randrange(2, 10))) for _ in range(200))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
    more = [
        (20_001, noise("абвгдежзийклмнопрстуфхцчшщыэюя"), "es", "s"), (20_002, noise("abcdefghijklmnopqrstuvwxyz"), "en", "s"),
        (20_003, polish * 8, None, "s"), (20_004, " ".join(words["de"][:300] + words["fr"][:300]), "de", "s"),
    ]
    folder = write_documents(spark, tmp_path, [*given, *more])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, folder).select("doc_id").collect()}
    assert {r[0] for r in (*given, *more)} - left == {20_001, 20_002, 20_003}


def test_run(spark, odd_documents, no_documents):  # noqa: F811
    assert corpus_pipeline.run(spark, no_documents).count() == 0
    packed = corpus_pipeline.run(spark, odd_documents[0])
    assert packed.count() == 0  # none has fifty words without repeats
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_copies", "personal_data", "packing"]
