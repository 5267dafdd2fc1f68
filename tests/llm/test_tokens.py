"""Encoding, shards and packing against the tokenizer libraries themselves."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from conftest import TESTDATA
from tables import no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from tagloom.llm import bpe, packing, wavelet
from tagloom.llm.queries import QUERIES
from tagloom.llm.wavelet import WaveletMatrix

RANKS = public.path("byte_bpe_50k.tiktoken")
SF = f"{TESTDATA}/sf0.001"


def raw(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def texts_of(spark, folder):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def tokenizer(name):
    t = Tokenizer.from_file(public.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("given", [True, False])
def test_op1(spark, odd_documents, given):
    folder = SF if given else odd_documents[0]
    lib = library()
    want = []
    for i, t in texts_of(spark, folder):
        ids = lib.encode_ordinary(t)
        digests = [hashlib.sha256(x).hexdigest() for x in (raw(ids), t.encode())]
        want.append((i, len(ids), *digests))
    assert sorted(map(tuple, QUERIES["op1_byte_bpe"](spark, folder).collect())) == sorted(want)


def test_op1_encodes_and_decodes_in_one_worker_of_bounded_memory(spark, monkeypatch):
    """A worker of its own for each step came to hold an encoder too, four to an executor."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = QUERIES["op1_byte_bpe"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    apart = bpe.decode_documents(bpe.encode_documents(docs, RANKS, public.PATTERN), RANKS)
    both = bpe.round_trip(docs, RANKS, public.PATTERN)
    assert both.schema == apart.schema and sorted(map(tuple, both.collect())) == sorted(map(tuple, apart.collect()))
    monkeypatch.setattr(bpe, "PAIRS", 100_000)
    merges = bpe.Merges(RANKS)
    assert {merges.fits(a, b) for a in range(600) for b in range(600)} == {True, False}
    assert 0 < len(merges.pairs) <= bpe.PAIRS < 600 * 600


def test_bpe_random_pieces():
    merges, lib, rng = bpe.Merges(RANKS), library(), random.Random(5)
    for _ in range(3000):
        piece = "".join(rng.choice("aabethinorsé😀_ ") for _ in range(rng.choice([1, 2, 5, 9, 40, 300])))
        assert merges.encode(piece.encode()) == lib._encode_single_piece(piece.encode())


def test_bpe_long_piece_is_linear():
    merges = bpe.Merges(RANKS)
    ids = merges.encode(b"ab" * 150_000)
    tokens = {v: k for k, v in merges.ranks.items()}
    assert b"".join(tokens[i] for i in ids) == b"ab" * 150_000


def test_encode_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id long, text string, ids string, n_tokens int")
    row = bpe.encode_documents(docs, RANKS, public.PATTERN).first()
    assert (row["n_tokens"], bytes(row["ids"])) == (2, raw(library().encode_ordinary("a b")))


@pytest.mark.parametrize("given", [True, False])
def test_op2(spark, odd_documents, given):
    folder = SF if given else odd_documents[0]
    encode = tokenizer("byte_bpe_50k.json")
    want, start = [], 0
    for i, t in sorted(texts_of(spark, folder)):
        ids = [*encode(t), 2]
        want.append((i, start, len(ids), zlib.crc32(raw(ids))))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op2_token_shards"](spark, folder).collect())) == want


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n, top in [(0, 1), (1, 1), (1, 7), (513, 2), (3000, 50257), (1024, 70000), (4097, 5)]:
        ids = rng.integers(0, top, n).astype(np.uint32)
        m = WaveletMatrix.build(ids)
        m = WaveletMatrix.load(m.n, m.bits, m.planes.tobytes(), m.zeros.tobytes(), m.ranks.tobytes())
        assert m.ids().tolist() == ids.tolist()
        for i in rng.integers(0, n, 20) if n else []:
            assert m.access(int(i)) == ids[i]
        for token in {*ids[:5].tolist(), top + 1}:
            places = np.flatnonzero(ids == token).tolist()
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert m.count(token, a, b) == sum(a <= p < b for p in places)
            for k in range(0, len(places), max(1, len(places) // 7)):
                assert m.select(token, k) == places[k]
            assert m.select(token, len(places)) == -1


def test_shards_small(spark, odd_documents, tmp_path):
    path = f"{tmp_path}/shards"
    docs = spark.read.parquet(f"{odd_documents[0]}/documents.parquet")
    wavelet.write_shards(docs, path, public.path("byte_bpe_50k.json"), 2, shard_tokens=50)
    assert spark.read.parquet(path).count() > 3
    rows = wavelet.with_start(wavelet.read_documents(spark, path), path).orderBy("start").collect()
    flat = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    assert [r["start"] for r in rows] == (np.cumsum([r["n_tokens"] for r in rows]) - [r["n_tokens"] for r in rows]).tolist()
    token = int(np.bincount(flat).argmax())
    counted = {r["token"]: r["n"] for r in wavelet.count_tokens(spark, path, [token, 2, 49999]).collect()}
    assert counted == {t: int((flat == t).sum()) for t in (token, 2, 49999)}
    places = [r["place"] for r in wavelet.occurrences(spark, path, token).orderBy("place").collect()]
    assert places == np.flatnonzero(flat == token).tolist()


def check_packing(spark, folder, rows, encode):
    docs = defaultdict(list)
    for i, t in texts_of(spark, folder):
        docs[i].append([*encode(t), 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(docs)
    for i, found in pieces.items():
        copies = len(docs[i])
        assert {r["doc_tokens"] for r in found} == {len(docs[i][0])}
        covered = sorted((r["start"], r["start"] + r["length"]) for r in found)
        seen = [0] * len(docs[i][0])
        for a, b in covered:
            for k in range(a, b):
                seen[k] += 1
        assert seen == [copies] * len(seen)
        for r in found:
            assert r["ids_crc32"] == zlib.crc32(raw(docs[i][0][r["start"] : r["start"] + r["length"]]))
    short = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0
        short += at < 2048
    return short, len(sequences)


@pytest.mark.parametrize("given", [True, False])
def test_op3(spark, odd_documents, given):
    folder = SF if given else odd_documents[0]
    rows = QUERIES["op3_mixture_packing"](spark, folder).collect()
    check_packing(spark, folder, rows, tokenizer("word_bpe_49k.json"))


def test_packing_carries_credit_over_segments(spark, tmp_path):
    path = f"{tmp_path}/segments"
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    packing.write_segments(docs, path, public.path("word_bpe_49k.json"), 1, segment_tokens=20_000)
    assert spark.read.parquet(path).count() > 5
    rows = packing.pack(spark, path, piece=64).collect()
    assert len({r["sequence_id"] for r in rows}) == max(r["sequence_id"] for r in rows) + 1
    # What a segment is told equals what packing the earlier ones in order leaves.
    segments = spark.read.schema(packing.SEGMENT).parquet(path).orderBy("part", "segment").collect()
    told = {(r["part"], r["segment"]): r for r in packing.carried(spark, path, 2048, None).collect()}
    total = sum(r["n_tokens"] for r in segments)
    supply = defaultdict(int)
    for r in segments:
        for s, n in zip(r["sources"], r["source_tokens"]):
            supply[s] += n
    done, sent, sequence = 0, defaultdict(int), 0
    for r in segments:
        mine = told[r["part"], r["segment"]]
        assert mine["first_sequence"] == sequence
        assert {m["source"] for m in mine["mix"]} == set(r["sources"])
        for m in mine["mix"]:
            assert m["credit"] == pytest.approx(supply[m["source"]] / total * done - sent[m["source"]], abs=1e-6)
        for s, n in zip(r["sources"], r["source_tokens"]):
            sent[s] += n
        done += r["n_tokens"]
        sequence += r["n_tokens"] // 2048 + (r["n_tokens"] % 2048).bit_count()


@pytest.mark.parametrize("targets", [None, {"a": 0.25, "b": 0.75}])
def test_windows_of_a_table_sorted_by_source(spark, tmp_path, targets):
    """Every full window has its sources in their shares; with targets, until b, which they ask
    more of than there is, has ended."""
    rng = random.Random(3)
    words = [r["text"].split()[:300] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(50).collect()]
    words = [w for w in sum(words, []) if w.isalpha()]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(50, 150))), s) for i, s in enumerate(["a"] * 1500 + ["b"] * 1500)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    packing.write_segments(docs, f"{tmp_path}/segments", public.path("word_bpe_49k.json"), 1, segment_tokens=40_000, targets=targets)
    assert spark.read.parquet(f"{tmp_path}/segments").count() > 5
    pieces = packing.pack(spark, f"{tmp_path}/segments", targets=targets).collect()
    of, size = defaultdict(int), defaultdict(int)
    for r in pieces:
        of[r["sequence_id"]] += r["length"] * (r["source"] == "a")
        size[r["sequence_id"]] += r["length"]
    full = [i for i in sorted(size) if size[i] == 2048]
    share = np.array([of[i] / 2048 for i in full])
    if targets is None:
        assert np.mean(abs(share - 0.5) < 0.2) > 0.9
    else:
        # All of b and a third as much of a, two thirds of all ids; then only a is left.
        early, late = share[: int(0.62 * len(full))], share[int(0.72 * len(full)) :]
        assert np.mean(abs(early - 0.25) < 0.2) > 0.9 and np.mean(late) > 0.97


def test_turns_follow_targets():
    supply = [[(i, 700) for i in range(100)], [(1000 + i, 90) for i in range(1000)]]
    windows = list(packing.take_turns(supply, [0.25, 0.75], [0.0, 0.0], 2048, 256))
    sent = 0
    for k, filled in enumerate(windows[:40]):
        sent += sum(n for d, _, n in filled if d < 1000)
        assert abs(sent - 0.25 * 2048 * (k + 1)) <= 512
    assert sum(n for w in windows for *_, n in w) == 160_000


def test_no_documents(spark, no_documents):
    for name in ("op1_byte_bpe", "op2_token_shards", "op3_mixture_packing"):
        assert QUERIES[name](spark, no_documents).count() == 0
