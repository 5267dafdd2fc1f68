"""Periodic runs of words, from longest common extensions by difference covers.

The words of the texts of a slice stand one after another as numbers, with a number of its own
between texts and at both ends, so no extension leaves its text. A run of period q and length 4q
or more covers two neighbouring points of the harmonic grid 0, 3q, 6q, ... shifted by 0 and q: for
every q up to a quarter of a text the words of all such pairs are compared, and those that agree
are extended to both sides. That is about n ln n / 3 pairs for n words.

The extension of a pair is first looked at word by word, until both places lie in the difference
cover modulo 31: with six residues any two places get there at once within 30 words. Only texts
with a pair that gets so far go on. For these the suffixes at places of the cover alone are sorted
(blocks of 31 words get their rank, then ranks are doubled), the common prefixes of neighbours are
measured, and a sparse table of their minima answers what two places share. Extensions to
the left do the same on the words in reverse.

Every period found for a stretch is a multiple of its smallest one, which the grid finds too,
with the same two ends: of the periods of a stretch the smallest stands.

Words are ``[^\\x20\\x09-\\x0D]+``. A null, empty or blank text has no words: no runs, nulls for the
longest one, digests of the empty string. Repeated rows are judged alike, one by one. Without an id
nothing is planted (see :func:`judge`). Memory grows with one slice of texts, or one
long text. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.tokens import plain, ragged, release, slices, text_buffers
from tagloom.llm.words import BLANK, word_starts

#: A run is at least so many words and so many periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Every difference modulo 31 is one of two of these.
MODULUS, COVER = 31, np.array([0, 1, 3, 8, 12, 18])
SLICE_BYTES = 1 << 20
#: Pairs of the grid looked at in one step.
STEP_PAIRS = 1 << 20

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: Steps from two residues until both are in the cover.
SHIFT = np.array([
    [next(t for t in range(MODULUS) if _IN_COVER[(a + t) % MODULUS] and _IN_COVER[(b + t) % MODULUS]) for b in range(MODULUS)]
    for a in range(MODULUS)
])


def agreeing(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
    """How many words from ``i`` and ``j`` on agree, up to ``most`` each (at most 31)."""
    n = len(words)
    out = np.broadcast_to(np.asarray(most, np.int64), i.shape).copy()
    open_ = np.flatnonzero(out > 0)
    for t in range(MODULUS):
        if not len(open_):
            break
        a, b = i[open_] + t, j[open_] + t
        same = (a < n) & (b < n)
        same[same] = words[a[same]] == words[b[same]]
        out[open_[~same]] = t
        open_ = open_[same]
        open_ = open_[out[open_] > t + 1]
    return out


class Extensions:
    """Longest common extensions to the right in ``words``, which end with a word of its own."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        places = [np.arange(r, n, MODULUS) for r in COVER]
        self.first = np.zeros(MODULUS, np.int64)  # of a residue's places among the sampled ones
        self.first[COVER] = np.cumsum([0, *map(len, places[:-1])])
        at = np.concatenate(places)
        rank = self._block_ranks(at)
        # Every residue's last block holds the end, which is there once: no suffix runs into the next residue.
        levels, step = [rank], 1
        while rank.max(initial=0) + 1 < len(rank):
            after = np.full(len(rank), -1, np.int64)
            after[:-step] = rank[step:]
            rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1]
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        # Common prefixes of neighbours: whole blocks by descending levels, then words.
        a, b = order[:-1].copy(), order[1:].copy()
        i, j = at[a], at[b]
        blocks = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = (a < len(rank)) & (b < len(rank))
            same = inside.copy()
            same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
            blocks[same] += 1 << level
            a[same] += 1 << level
            b[same] += 1 << level
        del levels
        shared = blocks * MODULUS
        shared += agreeing(words, i + shared, j + shared, MODULUS)
        self.least = [shared.astype(np.int32)]
        while 2 << len(self.least) - 1 <= len(shared):
            half, low = 1 << len(self.least) - 1, self.least[-1]
            self.least.append(np.minimum(low[:-half], low[half:]))

    def _block_ranks(self, at: np.ndarray) -> np.ndarray:
        """Ranks of the blocks of 31 words at these places, by their words."""
        padded = np.concatenate([self.words, np.full(MODULUS, -1)])
        order = np.arange(len(at))
        for t in range(MODULUS - 1, -1, -1):
            order = order[np.argsort(padded[at[order] + t], kind="stable")]
        new = np.zeros(len(at), bool)
        for t in range(MODULUS):
            column = padded[at[order] + t]
            new[1:] |= column[1:] != column[:-1]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _sample(self, place: np.ndarray) -> np.ndarray:
        return self.rank[self.first[place % MODULUS] + place // MODULUS]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of different places ``i`` and ``j``."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        out = agreeing(self.words, i, j, shift)
        on = np.flatnonzero(out == shift)
        n = len(self.words)
        on = on[np.maximum(i[on], j[on]) + shift[on] < n]
        x, y = self._sample(i[on] + shift[on]), self._sample(j[on] + shift[on])
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            of = level == k
            least = np.minimum(self.least[k][low[of]], self.least[k][high[of] - (1 << k)])
            out[on[of]] += least
        return out


def grid(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the harmonic grid of texts, a bounded number at a time."""
    periods = np.where(lengths >= LEAST_WORDS, lengths // LEAST_PERIODS, 0)
    of = np.repeat(np.arange(len(lengths)), periods)
    q = ragged(np.ones(len(lengths), np.int64), periods)
    step = (LEAST_PERIODS - 1) * q
    points = (lengths[of] - q - 1) // step + 1
    ends = np.cumsum(points)
    at = 0
    while at < len(q):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + STEP_PAIRS, side="right")))
        some = slice(at, to)
        place = ragged(np.zeros(to - at, np.int64), points[some])
        yield np.repeat(starts[of[some]], points[some]) + place * np.repeat(step[some], points[some]), np.repeat(q[some], points[some])
        at = to


def framed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of word numbers in one array, with a number of its own before, between and after
    them; the place and length of each."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    own = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    words = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    words[0] = own
    words[starts + lengths] = own + 1 + np.arange(len(texts))
    for s, t in zip(starts.tolist(), texts):
        words[s : s + len(t)] = t
    return words, starts, lengths


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For every text the rows (start, length, period) of its runs, by start and then period."""
    words, starts, lengths = framed(texts)
    back, n = words[::-1].copy(), len(words)
    near = [], []
    for i, q in grid(starts, lengths):
        same = words[i] == words[i + q]
        near[0].append(i[same])
        near[1].append(q[same])
    i, q = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in near)
    j = i + q
    # Word by word first; most pairs part here.
    right, left = agreeing(words, i, j, MODULUS), agreeing(back, n - i, n - j, MODULUS)
    far = (right == MODULUS) | (left == MODULUS)
    if far.any():
        text_of = np.searchsorted(starts, i, side="right") - 1
        some = np.unique(text_of[far])
        inner, begin, _ = framed([texts[t] for t in some])
        pair = np.flatnonzero(far)
        at = np.searchsorted(some, text_of[pair])
        x = i[pair] - starts[text_of[pair]] + begin[at]
        y = x + q[pair]
        right[pair] = Extensions(inner).common(x, y)
        left[pair] = Extensions(inner[::-1].copy()).common(len(inner) - x, len(inner) - y)
    length = left + right + q
    good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    found = np.stack([i - left, length, q], axis=1)[good]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    smallest = np.ones(len(found), bool)
    smallest[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[smallest]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    cuts = np.searchsorted(found[:, 0], starts)
    return [f - [s, 0, 0] for f, s in zip(np.split(found, cuts[1:]), starts.tolist())]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a text, where the contract makes its end periodic."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place < a, place, a + (place - a) % period)


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number per word, the first word of each text, and the bytes: all letters, of each word
    the first one and how many."""
    ends, data = text_buffers(plain(texts))
    inside = ~BLANK[data]
    begins = word_starts(ends, inside) if len(data) else np.zeros(0, np.int64)
    of = np.searchsorted(begins, ends)
    letters = data[inside]
    begin = np.cumsum(inside)[begins] - 1
    size = np.diff(np.append(begin, len(letters)))
    offsets = pa.py_buffer(np.append(begin, len(letters)).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, offsets, pa.py_buffer(np.ascontiguousarray(letters))])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), of, letters, begin, size


def _judged(batch: pa.RecordBatch, plant: bool) -> pa.RecordBatch:
    number, of, letters, begin, size = _split(batch.column(1))
    placed = []
    for doc_id, a, b in zip(batch.column(0).to_pylist(), of[:-1].tolist(), of[1:].tolist()):
        moved = planted(doc_id, b - a) if plant else None
        placed.append(np.arange(a, b) if moved is None else a + moved)
    runs = find_runs([number[p] for p in placed])
    n_runs, best, run_digests, kept_digests, n_dropped = [], [], [], [], []
    for place, found in zip(placed, runs):
        cover = np.zeros(len(place) + 1, np.int64)
        np.add.at(cover, found[:, 0] + found[:, 2], 1)
        np.add.at(cover, found[:, 0] + found[:, 1], -1)
        stays = place[np.cumsum(cover)[:-1] == 0]
        n_dropped.append(len(place) - len(stays))
        text = np.full(int((size[stays] + 1).sum()), 32, np.uint8)
        to = np.cumsum(size[stays] + 1) - size[stays] - 1
        text[ragged(to, size[stays])] = letters[ragged(begin[stays], size[stays])]
        kept_digests.append(hashlib.sha256(text[:-1].tobytes()).hexdigest())
        run_digests.append(hashlib.sha256("".join("%d,%d,%d\n" % tuple(r) for r in found.tolist()).encode()).hexdigest())
        n_runs.append(len(found))
        longest = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[:1]].tolist()
        best.append([*longest[0], 1000 * longest[0][1] // longest[0][2]] if longest else [None] * 4)
    columns = [
        batch.column(0), pa.array(n_runs, pa.int64()), *[pa.array([b[k] for b in best], pa.int64()) for k in range(4)],
        pa.array(run_digests, pa.string()), pa.array(kept_digests, pa.string()), pa.array(n_dropped, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])


RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
    "collapsed_sha256 string, n_dropped bigint"
)


def judge(docs: DataFrame, plant: bool = False) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> the runs of every text as figures and digests, one row per row.

    ``plant`` first makes the end of every tenth text or so periodic, by the checksum of its id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, 1, SLICE_BYTES):
            yield _judged(batch, plant)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, RESULT)


def list_runs(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row (doc_id, start, length, period) per run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, 1, SLICE_BYTES):
            number, of, *_ = _split(batch.column(1))
            for k, found in enumerate(find_runs(np.split(number, of[1:-1]))):
                if len(found):
                    ids = pa.array([batch.column(0)[k].as_py()] * len(found), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, found.T.copy())], names=["doc_id", "start", "length", "period"])

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, length bigint, period bigint")
