"""What the token operators share: Arrow helpers, and encoding by remembered chunks.

A *chunk* is a run of ASCII white space with the run of other characters after it, cut once more
where punctuation follows a letter or digit. Where a text holds no other white space, every chunk
border is a border of the tokenizer's own first split (which never joins letters or digits with
the punctuation after them), so the ids of a text are the ids of its chunks, one after another. Chunks are cut on the bytes of
an Arrow buffer, made unique per slice, looked up in a cache, and spread out again by numpy.
Texts with other white space are encoded whole.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A slice of a batch ends at this much text (one row at least) or at so many rows.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 8192

#: White space of any of the regular-expression engines involved, except blank, tab, line feed
#: and carriage return; the zero byte as well.
OTHER_SPACE = (
    "[\\x00\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}"
    "\\x{2028}-\\x{202f}\\x{205f}-\\x{2064}\\x{3000}\\x{feff}]"
)

#: Blank, tab, line feed, carriage return.
CHUNK_SPACE = np.isin(np.arange(256), [32, 9, 10, 13])

#: ASCII letters and digits; ASCII punctuation but the apostrophe, which contractions begin with.
CHUNK_WORD = np.isin(np.arange(256), [ord(c) for c in string.ascii_letters + string.digits])
CHUNK_POINT = np.isin(np.arange(256), [ord(c) for c in string.punctuation if c != "'"])

_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object], alone: bool = True):
    """One object per Python worker. Workers serve one stage after another: what is kept
    ``alone`` takes the place of all that was kept before, so caches don't add up."""
    if key not in _KEPT:
        if alone:
            _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Give up what earlier stages left in this worker."""
    _KEPT.clear()


def plain(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts, 64-bit offsets, no slice offset."""
    return pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the rows and bytes of an array made by ``plain``."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[: len(texts) + 1]
    return ends, np.frombuffer(data, dtype=np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8)


def slices(batches: Iterator[pa.RecordBatch], text: int = -1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of bounded size by the text in column ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at, base = 0, 0
        while at < batch.num_rows:
            end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(size, base + most, side="right"))))
            yield batch.slice(at, end - at)
            at, base = end, int(size[end - 1])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs ``[start, start + length)``, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class ChunkCache(dict):
    """Chunk -> little-endian unsigned 32-bit ids as bytes.

    ``encode`` takes one text, ``encode_many`` (optional) a list of chunks that each begin with
    white space. Two generations of at most ``entries`` chunks each are kept, none of over 64
    characters, so memory is bounded whatever the texts.
    """

    def __init__(self, encode, encode_many=None, entries: int = 150_000):
        super().__init__()
        self.encode, self.encode_many, self.entries, self.older = encode, encode_many, entries, {}

    def put(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= 64:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids

    def one(self, chunk: str) -> bytes:
        ids = self.get(chunk)
        if ids is None:
            ids = self.older.get(chunk)
            if ids is None:
                ids = self.encode(chunk)
            self.put(chunk, ids)
        return ids

    def many(self, chunks: list[str]) -> list[bytes]:
        found = [self.get(c) or self.older.get(c) for c in chunks]
        missing = [i for i, ids in enumerate(found) if ids is None]
        bulk = []
        for i in missing:
            c = chunks[i]
            if self.encode_many and len(c) <= 64 and c[0] in " \n\t\r" and not c[-1].isspace():
                bulk.append(i)
            else:
                found[i] = self.encode(c)
        for at in range(0, len(bulk), 2000):
            part = bulk[at : at + 2000]
            for i, ids in zip(part, self.encode_many([chunks[i] for i in part]), strict=True):
                found[i] = ids
        for i in missing:
            self.put(chunks[i], found[i])
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each text begin (one more entry for the end), and all ids."""
        texts = plain(texts)
        ends, data = text_buffers(texts)
        if not len(data):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint32)
        space = CHUNK_SPACE[data]
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (CHUNK_POINT[data[1:]] & CHUNK_WORD[data[:-1]])
        odd = pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd):
            cut[ends[i] : ends[i + 1]] = False
        cut[ends[:-1][ends[:-1] < len(data)]] = True
        begin = np.flatnonzero(cut)
        offsets = pa.py_buffer(np.append(begin, len(data)).astype(np.int64))
        chunks = pa.LargeStringArray.from_buffers(len(begin), offsets, texts.buffers()[2]).dictionary_encode()
        unique = self.many(chunks.dictionary.to_pylist())
        which = chunks.indices.to_numpy()
        length = np.fromiter(map(len, unique), np.int64, len(unique)) // 4
        start = np.cumsum(length) - length
        lengths = length[which]
        ids = np.frombuffer(b"".join(unique), dtype="<u4")[ragged(start[which], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return before[np.searchsorted(begin, ends)], ids


def tokenizer_cache(path: str, entries: int = 250_000) -> ChunkCache:
    """A cache over a tokenizer file; strings of special tokens in a text are ordinary text."""

    def make() -> ChunkCache:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        def encode(text: str) -> bytes:
            return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

        def encode_many(chunks: list[str]) -> list[bytes]:
            """One call for all: a token belongs to the chunk in which it begins."""
            found = tokenizer.encode("".join(chunks), add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u4")
            begins = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
            to = np.searchsorted(begins, ends)
            return [ids[a:b].tobytes() for a, b in zip(np.append(0, to[:-1]).tolist(), to.tolist(), strict=True)]

        return ChunkCache(encode, encode_many, entries=entries)

    return kept(("tokenizer", path), make)


def binary_column(starts: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Rows of 32-bit ids as binary values, without a copy per row."""
    offsets = pa.py_buffer((np.asarray(starts, dtype=np.int64) * 4).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(ids))])
