"""Byte-level BPE encoding and decoding by longest matches with backtracking.

The bytes of each match of the split pattern are read as Latin-1, so that an Aho-Corasick
automaton over the vocabulary finds every token at every place in one pass. From the left,
the longest token is taken whose pair with its neighbour is one that the merges would leave
standing; where none fits, the last token is given up for its next shorter one. A place that
was given up is never entered again, so the work is linear in the text. Whether two tokens
may stand side by side depends on these two alone and is remembered.

A null text encodes to no ids; so does an empty one. Rows, copies and further columns pass
unchanged.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.tokens import ChunkCache, binary_column, kept, slices

#: Pairs of tokens that a worker remembers.
PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """A rank file: which two tokens each token is merged from, and what may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick

        self.ranks = read_ranks(path)
        self.size = max(self.ranks.values()) + 1
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.lengths = {rank: len(token) for token, rank in self.ranks.items()}
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                halves = self._by_merging(token, rank)
                if len(halves) == 2:
                    self.parts[rank] = halves[0], halves[1]
                    self.merged[halves[0], halves[1]] = rank

    def _by_merging(self, token: bytes, below: int) -> list[int]:
        """The plain merge loop with tokens of a rank under ``below``."""
        pieces = [token[i : i + 1] for i in range(len(token))]
        while len(pieces) > 1:
            best, at = below, -1
            for i in range(len(pieces) - 1):
                rank = self.ranks.get(pieces[i] + pieces[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        return [self.ranks[p] for p in pieces]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` standing side by side.

        They do unless some merge across the border comes first. Undoing merges from the latest
        back shows every pair of tokens that ever met at the border, each together with the
        rank from which on it no longer did.
        """
        pair = left * self.size + right
        known = self.pairs.get(pair)
        if known is not None:
            return known
        a, b, gone = left, right, self.size
        while True:
            if self.merged.get((a, b), self.size) < gone:
                result = False
                break
            # Of the two neighbours the one made last is taken apart; of equal ones the right
            # one, because merges of the same rank go from left to right.
            if (a > b and a in self.parts) or b not in self.parts:
                if a not in self.parts:
                    result = True
                    break
                gone, a = a, self.parts[a][1]
            else:
                gone, b = b + 1, self.parts[b][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = result
        return result

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (length, rank) in self.automaton.iter(piece.decode("latin-1")):
            starts[end - length + 1].append((length, rank))  # from short to long
        fits, open_at = self.fits, bytearray(b"\x01") * (n + 1)
        ids: list[int] = []
        taken: list[int] = []  # for each id, which of the matches at its place it is
        at, which = 0, len(starts[0]) - 1
        while at < n:
            here = starts[at]
            while which >= 0:
                length, rank = here[which]
                if open_at[at + length] and (not ids or fits(ids[-1], rank)):
                    break
                which -= 1
            if which >= 0:
                ids.append(rank)
                taken.append(which)
                at += length
                if at < n:
                    which = len(starts[at]) - 1
            else:
                open_at[at] = 0
                which = taken.pop()
                at -= self.lengths[ids.pop()]
                which -= 1
        return ids


def encoder(path: str, pattern: str) -> ChunkCache:
    def make() -> ChunkCache:
        import regex

        merges, split = Merges(path), regex.compile(pattern)
        pieces = ChunkCache(lambda p: np.asarray(merges.encode(p.encode()), dtype="<u4").tobytes())
        return ChunkCache(lambda text: b"".join([pieces.one(p) for p in split.findall(text)]))

    return kept(("bpe", path, pattern), make)


Batches = Iterator[pa.RecordBatch]


def _encoding(path: str, pattern: str, others: list[str], ids: str) -> Callable[[Batches], Batches]:
    def encode(batches: Batches) -> Batches:
        cache = encoder(path, pattern)
        for batch in slices(batches):
            starts, found = cache.texts(batch.column(len(others)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], binary_column(starts, found)], names=[*others, ids])

    return encode


def _decoding(path: str, place: int, decoded: str) -> Callable[[Batches], Batches]:
    def decode(batches: Batches) -> Batches:
        def make() -> list[bytes]:
            table: list[bytes | None] = [None] * (max((ranks := read_ranks(path)).values()) + 1)
            for token, rank in ranks.items():
                table[rank] = token
            return table

        table = kept(("bytes", path), make, alone=False)
        for batch in slices(batches, place):
            out = [
                b"".join([table[i] for i in np.frombuffer(v, dtype="<u4").tolist()]) if v else b""
                for v in batch.column(place).to_pylist()
            ]
            names = [*batch.schema.names, decoded]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=names)

    return decode


def _texts(docs: DataFrame, text: str, ids: str, keep: list[str] | None) -> tuple[DataFrame, list[str], T.StructType]:
    others = [c for c in docs.columns if c not in (text, ids)] if keep is None else keep
    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField(ids, T.BinaryType())])
    return docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`")), others, schema


def encode_documents(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns but the text, if not given) and ``ids``: the ids as little-endian
    unsigned 32-bit integers in one binary value."""
    rows, others, schema = _texts(docs, text, ids, keep)
    return rows.mapInArrow(_encoding(path, pattern, others, ids), schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and ``decoded``: the bytes of the ids. An id outside the vocabulary raises."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())])
    return encoded.mapInArrow(_decoding(path, encoded.columns.index(ids), decoded), schema)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
    keep: list[str] | None = None,
) -> DataFrame:
    """:func:`decode_documents` of :func:`encode_documents` in one worker per task. As two steps they take two
    workers a task, every one of which comes to hold an encoder, since workers change between the steps."""
    rows, others, schema = _texts(docs, text, ids, keep)
    encode, decode = _encoding(path, pattern, others, ids), _decoding(path, len(others), decoded)
    schema = T.StructType([*schema.fields, T.StructField(decoded, T.BinaryType())])
    return rows.mapInArrow(lambda batches: decode(encode(batches)), schema)
