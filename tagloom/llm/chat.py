"""Chat formatting by columnar byte assembly.

Turns arrive sorted; an Arrow batch of them becomes one buffer: the lengths of all pieces (header,
escaped text, trailer) give the cumulative offsets, these the places every byte of every column
goes to, and numpy scatters whole columns at once into one preallocated buffer that Arrow takes
over. No string is built per turn.

Template: a user turn is ``[INST] text [/INST]``, an assistant turn `` text </s>``, one of any
other role ``[ROLE name] text [/ROLE]``, the name percent-encoded, and ``[ROLE]`` for a null
role. Control strings inside texts are escaped by a backslash after their first character, and
those that have backslashes there get one more, so that nothing in a text can be taken for a mark
and every text comes back as it was. Only the texts of assistant turns are under the loss mask.

The output has a row per turn and, where a conversation goes on, its rows follow each other by
``position``; a conversation of any length is read in one pass that holds one batch. A null text is
empty, a null role reads back as empty; turns are ordered by turn (nulls first), equal ones by role and text. An
empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import plain, ragged, slices, text_buffers

CONTROL = r"(?:/?INST\]|/?s>|/?ROLE[ \]]|<?/?SYS>)"

#: In a text: first character of a control string, backslashes, the rest.
TO_ESCAPE = rf"([\[<])(\\*)({CONTROL})"
ESCAPED = re.compile(rf"([\[<])\\(\\*)({CONTROL})")

FORMATTED = "conv_id bigint, position bigint, formatted string, loss_start int, loss_length int"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, TO_ESCAPE, r"\1\\\2\3")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def marks(role: str | None) -> tuple[bytes, bytes]:
    """What stands before and after the text of a turn."""
    if role == "user":
        return b"[INST] ", b" [/INST]"
    if role == "assistant":
        return b" ", b" </s>"
    return (f"[ROLE {quote(role, safe='')}] " if role else "[ROLE] ").encode(), b" [/ROLE]"


def assemble(columns: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: int) -> pa.Array:
    """A string array whose row i is the i-th piece of each column, one after another.

    A column is its bytes, and the start and length of each row's piece in them.
    """
    lengths = np.stack([length for *_, length in columns])
    ends = np.cumsum(lengths.sum(axis=0))
    begin = np.concatenate([[0], ends])
    buffer = np.empty(int(begin[-1]), np.uint8)
    at = begin[:-1].copy()
    for (data, start, length) in columns:
        buffer[ragged(at, length)] = data[ragged(start, length)]
        at += length
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(buffer)])


def _pieces(of: np.ndarray, values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A column of repeated values: piece i is ``values[of[i]]``."""
    length = np.array([len(v) for v in values], np.int64)
    start = np.cumsum(length) - length
    return np.frombuffer(b"".join(values), np.uint8), start[of], length[of]


def _chars(texts: pa.Array) -> np.ndarray:
    return pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one formatted piece per turn, with the place of what
    is under the loss mask in it, in characters (length -1 where nothing is)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, position = None, -1
        for batch in slices(batches, 2, 1 << 20):
            ids = batch.column(0)
            roles = batch.column(1).dictionary_encode()
            of = pc.fill_null(roles.indices, len(roles.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            before, after = zip(*[marks(r) for r in [*roles.dictionary.to_pylist(), None]], strict=True)
            texts = plain(escape(plain(batch.column(2))))
            ends, data = text_buffers(texts)
            columns = [_pieces(of, list(before)), (data, ends[:-1], np.diff(ends)), _pieces(of, list(after))]
            made = assemble(columns, len(texts))
            names = ids.to_pylist()
            places = np.empty(len(names), np.int64)
            for i, name in enumerate(names):
                position = position + 1 if position >= 0 and name == last else 0
                places[i], last = position, name
            learned = np.array([r == "assistant" for r in [*roles.dictionary.to_pylist(), None]])[of]
            start = np.array([len(b.decode()) for b in before])[of].astype(np.int32)
            length = np.where(learned, _chars(texts), -1).astype(np.int32)
            out = [ids, pa.array(places), made.cast(pa.string()), pa.array(start), pa.array(length)]
            yield pa.RecordBatch.from_arrays(out, names=["conv_id", "position", "formatted", "loss_start", "loss_length"])

    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, FORMATTED)


TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE ?([^\]]*)\] (.*?) \[/ROLE\]| (.*?) </s>", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation or a piece of one."""
    out = []
    for found in TURN.finditer(formatted):
        user, name, other, assistant = found.groups()
        if user is not None:
            out.append(("user", unescape(user)))
        elif assistant is not None:
            out.append(("assistant", unescape(assistant)))
        else:
            out.append((unquote(name), unescape(other)))
    return out


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: what was said, and what is under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DIGESTS.split(", ")])

        for batch in slices(batches, 2, 1 << 20):
            rows = []
            ids, texts, starts, lengths = (batch.column(k).to_pylist() for k in (0, 2, 3, 4))
            for name, text, start, length in zip(ids, texts, starts, lengths, strict=True):
                if state is None or state[0] != name:
                    if state is not None:
                        rows.append(done(state))
                    state = [name, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                if length >= 0:
                    learned = unescape(text[start : start + length])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if rows:
                yield emit(rows)
        if state is not None:
            yield emit([done(state)])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, DIGESTS)
