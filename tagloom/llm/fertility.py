"""Quality rules on how well a public vocabulary fits a text.

Prose of a language that a vocabulary knows takes few tokens per character, rarely falls back to
single bytes, and uses its tokens neither over and over nor all alike. Each document is encoded
by the pieces of a public SentencePiece vocabulary (word by word, punctuation after a letter
apart), and three figures are held against bands: characters per token, share of byte tokens, and
entropy of its tokens over the largest for their number (a thousand at most, since long texts
repeat common words). Wide bands depend on the main script. Narrower ones are measured, within a
language (or script, where no language is given) among documents of about the same number of
tokens, a power of two: characters per token and entropy may lie below the median by some multiples of
the distance between median and lower quartile, byte tokens above it, and the first two together
by less than both at once; cells of few documents are judged more mildly. Characters per token are
held against the whole language too, which catches what lies alone in its cell. The bands come from all documents
that do not fail the plain counts, labels play no part; they hold while junk is less than about
a quarter of a cell.

A document is first judged by plain counts: it fails with fewer than 50 words, or with more than
half of its words in three-word windows that occur again. A null text has no words, so it fails.
Other columns are not looked at; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import ChunkCache, kept, plain, slices, text_buffers
from tagloom.llm.words import BLANK, STEP, mix, word_hashes
from tagloom.session import materialize

SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])

#: Least words, and most words per hundred in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: script -> (least and most characters per token, most byte tokens of all, least entropy ratio).
BANDS = {
    "latin": (1.4, 8.0, 0.10, 0.45),
    "greek": (0.8, 5.0, 0.30, 0.40),
    "cyrillic": (1.2, 7.0, 0.20, 0.40),
    "hebrew": (0.6, 5.0, 0.50, 0.35),
    "arabic": (0.6, 5.0, 0.50, 0.35),
    "indic": (0.25, 4.0, 0.95, 0.25),
    "cjk": (0.3, 3.0, 0.90, 0.25),
    "hangul": (0.3, 3.0, 0.95, 0.25),
    "other": (0.2, 8.0, 1.00, 0.20),
}
SCRIPTS = list(BANDS)


def _script_of_byte() -> np.ndarray:
    """Script by the first byte of a letter; -1 for bytes that say nothing."""
    table = np.full(256, -1)
    for name, ranges in {
        "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)], "greek": [(0xCD, 0xCF)], "cyrillic": [(0xD0, 0xD3)],
        "hebrew": [(0xD6, 0xD7)], "arabic": [(0xD8, 0xDB)], "indic": [(0xE0, 0xE0)], "cjk": [(0xE3, 0xE9)],
        "hangul": [(0xEA, 0xED)], "other": [(0xD4, 0xD5), (0xDC, 0xDF), (0xE1, 0xE1), (0xF0, 0xF4)],
    }.items():
        for first, last in ranges:
            table[first : last + 1] = SCRIPTS.index(name)
    return table


SCRIPT_OF_BYTE = _script_of_byte()


def piece_cache(path: str) -> tuple[ChunkCache, np.ndarray]:
    """A cache over a SentencePiece model, and which of its ids are single bytes."""

    def make() -> tuple[ChunkCache, np.ndarray]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        space = model.piece_to_id("▁")

        def pieces(chunk: str, found: list[int]) -> bytes:
            # The model puts a blank before every text; a chunk without one doesn't count it.
            if found and found[0] == space:
                found = found[1:]
            return np.asarray(found, dtype="<u4").tobytes()

        def encode(chunk: str) -> bytes:
            return pieces(chunk, model.encode(chunk.strip(" \t\n\r")))

        def encode_many(chunks: list[str]) -> list[bytes]:
            found = model.encode([c.strip(" \t\n\r") for c in chunks], num_threads=1)
            return [pieces(c, f) for c, f in zip(chunks, found, strict=True)]

        single = np.fromiter((model.is_byte(i) for i in range(model.get_piece_size())), bool)
        return ChunkCache(encode, encode_many), single

    return kept(("pieces", path), make)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends])


def _repeated(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a three-word window found twice or more in it."""
    out = np.zeros(len(of) - 1, np.int64)
    if len(words) < 3:
        return out
    windows = mix(mix(mix(words[:-2]) * STEP + words[1:-1]) * STEP + words[2:])
    for d, (a, b) in enumerate(zip(of[:-1].tolist(), of[1:].tolist(), strict=True)):
        if b - a < 4:
            continue
        own = windows[a : b - 2]
        order = np.sort(own)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            hit = twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own
            covered = np.zeros(b - a, bool)
            for k in range(3):
                covered[k : k + len(own)] |= hit
            out[d] = covered.sum()
    return out


def _repeated_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    n = 0
    for line in lines:
        if line in seen:
            n += bool(line.strip(" \t\n\x0b\x0c\r"))
        seen.add(line)
    return n


def _entropy(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Entropy of each text's tokens, over the largest that so many, or a thousand, can have."""
    out = np.zeros(len(starts) - 1)
    small = ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids
    for d, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        n = b - a
        if n < 2:
            out[d] = 1.0
            continue
        order = np.sort(small[a:b], kind="stable")
        cuts = np.flatnonzero(order[1:] != order[:-1]) + 1
        counts = np.diff(np.concatenate([[0], cuts, [n]]))
        entropy = np.log(n) - float((counts * np.log(counts)).sum()) / n
        out[d] = entropy / np.log(min(n, 1000))
    return out


FIGURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, script string, "
    "n_tokens bigint, chars_per_token double, byte_share double, entropy double"
)


def figures(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns, if not given) and the figures of every whole text. A column with the
    name of a figure gives way to it."""
    made = [c.split()[0] for c in FIGURES.split(", ")]
    others = [c for c in (docs.columns if keep is None else keep) if c not in made]
    names = [*others, *made]
    # A kept text is sent once.
    sent = others if text in others else [*others, text]
    place = sent.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, single = piece_cache(vocabulary)
        for batch in slices(batches, place, 1 << 20):
            texts = batch.column(place)
            ends, data = text_buffers(plain(texts))
            words, of = word_hashes(texts, fold=False)
            chars = _sums(((data & 0xC0) != 0x80) & ~BLANK[data], ends)
            kinds = SCRIPT_OF_BYTE[data]
            doc = np.repeat(np.arange(len(texts)), np.diff(ends))[kinds >= 0]
            table = np.bincount(doc * len(SCRIPTS) + kinds[kinds >= 0], minlength=len(texts) * len(SCRIPTS))
            table = table.reshape(len(texts), -1)
            script = np.where(table.sum(axis=1) > 0, table.argmax(axis=1), SCRIPTS.index("other"))
            starts, ids = cache.texts(texts)
            tokens = np.diff(starts)
            some = np.maximum(tokens, 1)
            columns = [
                np.diff(of), chars, _sums(SYMBOLS[data], ends),
                np.array([_repeated_lines(t) for t in texts.to_pylist()], np.int64), _repeated(words, of),
            ]
            found = [
                *[pa.array(c.astype(np.int64)) for c in columns], pa.array([SCRIPTS[k] for k in script]),
                pa.array(tokens), pa.array(chars / some), pa.array(_sums(single[ids], starts) / some),
                pa.array(_entropy(ids, starts)),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *found], names=names)

    head = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in others)
    return docs.select(*[F.col(f"`{c}`") for c in sent]).mapInArrow(run, head + FIGURES)


#: How many standard deviations below the median of its cell a figure may lie, as estimated from the
#: lower quartile (byte tokens: above, from the upper one); documents of a cell at which that is
#: widened by the root of two; least deviation, as a share of the median (of byte tokens: of all).
BELOW, FEW_DOCS, LEAST_DEVIATION = 3.5, 40, 0.01
#: The same for the band of a whole language, and tokens of a document at which it is widened.
FEW_DOCS_OF_ALL, FEW_TOKENS = 400, 2000
#: Quartiles are taken of figures cut to this step, and to this at most.
STEP_OF_FIGURE, MOST_FIGURE = 1e-4, 16.0
#: Stands for all cells of a language.
ALL = -1


#: Cells that are broadcast, about two hundred bytes each.
MOST_BROADCAST = 100_000


def judge(
    measured: DataFrame, language: str | None = None, bands: dict[str, tuple[float, float, float, float]] = BANDS
) -> DataFrame:
    """Adds base_failed and kept to the figures. ``measured`` is read twice, once for the quartiles
    of all its documents that do not fail the plain counts; there is a row of those per cell."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fits = F.lit(False)
    for script, (least, most, byte_share, entropy) in bands.items():
        fits = fits | (
            (F.col("script") == script) & F.col("chars_per_token").between(least, most)
            & (F.col("byte_share") <= byte_share) & (F.col("entropy") >= entropy)
        )
    group = F.coalesce(F.col(f"`{language}`"), F.col("script")) if language else F.col("script")
    cell = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")
    judged = measured.withColumns({"base_failed": failed, "_group": group, "_cell": cell})

    def quartiles(c: str) -> Column:
        """Exact ones of figures cut to steps: a bounded number of values, whatever order tasks end in."""
        steps = F.floor(F.least(F.col(c), F.lit(MOST_FIGURE)) / STEP_OF_FIGURE) * STEP_OF_FIGURE
        return F.percentile(steps, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q_{c}")

    counted = judged.where("NOT base_failed").withColumn("_cell", F.explode(F.array("_cell", F.lit(ALL))))
    usual = counted.groupBy("_group", "_cell").agg(
        *[quartiles(c) for c in ("chars_per_token", "entropy", "byte_share")], F.count(F.lit(1)).alias("n"))
    wider = F.sqrt(1 + FEW_DOCS / F.col("n"))

    def below(c: str, wider: Column = wider, of: str = "") -> Column:
        """Deviations below the median of the cell, or of the language."""
        q = F.col(f"q_{of}{c}")
        return (q[1] - F.col(c)) / (F.greatest((q[1] - q[0]) / 0.6745, LEAST_DEVIATION * q[1]) * wider)

    shares = F.col("q_byte_share")
    most = shares[1] + BELOW * wider * F.greatest((shares[2] - shares[1]) / 0.6745, F.lit(LEAST_DEVIATION))
    # The two figures vary apart from each other, so their sum has a band of its own.
    near = (
        (below("chars_per_token") <= BELOW) & (below("entropy") <= BELOW) & (F.col("byte_share") <= most)
        & (below("chars_per_token") + below("entropy") <= BELOW * 2**0.5)
    )
    wider_of_all = F.sqrt(1 + FEW_TOKENS / F.greatest(F.col("n_tokens"), F.lit(1)) + FEW_DOCS_OF_ALL / F.col("n_all"))
    near_all = below("chars_per_token", wider_of_all, "all_") <= BELOW
    kept = ~F.col("base_failed") & fits & F.coalesce(near, F.lit(True)) & F.coalesce(near_all, F.lit(True))
    # Some thirty rows per language at most; if there were very many, Spark decides how to join them.
    usual = materialize(usual)
    small = usual.count() <= MOST_BROADCAST
    of_all = usual.where(F.col("_cell") == ALL).select(
        "_group", F.col("q_chars_per_token").alias("q_all_chars_per_token"), F.col("n").alias("n_all"))
    of_all, usual = (F.broadcast(t) if small else t for t in (of_all, usual))
    judged = judged.join(usual, ["_group", "_cell"], "left").join(of_all, "_group", "left").withColumn("kept", kept)
    return judged.drop("_group", "_cell", "q_chars_per_token", "q_entropy", "q_byte_share", "n", "q_all_chars_per_token", "n_all")
