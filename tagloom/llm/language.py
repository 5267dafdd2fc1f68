"""Language identification of documents that may mix languages.

Training counts byte trigrams of the words of all labelled documents per language, hashed to
32,768 places. A word's likelihood in a language is the product of those of its trigrams. A
document is taken as a mixture: expectation-maximisation over its words estimates the share of
each language. The set of languages is the one whose likelihood, less a penalty for each language
beyond the first, is largest; sets are nested by descending share. Where the full mixture gains
less than one penalty over the best single language, no larger set can win and none is tried.

The language of a document is that with the largest share in the chosen set, the first by name
among equals; the score is that share. Shares sum to one whatever the text is, so that it is of any
of the languages at all shows only in ``fit``, its log-likelihood a letter under the chosen
mixture: ``known`` tells by bands that are measured on labelled documents. A null text or one without a letter is ``und`` with score
0, as is every text when nothing was learned. Only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tokens import plain, slices, text_buffers
from tagloom.llm.words import word_starts

PLACES = 1 << 15
ROUNDS = 8
#: Log-likelihood that each further language must bring, times the logarithm of the words.
PENALTY = 4.0
#: How far below the median of its languages the fit of a text may lie, in deviations; least
#: deviation as a share of the median; letters at which that is widened by the root of two.
FAR, LEAST_DEVIATION, FEW_LETTERS = 12.0, 0.02, 400

#: Letters lower-cased, bytes of longer characters as they are, everything else 0.
LETTER = np.zeros(256, np.uint8)
LETTER[128:] = np.arange(128, 256)
LETTER[97:123] = np.arange(97, 123)
LETTER[65:91] = np.arange(97, 123)


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place per letter, the number of the first letter of each word, and of the first word of
    each text (one more for the end)."""
    ends, data = text_buffers(plain(texts))
    code = LETTER[data]
    inside = code > 0
    starts = word_starts(ends, inside) if len(data) else np.zeros(0, np.int64)
    of = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, np.int64), starts, of
    at = np.flatnonzero(inside)
    begin = np.searchsorted(at, starts)
    letters = code[at].astype(np.uint32)
    before = np.concatenate([[0], letters[:-1]]).astype(np.uint32)
    after = np.concatenate([letters[1:], [0]]).astype(np.uint32)
    before[begin] = 0
    after[np.append(begin[1:], len(at)) - 1] = 0
    mixed = ((before * np.uint32(65599) + letters) * np.uint32(65599) + after) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(17)).astype(np.int64), begin, of


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (PLACES, languages): log-likelihood of a trigram


def train(labelled: DataFrame) -> Model:
    """Learn from all rows of ``labelled(text, lang)``; null labels are left out.

    Tasks send counts of places, at most 32,768 per language each; the driver gets the summed
    table, whose size depends on the number of languages only.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, 0, 1 << 20):
            places, begin, of = _trigrams(batch.column(0))
            letter_of = np.append(begin, len(places))[of]
            languages = batch.column(1).dictionary_encode()
            which = languages.indices.to_numpy()
            key = np.repeat(which.astype(np.int64), np.diff(letter_of)) * PLACES + places
            found = np.bincount(key, minlength=len(languages.dictionary) * PLACES).reshape(-1, PLACES)
            for name, row in zip(languages.dictionary.to_pylist(), found, strict=True):
                total[name] = total.get(name, 0) + row
        for name, row in total.items():
            at = np.flatnonzero(row)
            columns = [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "place", "n"])

    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(count, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique().tolist())
    table = np.zeros((PLACES, len(languages)))
    table[found["place"].to_numpy(int), found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int)] = found["n"]
    table = (table + 0.1) / (table + 0.1).sum(axis=0) if languages else table
    return Model(languages, np.log(table).astype(np.float32))


def _mixture(like: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihoods of documents; ``like`` has the words' likelihoods, scaled."""
    words = np.diff(starts)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * np.repeat(share, words, axis=0)
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(part, starts[:-1], axis=0) / words[:, None]
    total = np.log(np.maximum((like * np.repeat(share, words, axis=0)).sum(axis=1), 1e-30))
    return share, np.add.reduceat(total, starts[:-1])


def shares(texts: pa.Array, model: Model) -> np.ndarray:
    """(texts, languages): shares in the chosen set; all zero where there is nothing to go by."""
    return mixtures(texts, model)[0]


def mixtures(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shares, the log-likelihood a letter under them, and the number of letters (as bytes)."""
    places, begin, of = _trigrams(texts)
    letters = np.diff(np.append(begin, len(places))[of])
    out, fit = np.zeros((len(texts), len(model.languages)), np.float32), np.zeros(len(texts))
    docs = np.flatnonzero(np.diff(of))
    if not len(docs) or not model.languages:
        return out, fit, letters
    starts = np.append(of[docs], of[-1])
    words = np.diff(starts)
    logs = np.add.reduceat(model.scores[places], begin, axis=0)
    best = logs.max(axis=1, keepdims=True)
    single = np.add.reduceat(logs, starts[:-1], axis=0)
    base = np.add.reduceat(best[:, 0], starts[:-1])
    like = np.exp(np.maximum(logs - best, -60))
    penalty = PENALTY * np.log(words + 1.0)
    share, full = _mixture(like, starts, np.ones((len(docs), len(model.languages)), np.float32))
    chosen = np.zeros_like(share)
    chosen[np.arange(len(docs)), single.argmax(axis=1)] = 1
    value = single.max(axis=1) - base  # relative to the best language of each word
    order = np.argsort(-share, axis=1, kind="stable")
    mixed = np.flatnonzero(full - value > penalty)
    size = 2
    while len(mixed) and size <= len(model.languages):
        # All documents for which a larger set may still win try their first ``size`` languages.
        take = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in mixed])
        allowed = np.zeros((len(mixed), len(model.languages)), np.float32)
        np.put_along_axis(allowed, order[mixed, :size], 1, axis=1)
        own, total = _mixture(like[take], np.append(0, np.cumsum(words[mixed])), allowed)
        gained = total - penalty[mixed] * (size - 1)
        better = gained > value[mixed]
        chosen[mixed[better]] = own[better]
        value[mixed[better]] = gained[better]
        mixed = mixed[full[mixed] - penalty[mixed] * size > value[mixed]]
        size += 1
    out[docs] = chosen
    # Words that no chosen language knows count with what is left of them in the scaled likelihoods.
    word = np.log(np.maximum((like * np.repeat(chosen, words, axis=0)).sum(axis=1), 1e-30)) + best[:, 0]
    fit[docs] = np.add.reduceat(word.astype(np.float64), starts[:-1]) / letters[docs]
    return out, fit, letters


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, and lang_pred, score, languages (those of the chosen set with their shares), fit
    and letters; columns with one of these names give way."""
    docs = docs.drop("lang_pred", "score", "languages", "fit", "letters")
    place = docs.columns.index(text)
    names = [*docs.columns, "lang_pred", "score", "languages", "fit", "letters"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, 1 << 20):
            texts = batch.column(place)
            found, fit, size = mixtures(texts, model)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if not model.languages:
                letters[:] = False
                found = np.zeros((len(texts), 1), np.float32)
            top, score = found.argmax(axis=1), np.clip(found.max(axis=1), 0, 1).astype(np.float64)
            score[~letters] = 0.0
            langs = [model.languages[t] if known else "und" for t, known in zip(top, letters)]
            sets = [
                [(model.languages[k], float(v)) for k, v in enumerate(row) if v > 0] if known else []
                for row, known in zip(found.tolist(), letters)
            ]
            extra = [pa.array(langs, pa.string()), pa.array(score), pa.array(sets, pa.map_(pa.string(), pa.float64()))]
            extra += [pa.array(fit), pa.array(size.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kept}, lang_pred string, score double, languages map<string, double>, fit double, letters bigint")


def bands(predicted: DataFrame, label: str = "lang") -> dict[str, tuple[float, float]]:
    """Language -> median and deviation, as estimated from the lower quartile, of ``fit`` over all
    documents labelled and taken as it. The languages of the model, at most."""
    own = predicted.where(F.col(f"`{label}`") == F.col("lang_pred")).groupBy("lang_pred")
    rows = own.agg(F.percentile_approx("fit", F.array(F.lit(0.5), F.lit(0.25)), 10_000).alias("q")).collect()
    return {r["lang_pred"]: (r["q"][0], max((r["q"][0] - r["q"][1]) / 0.6745, -LEAST_DEVIATION * r["q"][0])) for r in rows}


def known(measured: dict[str, tuple[float, float]]) -> Column:
    """Whether a predicted text is of its languages: ``fit`` lies no more than ``FAR`` deviations,
    more for few letters, below the medians of its languages by their shares. A language without a
    band has none to lie below."""
    if not measured:
        return F.lit(True)
    of = F.create_map(*[F.lit(x) for name, band in measured.items() for x in (name, F.array(*map(F.lit, band)))])
    shares = F.map_entries("languages")
    all_known = F.forall(shares, lambda e: F.array_contains(F.map_keys(of), e["key"]))

    def mixed(k: int) -> Column:
        return F.aggregate(shares, F.lit(0.0), lambda a, e: a + e["value"] * F.try_element_at(of, e["key"])[k])

    wider = F.sqrt(1 + FEW_LETTERS / F.greatest(F.col("letters"), F.lit(1)))
    return ~all_known | (F.col("fit") >= mixed(0) - FAR * mixed(1) * wider)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: a quarter, by the checksum of the id. False without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """The model of all labelled documents that have an id and are not held out."""
    return train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
