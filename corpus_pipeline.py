"""Documents to packed training sequences: language, quality, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes what a stage
returns to the shared folder as Parquet and reads it again for the next one. All but the last
return the columns of ``documents``, whatever further columns there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import language, neardup, pseudonyms
from tagloom.llm.queries import PSEUDONYM_KEY, fertile, pack_documents
from tagloom.session import drop_scratch, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Least share of a document's main language. Low, so that a document of two halves stays.
MAIN_LANGUAGE = 0.35


def _shielded(docs: DataFrame) -> DataFrame:
    """Further columns under names that no operator makes; ``_restored`` undoes it."""
    return docs.toDF(*[c if c in COLUMNS else f"_further_{i}" for i, c in enumerate(docs.columns)])


def _restored(made: DataFrame, docs: DataFrame) -> DataFrame:
    return made.select(*[F.col(c) for c in _shielded(docs).columns]).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, those without a main language, and those that fit the
    mixture found far worse than the labelled documents of its languages do. Texts are looked at
    twice, so that nothing of their size is stored in between."""
    model = language.learn(docs)
    measured = language.bands(language.predict(docs.select("text", F.col("lang").cast("string").alias("lang")), model))
    found = language.predict(_shielded(docs), model)
    good = (F.col("lang_pred") != "und") & (F.col("score") >= MAIN_LANGUAGE) & language.known(measured)
    return _restored(found.where(good), docs)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the plain counts or the bands of their language."""
    shielded = _shielded(docs)
    return _restored(fertile(shielded, shielded.columns).where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group, once. Without an id a document is in
    no group. Of rows with one id that with the smallest hash of its text stays, then that whose
    columns come first as JSON."""
    shielded = _shielded(docs)
    kept = neardup.near_duplicates(shielded).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count()
    path = scratch_path(spark, "kept")
    kept.write.parquet(path)
    kept = spark.read.parquet(path)
    # Most ids are kept, so their list is no size to broadcast: joined alike whatever the size.
    once = kept.where("count = 1").hint("merge")
    left = shielded.where("doc_id IS NULL").unionByName(shielded.join(once, "doc_id", "left_semi"))
    if not kept.where("count > 1").isEmpty():
        row = F.struct(*[c for c in shielded.columns if c != "doc_id"])
        order = F.struct(F.md5("text"), F.to_json(row))
        chosen = shielded.join(kept.where("count > 1"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, order).alias("row"))
        left = left.unionByName(chosen.select("doc_id", "row.*"))
    return _restored(left, docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in the text; n_chars follows where it changes."""
    changed = pseudonyms.pseudonymise(_shielded(docs), PSEUDONYM_KEY)
    length = F.when(F.size("replaced") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return _restored(changed.withColumn("n_chars", length), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens, mixed by source."""
    return pack_documents(spark, docs)


STAGES = [
    ("language", identify_language),
    ("quality", check_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]

#: SQL has no models, tokenizers, keyed permutations or min-wise hashing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        drop_scratch(spark, *before)  # what the stage before returned has been read
        before = [path]
    return docs
