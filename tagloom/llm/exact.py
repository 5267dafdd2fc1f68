"""Exact copies by a 128-bit hash of the normalised text, with the bytes compared.

Two texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]`` is one blank.
Rows are grouped by a 128-bit hash of that form; then the bytes inside the groups of two rows or
more are compared: a group whose smallest text is its largest one holds one text. A group that
holds several, by a collision, is divided by its texts, so the hash decides nothing in the end.

Only the id and two digests of a row are shuffled, and the texts of hashes that occur twice, which
shrink to two a hash before they move. A hash with more than a thousandth of all rows is dealt out
over salts; at most a thousand are, so their list is broadcast.

Null counts as the empty text, which like any other text has copies. Ids may be null or repeated: of equal texts
the row with the smallest id stays, an id before none; rows of one id and text are copies of each
other, of which the one read first stays. An empty table gives no rows. Further columns are carried
along in ``row`` if asked for, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch_path

#: Fixed value: the white space of the contract.
SPACE = r"[\x20\x09-\x0D]+"
#: A hash with more rows than this, and than a thousandth of all, is spread.
HOT_ROWS, HOT_SHARE = 1_000, 1_000
#: Broadcast at most so many hashes of 16 bytes to find the texts to compare (64 MB).
BROADCAST_HASHES = 4_000_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def _stored(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    paths.append(scratch_path(df.sparkSession, name))
    df.write.parquet(paths[-1])
    return df.sparkSession.read.parquet(paths[-1])


def _hot(groups: DataFrame, limit: int) -> DataFrame:
    """Hashes of more than ``limit`` rows, with the number of salts."""
    return groups.where(F.col("n") > limit).select("h", F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def _settled(rows: DataFrame, groups: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Every row with the first row and the size of its group, if that has more than one.

    ``groups`` is unique by ``keys``; rows of hot hashes meet copies of it, one for each salt.
    """
    salts = F.broadcast(hot)
    salted = rows.join(salts, "h", "left").withColumn("salt", F.coalesce(F.pmod("row_no", "salts"), F.lit(0)).cast("int"))
    dealt = groups.join(salts, "h", "left")
    dealt = dealt.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return salted.drop("salts").join(dealt.drop("salts"), [*keys, "salt"], "left").drop("salt")


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")).alias("first")
    return rows.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")


def _texts_of(texts: DataFrame, groups: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows of ``texts(h, ...)`` whose hash is in ``groups``."""
    wanted = groups.select("h")
    if wanted.count() <= BROADCAST_HASHES:
        return texts.join(F.broadcast(wanted), "h", "left_semi")
    salted = texts.join(F.broadcast(hot), "h", "left")
    salted = salted.withColumn("salt", F.coalesce(F.floor(F.rand(7) * F.col("salts")), F.lit(0)).cast("int"))
    dealt = wanted.join(F.broadcast(hot), "h", "left")
    dealt = dealt.select("h", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    return salted.drop("salts").join(dealt, ["h", "salt"], "left_semi").drop("salt")


def exact_copies(
    docs: DataFrame, keep: list[str] | None = None, hashed: Callable[[Column], Column] = content_hash, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, keep_id, group_size, kept, text_sha256, one row per row.

    ``keep`` names columns to return in ``row``. ``hashed`` may be any hash: a weak one costs time.
    """
    spark: SparkSession = docs.sparkSession
    paths: list[str] = []
    text = normalised(F.col("text"))
    carried = [F.struct(*keep).alias("row")] if keep else []
    described = docs.select("doc_id", hashed(text).alias("h"), F.unhex(F.sha2(text, 256)).alias("sha"), *carried)
    rows = _stored(described.withColumn("row_no", F.monotonically_increasing_id()), "hashed", paths)
    limit = max(hot_rows, rows.count() // HOT_SHARE)
    groups = _stored(_groups(rows, ["h"]), "groups", paths)
    hot = _hot(groups, limit)

    # The bytes of what shares a hash.
    texts = _texts_of(docs.select(hashed(text).alias("h"), text.alias("text")), groups, hot)
    compared = texts.groupBy("h").agg((F.min("text") < F.max("text")).alias("differ"))
    mixed = _stored(compared.where("differ").select("h"), "mixed", paths)
    if mixed.isEmpty():
        settled = _settled(rows, groups, ["h"], hot)
    else:
        own = _stored(rows.join(mixed, "h", "left_anti"), "unmixed", paths)
        parts = docs.select("doc_id", text.alias("text"), *carried)
        parts = parts.withColumn("h", hashed(F.col("text"))).withColumn("sha", F.unhex(F.sha2("text", 256)))
        parts = _texts_of(parts, mixed, hot).withColumn("row_no", F.monotonically_increasing_id())
        parts = _stored(parts, "divided", paths)
        settled = _settled(own, groups.join(mixed, "h", "left_anti"), ["h"], hot).unionByName(
            _settled(parts, _groups(parts, ["h", "text"]), ["h", "text"], hot).drop("text")
        )
    kept = F.coalesce(F.col("row_no") == F.col("first.row_no"), F.lit(True))
    return settled.select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"), kept.alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *(["row"] if keep else []),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text"))
    marked = exact_copies(named.select(doc_id, text, "*"), named.columns)
    return marked.where("kept").select("row.*").toDF(*docs.columns)


ORACLE = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER copies AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER copies = 1 AS kept,
    sha256(norm) AS text_sha256
FROM texts
WINDOW copies AS (PARTITION BY norm ORDER BY doc_id NULLS LAST)
"""
