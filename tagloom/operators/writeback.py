"""Write-back requests: validation, resolution, and the archive they are put into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import normalise_tag, parse_timestamp, partition_date, python_strip
from tagloom.operators.day_summary import day_summary
from tagloom.operators.enrich import enrich
from tagloom.operators.latest import latest_per_key
from tagloom.operators.resolve import valid_points
from tagloom.session import drop_scratch, scratch_path
from tagloom.sinks.current import INSERT, KEEP, UPDATE, merge_into, read_current

_PAYLOAD = "site string, tag string, timestamp string, value string, istat string, wait string"

# Fixed pattern: the texts Python's float() reads, once digit-group underscores are gone.
_FLOAT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"

BAD_JSON = "BAD_JSON"
MISSING_FIELD = "MISSING_FIELD"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
BAD_VALUE = "BAD_VALUE"
EMPTY_NAME = "EMPTY_NAME"
BAD_ISTAT = "BAD_ISTAT"
BAD_WAIT = "BAD_WAIT"
UNKNOWN_SITE = "UNKNOWN_SITE"
UNKNOWN_POINT = "UNKNOWN_POINT"

ARCHIVE_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("rval", T.DoubleType()),
    T.StructField("istat", T.LongType()),
    T.StructField("status", T.LongType()),
    T.StructField("arrival", T.TimestampType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
])


def _float_of(text: Column) -> Column:
    bare = F.regexp_replace(python_strip(text), r"(?<=\d)_(?=\d)", "")
    return F.when(bare.rlike(_FLOAT), bare.try_cast("double"))


def parse_requests(messages: DataFrame) -> DataFrame:
    """``messages`` (message_id, arrival, data as text or bytes) to request columns plus
    ``reason``, null where the request is valid. No row is dropped."""
    parsed = messages.withColumn("payload", F.from_json(F.col("data").cast("string"), _PAYLOAD))
    p = F.col("payload")
    no_fields = p.isNull() | F.coalesce(p["site"], p["tag"], p["timestamp"], p["value"], p["istat"], p["wait"]).isNull()
    cut = parsed.select(
        *messages.columns,
        no_fields.alias("bad_json"),
        (p["site"].isNull() | p["tag"].isNull() | p["timestamp"].isNull() | p["value"].isNull()).alias("missing"),
        python_strip(p["site"]).alias("site"),
        normalise_tag(p["tag"]).alias("tag"),
        parse_timestamp(p["timestamp"], "UTC").alias("ts"),
        _float_of(p["value"]).alias("value"),
        F.when(p["istat"].isNull(), F.lit(0)).otherwise(p["istat"].try_cast("bigint")).alias("istat"),
        F.when(p["wait"].isNull(), F.lit(True)).otherwise(p["wait"].try_cast("boolean")).alias("wait"),
    )
    reason = (
        F.when(F.col("bad_json"), BAD_JSON)
        .when(F.col("missing"), MISSING_FIELD)
        .when(F.col("ts").isNull(), BAD_TIMESTAMP)
        .when(F.col("value").isNull(), BAD_VALUE)
        .when((F.col("site") == "") | (F.col("tag") == ""), EMPTY_NAME)
        .when(F.col("istat").isNull(), BAD_ISTAT)
        .when(F.col("wait").isNull(), BAD_WAIT)
    )
    return cut.withColumn("reason", reason).drop("bad_json", "missing")


def resolve_requests(parsed: DataFrame, sites: DataFrame, points: DataFrame, **join_options) -> DataFrame:
    """Attach server and point id; a valid request for an unknown site or point gets a reason."""
    at_site = enrich(parsed, sites.select("site", "server"), ["site"], ["message_id"], **join_options)
    dim = valid_points(points).select("site", "server", "tag", "point_id")
    known = enrich(at_site, dim, ["site", "server", "tag"], ["message_id"], **join_options)
    return known.withColumn(
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("server").isNull(), UNKNOWN_SITE)
        .when(F.col("point_id").isNull(), UNKNOWN_POINT),
    )


def accepted(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("reason").isNull())


def rejected(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("reason").isNotNull())


def archive_rows(requests: DataFrame) -> DataFrame:
    """Accepted requests as raw readings, the last to arrive for each (site, tag, ts)."""
    rows = accepted(requests).select(
        "site", "server", "tag", "ts", F.col("value").alias("rval"), "istat",
        F.lit(0).cast("bigint").alias("status"), F.col("arrival").cast("timestamp").alias("arrival"),
        F.col("message_id").cast("string").alias("message_id"),
    )
    return latest_per_key(rows, ["site", "tag", "ts"], ["arrival", "message_id"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return read_current(spark, path, ARCHIVE_SCHEMA)


def _merged_archive(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored and fresh rows by key; the later arrival wins, the stored one among equals."""
    names = ARCHIVE_SCHEMA.fieldNames()
    t = stored.select(F.struct(*names).alias("t"))
    s = fresh.select(F.struct(*names).alias("s"))
    same = F.lit(True)
    for c in ("event_date", "site", "tag", "ts"):
        same = same & (F.col("t")[c] == F.col("s")[c])
    later = F.struct("s.arrival", "s.message_id") > F.struct("t.arrival", "t.message_id")
    action = F.when(F.col("s").isNull(), KEEP).when(F.col("t").isNull(), INSERT).when(later, UPDATE).otherwise(KEEP)
    both = t.join(s, same, "full_outer").withColumn("action", action)
    row = F.when(F.col("action") == KEEP, F.col("t")).otherwise(F.col("s"))
    return both.select("action", row.alias("row")).select("action", "row.*")


def put_archive(spark: SparkSession, path: str, requests: DataFrame, max_records_per_file: int = 0) -> dict[str, int]:
    """Upsert accepted requests into the raw-reading table; returns rows per action. Repeating a
    put changes nothing, and one that dies leaves the table as it was. Partitions with a changed
    row are rewritten; where rows are only new, they are added. The day summary follows by the same
    switch (see ``operators.day_summary``)."""
    fresh_path = scratch_path(spark, "put")
    archive_rows(requests).withColumn("event_date", partition_date("ts")).write.parquet(fresh_path)
    fresh = spark.read.parquet(fresh_path)
    counts = merge_into(spark, path, ARCHIVE_SCHEMA, fresh, _merged_archive, max_records_per_file, day_summary)
    drop_scratch(spark, fresh_path)
    return counts
