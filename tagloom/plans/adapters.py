"""The given ``events`` table seen as historian inputs."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schema import SOURCE_ARCHIVE
from tagloom.session import ensure_utc, materialize

EVENT_TABLE = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return with_k(spark.read.schema(EVENT_TABLE).parquet(f"{sf_dir}/events.parquet"))


def with_k(raw: DataFrame) -> DataFrame:
    """The number inside ``props``, and time as an instant."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    return raw.withColumn("k", k).withColumn("ts", F.col("ts").cast("timestamp"))


def readings_of(ev: DataFrame) -> DataFrame:
    """Raw readings: tag from the event type, state codes and failures from ``k``."""
    n = (F.col("user_id") % 3 + 1).cast("string")
    k = F.col("k")
    code = -((F.floor(k / 10) + 1) * 65536 + k % 7)
    return ev.select(
        F.concat(F.lit("Hist-Srv-0"), n).alias("server"),
        F.concat(F.lit("site"), n).alias("site"),
        F.upper("event_type").alias("tag"),
        "ts",
        F.col("value").alias("rval"),
        F.when(k % 10 == 0, code).otherwise(0).cast("bigint").alias("istat"),
        F.when(k % 17 == 1, k).otherwise(0).cast("bigint").alias("status"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(events(spark, sf_dir))


def tags(readings: DataFrame) -> DataFrame:
    """Distinct (site, server, tag), stored so that it is computed once per query."""
    return materialize(readings.select("site", "server", "tag").distinct())


def tags_and_states(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tag table and state dimension from one pass over the readings."""
    seen = materialize(readings.select("site", "server", "tag", "istat").distinct())
    return seen.select("site", "server", "tag").distinct(), states_of(seen)


def points(tag_table: DataFrame) -> DataFrame:
    """Point ids from a hash, so that no global numbering is needed; one lookup failed."""
    name = F.concat_ws("|", "site", "server", "tag")
    number = F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("bigint") + 1000
    failed = (F.col("site") == "site2") & (F.col("tag") == "SIGNUP")
    return tag_table.select(
        "site", "server", "tag", F.when(failed, F.lit(-1)).otherwise(number).cast("bigint").alias("point_id")
    )


def states_of(readings: DataFrame) -> DataFrame:
    """State rows: some codes are missing, some names are null."""
    code = F.col("istat")
    known = readings.where((code < 0) & (code > -500000)).select("site", "server", "istat").distinct()
    set_id = F.floor(-code / 65536).cast("bigint")
    return known.select(
        "site", F.lower("server").alias("server_key"), code.alias("digital_code"),
        F.when(code % 2 == 0, F.concat(F.lit("STATE_"), (-code).cast("string"))).alias("digital_state_name"),
        set_id.alias("digital_set_id"), (-code - set_id * 65536).alias("digital_state_id"),
        F.lit("cache").alias("state_source"),
    )


def sites(tag_table: DataFrame) -> DataFrame:
    return tag_table.select(
        "site", "server", F.lit(SOURCE_ARCHIVE).alias("source"), F.lit("America/Sao_Paulo").alias("timezone"),
        (F.col("site") != "site3").alias("enabled"),
    ).distinct()


def messages_of(ev: DataFrame) -> DataFrame:
    """Write-back messages, valid and invalid."""
    k = F.col("k")
    local = F.replace(F.col("ts").cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
    site = F.when(k % 19 == 0, F.lit("")).otherwise(
        F.concat(F.lit('"site":"site'), (F.col("user_id") % 4 + 1).cast("string"), F.lit('",'))
    )
    offset = F.when(k % 2 == 0, "Z").when(k % 3 == 0, "-03:00").otherwise("")
    value = F.when(k % 13 == 0, F.lit('"bad"')).otherwise(F.col("value").cast("string"))
    extra = F.when(k % 11 == 0, F.lit(',"istat":-65537')).when(k % 23 == 0, F.lit(',"istat":"x"')).otherwise("")
    data = F.concat(
        F.lit("{"), site, F.lit('"tag":" '), F.col("event_type"), F.lit(' ","timestamp":"'), local, offset,
        F.lit('","value":'), value, extra, F.lit("}"),
    )
    # Some messages are cut off on the way and are no JSON any more.
    data = F.when(k % 29 == 0, F.substring(data, 1, 20)).otherwise(data)
    return ev.select(F.col("event_id").alias("message_id"), F.col("ts").alias("arrival"), data.alias("data"))


def day_range(readings: DataFrame) -> tuple[datetime, datetime]:
    """Whole days that hold every reading: one row of two values from one column."""
    lo, hi = readings.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    day = 86_400_000_000
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (
        epoch + timedelta(microseconds=lo - lo % day),
        epoch + timedelta(microseconds=hi - hi % day + day),
    )
