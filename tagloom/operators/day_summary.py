"""First and last good sample of each tag and day, so that a run of a few days need not scan all
history for the neighbours of its edges.

The archive keeps it up by itself: every folder of rows that a put writes has its summary beside it,
from the same switch on (see ``sinks.current``), and the summary of a day is that of its folders'
summaries.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import in_range, partition_date
from tagloom.operators.grid import GridSpec
from tagloom.schema import READING_SCHEMA
from tagloom.sinks.current import read_summary

KEYS = ["site", "server", "tag"]


def day_summary(readings: DataFrame) -> DataFrame:
    """Two rows per tag and day at most, reduced before the shuffle: ``event_date`` and the
    columns of a reading. Summaries of new days are appended to a stored one; one of a changed
    day replaces it."""
    good = readings.where((F.col("status") == 0) & F.col("ts").isNotNull())
    good = good.withColumn("event_date", partition_date("ts"))
    picked = [by(c, "ts").alias(f"{side}_{c}") for side, by in (("first", F.min_by), ("last", F.max_by)) for c in ("rval", "istat")]
    edges = good.groupBy(*KEYS, "event_date").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), *picked)
    sides = F.array(*[
        F.struct(*[F.col(f"{side}_{c}").alias(c) for c in ("ts", "rval", "istat")]) for side in ("first", "last")
    ])
    rows = edges.select(*KEYS, "event_date", F.explode(F.array_distinct(sides)).alias("s"))
    return rows.select("event_date", *KEYS, "s.ts", "s.rval", "s.istat", F.lit(0).cast("bigint").alias("status"))


SUMMARY_SCHEMA = T.StructType([T.StructField("event_date", T.DateType()), *READING_SCHEMA.fields])


def read_day_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary of the archive at ``path`` as it is now."""
    return day_summary(read_summary(spark, path, SUMMARY_SCHEMA))


def _day(at: datetime, up: bool) -> datetime:
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
    floor = at.replace(hour=0, minute=0, second=0, microsecond=0)
    return floor + timedelta(days=1) if up and floor < at else floor


def readings_for(readings: DataFrame, summary: DataFrame, grid: GridSpec) -> DataFrame:
    """The readings of the grid's days, and of all other days each tag's last sample before and
    first one after, from the summary: all that ``value_at_time`` needs."""
    names = READING_SCHEMA.fieldNames()
    first, last = _day(grid.start, up=False), _day(grid.end, up=True)
    near = readings.select(*names).where(in_range("ts", first, last))
    picked = [c for c in names if c not in (*KEYS, "ts")]
    before = summary.where(F.col("event_date") < F.lit(first.date())).groupBy(*KEYS).agg(
        F.max("ts").alias("ts"), *[F.max_by(c, "ts").alias(c) for c in picked]
    )
    after = summary.where(F.col("event_date") >= F.lit(last.date())).groupBy(*KEYS).agg(
        F.min("ts").alias("ts"), *[F.min_by(c, "ts").alias(c) for c in picked]
    )
    return near.unionByName(before.select(*names)).unionByName(after.select(*names))
