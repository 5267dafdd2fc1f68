"""Newest row per key. Aggregation reduces copies before the shuffle, however many a key has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the largest in ``newest_by``; ties are settled by the other columns,
    so the result does not depend on row order."""
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    packed = F.max(F.struct(*newest_by, *rest)).alias("newest")
    picked = df.groupBy(*keys).agg(packed)
    return picked.select(*[F.col(c) if c in keys else F.col("newest")[c].alias(c) for c in df.columns])


def snapshot(samples: DataFrame) -> DataFrame:
    """Current reading of each tag. Samples are unique by tag and time, so the columns can be
    picked one by one; their fixed width lets Spark aggregate by hash."""
    keys = ["site", "server", "tag"]
    picked = [F.max_by(c, "ts").alias(c) for c in samples.columns if c not in (*keys, "ts")]
    return samples.groupBy(*keys).agg(F.max("ts").alias("ts"), *picked).select(*samples.columns)


def deduplicate(events: DataFrame, newest_by: list[str] | None = None) -> DataFrame:
    """One event per ``event_id``."""
    return latest_per_key(events, ["event_id"], newest_by or ["timestamp"])
