"""Counts reported about a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import partition_date
from tagloom.operators.grid import GridSpec


def events_per_day_and_site(events: DataFrame) -> DataFrame:
    return (
        events.withColumn("event_date", partition_date("timestamp"))
        .groupBy("event_date", "site")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def events_per_window(events: DataFrame, start: str, length_seconds: int) -> DataFrame:
    """Events per site and window; ``start`` names a column with the site's range start."""
    length = F.lit(length_seconds * 1_000_000)
    offset = F.unix_micros("timestamp") - F.unix_micros(start)
    window = F.timestamp_micros(F.unix_micros(start) + offset - F.pmod(offset, length))
    return events.groupBy("site", window.alias("window_start")).agg(F.count(F.lit(1)).alias("n_events"))


def missing_points(resolved: DataFrame) -> DataFrame:
    """Readings and distinct tags of each site whose point is unknown. One row per tag is
    made before the tags are counted, so no task holds a site's distinct set."""
    per_tag = resolved.groupBy("site", "server", "tag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("point_id").isNull()).alias("n_missing")
    )
    return per_tag.groupBy("site").agg(
        F.sum("n").alias("n_readings"),
        F.sum("n_missing").alias("n_missing_readings"),
        F.count_if(F.col("n_missing") > 0).alias("n_missing_tags"),
    )


def tags_per_site(tags: DataFrame, sites: DataFrame) -> DataFrame:
    """Distinct tags of each enabled site, zero for a site without tags."""
    per_site = tags.select("site", "tag").distinct().groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    enabled = sites.where("enabled").select("site")
    return enabled.join(per_site, "site", "left").select("site", F.coalesce("n", F.lit(0)).alias("n_tags"))


def task_plan(tags: DataFrame, grid: GridSpec, tag_partition_size: int) -> DataFrame:
    """Tag chunks, windows and their product per site."""
    if tag_partition_size <= 0:
        raise ValueError("tag_partition_size must be greater than zero")
    span = (grid.end - grid.start).total_seconds()
    windows = -int(-max(span, 0) // grid.window_seconds)
    counted = tags.groupBy("site").agg(F.count(F.lit(1)).alias("n_tags"))
    chunks = F.ceil(F.col("n_tags") / F.lit(tag_partition_size)).cast("bigint")
    return counted.select(
        "site", "n_tags", chunks.alias("n_chunks"), F.lit(windows).cast("bigint").alias("n_windows"),
        (chunks * F.lit(windows)).cast("bigint").alias("n_tasks"),
    )
