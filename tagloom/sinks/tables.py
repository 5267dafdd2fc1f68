"""File and table sinks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import event_json, partition_date
from tagloom.sinks.current import PAIR, PLAIN, current, drop_days, listed, read_current, replace_partitions

PARTITION_COLUMNS = ["event_date", "site"]
CLUSTER_COLUMNS = ["event_date", "site", "tag", "timestamp"]


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", partition_date("timestamp"))


def with_ingestion_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ingestion_timestamp", F.current_timestamp())


def clustered(events: DataFrame) -> DataFrame:
    """Rows of a (day, site) together and sorted by tag and time, large ones split.

    A rebalance lets adaptive execution cut a (day, site) that holds most of the rows
    into pieces of the advisory size, and join small ones up.
    """
    order = [c for c in CLUSTER_COLUMNS + ["ts"] if c in events.columns]
    return events.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*order)


def clustered_by_range(events: DataFrame, rows_per_file: int) -> DataFrame:
    """Rows in ranges of (day, site, tag, time), about ``rows_per_file`` each.

    Split points come from a sample of the rows, so a large (day, site) becomes files that each hold
    a range of its tags, or of one tag's time: the statistics of the files leave few to open for
    a tag. The rows are computed twice, which suits stored ones.
    """
    order = [c for c in CLUSTER_COLUMNS + ["ts"] if c in events.columns]
    tasks = max(1, -(-events.count() // rows_per_file))
    return events.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def append_jsonl(events: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Append one JSON object per line, nulls kept."""
    lines = events.select(event_json().alias("value"))
    lines.write.mode("append").option("maxRecordsPerFile", max_records_per_file).text(path)


def overwrite_partitions(
    events: DataFrame, path: str, file_format: str = "parquet", max_records_per_file: int = 0
) -> None:
    """Replace every (day, site) present in ``events`` and leave the others alone.

    A rerun replaces a whole (day, site) even with partial data; use the merge to add to one.
    ``path`` may be any URI Spark can write: local, HDFS or object storage. Folders are replaced in
    place; in a table that was merged into, the pointers of these days and sites are switched (see
    ``sinks.current``).
    """
    if file_format not in ("parquet", "jsonl"):
        raise ValueError("file_format must be 'parquet' or 'jsonl'")
    rows = events if "event_date" in events.columns else with_event_date(events)
    at = current(events.sparkSession, path)
    if at.listing is not None:
        if file_format == "jsonl":
            raise ValueError("a table that was merged into holds parquet only")
        replace_partitions(rows, path, at, max_records_per_file=max_records_per_file)
        return
    rows = clustered(rows)
    if file_format == "jsonl":
        # The partition values are in the directory names, the full event in the line.
        rows = rows.select(*PARTITION_COLUMNS, event_json().alias("value"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION_COLUMNS)
        .format("text" if file_format == "jsonl" else "parquet")
        .save(path)
    )


def partition_path(base: str, event_date: str, site: str) -> str:
    """Where a plain writer leaves the events of one day and site."""
    return f"{base.rstrip('/')}/event_date={event_date}/site={site}"


def partition_paths(spark: SparkSession, path: str) -> DataFrame:
    """The folders of each day and site now: one, or more after inserts (see ``rewrite_days``)."""
    base = F.when(F.col("folder") == PLAIN, F.lit(path.rstrip("/"))).otherwise(
        F.concat(F.lit(f"{path.rstrip('/')}/_rows/folder="), "folder"))
    place = F.concat(base, F.lit("/event_date="), F.col("event_date").cast("string"), F.lit("/site="), "site")
    return listed(spark, path).groupBy("event_date", "site").agg(F.sort_array(F.collect_set(place)).alias("folders"))


def files_per_day(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files of each day that the table holds now, from file metadata only."""
    files = read_current(spark, path, PAIR, files=True).select("event_date", "file").distinct()
    return files.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_files"))


def drop_expired(spark: SparkSession, path: str, today: date, keep_days: int) -> list[str]:
    """Delete day partitions older than ``keep_days`` before ``today``; returns their names."""
    if keep_days < 0:
        raise ValueError("keep_days must not be negative")
    return drop_days(spark, path, today - timedelta(days=keep_days))


def batch_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("site", "server").agg(F.count(F.lit(1)).alias("n_events"))


def print_summary(events: DataFrame) -> list[str]:
    """One line per site and server with its number of events; the rows are not printed."""
    lines = [
        f"{r['site']} ({r['server']}): published batch of {r['n_events']} events"
        for r in batch_summary(events).orderBy("site", "server").toLocalIterator()
    ]
    for line in lines:
        print(line)
    return lines
