"""Row inserts that ignore events already stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.functions import partition_date
from tagloom.operators.merge import REJECT, TABLE_SCHEMA, set_aside, with_reason
from tagloom.schema import TABLE_COLUMNS
from tagloom.session import drop_scratch, scratch_path
from tagloom.sinks.current import INSERT, add_rows, current, read_current
from tagloom.sinks.tables import with_ingestion_time


def insert_new(spark: SparkSession, path: str, events: DataFrame) -> dict[str, int]:
    """Append events whose id is not stored yet, one of each id, and return the numbers of rows
    inserted and rejected (see ``operators.merge.read_rejected``).

    Only the days and sites of the batch are read, and of them the ids. The new rows are one
    folder of the table: a run that dies has stored nothing, and a repeated one stores nothing
    twice. Copies of an id have the same site, tag and time; any of them is kept. Each call adds at
    least one file to each (day, site) of the batch: gather them with ``rewrite_days`` once a day
    is over, and drop repeats in the stream by watermark first.
    """
    batch_path = scratch_path(spark, "batch")
    with_reason(events).withColumn("event_date", partition_date("timestamp")).write.parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    rejected = set_aside(spark, path, batch)
    good = batch.where("reason IS NULL").dropDuplicates(["event_id"])
    at = current(spark, path)
    pairs = good.select("event_date", "site").distinct()
    stored = read_current(spark, path, TABLE_SCHEMA, at).join(pairs, ["event_date", "site"], "left_semi")
    fresh = good.join(stored.select("event_date", "event_id"), ["event_date", "event_id"], "left_anti")
    inserted = add_rows(with_ingestion_time(fresh).select(*TABLE_COLUMNS), path, at)
    drop_scratch(spark, batch_path)
    return {INSERT: inserted, **({REJECT: rejected} if rejected else {})}
