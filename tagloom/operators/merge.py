"""Idempotent merge of staged events into a day-partitioned table.

New events are inserted; an existing event is updated only where it differs; nothing
is deleted. The plan touches the staged days and sites only, and writes only the (day, site)
partitions in which a row changed, in folders of their own (see ``sinks.current``).

An event without site, tag or timestamp has no key: it is set aside with its reason, neither
merged nor dropped without a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions import partition_date
from tagloom.schema import EVENT_COLUMNS, EVENT_SCHEMA, MERGE_UPDATED_COLUMNS, TABLE_COLUMNS
from tagloom.session import drop_scratch, scratch_path
from tagloom.sinks.current import INSERT, KEEP, UPDATE, merge_into, read_current, read_or_empty

TABLE_SCHEMA = T.StructType([
    *EVENT_SCHEMA.fields,
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
])

REJECT = "reject"


def with_reason(events: DataFrame) -> DataFrame:
    """Adds ``reason``: why an event cannot be stored by its key, null where it can."""
    reason = (
        F.when(F.col("site").isNull() | (F.col("site") == ""), "NO_SITE")
        .when(F.col("tag").isNull(), "NO_TAG")
        .when(F.col("timestamp").isNull(), "NO_TIMESTAMP")
        .when(F.col("event_id").isNull(), "NO_EVENT_ID")
    )
    return events.withColumn("reason", reason)


def set_aside(spark: SparkSession, path: str, batch: DataFrame) -> int:
    """Write the rejected rows of ``batch``, which has a ``reason``, to ``<path>/_rejected`` and
    return their number. The folder is named by their content: a repeated batch replaces its own."""
    bad = batch.where("reason IS NOT NULL").select("reason", *EVENT_COLUMNS)
    n, mark = bad.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*bad.columns))).first()
    if n:
        bad.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_rejected/batch={n}-{mark & (1 << 64) - 1:x}")
    return n


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """What was set aside, with its reason."""
    schema = T.StructType([T.StructField("reason", T.StringType()), *EVENT_SCHEMA.fields, T.StructField("batch", T.StringType())])
    return read_or_empty(spark, f"{path.rstrip('/')}/_rejected", schema).drop("batch")


def unique_staging(staging: DataFrame, on_conflict: str = "error", newest_by: list[str] | None = None) -> DataFrame:
    """One staged row per event. Exact copies collapse. Copies that differ raise, unless
    ``on_conflict='latest'``: then the largest in ``newest_by`` wins."""
    if on_conflict not in ("error", "latest"):
        raise ValueError("on_conflict must be 'error' or 'latest'")
    rest = [c for c in EVENT_COLUMNS if c != "event_id"]
    order = list(newest_by or []) if on_conflict == "latest" else []
    if on_conflict == "latest" and not order:
        raise ValueError("on_conflict='latest' needs newest_by")
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *rest)
    # Rows without a key are no copies of each other: the caller has set them aside.
    grouped = staging.where("event_id IS NOT NULL").groupBy("event_id").agg(F.max(row).alias("hi"), F.min(row).alias("lo"))
    if on_conflict == "error":
        problem = F.concat(F.lit("conflicting staged rows for event "), F.col("event_id"))
        picked = F.when(F.col("hi").eqNullSafe(F.col("lo")), F.col("hi")).otherwise(F.raise_error(problem))
    else:
        picked = F.col("hi")
    chosen = grouped.select("event_id", picked.alias("row"))
    return chosen.select(*[F.col(c) if c == "event_id" else F.col("row")[c].alias(c) for c in EVENT_COLUMNS])


def merge_rows(target: DataFrame, staging: DataFrame, compare: str = "value", now: Column | None = None) -> DataFrame:
    """Rows of the merged table with the ``action`` that made them.

    ``compare='value'`` updates where the value differs; ``compare='all'`` also where only
    another updatable column does. Source, server, site, tag and timestamp never change.
    """
    if compare not in ("value", "all"):
        raise ValueError("compare must be 'value' or 'all'")
    now = F.current_timestamp() if now is None else now
    # Which side a row is from is marked, not read off a key that may be null.
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in TABLE_COLUMNS], F.lit(True).alias("t_here"))
    s = staging.withColumn("event_date", partition_date("timestamp")).select(
        *[F.col(c).alias(f"s_{c}") for c in [*EVENT_COLUMNS, "event_date"]], F.lit(True).alias("s_here")
    )
    both = t.join(
        s, (F.col("t_event_id") == F.col("s_event_id")) & (F.col("t_event_date") == F.col("s_event_date")), "full_outer"
    )
    compared = ["value"] if compare == "value" else MERGE_UPDATED_COLUMNS
    changed = F.lit(False)
    for c in compared:
        changed = changed | ~F.col(f"t_{c}").eqNullSafe(F.col(f"s_{c}"))
    action = (
        F.when(F.col("s_here").isNull(), KEEP)
        .when(F.col("t_here").isNull(), INSERT)
        .when(changed, UPDATE)
        .otherwise(KEEP)
    )
    acted = both.withColumn("action", action)
    inserted = F.col("action") == INSERT
    updated = F.col("action") == UPDATE
    columns = []
    for c in TABLE_COLUMNS:
        if c == "ingestion_timestamp":
            merged = F.when(inserted | updated, now).otherwise(F.col(f"t_{c}"))
        elif c in MERGE_UPDATED_COLUMNS:
            merged = F.when(inserted | updated, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        else:
            merged = F.when(inserted, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        columns.append(merged.alias(c))
    return acted.select(*columns, "action")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The event table; empty where nothing was written yet."""
    return read_current(spark, path, TABLE_SCHEMA)


def reconcile(
    spark: SparkSession,
    path: str,
    staging: DataFrame,
    compare: str = "value",
    on_conflict: str = "error",
    newest_by: list[str] | None = None,
    max_records_per_file: int = 0,
) -> dict[str, int]:
    """Merge ``staging`` into the table at ``path`` and return the number of rows per action:
    insert, update, keep (of the partitions touched), and reject (see :func:`read_rejected`).

    An interrupted run changes nothing that can be read; running it again merges the same rows.
    """
    staged_path = scratch_path(spark, "staged")
    checked = with_reason(staging)
    good = unique_staging(checked.where("reason IS NULL"), on_conflict, newest_by)
    good.withColumn("event_date", partition_date("timestamp")).write.parquet(staged_path)
    rejected = set_aside(spark, path, checked)
    staged = spark.read.parquet(staged_path)
    counts = merge_into(
        spark, path, TABLE_SCHEMA, staged, lambda t, s: merge_rows(t, s.select(*EVENT_COLUMNS), compare), max_records_per_file
    )
    drop_scratch(spark, staged_path)
    return {**counts, **({REJECT: rejected} if rejected else {})}
