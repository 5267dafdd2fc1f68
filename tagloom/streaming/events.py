"""Readings to events, as a stream.

Offsets and progress live in the checkpoint: after a failure the same micro-batch runs
again, and sinks that ignore stored event ids make the outcome the same as one run. Sinks that
cannot tell a repeated row get a ledger (see ``sinks.ledger``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tagloom.operators.canonical import attach_site, canonical_events
from tagloom.operators.resolve import resolve_and_classify
from tagloom.sinks.ledger import Ledger


def file_stream(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet",
    max_files_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    """New files under ``path`` as a stream, always with an explicit schema."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def queue_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """A message queue as (message_id, arrival, data), for example
    ``queue_stream(spark, "kafka", subscribe="requests", **{"kafka.bootstrap.servers": "..."})``.

    A source with Kafka's columns is renamed; any other must offer the three itself.
    """
    rows = spark.readStream.format(source).options(**options).load()
    if {"topic", "partition", "offset", "value"} <= set(rows.columns):
        place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        return rows.select(place.alias("message_id"), F.col("timestamp").alias("arrival"), F.col("value").alias("data"))
    return rows.select("message_id", "arrival", "data")


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval_seconds: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``on_batch`` on every micro-batch: every ``interval_seconds``, or, without one,
    over everything there is now and then stop. Stop a running query with ``.stop()``."""
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()


def deduplicated(events: DataFrame, delay: str) -> DataFrame:
    """Drop repeats of an event id that arrive within ``delay`` of each other.

    State is kept for ``delay`` only, and events later than that are dropped here: follow
    with the daily merge, which brings them in, or use a sink that ignores stored ids.
    """
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def event_batches(
    load_points: Callable[[], DataFrame],
    load_states: Callable[[], DataFrame],
    load_sites: Callable[[], DataFrame],
    sink: Callable[[DataFrame], None],
    ledger: Ledger | None = None,
    **join_options,
) -> Callable[[DataFrame, int], None]:
    """Batch function turning readings into events. Dimensions are loaded anew for every
    batch, so a point or state added meanwhile is seen; with a ``ledger``, a batch that is run again
    delivers what it made the first time, and nothing that is on record. All sites share one query."""

    def on_batch(readings: DataFrame, batch: int) -> None:
        def made() -> DataFrame:
            at_site = attach_site(readings, load_sites(), **join_options)
            return canonical_events(resolve_and_classify(at_site, load_points(), load_states(), **join_options))

        if ledger:
            ledger.deliver(made, batch, sink)
        else:
            sink(made())

    return on_batch
