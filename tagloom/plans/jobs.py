"""End-to-end jobs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.canonical import attach_site, canonical_events
from tagloom.operators.day_summary import readings_for
from tagloom.operators.grid import GridSpec
from tagloom.operators.resolve import resolve_and_classify
from tagloom.operators.value_at_time import value_at_time
from tagloom.operators.writeback import parse_requests, put_archive, resolve_requests
from tagloom.options import ReadOptions, effective_read_options
from tagloom.session import drop_scratch, scratch_path
from tagloom.sinks import choose_sink
from tagloom.sinks.ledger import Ledger
from tagloom.sinks.registry import with_retry
from tagloom.sources.sites import select_sites
from tagloom.streaming import GridStream, event_batches, request_batches, start


def stored_events(readings: DataFrame, sites: DataFrame, points: DataFrame, states: DataFrame, **join_options) -> DataFrame:
    """Every raw reading as an event."""
    at_site = attach_site(readings, sites, **join_options)
    return canonical_events(resolve_and_classify(at_site, points, states, **join_options))


def sampled_events(
    readings: DataFrame, sites: DataFrame, tags: DataFrame, points: DataFrame, states: DataFrame, grid: GridSpec,
    lookback: timedelta | None = None, lookahead: timedelta | None = None, **join_options,
) -> DataFrame:
    """The value of every tag at every grid instant as an event. ``tags`` is (site, tag)."""
    wanted = tags.join(sites.select("site", "server"), "site").select("site", "server", "tag").distinct()
    at_site = attach_site(readings, sites, **join_options)
    sampled = value_at_time(at_site, wanted, grid, lookback, lookahead, **join_options)
    return stored_events(sampled, sites, points, states, **join_options)


def run_historical(
    readings: DataFrame,
    sites: DataFrame,
    tags: DataFrame,
    points: DataFrame,
    states: DataFrame,
    start_at: datetime,
    end_at: datetime,
    sink: str,
    wanted_sites: str | None = None,
    read: ReadOptions | None = None,
    lookback: timedelta | None = None,
    lookahead: timedelta | None = None,
    summary: DataFrame | None = None,
    **sink_options,
) -> int:
    """Sample a range for all wanted sites in one plan and deliver it. A failure anywhere
    stops the job before anything is committed. Returns the number of events delivered, as
    counted on their way into the sink.

    With the ``summary`` that ``day_summary`` keeps, only the days of the range are scanned; with
    paddings, what lies within them; with neither, all history.
    """
    options = effective_read_options(read, None)
    publish = choose_sink("historical", sink, **{"max_records_per_file": options.batch_rows, **sink_options})
    chosen = select_sites(sites, wanted_sites)
    grid = GridSpec(start_at, end_at, options.interval_seconds, options.window_seconds)
    source = readings if summary is None else readings_for(readings, summary, grid)
    events = sampled_events(source, chosen, tags, points, states, grid, lookback, lookahead)
    return counted(publish)(events)


def counted(publish: Callable[[DataFrame], None]) -> Callable[[DataFrame], int]:
    """``publish``, returning how many rows it delivered. They are written to the shared folder
    first, so that a sink which reads them more than once computes them once, and counted there."""

    def run(events: DataFrame) -> int:
        spark = events.sparkSession
        path = scratch_path(spark, "delivery")
        events.write.parquet(path)
        delivery = spark.read.schema(events.schema).parquet(path)
        delivered = delivery.count()
        publish(delivery)
        drop_scratch(spark, path)
        return delivered

    return run


def run_realtime(
    stream: DataFrame,
    tags: DataFrame,
    load_sites: Callable[[], DataFrame],
    load_points: Callable[[], DataFrame],
    load_states: Callable[[], DataFrame],
    start_at: datetime,
    end_at: datetime,
    sink: str,
    checkpoint: str,
    state_path: str,
    wanted_sites: str | None = None,
    read: ReadOptions | None = None,
    once: bool = False,
    hold: bool = True,
    ledger_path: str | None = None,
    **sink_options,
) -> tuple[StreamingQuery, GridStream]:
    """The value of every tag at every grid instant of a live stream, as events into a realtime
    sink; one query serves all sites. ``tags`` is (site, tag).

    A tag that is silent for longer than the window holds its last value; one that was never
    seen has no data, and one without a point the quality that says so. ``hold=False`` waits for
    every tag instead. Call ``flush`` on the returned grid when the range is over. ``ledger_path``: where
    deliveries are recorded, for sinks that cannot tell a repeated event (see ``sinks.ledger``).
    """
    options = effective_read_options(read, None)
    publish = with_retry(
        choose_sink("realtime", sink, **sink_options), options.publish_retries, options.retry_sleep_seconds
    )
    grid = GridSpec(start_at, end_at, options.interval_seconds, options.window_seconds)
    spark = stream.sparkSession
    chosen = select_sites(load_sites(), wanted_sites)
    wanted = tags.join(chosen.select("site", "server"), "site").select("site", "server", "tag").distinct()

    ledger = Ledger(spark, ledger_path, "grid") if ledger_path else None

    def deliver(sampled: DataFrame, batch: int) -> None:
        def made() -> DataFrame:
            return stored_events(sampled, select_sites(load_sites(), wanted_sites), load_points(), load_states())

        if ledger:
            ledger.deliver(made, batch, publish)
        else:
            publish(made())

    after = timedelta(seconds=options.window_seconds) if hold else None
    sampler = GridStream(spark, wanted, grid, state_path, after, deliver)
    return start(stream, sampler.on_batch, checkpoint, None if once else options.interval_seconds), sampler


def run_realtime_raw(
    stream: DataFrame,
    load_sites: Callable[[], DataFrame],
    load_points: Callable[[], DataFrame],
    load_states: Callable[[], DataFrame],
    sink: str,
    checkpoint: str,
    wanted_sites: str | None = None,
    read: ReadOptions | None = None,
    once: bool = False,
    ledger_path: str | None = None,
    **sink_options,
) -> StreamingQuery:
    """Every raw reading of a stream as an event, without a grid; ``ledger_path`` as above."""
    options = effective_read_options(read, None)
    publish = with_retry(
        choose_sink("realtime", sink, **sink_options), options.publish_retries, options.retry_sleep_seconds
    )
    ledger = Ledger(stream.sparkSession, ledger_path, "raw") if ledger_path else None
    on_batch = event_batches(load_points, load_states, lambda: select_sites(load_sites(), wanted_sites), publish, ledger)
    return start(stream, on_batch, checkpoint, None if once else options.interval_seconds)


def run_writer(
    messages: DataFrame,
    load_sites: Callable[[], DataFrame],
    load_points: Callable[[], DataFrame],
    archive_path: str,
    dead_letter_path: str,
    checkpoint: str,
    read: ReadOptions | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Write-back requests of a queue into the archive; refused ones into the dead-letter table.
    ``messages`` is (message_id, arrival, data), from any stream source."""
    options = effective_read_options(read, None)
    on_batch = request_batches(load_sites, load_points, archive_path, dead_letter_path)
    return start(messages, on_batch, checkpoint, None if once else options.interval_seconds)


def write_request(
    spark: SparkSession, body: str, sites: DataFrame, points: DataFrame, archive_path: str, message_id: str = "single"
) -> str | None:
    """Put a single request, without a stream; returns why it was refused, or null."""
    message = spark.createDataFrame([(message_id, body)], "message_id string, data string")
    parsed = parse_requests(message.withColumn("arrival", F.current_timestamp()))
    requests = resolve_requests(parsed, sites, points)
    put_archive(spark, archive_path, requests)
    return requests.first()["reason"]
