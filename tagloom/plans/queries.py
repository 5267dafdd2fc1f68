"""Registered queries: each takes (spark, sf_dir) and runs over the whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import functions as fn
from tagloom.operators import chunks, dimensions, grid, latest, merge, reports, resolve, writeback
from tagloom.operators.canonical import published_form
from tagloom.operators.day_summary import read_day_summary
from tagloom.operators.enrich import enrich
from tagloom.operators.value_at_time import value_at_time
from tagloom.plans import adapters as A
from tagloom.options import ReadOptions
from tagloom.plans.jobs import run_realtime, stored_events
from tagloom.schema import EVENT_COLUMNS, EVENT_SCHEMA, READING_SCHEMA
from tagloom.session import materialize, scratch_path
from tagloom.sinks import messages as msg
from tagloom.sinks import tables
from tagloom.sinks.inserts import insert_new
from tagloom.sinks.ledger import Ledger
from tagloom.sources import dimensions as dims
from tagloom.sources import events as event_source
from tagloom.sources import readings as reading_source
from tagloom.sources import sites as site_source
from tagloom.sources import tags as tag_source
from tagloom.streaming import (
    GridStream, closing, deduplicated, event_batches, file_stream, keyed_grid, request_batches, start,
)
from tagloom.streaming.grid import OUTPUT_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered grid queries; the window is no multiple of the interval,
# so that the grid restarts out of step.
INTERVAL_SECONDS = 600
WINDOW_SECONDS = 100_000
TICK_SECONDS = 60
REALTIME_WINDOW_SECONDS = 86_400
CHUNK_SIZE = 7
KEEP_DAYS = 7
#: Two readings of a tag at one instant have one event id. A merge stores one of them: a good value
#: before a state, a state before a failure (as their texts sort), then the larger value text.
MERGE_ORDER = ["quality", "value"]


def _iso(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: fn.iso_zulu(n) for n in names})


def _events_of(readings: DataFrame) -> DataFrame:
    tag_table, state_table = A.tags_and_states(readings)
    return stored_events(readings, A.sites(tag_table), A.points(tag_table), state_table)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(A.samples(spark, sf_dir))


def _reconcile(spark: SparkSession, path: str, staged: DataFrame, compare: str = "value") -> None:
    merge.reconcile(spark, path, staged, compare=compare, on_conflict="latest", newest_by=MERGE_ORDER)


def _classified(readings: DataFrame) -> DataFrame:
    tag_table, state_table = A.tags_and_states(readings)
    return resolve.resolve_and_classify(readings, A.points(tag_table), state_table)


def _grid(readings: DataFrame) -> grid.GridSpec:
    return grid.GridSpec(*A.day_range(readings), INTERVAL_SECONDS, WINDOW_SECONDS)


def q01_event_id(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    keyed = ev.select(F.col("event_id").alias("row_id"), *[F.col(c) for c in ("k", "ts")],
                      F.concat(F.lit("site"), (F.col("user_id") % 3 + 1).cast("string")).alias("site"),
                      F.upper("event_type").alias("tag"))
    return keyed.select("row_id", "site", "tag", fn.iso_utc("ts").alias("instant"), fn.iso_zulu("ts").alias("shown"),
                        fn.event_id("site", "tag", "ts").alias("event_id"))


def q02_value_text(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    v = F.col("value")
    return ev.select(F.col("event_id").alias("row_id"), fn.value_text(v).alias("value"),
                     fn.value_text(v / 7).alias("seventh"), fn.value_text(v * 1000003.0).alias("large"),
                     fn.value_text(v * v / 100000.0).alias("small"),
                     fn.value_text(-v * 1.37e16).alias("huge"), fn.value_text(v * v * 1.37e22).alias("immense"))


def q03_digital_decode(spark, sf_dir):
    return A.samples(spark, sf_dir).select(
        "site", "tag", fn.iso_zulu("ts").alias("ts"), "istat", fn.digital_code("istat").alias("digital_code"),
        fn.digital_set_id("istat").alias("digital_set_id"), fn.digital_state_id("istat").alias("digital_state_id"))


def q04_classify(spark, sf_dir):
    return _iso(_classified(A.samples(spark, sf_dir)), "ts").select(
        "site", "server", "tag", "ts", "point_id", "value", "quality", "value_type", "digital_code", "digital_set_id",
        "digital_state_id", "digital_state_name", "state_source", "raw_istat")


def q05_canonical_event(spark, sf_dir):
    return published_form(_canonical(spark, sf_dir))


def q06_partition_date_counts(spark, sf_dir):
    ev = A.samples(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    return reports.events_per_day_and_site(ev).withColumn("event_date", F.col("event_date").cast("string"))


def q07_floor_interval(spark, sf_dir):
    return A.events(spark, sf_dir).select(
        F.col("event_id").alias("row_id"), fn.iso_zulu(fn.floor_to_interval("ts", 300)).alias("floored"))


def _site_bounds(readings: DataFrame) -> DataFrame:
    """Whole-day range of each site's readings, one row per site."""
    day = F.expr("INTERVAL 1 DAY")
    return readings.groupBy("site").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(
        "site", F.date_trunc("day", "lo").alias("range_start"), (F.date_trunc("day", "hi") + day).alias("range_end"))


def q08_windows(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    bounds = materialize(_site_bounds(readings))
    windows = grid.split_windows(bounds, "range_start", "range_end", WINDOW_SECONDS)
    placed = enrich(readings.withColumnRenamed("ts", "timestamp"), bounds, ["site"], ["timestamp"], how="inner")
    inside = placed.where((F.col("timestamp") >= F.col("range_start")) & (F.col("timestamp") < F.col("range_end")))
    counts = reports.events_per_window(inside, "range_start", WINDOW_SECONDS)
    joined = windows.join(counts, ["site", "window_start"], "left")
    return _iso(joined, "window_start", "window_end").select(
        "site", "window_start", "window_end", F.coalesce("n_events", F.lit(0)).alias("n_events"))


def q09_grid_counts(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    tag_table = A.tags(readings).select("site", "tag")
    windows = grid.tag_windows(tag_table, _site_bounds(readings), WINDOW_SECONDS)
    per = grid.sampling_points(windows, TICK_SECONDS).groupBy("site", "tag", "window_start").agg(
        F.count(F.lit(1)).alias("n_points"), F.max("ts").alias("last_point"))
    return _iso(per, "window_start", "last_point")


def _sampled(readings: DataFrame) -> DataFrame:
    return value_at_time(readings, A.tags(readings), _grid(readings))


def q10_interpolated(spark, sf_dir):
    return _iso(_sampled(A.samples(spark, sf_dir)), "ts").select("site", "tag", "ts", "rval", "istat", "no_data")


def q11_interpolated_events(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    tag_table, state_table = A.tags_and_states(readings)
    sampled = value_at_time(readings, tag_table, _grid(readings))
    return published_form(stored_events(sampled, A.sites(tag_table), A.points(tag_table), state_table))


def q12_snapshot_latest(spark, sf_dir):
    return _iso(latest.snapshot(A.samples(spark, sf_dir)), "ts").select(
        "site", "server", "tag", "ts", "rval", "istat", "status")


def q13_missing_points(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    return reports.missing_points(resolve.resolve_points(readings, A.points(A.tags(readings))))


def _tag_lines(spark, sf_dir) -> DataFrame:
    """A tag-list line per event: mixed case, blanks, comments, repeats."""
    ev = A.events(spark, sf_dir)
    k = F.col("k")
    name = F.concat(F.lit("  "), F.col("event_type"), F.lit("."), k.cast("string"), F.lit(" "))
    line = F.when(k % 17 == 1, F.concat(F.lit(" # "), name)).when(k % 23 == 2, F.lit("   ")).otherwise(name)
    return ev.select(F.concat(F.lit("site"), (F.col("user_id") % 3 + 1).cast("string")).alias("site"),
                     F.col("event_id").alias("pos"), line.alias("line"))


def q14_tag_list(spark, sf_dir):
    return tag_source.tag_list(_tag_lines(spark, sf_dir)).select("site", "pos", "tag")


def q14_inline_tags(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    text = F.concat(F.col("event_type"), F.lit(", ,TAG_"), F.col("k").cast("string"), F.lit(" ,"), F.upper("event_type"))
    found = ev.select(F.col("event_id").alias("row_id"), F.posexplode(tag_source.inline_tags(text)).alias("pos", "tag"))
    return found.withColumn("pos", F.col("pos").cast("bigint"))


def q15_site_tag_counts(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    tag_list = tag_source.tag_list(_tag_lines(spark, sf_dir))
    chosen = site_source.select_sites(A.sites(A.tags(readings)), "all")
    return reports.tags_per_site(tag_list, chosen)


def _deliveries(readings: DataFrame) -> DataFrame:
    """Every reading delivered twice, the second time with a corrected value."""
    again = readings.withColumn("rval", F.when(F.col("rval") >= 100, F.col("rval") + 1).otherwise(F.col("rval")))
    return readings.withColumn("delivery", F.lit(1)).unionByName(again.withColumn("delivery", F.lit(2)))


def q16_dedup(spark, sf_dir):
    rows = _deliveries(A.samples(spark, sf_dir)).select(
        fn.event_id("site", "tag", "ts").alias("event_id"), "site", "tag", F.col("ts").alias("timestamp"),
        fn.value_text("rval").alias("value"), "delivery")
    return _iso(latest.deduplicate(rows, ["delivery"]), "timestamp")


def _merged(spark, sf_dir, compare: str) -> DataFrame:
    """Stored: every event, and a retired tag for each. Staged: every event corrected, and
    every event forty days later."""
    readings = A.samples(spark, sf_dir)
    tag_table, state_table = A.tags_and_states(readings)
    site_table, point_table = A.sites(tag_table), A.points(tag_table)

    def made(r: DataFrame) -> DataFrame:
        return stored_events(r, site_table, point_table, state_table)

    retired = readings.withColumn("tag", F.concat("tag", F.lit(".OLD")))
    corrected = readings.withColumn("rval", F.when(F.col("rval") >= 100, F.col("rval") + 1).otherwise(F.col("rval")))
    corrected = corrected.withColumn("status", F.when(F.col("status") > 90, 5).otherwise(F.col("status")).cast("bigint"))
    later = readings.withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS"))
    path = scratch_path(spark, "table")
    first = tables.with_ingestion_time(made(readings.unionByName(retired)))
    tables.overwrite_partitions(first, path)
    _reconcile(spark, path, made(corrected.unionByName(later)), compare)
    return _iso(merge.read_table(spark, path), "timestamp").select(*EVENT_COLUMNS)


def q17_merge(spark, sf_dir):
    return _merged(spark, sf_dir, "value")


def q17_merge_all_columns(spark, sf_dir):
    return _merged(spark, sf_dir, "all")


def q18_point_merge(spark, sf_dir):
    """Stored points, and one lookup result per event, many of them failed."""
    ev = A.events(spark, sf_dir)
    readings = A.readings_of(ev)
    lookup = F.when(F.col("k") % 3 == 0, -1).when(F.col("k") % 7 == 1, None).otherwise(F.col("k") + 5000)
    fresh = ev.select(
        F.concat(F.lit("site"), (F.col("user_id") % 3 + 1).cast("string")).alias("site"),
        F.concat(F.lit("Hist-Srv-0"), (F.col("user_id") % 3 + 1).cast("string")).alias("server"),
        F.concat(F.upper("event_type"), F.lit("."), (F.col("k") % 11).cast("string")).alias("tag"),
        lookup.cast("bigint").alias("point_id"), F.col("event_id").alias("seq"))
    return dimensions.merge_points(A.points(A.tags(readings)), fresh, "seq")


def q18_state_merge(spark, sf_dir):
    """Stored states, and one resolution result per digital reading, some without a name."""
    ev = A.events(spark, sf_dir)
    readings = A.readings_of(ev)
    k = F.col("k")
    code = -((F.floor(k / 10) + 1) * 65536 + k % 7)
    fresh = ev.where(k % 10 == 0).select(
        F.concat(F.lit("site"), (F.col("user_id") % 3 + 1).cast("string")).alias("site"),
        F.concat(F.lit("HIST-SRV-0"), (F.col("user_id") % 3 + 1).cast("string")).alias("server"),
        code.cast("bigint").alias("digital_code"),
        F.when(F.col("user_id") % 5 > 1, F.concat(F.lit("NEW_"), F.col("user_id").cast("string"))).alias(
            "digital_state_name"),
        F.shiftright((-code).cast("bigint"), 16).alias("digital_set_id"),
        F.lit(None).cast("bigint").alias("digital_state_id"),
        F.lit("lookup").alias("state_source"), F.col("event_id").alias("seq"))
    return dimensions.merge_states(A.states_of(readings), fresh, "seq")


def _requests(spark, sf_dir) -> DataFrame:
    ev = A.events(spark, sf_dir)
    tag_table = A.tags(A.readings_of(ev))
    return writeback.resolve_requests(
        writeback.parse_requests(A.messages_of(ev)), A.sites(tag_table), A.points(tag_table))


def q19_write_requests_valid(spark, sf_dir):
    return _iso(writeback.accepted(_requests(spark, sf_dir)), "ts").select(
        "message_id", "site", "server", "tag", "ts", "value", "istat", "wait", "point_id")


def q20_write_requests_rejected(spark, sf_dir):
    return writeback.rejected(_requests(spark, sf_dir)).select("message_id", "data", "reason")


def q21_local_time_text(spark, sf_dir):
    return A.events(spark, sf_dir).select(
        F.col("event_id").alias("row_id"), fn.source_local_text("ts", "America/Sao_Paulo").alias("local_text"))


def q22_json_payload(spark, sf_dir):
    rows = _canonical(spark, sf_dir)
    kafka = msg.kafka_rows(rows)
    headers = F.array_join(
        F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ";")
    return kafka.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("payload"),
                        headers.alias("headers"))


def q22_ordered_messages(spark, sf_dir):
    rows = msg.pubsub_rows(_canonical(spark, sf_dir), ordering_key_by_tag=True)
    a = F.col("attributes")
    return rows.select("ordering_key", a["tag"].alias("tag"), a["site"].alias("site"), a["server"].alias("server"),
                       a["quality"].alias("quality"), F.md5("data").alias("data_md5"))


def q23_overwrite_day_site(spark, sf_dir):
    """All events, then a rerun of one tag over them: a day and site it has is replaced whole."""
    rows = _canonical(spark, sf_dir)
    path = scratch_path(spark, "days")
    tables.overwrite_partitions(tables.with_ingestion_time(rows), path)
    rerun = rows.where((F.col("tag") == "ERROR") & (F.col("quality") == "DIGITAL_STATE"))
    tables.overwrite_partitions(tables.with_ingestion_time(rerun), path)
    kept = merge.read_table(spark, path)
    return _iso(kept, "timestamp").select(F.col("event_date").cast("string"), *EVENT_COLUMNS)


def q24_retention(spark, sf_dir):
    rows = _canonical(spark, sf_dir)
    path = scratch_path(spark, "aged")
    tables.overwrite_partitions(tables.with_ingestion_time(rows), path)
    newest = merge.read_table(spark, path).agg(F.max("event_date")).first()[0]
    tables.drop_expired(spark, path, newest, KEEP_DAYS)
    left = merge.read_table(spark, path).groupBy("event_date", "site").agg(F.count(F.lit(1)).alias("n_events"))
    return left.withColumn("event_date", F.col("event_date").cast("string"))


#: Micro-batches of a stream, and files of each; more where a file would get more than so many rows.
STREAM_BATCHES, BATCH_FILES, FILE_ROWS = 4, 2, 250_000


def _event_stream(spark, sf_dir, twice: bool = False, shuffled: bool = False) -> DataFrame:
    """The events by time, a quarter per micro-batch; ``twice``: the first half once more;
    ``shuffled``: in no order."""
    A.ensure_utc(spark)
    raw = spark.read.schema(A.EVENT_TABLE).parquet(f"{sf_dir}/events.parquet")
    folder = scratch_path(spark, "arriving")
    cuts = [r * 1.0 / STREAM_BATCHES for r in range(1, STREAM_BATCHES)]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds, n_rows = raw.agg(F.percentile_approx(at, F.array(*map(F.lit, cuts)), 10_000), F.count(F.lit(1))).first()
    # A file is written by one task, and a small one read by one.
    n_files = max(BATCH_FILES, -(-n_rows // (STREAM_BATCHES * FILE_ROWS)))
    piece = F.lit(0)
    for bound in bounds or []:
        piece = piece + (at > F.lit(bound)).cast("int")
    if shuffled:
        piece = F.pmod(F.xxhash64("event_id"), F.lit(STREAM_BATCHES)).cast("int")
    pieces = raw.withColumn("piece", piece)
    for k in [*range(STREAM_BATCHES), *(range(STREAM_BATCHES // 2) if twice else ())]:
        # So many files per append, so that a stream source reads a piece as one batch, in this order.
        own = pieces.where(F.col("piece") == k).drop("piece")
        own.repartition(n_files).write.mode("append").parquet(folder)
    return file_stream(spark, folder, raw.schema, max_files_per_trigger=n_files)


def _run(stream: DataFrame, on_batch, checkpoint: str) -> None:
    """Run to the end; a query over several files must be several micro-batches."""
    batches = []
    query = start(stream, lambda df, n: (batches.append(n), on_batch(df, n))[1], checkpoint)
    query.awaitTermination()
    if len(set(batches)) < STREAM_BATCHES:
        raise RuntimeError(f"{len(set(batches))} micro-batches, expected {STREAM_BATCHES} at least")


def _loaders(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    tag_table, state_table = A.tags_and_states(readings)
    return lambda: A.points(tag_table), lambda: state_table, lambda: A.sites(tag_table)


def _streamed_table(spark, sf_dir, shape=lambda readings: readings, twice: bool = False) -> DataFrame:
    path, checkpoint = scratch_path(spark, "inserted"), scratch_path(spark, "offsets")
    on_batch = event_batches(*_loaders(spark, sf_dir), lambda events: insert_new(spark, path, events))
    _run(shape(A.readings_of(A.with_k(_event_stream(spark, sf_dir, twice)))), on_batch, checkpoint)
    return _iso(merge.read_table(spark, path), "timestamp").select(*EVENT_COLUMNS)


def q25_stream_dedup_parity(spark, sf_dir):
    """Every reading arrives twice in a batch and half of them in a later batch once more; ids
    already stored are not stored again."""
    return _streamed_table(spark, sf_dir, lambda readings: readings.unionByName(readings), twice=True)


def q25_watermarked_dedup(spark, sf_dir):
    """Every reading arrives twice at a time; the stream itself drops the repeats."""
    path, checkpoint = scratch_path(spark, "deduplicated"), scratch_path(spark, "offsets")
    on_batch = event_batches(
        *_loaders(spark, sf_dir), lambda events: events.write.mode("append").parquet(path))
    readings = A.readings_of(A.with_k(_event_stream(spark, sf_dir)))
    keyed = readings.unionByName(readings).withColumns(
        {"timestamp": F.col("ts"), "event_id": fn.event_id("site", "tag", "ts")})
    once = deduplicated(keyed, "1 day").select(*readings.columns)
    _run(once, on_batch, checkpoint)
    return _iso(spark.read.schema(EVENT_SCHEMA).parquet(path), "timestamp").select(*EVENT_COLUMNS)


def q26_stream_events_parity(spark, sf_dir):
    return _streamed_table(spark, sf_dir)


def q27_chunk_ids(spark, sf_dir):
    tag_list = tag_source.tag_list(_tag_lines(spark, sf_dir)).select("site", "tag", "pos")
    return chunks.chunk_ids(tag_list, "site", "pos", CHUNK_SIZE).select("site", "tag", "chunk_id")


def q27_task_plan(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    tag_list = tag_source.tag_list(_tag_lines(spark, sf_dir))
    return reports.task_plan(tag_list, _grid(readings), CHUNK_SIZE)


def q28_writeback_archive(spark, sf_dir):
    """All requests put twice: repeating a put changes nothing."""
    requests = _requests(spark, sf_dir)
    path = scratch_path(spark, "archive-table")
    writeback.put_archive(spark, path, requests)
    writeback.put_archive(spark, path, requests)
    return _iso(writeback.read_archive(spark, path), "ts").select(
        "site", "server", "tag", "ts", "rval", "istat", "status", "message_id")


def q28_stream_requests(spark, sf_dir):
    """The same requests as a stream: what the archive and the dead-letter table hold."""
    load_points, _states, load_sites = _loaders(spark, sf_dir)
    archive, dead, checkpoint = (scratch_path(spark, n) for n in ("archive-table", "dead", "offsets"))
    on_batch = request_batches(load_sites, load_points, archive, dead)
    _run(A.messages_of(A.with_k(_event_stream(spark, sf_dir, twice=True))), on_batch, checkpoint)
    stored = writeback.read_archive(spark, archive).groupBy("site", "tag").agg(F.count(F.lit(1)).alias("n"))
    failed = spark.read.schema("message_id bigint, arrival timestamp, data string, reason string").parquet(dead)
    failed = failed.drop("batch").distinct()  # a message delivered twice is refused twice
    refused = failed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return stored.select(F.lit("archive").alias("place"), F.concat_ws("|", "site", "tag").alias("what"), "n").unionByName(
        refused.select(F.lit("dead").alias("place"), F.col("reason").alias("what"), "n"))


def q43_day_summary_upkeep(spark, sf_dir):
    """Two thirds of the requests put, then all of them: the archive's own summary of days."""
    requests = _requests(spark, sf_dir)
    path = scratch_path(spark, "archive-table")
    writeback.put_archive(spark, path, requests.where(F.pmod(F.col("message_id"), F.lit(3)) > 0))
    writeback.put_archive(spark, path, requests)
    return _iso(read_day_summary(spark, path), "ts").select(
        F.col("event_date").cast("string"), "site", "server", "tag", "ts", "rval", "istat")


def q44_delivery_ledger(spark, sf_dir):
    """Events of a stream as lines. The sink fails within the second batch, which is run again, and
    the third is run twice: every line is there once."""
    path, ledger = scratch_path(spark, "lines"), Ledger(spark, scratch_path(spark, "ledger"), "lines")
    calls = []

    def sink(events: DataFrame) -> None:
        calls.append(1)
        if len(calls) == 6:
            raise ConnectionError("the sink is away")
        tables.append_jsonl(events, path)

    deliver = event_batches(*_loaders(spark, sf_dir), sink, ledger)

    def on_batch(readings: DataFrame, batch: int) -> None:
        try:
            deliver(readings, batch)
        except ConnectionError:
            deliver(readings, batch)
        if batch == 2:
            deliver(readings, batch)

    _run(A.readings_of(A.with_k(_event_stream(spark, sf_dir))), on_batch, scratch_path(spark, "offsets"))
    return published_form(event_source.read_event_jsonl(spark, path))


def q29_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "lines")
    tables.append_jsonl(_canonical(spark, sf_dir), path)
    return published_form(event_source.read_event_jsonl(spark, path))


def q30_point_json_import(spark, sf_dir):
    """Each reading's point as a nested document, imported and merged."""
    readings = A.samples(spark, sf_dir)
    resolved = resolve.resolve_points(readings, A.points(A.tags(readings)))
    number = F.coalesce(F.col("point_id"), F.lit(-1)).cast("string")
    text = F.concat(F.lit('{"sites":{"'), F.col("site"), F.lit('":{"servers":{"'), F.col("server"),
                    F.lit('":{"tags":{"'), F.col("tag"), F.lit('":'), number, F.lit("}}}}}}"))
    imported = dims.import_point_json(resolved.select(text.alias("value")))
    nothing = imported.where(F.lit(False))
    return dimensions.merge_points(nothing, imported)


def q30_state_json_import(spark, sf_dir):
    """Each digital reading's state as a nested document; the code is only in the key."""
    readings = A.samples(spark, sf_dir).where("istat < 0")
    text = F.concat(F.lit('{"'), F.col("site"), F.lit('":{"'), F.lower("server"), F.lit('":{"'),
                    F.col("istat").cast("string"), F.lit('":{"digital_state_name":"S'),
                    (-F.col("istat")).cast("string"), F.lit('","digital_set_id":'),
                    fn.digital_set_id("istat").cast("string"), F.lit("}}}}"))
    imported = dims.import_state_json(readings.select(text.alias("value")))
    return dimensions.merge_states(imported.where(F.lit(False)), imported)


def q31_parse_datetime(spark, sf_dir):
    ev = A.events(spark, sf_dir)
    k = F.col("k")
    t = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    text = (
        F.when(k % 6 == 0, t).when(k % 6 == 1, F.concat(t, F.lit("Z"))).when(k % 6 == 2, F.concat(t, F.lit("-03:00")))
        .when(k % 6 == 3, F.substring(t, 1, 10)).when(k % 6 == 4, F.substring(t, 1, 16))
        .otherwise(F.concat(F.lit("on "), t)))
    return ev.select(F.col("event_id").alias("row_id"),
                     fn.iso_zulu(fn.parse_timestamp(text, "America/Sao_Paulo")).alias("instant"),
                     fn.iso_zulu(fn.parse_timestamp(text, "UTC")).alias("instant_utc"))


def q32_realtime_windows(spark, sf_dir):
    """A stream that began one window before each site's first reading and now is at its last."""
    readings = A.samples(spark, sf_dir)
    seen = readings.groupBy("site").agg(F.min("ts").alias("first"), F.max("ts").alias("now"))
    progress = seen.select(
        "site", "now", grid.first_realtime_start("first", TICK_SECONDS, REALTIME_WINDOW_SECONDS).alias("last_end"))
    windows = grid.realtime_windows(progress, TICK_SECONDS, REALTIME_WINDOW_SECONDS)
    return _iso(windows, "window_start", "window_end").select("site", "window_start", "window_end")


def q33_stream_grid_parity(spark, sf_dir):
    readings = A.samples(spark, sf_dir)
    sampler = GridStream(spark, A.tags(readings), _grid(readings), scratch_path(spark, "grid"))
    _run(A.readings_of(A.with_k(_event_stream(spark, sf_dir))), sampler.on_batch, scratch_path(spark, "offsets"))
    sampler.flush()
    return _iso(sampler.output(), "ts").select("site", "tag", "ts", "rval", "istat", "no_data")


def q42_keyed_grid_parity(spark, sf_dir):
    """The grid by a state per tag in the state store; the last piece of the stream ends the range."""
    readings = A.samples(spark, sf_dir)
    tag_table, spec = A.tags(readings), _grid(readings)
    folder, out = scratch_path(spark, "readings"), scratch_path(spark, "sampled")
    first, last = (at.timestamp() for at in A.day_range(readings))
    piece = F.floor((F.col("ts").cast("double") - first) / ((last - first) / STREAM_BATCHES))
    for k in range(STREAM_BATCHES):
        readings.where(piece == k).repartition(BATCH_FILES).write.mode("append").parquet(folder)
    closing(tag_table, spec).repartition(BATCH_FILES).write.mode("append").parquet(folder)
    arriving = file_stream(spark, folder, READING_SCHEMA, max_files_per_trigger=BATCH_FILES)
    sink = keyed_grid(arriving, tag_table, spec).writeStream.format("parquet").option("path", out)
    sink.option("checkpointLocation", scratch_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    sampled = spark.read.schema(OUTPUT_SCHEMA).parquet(out)
    return _iso(sampled, "ts").select("site", "tag", "ts", "rval", "istat", "no_data")


def q41_stream_grid_repair(spark, sf_dir):
    """The stream in no order: most samples come after their instants were emitted, which are
    repaired from the stored ones, first after two thirds of the stream and then at its end."""
    readings = A.samples(spark, sf_dir)
    sampler = GridStream(spark, A.tags(readings), _grid(readings), scratch_path(spark, "grid"))
    seen = []

    def on_batch(fresh: DataFrame, batch: int) -> None:
        sampler.on_batch(fresh, batch)
        seen.append(materialize(fresh))
        if len(seen) == STREAM_BATCHES - 1:
            stored = seen[0]
            for more in seen[1:]:
                stored = stored.unionByName(more)
            sampler.repair(stored)

    _run(A.readings_of(A.with_k(_event_stream(spark, sf_dir, shuffled=True))), on_batch, scratch_path(spark, "offsets"))
    sampler.flush()
    sampler.repair(readings)
    return _iso(sampler.output(), "ts").select("site", "tag", "ts", "rval", "istat", "no_data")


def q34_realtime_grid_events(spark, sf_dir):
    """The realtime job over files that arrive one by one: the same events as the historical one."""
    readings = A.samples(spark, sf_dir)
    tag_table, state_table = A.tags_and_states(readings)
    site_table = A.sites(tag_table).withColumn("enabled", F.lit(True))
    path, spec = scratch_path(spark, "inserted"), _grid(readings)
    query, sampler = run_realtime(
        A.readings_of(A.with_k(_event_stream(spark, sf_dir))), tag_table.select("site", "tag"), lambda: site_table,
        lambda: A.points(tag_table), lambda: state_table, spec.start, spec.end, "bigquery",
        scratch_path(spark, "offsets"), scratch_path(spark, "grid"),
        read=ReadOptions(interval_seconds=spec.interval_seconds, window_seconds=spec.window_seconds),
        once=True, hold=False, path=path)
    query.awaitTermination()
    sampler.flush()
    return _iso(merge.read_table(spark, path), "timestamp").select(*EVENT_COLUMNS)


def _incomplete(spark, sf_dir) -> DataFrame:
    """Events of which some have lost their tag or their time."""
    k = F.conv(F.substring("event_id", 1, 4), 16, 10).cast("bigint") % 20
    made = _canonical(spark, sf_dir).withColumn("cut", k)
    lost = made.withColumns({
        "tag": F.when(F.col("cut") != 0, F.col("tag")), "timestamp": F.when(F.col("cut") != 1, F.col("timestamp")),
    }).drop("cut")
    return lost.withColumn("event_id", fn.event_id("site", "tag", "timestamp"))


def q35_rejected_events(spark, sf_dir):
    """Incomplete events merged twice and inserted twice: what is stored, and what is set aside."""
    rows = materialize(_incomplete(spark, sf_dir))
    out = []
    for how in ("merge", "insert"):
        path = scratch_path(spark, how)
        for _ in range(2):
            if how == "merge":
                _reconcile(spark, path, rows)
            else:
                insert_new(spark, path, rows)
        stored = merge.read_table(spark, path).select("site", F.lit("STORED").alias("reason"))
        bad = merge.read_rejected(spark, path).select("site", "reason")
        out.append(stored.unionByName(bad).groupBy("site", "reason").agg(F.count(F.lit(1)).alias("n_events")).withColumn(
            "how", F.lit(how)))
    return out[0].unionByName(out[1])


def q36_stored_inputs(spark, sf_dir):
    """Readings, points and states written as tables and read back, for two named sites and half of
    the range, the points merged into the stored ones first: S4 to S6 feeding the flagship plan."""
    readings = A.samples(spark, sf_dir)
    tag_table, state_table = A.tags_and_states(readings)
    raw, point_path, state_path = (scratch_path(spark, n) for n in ("raw", "points", "states"))
    readings.write.partitionBy("site").parquet(raw)
    stored = dims.read_points(spark, point_path)
    dimensions.merge_points(stored, A.points(tag_table)).write.parquet(point_path)
    state_table.write.parquet(state_path)
    first, last = A.day_range(readings)
    middle = first + (last - first) / 2
    chosen = site_source.select_sites(A.sites(tag_table), "site1,site3")
    found = reading_source.read_readings(spark, raw, first, middle, ["site1", "site3"])
    found = found.where(fn.in_range("ts", first, middle))
    events = stored_events(found, chosen, dims.read_points(spark, point_path), dims.read_states(spark, state_path))
    return _iso(events, "timestamp").select(*EVENT_COLUMNS)


def q37_unknown_sites(spark, sf_dir):
    """Which of the asked sites the site table does not have."""
    site_table = A.sites(A.tags(A.samples(spark, sf_dir)))
    return site_source.unknown_sites(site_table, ["site2", "nowhere", "site1", "elsewhere"])


def q38_files_and_paths(spark, sf_dir):
    """Partition folders of the day and site table, with whether each day has files."""
    path = scratch_path(spark, "days")
    tables.overwrite_partitions(tables.with_ingestion_time(_canonical(spark, sf_dir)), path)
    files = tables.files_per_day(spark, path).withColumn("has_files", F.col("n_files") >= 1)
    kept = merge.read_table(spark, path).groupBy("event_date", "site").agg(F.count(F.lit(1)).alias("n_events"))
    folder = F.concat(F.lit("/event_date="), F.col("event_date").cast("string"), F.lit("/site="), F.col("site"))
    sample = kept.select("event_date", "site").orderBy("event_date", "site").first()
    base = tables.partition_path("", str(sample["event_date"]), sample["site"]) if sample else ""
    return kept.join(files, "event_date").select(
        folder.alias("folder"), "n_events", "has_files", (folder == F.lit(base)).alias("is_first"))


def _corrected(rows: DataFrame) -> DataFrame:
    """Events of every fifth id with another value."""
    fifth = F.conv(F.substring("event_id", 1, 4), 16, 10).cast("bigint") % 5 == 0
    return rows.withColumn("value", F.when(fifth, F.concat(F.lit("corrected "), "event_id")).otherwise(F.col("value")))


def q39_retention_after_merge(spark, sf_dir):
    """Days merged, corrected by a second merge and then aged: what is left, and in which folders."""
    rows = materialize(_canonical(spark, sf_dir))
    path = scratch_path(spark, "merged-days")
    _reconcile(spark, path, rows)
    _reconcile(spark, path, _corrected(rows))
    newest = merge.read_table(spark, path).agg(F.max("event_date")).first()[0]
    tables.drop_expired(spark, path, newest, KEEP_DAYS)
    kept = merge.read_table(spark, path).groupBy("event_date", "site").agg(
        F.count(F.lit(1)).alias("n_events"), F.count(F.when(F.col("value").startswith("corrected"), 1)).alias("n_corrected"))
    places = tables.partition_paths(spark, path).select("event_date", "site", F.size("folders").cast("bigint").alias("n_folders"))
    return kept.join(places, ["event_date", "site"], "full_outer").withColumn("event_date", F.col("event_date").cast("string"))


def q40_overwrite_after_merge(spark, sf_dir):
    """Days merged and corrected, then a rerun of one tag over them: a day and site it has is
    replaced whole, the corrections of others stay."""
    rows = materialize(_canonical(spark, sf_dir))
    path = scratch_path(spark, "merged-days")
    _reconcile(spark, path, rows)
    _reconcile(spark, path, _corrected(rows))
    rerun = rows.where((F.col("tag") == "ERROR") & (F.col("quality") == "DIGITAL_STATE"))
    tables.overwrite_partitions(tables.with_ingestion_time(rerun), path)
    kept = _iso(merge.read_table(spark, path), "timestamp")
    return kept.select(F.col("event_date").cast("string"), *EVENT_COLUMNS)


QUERIES: dict[str, Query] = {
    name: made for name, made in sorted(globals().items()) if name[0] == "q" and name[1:3].isdigit()
}

__all__ = ["QUERIES"]
