"""Windows, grids and the value at a grid instant."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tagloom.functions import iso_utc
from tagloom.operators import grid as G
from tagloom.operators.latest import snapshot
from tagloom.operators.reports import task_plan
from tagloom.operators.value_at_time import value_at_time

UTC = timezone.utc


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "a string, b string").select(
        F.col("a").cast("timestamp").alias("range_start"), F.col("b").cast("timestamp").alias("range_end"))


def window_list(df):
    rows = df.select(iso_utc("window_start").alias("a"), iso_utc("window_end").alias("b")).collect()
    return sorted((r.a, r.b) for r in rows)


def test_two_years_in_weeks(spark):
    df = G.split_windows(bounds(spark, "2024-01-01", "2026-01-01"), "range_start", "range_end", 604_800)
    got = window_list(df)
    assert len(got) == 105
    assert got[0][0] == "2024-01-01T00:00:00+00:00" and got[-1][1] == "2026-01-01T00:00:00+00:00"
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_empty_and_reversed_ranges_have_no_window(spark):
    for start, end in [("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-01")]:
        assert G.split_windows(bounds(spark, start, end), "range_start", "range_end", 60).count() == 0


def test_bad_lengths_are_errors(spark):
    with pytest.raises(ValueError):
        G.split_windows(bounds(spark, "2024-01-01", "2024-01-02"), "range_start", "range_end", 0)
    with pytest.raises(ValueError):
        G.GridSpec(at("2024-01-01"), at("2024-01-02"), 0, 60)


def test_each_tag_meets_each_window(spark):
    tags = spark.createDataFrame([("s", "TAG_A"), ("s", "TAG_B")], "site string, tag string")
    span = bounds(spark, "2026-08-26 12:00:00", "2026-08-28 06:00:00").withColumn("site", F.lit("s"))
    df = G.tag_windows(tags, span, 86_400)
    got = sorted(tuple(r) for r in df.select("tag", iso_utc("window_start"), iso_utc("window_end")).collect())
    first = ("2026-08-26T12:00:00+00:00", "2026-08-27T12:00:00+00:00")
    second = ("2026-08-27T12:00:00+00:00", "2026-08-28T06:00:00+00:00")
    assert got == [("TAG_A", *first), ("TAG_A", *second), ("TAG_B", *first), ("TAG_B", *second)]
    spec = G.GridSpec(at("2026-08-26T12:00:00"), at("2026-08-28T06:00:00"), 60, 86_400)
    assert task_plan(tags, spec, 1).first()["n_tasks"] == 4


def test_two_tags_two_minutes(spark):
    tags = spark.createDataFrame([("s", "A"), ("s", "B")], "site string, tag string")
    span = bounds(spark, "2026-01-01 00:00:00", "2026-01-01 00:02:00").withColumn("site", F.lit("s"))
    assert G.sampling_points(G.tag_windows(tags, span, 300), 60).count() == 4


def test_realtime_window(spark):
    now = spark.createDataFrame([("2026-08-30T15:52:00-03:00",)], "t string").select(F.col("t").cast("timestamp").alias("now"))
    progress = now.withColumn("last_end", G.first_realtime_start("now", 60, 120))
    assert window_list(G.realtime_windows(progress, 60, 120)) == [
        ("2026-08-30T18:50:00+00:00", "2026-08-30T18:52:00+00:00")]
    caught_up = now.withColumn("last_end", F.col("now"))
    assert G.realtime_windows(caught_up, 60, 120).count() == 0


@pytest.mark.parametrize("window, interval", [(100, 60), (300, 60), (7, 7), (60, 100), (1000, 1)])
def test_closed_form_equals_generated_grid(spark, window, interval):
    start, end = at("2024-01-01T00:00:03"), at("2024-01-01T00:20:44")
    spec = G.GridSpec(start, end, interval, window)
    df = G.sampling_points(
        G.split_windows(bounds(spark, "2024-01-01 00:00:03", "2024-01-01 00:20:44"), "range_start", "range_end", window),
        interval)
    got = sorted(r[0] for r in df.select(F.unix_micros("ts")).collect())
    cells = spark.range(spec.points).select(spec.instant_micros(F.col("id")).alias("t"), "id")
    assert sorted(r.t for r in cells.collect()) == got
    back = cells.select("id", spec.cell_of(F.timestamp_micros("t")).alias("cell"))
    assert all(r.id == r.cell for r in back.collect())


def brute_force(samples, tags, points):
    """The rules read straight from their statement."""
    out = {}
    for tag in tags:
        mine = sorted((t, istat, v) for s_tag, t, istat, v, status in samples if s_tag == tag and status == 0)
        for g in points:
            before = [s for s in mine if s[0] <= g]
            after = [s for s in mine if s[0] >= g]
            p, n = (before[-1] if before else None), (after[0] if after else None)
            if p and p[0] == g:
                out[tag, g] = (p[2], p[1], False)
            elif p is None:
                out[tag, g] = (None, None, True)
            elif n is None or p[1] < 0 or n[1] < 0:
                out[tag, g] = (p[2], p[1], False)
            else:
                out[tag, g] = (p[2] + (n[2] - p[2]) * (float(g - p[0]) / float(n[0] - p[0])), 0, False)
    return out


@pytest.mark.parametrize("block", [1, 3, 16, 16384])
@pytest.mark.parametrize("limit", [None, 0])
def test_value_at_time_equals_brute_force(spark, block, limit):
    rng = random.Random(block)
    start, end = at("2024-01-01T00:00:00"), at("2024-01-01T01:10:30")
    spec = G.GridSpec(start, end, 60, 1000)
    base = G.to_micros(start)
    tags = ["HOT", "RARE", "BEFORE", "AFTER", "NONE", "EXACT"]
    seen, samples = set(), []

    def add(tag, micros):
        if (tag, micros) not in seen:
            seen.add((tag, micros))
            istat = rng.choice([0, 0, 0, 5, -65537, -131087])
            samples.append((tag, base + micros, istat, round(rng.uniform(-50, 50), 3), rng.choice([0, 0, 0, 0, -11])))

    for _ in range(600):
        add("HOT", rng.randrange(-600_000_000, 5_000_000_000))
    for _ in range(5):
        add("RARE", rng.randrange(0, 4_000_000_000))
    add("BEFORE", -7_000_000_000)
    add("AFTER", 9_000_000_000)
    for i in range(0, 70, 3):
        add("EXACT", i * 60_000_000)
    add("UNLISTED", 0)

    rows = [("s", "srv", t, micros, v, istat, status) for t, micros, istat, v, status in samples]
    df = spark.createDataFrame(rows, "site string, server string, tag string, m bigint, rval double, istat bigint, status bigint")
    df = df.withColumn("ts", F.timestamp_micros("m"))
    tag_df = spark.createDataFrame([("s", "srv", t) for t in tags], "site string, server string, tag string")
    points = [r[0] for r in spark.range(spec.points).select(spec.instant_micros(F.col("id"))).collect()]
    got_df = value_at_time(df, tag_df, spec, cells_per_block=block, broadcast_limit=limit, hot_rows=3)
    got_rows = got_df.select("tag", F.unix_micros("ts").alias("g"), "rval", "istat", "no_data").collect()
    got = {(r.tag, r.g): (r.rval, r.istat, r.no_data) for r in got_rows}
    assert len(got_rows) == len(got) == len(tags) * spec.points
    assert got == brute_force(samples, tags, points)


def test_value_at_time_padding_bounds_the_scan(spark):
    spec = G.GridSpec(at("2024-01-01T01:00:00"), at("2024-01-01T02:00:00"), 600, 3600)
    rows = [("s", "v", "T", "2024-01-01 00:10:00", 1.0, 0, 0), ("s", "v", "T", "2024-01-01 02:30:00", 9.0, 0, 0)]
    df = spark.createDataFrame(rows, "site string, server string, tag string, t string, rval double, istat bigint, status bigint")
    df = df.withColumn("ts", F.col("t").cast("timestamp"))
    tags = df.select("site", "server", "tag").distinct()
    near = value_at_time(df, tags, spec, lookback=timedelta(minutes=10), lookahead=timedelta(0)).collect()
    assert len(near) == 6 and all(r.no_data for r in near)
    wide = value_at_time(df, tags, spec, lookback=timedelta(hours=1), lookahead=timedelta(hours=1)).collect()
    assert not any(r.no_data for r in wide) and all(1.0 < r.rval < 9.0 for r in wide)


def test_empty_grid(spark):
    spec = G.GridSpec(at("2024-01-01T01:00:00"), at("2024-01-01T01:00:00"), 60, 60)
    df = spark.createDataFrame([], "site string, server string, tag string, ts timestamp, rval double, istat bigint, status bigint")
    assert value_at_time(df, df.select("site", "server", "tag"), spec).count() == 0


def test_snapshot(spark):
    rows = [("s", "v", "A", "2024-01-01", 1.0, 0, 0), ("s", "v", "A", "2024-01-03", 3.0, -5, 0), ("s", "v", "A", "2024-01-02", 2.0, 0, 7)]
    df = spark.createDataFrame(rows, "site string, server string, tag string, t string, rval double, istat bigint, status bigint")
    got = snapshot(df.withColumn("ts", F.col("t").cast("timestamp")).drop("t")).collect()
    assert [(r.tag, r.rval, r.istat, r.status) for r in got] == [("A", 3.0, -5, 0)]
