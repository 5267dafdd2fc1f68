"""Dimension merges, event merge, table sinks, retention, chunks, reports."""

import glob
import json
import os
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagloom.functions import event_id
from tagloom.operators import chunks, dimensions, latest, merge, reports, writeback
from tagloom.schema import EVENT_COLUMNS, EVENT_SCHEMA
from tagloom.sinks import choose_sink, current, tables
from tagloom.sinks.inserts import insert_new
from tagloom.sinks.registry import with_retry
from tagloom.sources import dimensions as dims
from tagloom.sources.events import read_event_jsonl

POINT = "site string, server string, tag string, point_id bigint"
STATE = "site string, server string, digital_code bigint, digital_state_name string, digital_set_id bigint, digital_state_id bigint"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def events(spark, rows, **extra):
    """rows: (site, tag, time, value) with optional quality."""
    full = [(r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else "GOOD") for r in rows]
    df = spark.createDataFrame(full, "site string, tag string, t string, value string, quality string")
    df = df.withColumn("timestamp", F.col("t").cast("timestamp"))
    made = {f.name: F.lit(None).cast(f.dataType) for f in EVENT_SCHEMA}
    made.update(source=F.lit("piapi"), server=F.lit("srv"), value_type=F.lit("numeric"),
                event_id=event_id("site", "tag", "timestamp"))
    made.update({c: F.col(c) for c in ("site", "tag", "timestamp", "value", "quality")})
    made.update(extra)
    return df.select(*[made[c].alias(c) for c in EVENT_COLUMNS])


def stored(spark, path):
    return rows_of(merge.read_table(spark, path).select("site", "tag", F.col("timestamp").cast("string"), "value", "quality"))


# dimensions

def test_point_merge(spark):
    current = spark.createDataFrame([("s1", "v", "A", 1), ("s1", "v", "B", -1), ("s2", "v", "A", 5)], POINT)
    fresh = spark.createDataFrame(
        [("s1", "v", "OK_TAG", 123), ("s1", "v", "MISSING_TAG", -1), ("s1", "v", "A", 2), ("s2", "v", "A", None)], POINT)
    merged = dimensions.merge_points(current, fresh)
    assert rows_of(merged) == [("s1", "v", "A", 2), ("s1", "v", "OK_TAG", 123), ("s2", "v", "A", 5)]
    assert rows_of(dimensions.merge_points(merged, fresh)) == rows_of(merged)


def test_state_merge_keeps_names_and_isolates_sites(spark):
    none = spark.createDataFrame([], STATE)
    first = dimensions.merge_states(none, spark.createDataFrame(
        [("s1", "Srv-1", -62914560, "Shutdown", 960, 0), ("s2", "Srv-2", -62914560, "Comm Fail", 960, 0),
         ("s1", "Srv-1", -5, None, 0, 5)], STATE))
    again = dimensions.merge_states(first, spark.createDataFrame(
        [("s1", "SRV-1", -62914560, None, 1, 1), ("s1", "SRV-1", -5, "Found", 0, 5)], STATE))
    got = {(r.site, r.server_key, r.digital_code): r.digital_state_name for r in again.collect()}
    assert got == {("s1", "srv-1", -62914560): "Shutdown", ("s2", "srv-2", -62914560): "Comm Fail", ("s1", "srv-1", -5): "Found"}
    assert rows_of(dimensions.merge_states(again, none)) == rows_of(again)


def test_dimension_files(spark, tmp_path):
    assert dims.read_points(spark, str(tmp_path / "none")).count() == 0
    assert dims.read_states(spark, str(tmp_path / "none")).count() == 0
    path = str(tmp_path / "points")
    spark.createDataFrame([("s1", "v", "A", 1), ("s1", "V", "B", 2), ("s2", "v", "A", 3)], POINT).write.parquet(path)
    assert rows_of(dims.read_points(spark, path, "s1", "v")) == [("s1", "v", "A", 1)]
    spath = str(tmp_path / "states")
    dimensions.merge_states(spark.createDataFrame([], STATE), spark.createDataFrame(
        [("s1", "Srv", -5, "X", 0, 5)], STATE)).write.parquet(spath)
    assert dims.read_states(spark, spath, "s1", "sRV").first()["digital_state_name"] == "X"
    assert dims.read_states(spark, spath, "s1", "other").count() == 0


def test_nested_json(spark):
    docs = [json.dumps({"sites": {"s1": {"servers": {"V": {"tags": {"A": 1, "B": 2}}}}, "s2": {"servers": {"W": {"tags": {}}}}}}),
            "{broken", "[]"]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    assert rows_of(dims.import_point_json(df)) == [("s1", "V", "A", 1), ("s1", "V", "B", 2)]
    states = {"s1": {"v": {"-5": {"digital_state_name": "On"}, "-6": {"digital_code": -7, "source": "x", "digital_set_id": 1}}}}
    got = rows_of(dims.import_state_json(spark.createDataFrame([(json.dumps(states),), ("{",)], "value string")))
    assert got == [("s1", "v", -5, "On", None, None, "cache"), ("s1", "v", -7, None, 1, None, "x")]


# event merge

DAY = [("s1", "A", "2026-01-01 10:00:00", "1.0"), ("s1", "B", "2026-01-01 11:00:00", "2.0"),
       ("s2", "A", "2026-01-01 10:00:00", "3.0"), ("s1", "A", "2026-01-02 10:00:00", "4.0")]


def test_merge_inserts_updates_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    assert merge.reconcile(spark, path, events(spark, DAY)) == {"insert": 4}
    staged = events(spark, [("s1", "A", "2026-01-01 10:00:00", "9.0"), ("s1", "C", "2026-01-01 23:59:59.999999", "5.0"),
                            ("s1", "B", "2026-01-01 11:00:00", "2.0", "OTHER")])
    counts = merge.reconcile(spark, path, staged)
    assert counts == {"insert": 1, "update": 1, "keep": 1}
    want = sorted([(*DAY[1], "GOOD"), (*DAY[2], "GOOD"), (*DAY[3], "GOOD"), ("s1", "A", "2026-01-01 10:00:00", "9.0", "GOOD"),
                   ("s1", "C", "2026-01-01 23:59:59.999999", "5.0", "GOOD")], key=repr)
    assert stored(spark, path) == want
    before = merge.read_table(spark, path).select("event_id", "ingestion_timestamp").collect()
    assert merge.reconcile(spark, path, staged) == {"keep": 4 - 1}
    assert sorted(before) == sorted(merge.read_table(spark, path).select("event_id", "ingestion_timestamp").collect())
    assert merge.reconcile(spark, path, staged, compare="all") == {"keep": 2, "update": 1}


def test_merge_writes_only_changed_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.reconcile(spark, path, events(spark, DAY))
    merge.reconcile(spark, path, events(spark, [("s1", "A", "2026-01-01 10:00:00", "9.0"), ("s2", "A", "2026-01-01 10:00:00", "3.0")]))
    places = lambda: {tuple(r) for r in current.listed(spark, path).select(F.col("event_date").cast("string"), "site", "folder").collect()}
    older = {folder for _, _, folder in places()}
    written = {(day, site): folder for day, site, folder in places()}
    assert written.keys() == {("2026-01-01", "s1"), ("2026-01-01", "s2"), ("2026-01-02", "s1")} and len(older) == 2
    second = {p.split("/folder=")[1] for p in glob.glob(f"{path}/_rows/*/*/*") if written["2026-01-01", "s1"] in p}
    assert second == {f"{written['2026-01-01', 's1']}/event_date=2026-01-01/site=s1"}
    # New rows are added beside the stored ones; unchanged ones write nothing.
    merge.reconcile(spark, path, events(spark, [("s2", "B", "2026-01-01 10:00:00", "9.0"), DAY[3]]))
    (added,) = {folder for _, _, folder in places()} - older
    assert [(r.site, r.tag) for r in spark.read.parquet(f"{path}/_rows/folder={added}").collect()] == [("s2", "B")]
    assert merge.reconcile(spark, path, events(spark, DAY[1:2])) == {"keep": 2} and current.current(spark, path).number == 3


INCOMPLETE = [(None, "A", "2026-01-01 10:00:00", "1"), ("s1", None, "2026-01-01 10:00:00", "2"), ("s1", None, "2026-01-01 11:00:00", "3"),
              ("s1", "A", None, "4"), ("", "A", "2026-01-01 10:00:00", "5")]


@pytest.mark.parametrize("how", ["merge", "insert"])
def test_events_without_a_key_are_set_aside(spark, tmp_path, how):
    path = str(tmp_path / "t")
    batch = events(spark, DAY + INCOMPLETE)
    run = (lambda: merge.reconcile(spark, path, batch)) if how == "merge" else (lambda: insert_new(spark, path, batch))
    assert run() == {"insert": 4, "reject": 5}
    assert run() == ({"keep": 4, "reject": 5} if how == "merge" else {"insert": 0, "reject": 5})
    assert stored(spark, path) == sorted([(*r, "GOOD") for r in DAY], key=repr)
    reasons = [r.reason for r in merge.read_rejected(spark, path).orderBy("value").collect()]
    assert reasons == ["NO_SITE", "NO_TAG", "NO_TAG", "NO_TIMESTAMP", "NO_SITE"]


def test_interrupted_merge_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge.reconcile(spark, path, events(spark, DAY))
    before = stored(spark, path)
    changed = events(spark, [("s1", "A", "2026-01-01 10:00:00", "9.0"), ("s3", "A", "2026-01-05 10:00:00", "1.0")])

    def broken(*args):
        raise RuntimeError("lost between the rows and the commit")

    with monkeypatch.context() as m:
        m.setattr(current, "put_pointer", broken)
        with pytest.raises(RuntimeError):
            merge.reconcile(spark, path, changed)
    assert len(os.listdir(f"{path}/_rows")) == 2 and stored(spark, path) == before
    assert merge.reconcile(spark, path, changed) == {"insert": 1, "update": 1, "keep": 1}
    assert len(stored(spark, path)) == 5 and ("s1", "A", "2026-01-01 10:00:00", "9.0", "GOOD") in stored(spark, path)


def test_interrupted_archive_put_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def requests(*rows):
        df = spark.createDataFrame(list(rows), "tag string, t string, value double, a string, message_id string")
        return df.select(F.lit("s1").alias("site"), F.lit("v").alias("server"), "tag", F.col("t").cast("timestamp").alias("ts"), "value",
                         F.lit(0).cast("bigint").alias("istat"), F.col("a").cast("timestamp").alias("arrival"), "message_id",
                         F.lit(None).cast("string").alias("reason"))

    read = lambda: rows_of(writeback.read_archive(spark, path).select("tag", "rval", "message_id"))
    assert writeback.put_archive(spark, path, requests(("A", "2026-01-01", 1.0, "2026-02-01", "m1"), ("B", "2026-01-01", 2.0, "2026-02-01", "m2"))) == {"insert": 2}
    later = requests(("A", "2026-01-01", 3.0, "2026-02-02", "m3"), ("B", "2026-01-01", 9.0, "2026-01-31", "m0"), ("C", "2026-01-02", 4.0, "2026-02-02", "m4"))
    with monkeypatch.context() as m:
        m.setattr(current, "put_pointer", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            writeback.put_archive(spark, path, later)
    assert read() == [("A", 1.0, "m1"), ("B", 2.0, "m2")]
    assert writeback.put_archive(spark, path, later) == {"insert": 1, "update": 1, "keep": 1}
    assert read() == [("A", 3.0, "m3"), ("B", 2.0, "m2"), ("C", 4.0, "m4")]
    assert writeback.put_archive(spark, path, later).keys() == {"keep"}


def test_closed_days_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    for hour in range(6):
        insert_new(spark, path, events(spark, [("s1", "A", f"2026-01-0{d} 1{hour}:00:00", "1") for d in (1, 2)]))
    rows = stored(spark, path)
    files = lambda: {str(r.event_date): r.n_files for r in tables.files_per_day(spark, path).collect()}
    assert files() == {"2026-01-01": 6, "2026-01-02": 6}
    assert current.rewrite_days(spark, path, merge.TABLE_SCHEMA, date(2026, 1, 2)) == 1
    assert stored(spark, path) == rows and files() == {"2026-01-01": 1, "2026-01-02": 6}
    assert current.rewrite_days(spark, path, merge.TABLE_SCHEMA, date(2026, 1, 2)) == 0
    assert current.rewrite_days(spark, path, merge.TABLE_SCHEMA, date(2026, 1, 3)) == 1
    assert len(current.drop_unlisted(spark, path)) == 6 and len(os.listdir(f"{path}/_rows")) == 2
    assert stored(spark, path) == rows and files() == {"2026-01-01": 1, "2026-01-02": 1}


TEN_DAYS = [(s, "A", f"2026-01-{d:02d} 0{h}:00:00", "X") for s in ("s1", "s2") for d in range(1, 11) for h in range(3)]


def test_retention_after_merges(spark, tmp_path):
    """Of a plain table merged into, of merged rows and of inserted ones."""
    path = str(tmp_path / "t")
    tables.overwrite_partitions(tables.with_ingestion_time(events(spark, TEN_DAYS[:40])), path)
    merge.reconcile(spark, path, events(spark, TEN_DAYS))
    merge.reconcile(spark, path, events(spark, [(*r[:3], "Y") for r in TEN_DAYS[::6]]))
    insert_new(spark, path, events(spark, [(r[0], "B", r[2], "Z") for r in TEN_DAYS]))
    whole = stored(spark, path)
    assert len(whole) == 120
    assert tables.drop_expired(spark, path, date(2026, 1, 10), 7) == ["2026-01-01", "2026-01-02"]
    left = [r for r in whole if r[2] >= "2026-01-03"]
    assert stored(spark, path) == left and len(left) == 96
    assert not glob.glob(f"{path}/**/event_date=2026-01-0[12]", recursive=True)
    assert tables.drop_expired(spark, path, date(2026, 1, 10), 7) == []
    # What comes back for a dropped day is new.
    assert merge.reconcile(spark, path, events(spark, TEN_DAYS[:1]))["insert"] == 1
    assert len(stored(spark, path)) == 97


def test_overwrite_after_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.reconcile(spark, path, events(spark, TEN_DAYS))
    merge.reconcile(spark, path, events(spark, [(*r[:3], "Y") for r in TEN_DAYS[::2]]))
    again = [r for r in TEN_DAYS if r[0] == "s1" and r[2] < "2026-01-04"]
    sink = choose_sink("historical", "parquet", path=path)
    for value in ("Z", "W"):
        sink(tables.with_ingestion_time(events(spark, [(*r[:3], value) for r in again[1:]])))
        assert [r for r in stored(spark, path) if r[0] == "s1" and r[2] < "2026-01-04"] == [(*r[:3], value, "GOOD") for r in again[1:]]
    assert len(stored(spark, path)) == len(TEN_DAYS) - 1
    assert sum(r.n_files for r in tables.files_per_day(spark, path).collect()) == 20
    places = {(str(r.event_date), r.site): r.folders for r in tables.partition_paths(spark, path).collect()}
    assert len(places) == 20 and all(len(f) == 1 and glob.glob(f"{f[0]}/*.parquet") for f in places.values())
    assert places["2026-01-01", "s1"] != places["2026-01-01", "s2"]
    with pytest.raises(ValueError, match="parquet only"):
        tables.overwrite_partitions(events(spark, DAY), path, file_format="jsonl")


def test_second_writer_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.reconcile(spark, path, events(spark, DAY[:1]))
    at = current.current(spark, path)
    insert_new(spark, path, events(spark, DAY[1:2]))
    rows = tables.with_event_date(tables.with_ingestion_time(events(spark, DAY[2:3])))
    with pytest.raises(current.ConcurrentWriteError):
        current.add_rows(rows, path, at)
    assert len(stored(spark, path)) == 2
    current.add_rows(rows, path, current.current(spark, path))
    assert len(stored(spark, path)) == 3


def test_partitions_without_site_or_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = tables.with_ingestion_time(events(spark, [(None, "A", "2026-01-01", "1"), ("s1", "A", None, "2"), *DAY]))
    tables.overwrite_partitions(rows, path)
    merge.reconcile(spark, path, events(spark, DAY))
    assert len(stored(spark, path)) == 6
    tables.overwrite_partitions(rows.where("site IS NULL OR timestamp IS NULL").withColumn("value", F.lit("9")), path)
    assert sorted(r[3] for r in stored(spark, path) if r[0] is None or r[2] is None) == ["9", "9"]


def test_table_written_plainly_can_be_merged_into(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(tables.with_ingestion_time(events(spark, DAY)), path)
    assert merge.reconcile(spark, path, events(spark, [(*DAY[0][:3], "9.0")])) == {"update": 1, "keep": 1}
    assert sorted(r[3] for r in stored(spark, path)) == ["2.0", "3.0", "4.0", "9.0"]


def test_merge_in_two_steps_equals_one(spark, tmp_path):
    a, b = events(spark, DAY[:2]), events(spark, DAY[1:])
    merge.reconcile(spark, str(tmp_path / "two"), a)
    merge.reconcile(spark, str(tmp_path / "two"), b)
    merge.reconcile(spark, str(tmp_path / "one"), a.unionByName(b))
    assert stored(spark, str(tmp_path / "two")) == stored(spark, str(tmp_path / "one"))


def test_conflicting_copies(spark, tmp_path):
    twice = events(spark, [DAY[0], (*DAY[0][:3], "7.0")])
    with pytest.raises(PySparkException, match="conflicting staged rows"):
        merge.reconcile(spark, str(tmp_path / "t"), twice)
    merge.reconcile(spark, str(tmp_path / "t"), twice, on_conflict="latest", newest_by=["value"])
    assert [r[3] for r in stored(spark, str(tmp_path / "t"))] == ["7.0"]
    with pytest.raises(ValueError):
        merge.unique_staging(twice, "latest")


def test_exact_copies_with_nulls_collapse(spark):
    one = events(spark, [(*DAY[0][:3], None)])
    assert merge.unique_staging(one.unionByName(one)).count() == 1


# sinks

def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sink = choose_sink("historical", "parquet", path=path)
    sink(events(spark, DAY))
    sink(events(spark, [DAY[0]]))
    sink(events(spark, [DAY[0]]))
    got = rows_of(spark.read.parquet(path).select("site", "tag", F.col("event_date").cast("string")))
    assert got == [("s1", "A", "2026-01-01"), ("s1", "A", "2026-01-02"), ("s2", "A", "2026-01-01")]
    assert os.path.isdir(tables.partition_path(path, "2026-01-01", "s1"))
    files = {str(r.event_date): r.n_files for r in tables.files_per_day(spark, path).collect()}
    assert files == {"2026-01-01": 2, "2026-01-02": 1}


def test_jsonl_partitions_hold_whole_events(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(events(spark, DAY), path, file_format="jsonl")
    lines = [json.loads(x) for f in glob.glob(f"{path}/*/*/*.txt") for x in open(f)]
    assert len(lines) == 4 and all(list(x) == EVENT_COLUMNS for x in lines)
    assert {x["timestamp"] for x in lines} >= {"2026-01-02T10:00:00Z"}


def test_jsonl_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = events(spark, [("s1", "Ação", "2026-01-01 10:00:00.5", None), DAY[1]])
    sink = choose_sink("realtime", "file", path=path)
    sink(rows)
    sink(rows)
    text = [x for f in glob.glob(f"{path}/*.txt") for x in open(f, encoding="utf-8")]
    assert len(text) == 4 and any('"Ação"' in x for x in text) and all('"digital_code":null' in x for x in text)
    back = read_event_jsonl(spark, path)
    assert back.schema == EVENT_SCHEMA
    assert rows_of(back.distinct()) == rows_of(rows)


def test_malformed_line_is_an_error(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"site":"s"}\n{oops\n')
    with pytest.raises(Exception, match="FAILFAST"):
        read_event_jsonl(spark, str(tmp_path)).collect()


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60_000).select(
        F.lit("s1").alias("site"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("tag"),
        F.lit("2026-01-01").alias("t"), F.md5(F.col("id").cast("string")).alias("value"))
    df = rows.withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
    try:
        tables.overwrite_partitions(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    written = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(written) >= 4 and max(r["count"] for r in written) < 30_000
    assert sum(r["count"] for r in written) == 60_000


def test_rewritten_days_are_clustered_by_tag(spark, tmp_path):
    """One (day, site) with most of the rows: a tag lies in few of its files, by their statistics."""
    path = str(tmp_path / "t")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 == 0, "s2").otherwise("s1").alias("site"), F.format_string("T%02d", F.pmod(F.xxhash64("id"), F.lit(40))).alias("tag"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id")).alias("timestamp"), F.col("id").cast("string").alias("value"))
    given = {f.name for f in rows.schema}
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA if f.name not in given])
    rows = rows.withColumn("event_id", event_id("site", "tag", "timestamp"))
    for half in range(2):
        insert_new(spark, path, rows.where(F.col("value").cast("int") % 2 == half))
    whole = stored(spark, path)
    assert current.rewrite_days(spark, path, merge.TABLE_SCHEMA, date(2026, 1, 2), rows_per_file=2_500) == 1
    assert stored(spark, path) == whole
    files = current.read_current(spark, path, merge.TABLE_SCHEMA, files=True).where("site = 's1'").groupBy("file").agg(
        F.min("tag").alias("lo"), F.max("tag").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
    assert len(files) >= 9 and max(r.n for r in files) < 5_000
    for k in range(40):
        assert sum(r.lo <= f"T{k:02d}" <= r.hi for r in files) <= 2


def test_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(events(spark, [("s", "A", f"2026-01-{d:02d}", "1") for d in range(1, 11)]), path)
    dropped = tables.drop_expired(spark, path, date(2026, 1, 10), 7)
    assert dropped == ["2026-01-01", "2026-01-02"]
    assert merge.read_table(spark, path).count() == 8


def test_insert_ignores_stored_ids(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = events(spark, [DAY[0], DAY[0], DAY[3]])
    insert_new(spark, path, batch)
    insert_new(spark, path, batch)
    insert_new(spark, path, events(spark, DAY[:1]).where("false"))
    assert stored(spark, path) == sorted([(*DAY[0], "GOOD"), (*DAY[3], "GOOD")], key=repr)
    assert merge.read_table(spark, path).where("ingestion_timestamp IS NULL").count() == 0


def test_console_prints_counts_only(spark, capsys):
    choose_sink("realtime", "console")(events(spark, DAY))
    out = capsys.readouterr().out
    assert "s1 (srv): published batch of 3 events" in out and "s2 (srv): published batch of 1 events" in out


@pytest.mark.parametrize("mode, name", [("historical", "kafka"), ("realtime", "parquet"), ("realtime", "nothing"), ("other", "file")])
def test_sink_not_allowed(mode, name):
    with pytest.raises(ValueError):
        choose_sink(mode, name, path="x")


def test_sink_without_its_options():
    with pytest.raises(ValueError, match="not configured"):
        choose_sink("realtime", "kafka")


def test_unknown_sink_options():
    with pytest.raises(ValueError, match="no option pth"):
        choose_sink("realtime", "file", path="x", pth="y")


def test_retry_counts_failures():
    calls = []

    def flaky(_):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("away")

    with_retry(flaky, retries=2, sleep_seconds=0)(None)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        with_retry(flaky, retries=1, sleep_seconds=0)(None)


# latest, chunks, reports

def test_deduplicate_is_order_free(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "event_id string, n int, v string").repartition(3)
        assert rows_of(latest.deduplicate(df, ["n"])) == [("a", 2, "z"), ("b", 1, None)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_chunks(spark, partitions):
    df = spark.createDataFrame([("s", i) for i in (3, 1, 5, 2, 4)] + [("t", 1)], "g string, n int")
    got = rows_of(chunks.chunk_ids(df, "g", "n", 2, partitions))
    assert got == [("s", 1, 0), ("s", 2, 0), ("s", 3, 1), ("s", 4, 1), ("s", 5, 2), ("t", 1, 0)]
    with pytest.raises(ValueError):
        chunks.chunk_ids(df, "g", "n", 0)


def test_chunks_of_one_large_group(spark):
    df = spark.range(20_000).select(F.lit("s").alias("g"), (F.col("id") * 7919 % 20_011).alias("n"))
    placed = chunks.dense_position(df, "g", "n", 8)
    assert [r[0] for r in placed.orderBy("n").select("position").collect()] == list(range(1, 20_001))


def test_reports(spark):
    counts = {(str(r.event_date), r.site): r.n_events for r in reports.events_per_day_and_site(events(spark, DAY)).collect()}
    assert counts == {("2026-01-01", "s1"): 2, ("2026-01-01", "s2"): 1, ("2026-01-02", "s1"): 1}
    sites = spark.createDataFrame([("s1", True), ("s2", False), ("s3", True)], "site string, enabled boolean")
    tags = spark.createDataFrame([("s1", "A"), ("s1", "A"), ("s1", "B"), ("s2", "A")], "site string, tag string")
    assert rows_of(reports.tags_per_site(tags, sites)) == [("s1", 2), ("s3", 0)]
