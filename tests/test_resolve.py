"""Joins with dimensions, classification, canonical events."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators.canonical import attach_site, canonical_events
from tagloom.operators.enrich import enrich
from tagloom.operators.resolve import resolve_and_classify
from tagloom.schema import EVENT_COLUMNS, EVENT_SCHEMA

READINGS = "site string, server string, tag string, t string, rval double, istat int, status int"


def readings(spark, rows):
    return spark.createDataFrame(rows, READINGS).withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def points(spark):
    return spark.createDataFrame(
        [("s1", "Srv", "A", 7), ("s1", "Srv", "B", -1), ("s1", "SRV", "C", 9), ("s2", "Srv", "A", 8)],
        "site string, server string, tag string, point_id bigint")


def states(spark):
    return spark.createDataFrame(
        [("s1", "srv", -131087, "Shutdown", 2, 15), ("s2", "srv", -131087, "Comm Fail", 2, 15),
         ("s1", "srv", -62914560, "Bad Input", None, None), ("s1", "srv", -65537, None, 1, 1)],
        "site string, server_key string, digital_code bigint, digital_state_name string, digital_set_id bigint,"
        " digital_state_id bigint")


T = "2026-01-01 00:00:00"
ROWS = [
    ("s1", "Srv", "A", T, 42.0, 0, 0),           # number
    ("s1", "Srv", "A", T, 1.0, 0, -11),          # failed read
    ("s1", "Srv", "A", T, 1.0, -131087, -11),    # failed read beats digital
    ("s1", "Srv", "A", T, 1.0, -131087, 0),      # resolved state
    ("s2", "Srv", "A", T, 1.0, -131087, 0),      # same code, other site
    ("s1", "Srv", "A", T, 1.0, -62914560, 0),    # resolved, numbers null in the dimension
    ("s1", "Srv", "A", T, 1.0, -65537, 0),       # resolved without a name
    ("s1", "Srv", "A", T, 1.0, -327689, 0),      # unknown state
    ("s1", "Srv", "B", T, 1.0, -131087, 0),      # failed lookup
    ("s1", "Srv", "C", T, 1.0, 0, 0),            # server case differs: no point
    ("s1", "Srv", "A", T, 1.0, -2147483648, 0),  # smallest code
    ("s1", "Srv", "A", T, None, 3, 0),           # number missing
]
WANT = [
    ("42.0", "GOOD", "numeric", 7, None, None, None, None, 0),
    (None, "BAD_STATUS_-11", "error", 7, None, None, None, None, 0),
    (None, "BAD_STATUS_-11", "error", 7, None, None, None, None, -131087),
    ("Shutdown", "DIGITAL_STATE", "digital", 7, -131087, 2, 15, "Shutdown", -131087),
    ("Comm Fail", "DIGITAL_STATE", "digital", 8, -131087, 2, 15, "Comm Fail", -131087),
    ("Bad Input", "DIGITAL_STATE", "digital", 7, -62914560, None, None, "Bad Input", -62914560),
    (None, "DIGITAL_STATE", "digital", 7, -65537, 1, 1, None, -65537),
    (None, "DIGITAL_STATE", "digital", 7, -327689, 5, 9, None, -327689),
    (None, "BAD_POINT_NOT_FOUND", "numeric", None, None, None, None, None, None),
    (None, "BAD_POINT_NOT_FOUND", "numeric", None, None, None, None, None, None),
    (None, "DIGITAL_STATE", "digital", 7, -2147483648, 32768, 0, None, -2147483648),
    (None, "GOOD", "numeric", 7, None, None, None, None, 3),
]


@pytest.mark.parametrize("limit", [None, 0])
def test_classification(spark, limit):
    numbered = readings(spark, ROWS).withColumn("n", F.monotonically_increasing_id())
    df = resolve_and_classify(numbered, points(spark), states(spark), broadcast_limit=limit, hot_rows=2)
    got = [tuple(r) for r in df.orderBy("n").select(
        "value", "quality", "value_type", "point_id", "digital_code", "digital_set_id", "digital_state_id",
        "digital_state_name", "raw_istat").collect()]
    assert got == WANT


def test_no_data_is_neither_good_nor_digital(spark):
    df = readings(spark, [("s1", "Srv", "A", T, None, None, 0)]).withColumn("no_data", F.lit(True))
    r = resolve_and_classify(df, points(spark), states(spark)).first()
    assert (r.value, r.quality, r.value_type, r.point_id) == (None, "BAD_NO_DATA", "error", 7)


def test_canonical_event(spark):
    df = resolve_and_classify(readings(spark, ROWS), points(spark), states(spark))
    events = canonical_events(df)
    assert events.columns == EVENT_COLUMNS
    assert [f.dataType for f in events.schema] == [f.dataType for f in EVENT_SCHEMA]
    assert {r.source for r in events.collect()} == {"piapi"}


def test_attach_site_stamps_source_and_server(spark):
    sites = spark.createDataFrame([("s1", "New", "pi-simulator")], "site string, server string, source string")
    got = attach_site(readings(spark, ROWS), sites).select("site", "server", "source").distinct().collect()
    assert [tuple(r) for r in got] == [("s1", "New", "pi-simulator")]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_join_equals_broadcast_join(spark, how):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("unused", 4)], "k string, v int")
    a = enrich(fact, dim, ["k"], ["id"], how=how)
    b = enrich(fact, dim, ["k"], ["id"], how=how, broadcast_limit=0, hot_rows=5)
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_salted_join_spreads_hot_and_null_keys(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 8000
        for hot in (F.lit("hot"), F.lit(None).cast("string")):
            fact = spark.range(n).select(hot.alias("k"), "id")
            dim = spark.createDataFrame([("hot", 1)], "k string, v int")
            joined = enrich(fact, dim, ["k"], ["id"], broadcast_limit=0, hot_rows=125)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < n / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
