"""Plans: what is scanned, joined and shuffled, and whether it compiles."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import TESTDATA
from tagloom.operators import merge
from tagloom.plans import adapters
from tagloom.schema import EVENT_COLUMNS

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = contract.queries()
# Building these runs streams or writes tables; their result plans are plain scans.
BUILT = [n for n in QUERIES if not re.match(r"q(17_m|23|24|25|26|28|29|33)", n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BUILT)
def test_no_cross_join_and_no_python_worker(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


def test_flagship_broadcasts_its_dimensions_and_prunes_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(QUERIES["q05_canonical_event"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "event_id" not in scan.split("ReadSchema")[1]


def test_generated_methods_can_be_compiled(spark):
    """The JVM leaves methods of more than 8000 bytes interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("q05_canonical_event", "q10_interpolated", "q04_classify", "q31_parse_datetime", "q19_write_requests_valid", "q02_value_text"):
            df = QUERIES[name](spark, SF_DIR)
            text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, (name, max(sizes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_interpolation_scans_once_and_aggregates_by_hash(spark):
    df = QUERIES["q10_interpolated"](spark, SF_DIR)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "SortAggregate" not in final
    assert final.count("FileScan parquet") == 1


def test_time_range_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    adapters.samples(spark, SF_DIR).write.partitionBy("site").parquet(path)
    df = spark.read.parquet(path).where((F.col("ts") >= F.lit("2024-01-05").cast("timestamp")) & (F.col("site") == "site1"))
    plan = plan_of(df.select("rval"))
    assert "PartitionFilters: [isnotnull(site" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_merge_reads_only_the_staged_days(spark, tmp_path):
    path = str(tmp_path / "t")
    events = QUERIES["q05_canonical_event"](spark, SF_DIR).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    merge.reconcile(spark, path, events)
    day = events.where(F.to_date("timestamp") == F.lit("2024-01-05").cast("date")).select(*EVENT_COLUMNS)
    n = day.count()
    assert n > 0
    assert merge.reconcile(spark, path, day) == {"keep": n}
    target = merge.read_table(spark, path).where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    assert target.count() == n
    # The folders of the versions are pruned by day before any file is read.
    assert len(re.findall(r"PartitionFilters: \[[^\]]*event_date", plan_of(target))) >= 1
