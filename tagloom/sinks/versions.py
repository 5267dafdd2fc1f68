"""Partitioned tables that change by whole versions.

Rows lie in ``<path>/event_date=…/site=…`` (version 0, as plain writers leave them) and in
``<path>/_versions/version=<n>/event_date=…/site=…``. Version n counts from the moment its commit
file ``_versions/_commits/version=<n>/part-….parquet`` is there. That file is written last, by a
rename of one file, and names the (day, site) partitions which version n replaces: readers take
those from version n on only. Nothing that readers may see is ever deleted or overwritten before
that, so a write that dies at any moment leaves the table as it was, and running it again
overwrites what the dead one left. One writer at a time.

``compact_days`` gathers a day's pieces, ``vacuum`` removes what later versions replaced; run it
when no reader of older versions is left.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tagloom.session import drop_scratch, scratch_path

PARTITION = ["event_date", "site"]
KEEP, INSERT, UPDATE = "keep", "insert", "update"

_COMMIT = T.StructType([
    T.StructField("event_date", T.DateType()), T.StructField("site", T.StringType()), T.StructField("version", T.LongType()),
])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _root(path: str) -> str:
    return f"{path.rstrip('/')}/_versions"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{_root(path)}/_commits", _COMMIT)


def last_version(spark: SparkSession, path: str) -> int:
    return _commits(spark, path).agg(F.max("version")).first()[0] or 0


def _replaced(commits: DataFrame) -> DataFrame:
    return commits.where("event_date IS NOT NULL").groupBy(*PARTITION).agg(F.max("version").alias("since"))


def _all_rows(spark: SparkSession, path: str, schema: T.StructType, last: int) -> DataFrame:
    base = read_or_empty(spark, path, schema).withColumn("version", F.lit(0).cast("bigint"))
    if not last:
        return base
    numbered = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    later = read_or_empty(spark, _root(path), numbered).where(F.col("version") <= last)
    return base.unionByName(later)


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of its last committed version; empty where nothing was written yet."""
    last = last_version(spark, path)
    rows = _all_rows(spark, path, schema, last)
    names = schema.fieldNames()
    if not last:
        return rows.select(*names)
    since = _replaced(_commits(spark, path).where(F.col("version") <= last))
    since = since.select(*[F.col(c).alias(f"r_{c}") for c in PARTITION], "since")
    same = (F.col("event_date") == F.col("r_event_date")) & F.col("site").eqNullSafe(F.col("r_site"))
    current = rows.join(since, same, "left").where(F.col("version") >= F.coalesce("since", F.lit(0)))
    return current.select(*names)


def write_version(rows: DataFrame, path: str, replaced: DataFrame | None = None, max_records_per_file: int = 0) -> None:
    """Write ``rows`` as the next version. ``replaced(event_date, site)``: the partitions that it
    holds in full; in others its rows are added."""
    from tagloom.sinks.tables import clustered

    spark = rows.sparkSession
    version = last_version(spark, path) + 1
    (
        clustered(rows).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION).parquet(f"{_root(path)}/version={version}")
    )
    commit(spark, path, version, replaced)


def commit(spark: SparkSession, path: str, version: int, replaced: DataFrame | None) -> None:
    mark = spark.createDataFrame([(None, None)], T.StructType(_COMMIT.fields[:2]))
    names = mark if replaced is None else mark.unionByName(replaced.select(*PARTITION).distinct())
    names.coalesce(1).write.mode("overwrite").parquet(f"{_root(path)}/_commits/version={version}")


def merge_into(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    staged: DataFrame,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
    max_records_per_file: int = 0,
) -> dict[str, int]:
    """Merge ``staged``, stored rows with non-null partition columns, and return rows per action.

    ``merged(target, staged)`` gives the rows of the merged table with their ``action``. The first
    pass only counts actions per partition and reads the columns this needs. The second writes:
    partitions with an update in full, of those with inserts only the inserted rows, and nothing
    of the others.
    """
    table = read_versions(spark, path, schema)
    pairs = staged.select(*PARTITION).distinct()
    tally_path = scratch_path(spark, "tally")
    actions = merged(table.join(pairs, PARTITION, "left_semi"), staged)
    actions.groupBy(*PARTITION, "action").agg(F.count(F.lit(1)).alias("n")).write.parquet(tally_path)
    tally = spark.read.parquet(tally_path)
    counts = {r["action"]: r["n"] for r in tally.groupBy("action").agg(F.sum("n").alias("n")).collect()}
    if counts.keys() - {KEEP}:
        flags = tally.groupBy(*PARTITION).agg(
            F.max(F.col("action") == UPDATE).alias("rewrite"), F.max(F.col("action") != KEEP).alias("touched")
        ).where("touched").drop("touched")
        due = [df.join(flags.select(*PARTITION), PARTITION, "left_semi") for df in (table, staged)]
        rows = merged(*due).join(flags, PARTITION).where(F.col("rewrite") | (F.col("action") == INSERT))
        write_version(rows.select(*schema.fieldNames()), path, flags.where("rewrite"), max_records_per_file)
    drop_scratch(spark, tally_path)
    return counts


def compact_days(spark: SparkSession, path: str, schema: T.StructType, before: date) -> int:
    """Gather the pieces of (day, site) partitions of closed days; returns how many there were."""
    last = last_version(spark, path)
    since = _replaced(_commits(spark, path))
    pieces = _all_rows(spark, path, schema, last).where(F.col("event_date") < F.lit(before))
    pieces = pieces.select(*PARTITION, "version").distinct().join(since, PARTITION, "left")
    pieces = pieces.where(F.col("version") >= F.coalesce("since", F.lit(0)))
    many = pieces.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    path_many = scratch_path(spark, "pieces")
    many.write.parquet(path_many)
    many = spark.read.parquet(path_many)
    found = many.count()
    if found:
        rows = read_versions(spark, path, schema).join(many.select(*PARTITION), PARTITION, "left_semi")
        write_version(rows.select(*schema.fieldNames()), path, many)
    drop_scratch(spark, path_many)
    return found


def vacuum(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Delete partitions of versions that a later one replaces; returns how many. Their names go
    through the driver one by one."""
    last = last_version(spark, path)
    stored = _all_rows(spark, path, schema, last).select(*PARTITION, "version").distinct()
    old = stored.join(_replaced(_commits(spark, path)), PARTITION).where("version < since")
    gone = 0
    for r in old.toLocalIterator():
        base = path.rstrip("/") if r["version"] == 0 else f"{_root(path)}/version={r['version']}"
        drop_scratch(spark, f"{base}/event_date={r['event_date']}/site={r['site']}")
        gone += 1
    return gone
