"""Tables of which whole (day, site) partitions are replaced by switching one pointer.

Rows lie in ``<path>/event_date=…/site=…``, as plain writers leave them, until something is merged
in. From then on the table has a listing: for every (day, site) the folders that hold its rows,
which are ``<path>/_rows/folder=<id>/event_date=…/site=…`` or the plain one. Every writer (merge,
insert, overwrite, retention, rewrite) writes its rows and the whole next listing aside, and last of
all renames one small file to ``<path>/_current/<n + 1>``, which names that listing. Readers take the
newest pointer: a write that dies before the rename has changed nothing, and running it again gives the same
table. The rename fails where n + 1 is there already, so the second of two writers fails too.

Rows that were replaced stay for readers that began earlier; :func:`drop_unlisted` removes folders
that hold none of the table any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import drop_scratch, scratch_path

PARTITION = ["event_date", "site"]
KEEP, INSERT, UPDATE = "keep", "insert", "update"
#: The folder of rows that a plain writer left.
PLAIN = ""
#: Where the summaries of the rows' folders lie.
SUMMARY = "_summary"
Summarise = Callable[[DataFrame], DataFrame]
#: Rows of a file that a rewrite of days aims at.
ROWS_PER_FILE = 2_000_000
#: So many older pointers and listings are kept for readers that began earlier.
KEPT_POINTERS = 10

PAIR = T.StructType([T.StructField("event_date", T.DateType()), T.StructField("site", T.StringType())])
_LISTING = T.StructType([*PAIR.fields, T.StructField("folder", T.StringType())])


class ConcurrentWriteError(RuntimeError):
    """Another writer changed the table first."""


class Current(NamedTuple):
    """What a pointer says: its number, and the listing it names (none for a plain table)."""

    number: int
    listing: DataFrame | None


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, files: bool = False) -> DataFrame:
    """Parquet rows at ``path``, none where there is nothing; ``files`` adds the ``file`` of each."""
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        none = spark.createDataFrame([], schema)
        return none.withColumn("file", F.lit(None).cast("string")) if files else none
    return rows.select("*", F.col("_metadata.file_path").alias("file")) if files else rows


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    files, folder = _files(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []


def current(spark: SparkSession, path: str) -> Current:
    path = path.rstrip("/")
    numbers = [int(name) for name in names_in(spark, f"{path}/_current") if name.isdigit()]
    if not numbers:
        return Current(0, None)
    files, pointer = _files(spark, f"{path}/_current/{max(numbers):012d}")
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(pointer), "UTF-8"))
    name = reader.readLine()
    reader.close()
    return Current(max(numbers), spark.read.schema(_LISTING).parquet(f"{path}/_listed/{name}"))


def _matching(rows: DataFrame, pairs: DataFrame, names: list[str], how: str = "left_semi") -> DataFrame:
    """Rows that have a match in ``pairs``, or none (``left_anti``). Nulls match nulls."""
    named = pairs.select(*[F.col(c).alias(f"m_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"m_{c}"))
    return rows.join(named, same, how)


def read_current(
    spark: SparkSession, path: str, schema: T.StructType, at: Current | None = None, files: bool = False
) -> DataFrame:
    """The rows of the table, with ``folder`` and ``file`` too if ``files``; empty where nothing was
    written yet."""
    path = path.rstrip("/")
    at = current(spark, path) if at is None else at
    names = [*schema.fieldNames(), *(["folder", "file"] if files else [])]
    plain = read_or_empty(spark, path, schema, files).withColumn("folder", F.lit(PLAIN))
    if at.listing is None:
        return plain.select(*names)
    numbered = T.StructType([*schema.fields, T.StructField("folder", T.StringType())])
    rows = plain.unionByName(read_or_empty(spark, f"{path}/_rows", numbered, files))
    return _matching(rows, at.listing, [*PARTITION, "folder"]).select(*names)


def listed(spark: SparkSession, path: str, at: Current | None = None) -> DataFrame:
    """(event_date, site, folder) of the table as it is now, from names alone."""
    at = current(spark, path) if at is None else at
    if at.listing is not None:
        return at.listing
    return read_or_empty(spark, path.rstrip("/"), PAIR).distinct().withColumn("folder", F.lit(PLAIN))


def switch(spark: SparkSession, path: str, at: Current, listing: DataFrame) -> None:
    """Make ``listing`` the table, if it still is as it was at ``at``."""
    path, name = path.rstrip("/"), uuid.uuid4().hex
    listing.select(*_LISTING.fieldNames()).hint("rebalance").write.parquet(f"{path}/_listed/{name}")
    files, aside = _files(spark, f"{path}/_listed/{name}.pointer")
    out = files.create(aside, True)
    out.write(bytearray(name.encode()))
    out.close()
    put_pointer(spark, aside, f"{path}/_current/{at.number + 1:012d}")
    for old in (n for n in names_in(spark, f"{path}/_current") if n.isdigit() and int(n) <= at.number - KEPT_POINTERS):
        drop_scratch(spark, f"{path}/_current/{old}")


def put_pointer(spark: SparkSession, aside, place: str) -> None:
    """Rename without overwriting."""
    jvm = spark._jvm
    files, pointer = _files(spark, place)
    files.mkdirs(pointer.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(pointer), spark.sparkContext._gateway.new_array(kind, 0))
    except Exception as problem:
        if files.exists(pointer):
            raise ConcurrentWriteError(f"another writer changed the table first: {place}") from problem
        raise


def replace_partitions(
    rows: DataFrame, path: str, at: Current, replaced: DataFrame | None = None, max_records_per_file: int = 0,
    summarise: Summarise | None = None, rows_per_file: int | None = None,
) -> None:
    """Write ``rows`` and switch to them. ``replaced(event_date, site)``: the partitions that they
    replace, all they hold if None; to others they are added. ``summarise(rows)``, with the
    partition columns, is stored beside the rows and counts from the same switch on (see
    :func:`read_summary`)."""
    folder = write_folder(rows, path, max_records_per_file, summarise, rows_per_file)
    list_folder(rows.sparkSession, path, at, folder, replaced)


def write_folder(
    rows: DataFrame, path: str, max_records_per_file: int = 0, summarise: Summarise | None = None, rows_per_file: int | None = None
) -> str:
    """Write ``rows`` to a folder of the table that nobody reads yet; returns its name."""
    from tagloom.sinks.tables import clustered, clustered_by_range

    spark, path, folder = rows.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    arranged = clustered_by_range(rows, rows_per_file) if rows_per_file else clustered(rows)
    place = f"{path}/_rows/folder={folder}"
    (
        arranged.write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION).parquet(place)
    )
    if summarise:
        stored = spark.read.schema(rows.schema).parquet(place)
        summarise(stored).write.partitionBy(*PARTITION).parquet(f"{path}/{SUMMARY}/folder={folder}")
    return folder


def list_folder(spark: SparkSession, path: str, at: Current, folder: str, replaced: DataFrame | None) -> None:
    """Switch to the table with that folder, for ``replaced`` partitions (all that it holds if None) in place of others."""
    written = read_or_empty(spark, f"{path.rstrip('/')}/_rows/folder={folder}", PAIR).distinct()
    left = _matching(listed(spark, path, at), written if replaced is None else replaced, PARTITION, "left_anti")
    switch(spark, path, at, left.unionByName(written.withColumn("folder", F.lit(folder))))


def add_rows(rows: DataFrame, path: str, at: Current) -> int:
    """Write ``rows`` beside those stored; returns their number. None change nothing."""
    spark, folder = rows.sparkSession, write_folder(rows, path)
    place = f"{path.rstrip('/')}/_rows/folder={folder}"
    added = read_or_empty(spark, place, PAIR).count()
    if added:
        list_folder(spark, path, at, folder, spark.createDataFrame([], PAIR))
    else:
        drop_scratch(spark, place)
    return added


def merge_into(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    staged: DataFrame,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
    max_records_per_file: int = 0,
    summarise: Summarise | None = None,
) -> dict[str, int]:
    """Merge ``staged``, stored rows with non-null partition columns, and return rows per action.

    ``merged(target, staged)`` gives the rows of the merged table with their ``action``. The first
    pass only counts actions per partition and reads the columns this needs. The second writes:
    partitions with an update in full, of those with inserts only the inserted rows, and nothing
    of the others.
    """
    at = current(spark, path)
    table = read_current(spark, path, schema, at)
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
        rows = rows.select(*schema.fieldNames())
        replace_partitions(rows, path, at, flags.where("rewrite"), max_records_per_file, summarise)
    drop_scratch(spark, tally_path)
    return counts


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The summaries of the folders that the table holds now, with the columns of ``schema``: several of
    a partition after inserts."""
    at = current(spark, path)
    numbered = T.StructType([*schema.fields, T.StructField("folder", T.StringType())])
    rows = read_or_empty(spark, f"{path.rstrip('/')}/{SUMMARY}", numbered)
    return _matching(rows, listed(spark, path, at), [*PARTITION, "folder"]).select(*schema.fieldNames())


def rewrite_days(
    spark: SparkSession, path: str, schema: T.StructType, before: date, summarise: Summarise | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Write the partitions of closed days that lie in several folders anew, as one, in files by
    range of tag and time; returns how many there were. A table with summaries needs its ``summarise`` here too."""
    at = current(spark, path)
    many = listed(spark, path, at).where(F.col("event_date") < F.lit(before)).groupBy(*PARTITION).agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    found = many.count()
    if found:
        rows = _matching(read_current(spark, path, schema, at), many, PARTITION)
        replace_partitions(rows, path, at, summarise=summarise, rows_per_file=rows_per_file)
    return found


def drop_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Remove folders of which the table holds nothing any more, and old listings. Run it while no writer is
    at work and no reader of an older state is left."""
    path = path.rstrip("/")
    at = current(spark, path)
    if at.listing is None:
        return []
    used = {r["folder"] for r in at.listing.select("folder").distinct().toLocalIterator()}
    gone = [n for n in names_in(spark, f"{path}/_rows") if n.startswith("folder=") and n[7:] not in used]
    drop_scratch(spark, *[f"{path}/{kind}/{name}" for kind in ("_rows", SUMMARY) for name in gone])
    name = at.listing.inputFiles()[0].rsplit("/", 2)[1] if not at.listing.isEmpty() else None
    drop_scratch(spark, *[f"{path}/_listed/{n}" for n in names_in(spark, f"{path}/_listed") if name and n != name])
    for old in names_in(spark, f"{path}/_current"):
        if old.isdigit() and int(old) < at.number:
            drop_scratch(spark, f"{path}/_current/{old}")
    return gone


def drop_days(spark: SparkSession, path: str, oldest: date) -> list[str]:
    """Drop the partitions of days before ``oldest``, rows and all; returns the names of the days."""
    path = path.rstrip("/")
    at = current(spark, path)
    if at.listing is not None:
        old = F.col("event_date") < F.lit(oldest)
        if not at.listing.where(old).isEmpty():
            switch(spark, path, at, at.listing.where(~F.coalesce(old, F.lit(False))))
    dropped = set()
    kept = [f"{path}/{kind}/{name}" for kind in ("_rows", SUMMARY) for name in names_in(spark, f"{path}/{kind}")]
    for place in [path, *kept]:
        for name in names_in(spark, place):
            if name.startswith("event_date=") and name[11:] < oldest.isoformat():
                drop_scratch(spark, f"{place}/{name}")
                dropped.add(name[11:])
    return sorted(dropped)
