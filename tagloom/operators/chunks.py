"""Fixed-size chunks of an ordered list, numbered without gathering the list in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import materialize


def dense_position(df: DataFrame, group: str, order: str, partitions: int | None = None) -> DataFrame:
    """Add ``position`` 1, 2, 3, ... within each group, in ``order`` (unique per group).

    Rows are range-partitioned and numbered inside their partition; each partition then
    starts after the rows of the partitions before it, and each group after its first row.
    The window over all rows that this needs holds one row per partition and group piece.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fixed once: the ranges come from a sample and must not move between the two readings below.
    placed = materialize(
        df.repartitionByRange(n, group, order).sortWithinPartitions(group, order)
        .withColumn("__part", F.spark_partition_id())
    )
    pieces = placed.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(group, "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__part", group).orderBy(order)
    numbered = placed.withColumn("__row", F.row_number().over(inside))
    return numbered.join(starts, [group, "__part"]).select(
        *df.columns, (F.col("__start") + F.col("__row")).cast("bigint").alias("position")
    )


def chunk_ids(df: DataFrame, group: str, order: str, size: int, partitions: int | None = None) -> DataFrame:
    """Add ``chunk_id`` from 0; every chunk but the last of a group has ``size`` rows."""
    if size <= 0:
        raise ValueError("a chunk needs at least one row")
    placed = dense_position(df, group, order, partitions)
    chunk = F.call_function("div", F.col("position") - 1, F.lit(size))
    return placed.withColumn("chunk_id", chunk.cast("bigint")).drop("position")
