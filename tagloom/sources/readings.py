"""Raw readings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schema import READING_SCHEMA


def read_readings(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    sites: list[str] | None = None,
    lookback: timedelta = timedelta(0),
    lookahead: timedelta = timedelta(0),
) -> DataFrame:
    """Raw readings of a time range, widened by the paddings that interpolation needs.
    Every condition reaches the Parquet scan."""
    df = spark.read.schema(READING_SCHEMA).parquet(path)
    if start is not None:
        df = df.where(F.col("ts") >= F.lit(start - lookback))
    if end is not None:
        df = df.where(F.col("ts") < F.lit(end + lookahead))
    if sites is not None:
        df = df.where(F.col("site").isin(sites))
    return df
