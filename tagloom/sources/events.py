"""Published events read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.schema import EVENT_SCHEMA


def read_event_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Event JSON lines with the fixed schema; a malformed line is an error, not a null row."""
    return spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST").json(paths)
