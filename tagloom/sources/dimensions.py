"""Point and digital-state dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tagloom.functions import server_key
from tagloom.schema import POINT_SCHEMA, STATE_SCHEMA, STATE_SOURCE_CACHED

_POINT_JSON = "sites map<string, struct<servers: map<string, struct<tags: map<string, bigint>>>>>"
_STATE = (
    "struct<digital_code: bigint, digital_state_name: string, digital_set_id: bigint,"
    " digital_state_id: bigint, source: string>"
)
_STATE_JSON = f"map<string, map<string, map<string, {_STATE}>>>"


def _read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_points(spark: SparkSession, path: str, site: str | None = None, server: str | None = None) -> DataFrame:
    """Point dimension, empty where none was stored. Server names match exactly."""
    df = _read_or_empty(spark, path, POINT_SCHEMA)
    if site is not None:
        df = df.where(F.col("site") == site)
    return df if server is None else df.where(F.col("server") == server)


def read_states(spark: SparkSession, path: str, site: str | None = None, server: str | None = None) -> DataFrame:
    """State dimension, empty where none was stored. Server names match without case."""
    df = _read_or_empty(spark, path, STATE_SCHEMA)
    if site is not None:
        df = df.where(F.col("site") == site)
    if server is not None:
        df = df.where(F.col("server_key") == server_key(F.lit(server)))
    return df.withColumn("state_source", F.coalesce("state_source", F.lit(STATE_SOURCE_CACHED)))


def import_point_json(documents: DataFrame, text: str = "value") -> DataFrame:
    """Nested documents site -> server -> tag -> id as rows. A corrupt document gives none."""
    return (
        documents.select(F.from_json(text, _POINT_JSON).alias("d"))
        .select(F.explode("d.sites").alias("site", "s"))
        .select("site", F.explode("s.servers").alias("server", "v"))
        .select("site", "server", F.explode("v.tags").alias("tag", "point_id"))
    )


def import_state_json(documents: DataFrame, text: str = "value") -> DataFrame:
    """Nested documents site -> server -> code -> state as rows; the code defaults to its key."""
    return (
        documents.select(F.from_json(text, _STATE_JSON).alias("d"))
        .select(F.explode("d").alias("site", "s"))
        .select("site", F.explode("s").alias("server_key", "v"))
        .select("site", "server_key", F.explode("v").alias("code", "state"))
        .select(
            "site", "server_key",
            F.coalesce(F.col("state.digital_code"), F.col("code").try_cast("bigint")).alias("digital_code"),
            "state.digital_state_name", "state.digital_set_id", "state.digital_state_id",
            F.coalesce("state.source", F.lit(STATE_SOURCE_CACHED)).alias("state_source"),
        )
    )
