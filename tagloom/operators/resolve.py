"""Point and digital-state resolution, and the quality of a reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import schema as S
from tagloom.functions import digital_code, digital_set_id, digital_state_id, server_key, value_text
from tagloom.operators.enrich import enrich


def valid_points(points: DataFrame) -> DataFrame:
    """Points that were resolved: a null or negative id is a failed lookup."""
    return points.where(F.col("point_id") >= 0)


def resolve_points(readings: DataFrame, points: DataFrame, **join_options) -> DataFrame:
    """Attach ``point_id``; an unknown tag keeps its row with a null id."""
    dim = valid_points(points).select("site", "server", "tag", "point_id")
    return enrich(readings, dim, ["site", "server", "tag"], ["ts"], **join_options)


def _no_data(df: DataFrame) -> Column:
    return F.col("no_data") if "no_data" in df.columns else F.lit(False)


def with_number_text(readings: DataFrame) -> DataFrame:
    """Render numbers ahead of the joins, so that joins and classification make one generated
    method short enough for the JVM to compile."""
    numeric = ~_no_data(readings) & (F.col("status") == 0) & (F.col("istat") >= 0)
    return readings.withColumn("number_text", F.when(numeric, value_text("rval"))).drop("rval")


def _is_digital(no_data: Column) -> Column:
    return F.col("point_id").isNotNull() & ~no_data & (F.col("status") == 0) & (F.col("istat") < 0)


def resolve_states(readings: DataFrame, states: DataFrame, **join_options) -> DataFrame:
    """Attach the state row of readings that carry a state code.

    A hit takes set and state from the dimension even where they are null; a miss
    keeps the numbers decoded from the code.
    """
    no_data = _no_data(readings)
    keyed = readings.withColumn("server_key", server_key("server")).withColumn(
        "digital_code", F.when(_is_digital(no_data), digital_code("istat"))
    )
    origin = F.col("state_source") if "state_source" in states.columns else F.lit(None).cast("string")
    dim = states.select(
        "site", "server_key", "digital_code", "digital_state_name",
        F.col("digital_set_id").alias("dim_set_id"), F.col("digital_state_id").alias("dim_state_id"),
        F.coalesce(origin, F.lit(S.STATE_SOURCE_CACHED)).alias("dim_source"), F.lit(True).alias("state_hit"),
    )
    joined = enrich(keyed, dim, ["site", "server_key", "digital_code"], ["ts", "tag"], **join_options)
    coded = F.when(F.col("digital_code").isNotNull(), F.col("istat"))
    hit = F.col("state_hit")
    return (
        joined.withColumn("digital_set_id", F.when(hit, F.col("dim_set_id")).otherwise(digital_set_id(coded)))
        .withColumn("digital_state_id", F.when(hit, F.col("dim_state_id")).otherwise(digital_state_id(coded)))
        .withColumn(
            "state_source",
            F.when(hit, F.col("dim_source")).when(F.col("digital_code").isNotNull(), S.STATE_SOURCE_UNRESOLVED),
        )
        .drop("server_key", "state_hit", "dim_set_id", "dim_state_id", "dim_source")
    )


def classify(resolved: DataFrame) -> DataFrame:
    """Value text, quality and value type of readings with ``number_text``. The first matching condition decides:
    no point, no data, bad status, digital state, number."""
    no_point = F.col("point_id").isNull()
    no_data = _no_data(resolved)
    failed = F.col("status") != 0
    digital = F.col("istat") < 0
    return (
        resolved.withColumn(
            "value",
            F.when(no_point | no_data | failed, F.lit(None).cast("string"))
            .when(digital, F.col("digital_state_name"))
            .otherwise(F.col("number_text")),
        )
        .withColumn(
            "quality",
            F.when(no_point, S.QUALITY_NO_POINT)
            .when(no_data, S.QUALITY_NO_DATA)
            .when(failed, F.concat(F.lit(S.QUALITY_STATUS_PREFIX), F.col("status").cast("string")))
            .when(digital, S.QUALITY_DIGITAL)
            .otherwise(S.QUALITY_GOOD),
        )
        .withColumn(
            "value_type",
            F.when(no_point, S.VALUE_NUMERIC)
            .when(no_data | failed, S.VALUE_ERROR)
            .when(digital, S.VALUE_DIGITAL)
            .otherwise(S.VALUE_NUMERIC),
        )
        .withColumn("raw_istat", F.when(~no_point, F.col("istat")))
    )


def resolve_and_classify(readings: DataFrame, points: DataFrame, states: DataFrame, **join_options) -> DataFrame:
    rendered = with_number_text(readings)
    return classify(resolve_states(resolve_points(rendered, points, **join_options), states, **join_options))
