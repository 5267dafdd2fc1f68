"""Merging newly resolved points and states into the dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import server_key
from tagloom.operators.latest import latest_per_key
from tagloom.operators.resolve import valid_points
from tagloom.schema import STATE_SOURCE_CACHED


def merge_points(current: DataFrame, fresh: DataFrame, fresh_order: str | None = None) -> DataFrame:
    """Update or insert by (site, server, tag). Failed lookups are never stored and never
    replace a stored id. ``fresh_order`` names a column of ``fresh`` that grows with time."""
    columns = ["site", "server", "tag", "point_id"]
    order = F.col(fresh_order).cast("bigint") if fresh_order else F.lit(0).cast("bigint")
    old = valid_points(current).select(*columns, F.lit(0).alias("batch"), F.lit(0).cast("bigint").alias("seq"))
    new = valid_points(fresh).select(*columns, F.lit(1).alias("batch"), order.alias("seq"))
    return latest_per_key(old.unionByName(new), ["site", "server", "tag"], ["batch", "seq"]).select(*columns)


def merge_states(current: DataFrame, fresh: DataFrame, fresh_order: str | None = None) -> DataFrame:
    """Overwrite by (site, server, code). A row without a name never replaces one with a
    name, so a state that could not be resolved once can still be resolved later."""
    columns = ["site", "server_key", "digital_code", "digital_state_name", "digital_set_id", "digital_state_id",
               "state_source"]

    def shaped(df: DataFrame, batch: int, seq) -> DataFrame:
        key = F.col("server_key") if "server_key" in df.columns else server_key("server")
        origin = F.col("state_source") if "state_source" in df.columns else F.lit(None).cast("string")
        return df.select(
            "site", key.alias("server_key"), F.col("digital_code").cast("bigint"), "digital_state_name",
            F.col("digital_set_id").cast("bigint"), F.col("digital_state_id").cast("bigint"),
            F.coalesce(origin, F.lit(STATE_SOURCE_CACHED)).alias("state_source"),
            F.col("digital_state_name").isNotNull().alias("named"), F.lit(batch).alias("batch"), seq.alias("seq"),
        )

    zero = F.lit(0).cast("bigint")
    order = F.col(fresh_order).cast("bigint") if fresh_order else zero
    both = shaped(current, 0, zero).unionByName(shaped(fresh, 1, order))
    return latest_per_key(both, ["site", "server_key", "digital_code"], ["named", "batch", "seq"]).select(*columns)
