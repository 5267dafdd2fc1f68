"""Left joins of a large fact with a dimension, safe for hot keys.

A dimension whose measured size is within a bound is broadcast, so the fact is not
shuffled at all. Beyond the bound the fact's rows per key are counted (reduced before
the shuffle); a key with more than ``hot_rows`` is spread over as many salts as it has
times that, and only its dimension rows are repeated. All other keys join as they are.
Fact rows whose key is null cannot match; they are spread over all partitions instead
of gathering in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize

BROADCAST_BYTES = 128 * 1024 * 1024
HOT_ROWS = 2_000_000
_SALT, _ROWS = "__salt", "__rows"


def measured_bytes(dim: DataFrame) -> int:
    """Upper estimate of the in-memory size of a dimension, from its actual content."""
    text = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in dim.schema if f.dataType.typeName() == "string"]
    width = F.lit(48 + 16 * len(dim.columns))
    for t in text:
        width = width + t
    return int(dim.select(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0])


def fits_broadcast(dim: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(dim) <= (BROADCAST_BYTES if limit is None else limit)


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    broadcast_limit: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``dim`` (unique on ``keys``) to ``fact``; ``spread_by`` varies within a hot key."""
    if fits_broadcast(dim, broadcast_limit):
        return fact.join(F.broadcast(dim), keys, how)
    spread: Column = F.xxhash64(*spread_by)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    # At most one hot key per ``hot_rows`` rows of the fact.
    hot = fact.where(~no_key).groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).where(F.col(_ROWS) > hot_rows)
    hot = materialize(hot.select(*keys, F.ceil(F.col(_ROWS) / hot_rows).alias(_ROWS)))
    small = F.broadcast(hot) if fits_broadcast(hot, broadcast_limit or None) else hot
    salts = F.coalesce(F.col(_ROWS), F.lit(1))
    salted_fact = fact.join(small, keys, "left").withColumn(_SALT, F.when(no_key, spread).otherwise(F.pmod(spread, salts)))
    salted_dim = dim.join(small, keys, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    return salted_fact.drop(_ROWS).join(salted_dim.drop(_ROWS), [*keys, _SALT], how).drop(_SALT)
