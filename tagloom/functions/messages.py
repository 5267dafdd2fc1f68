"""Message payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.timestamps import iso_zulu
from tagloom.schema import EVENT_COLUMNS

# The attributes carried next to a payload.
MESSAGE_ATTRIBUTES = ["tag", "site", "server", "quality"]


def event_json() -> Column:
    """One event as JSON text, nulls kept, time rendered with Z."""
    fields = [iso_zulu(c).alias(c) if c == "timestamp" else F.col(c) for c in EVENT_COLUMNS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message_attributes() -> Column:
    return F.array(*[
        F.struct(F.lit(a).alias("key"), F.col(a).cast("binary").alias("value")) for a in MESSAGE_ATTRIBUTES
    ])
