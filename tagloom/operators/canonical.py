"""The canonical event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import event_id, iso_zulu, safe_int
from tagloom.operators.enrich import enrich
from tagloom.schema import EVENT_COLUMNS, INTEGER_COLUMNS, SOURCE_ARCHIVE


def attach_site(readings: DataFrame, sites: DataFrame, **join_options) -> DataFrame:
    """Stamp ``source`` and ``server`` from the site table; readings of no listed site are left out."""
    dim = sites.select("site", "server", "source")
    bare = readings.drop("server", "source")
    return enrich(bare, dim, ["site"], ["tag", "ts"], how="inner", **join_options)


def canonical_events(classified: DataFrame) -> DataFrame:
    """The fifteen event columns, timestamp as an instant."""
    source = F.col("source") if "source" in classified.columns else F.lit(SOURCE_ARCHIVE)
    made = {
        "source": source,
        "timestamp": F.col("ts").cast("timestamp"),
        "event_id": event_id("site", "tag", "ts"),
    }
    return classified.select(*[
        made.get(c, safe_int(c) if c in INTEGER_COLUMNS else F.col(c)).alias(c) for c in EVENT_COLUMNS
    ])


def published_form(events: DataFrame) -> DataFrame:
    """Events as they leave: the timestamp as ISO text."""
    return events.withColumn("timestamp", iso_zulu("timestamp"))
