"""The idempotency key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.timestamps import iso_utc


def event_id(site: Column | str, tag: Column | str, ts: Column | str) -> Column:
    """md5 of site, tag and UTC instant. Null when any part is null, so that no two
    incomplete events can share a key."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (site, tag)]
    return F.md5(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), iso_utc(ts)))
