"""Site selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_SITES = ("all", "*")


def unknown_sites(sites: DataFrame, names: list[str]) -> DataFrame:
    """The asked names (``unknown_site``) that the site table does not have."""
    asked = sites.sparkSession.createDataFrame([(n,) for n in names], "unknown_site string").distinct()
    return asked.join(sites, asked["unknown_site"] == sites["site"], "left_anti")


def select_sites(sites: DataFrame, wanted: str | None = None) -> DataFrame:
    """Enabled sites, or the comma-separated ``wanted`` ones, which are used even when
    disabled. An unknown name is an error."""
    if not wanted or wanted.lower() in ALL_SITES:
        return sites.where("enabled")
    names = list(dict.fromkeys(n.strip() for n in wanted.split(",") if n.strip()))
    unknown = sorted(r["unknown_site"] for r in unknown_sites(sites, names).collect())
    if unknown:
        raise ValueError(f"unknown sites: {', '.join(unknown)}")
    return sites.where(F.col("site").isin(names))
