"""Digital states: a negative istat is a code holding a set and a state number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _magnitude(istat: Column | str) -> Column:
    c = F.col(istat) if isinstance(istat, str) else istat
    # Widened before abs: the smallest 32-bit integer has no 32-bit magnitude.
    return F.when(c < 0, F.abs(c.cast("bigint")))


def digital_code(istat: Column | str) -> Column:
    c = F.col(istat) if isinstance(istat, str) else istat
    return F.when(c < 0, c.cast("bigint"))


def digital_set_id(istat: Column | str) -> Column:
    return F.shiftright(_magnitude(istat), 16).bitwiseAND(F.lit(0xFFFF))


def digital_state_id(istat: Column | str) -> Column:
    return _magnitude(istat).bitwiseAND(F.lit(0xFFFF))


def server_key(server: Column | str) -> Column:
    """Servers match without case in the state dimension, and only there."""
    return F.lower(F.col(server) if isinstance(server, str) else server)
