"""Half-open windows and sampling grids.

Windows and points are generated row by row from bounds carried in the row: no join
with a calendar and no cross join.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MICRO = 1_000_000


def _steps(start: Column, end: Column, seconds: int) -> Column:
    """start, start + n, ... strictly before end; no element when start >= end."""
    last = end - F.expr("INTERVAL 1 MICROSECOND")
    step = F.make_interval(secs=F.lit(seconds))
    return F.when(start < end, F.sequence(start, last, step)).otherwise(F.array().cast("array<timestamp>"))


def split_windows(df: DataFrame, start: str, end: str, window_seconds: int) -> DataFrame:
    """One row per window of each input row; the last window is clipped to ``end``."""
    if window_seconds <= 0:
        raise ValueError("window_seconds must be greater than zero")
    length = F.make_interval(secs=F.lit(window_seconds))
    opened = df.withColumn("window_start", F.explode(_steps(F.col(start), F.col(end), window_seconds)))
    return opened.withColumn("window_end", F.least(F.col("window_start") + length, F.col(end)))


def sampling_points(windows: DataFrame, interval_seconds: int) -> DataFrame:
    """One row per grid instant; the grid restarts at every window start."""
    if interval_seconds <= 0:
        raise ValueError("interval_seconds must be greater than zero")
    return windows.withColumn("ts", F.explode(_steps(F.col("window_start"), F.col("window_end"), interval_seconds)))


def tag_windows(tags: DataFrame, bounds: DataFrame, window_seconds: int) -> DataFrame:
    """Every tag of a site with every window of that site's range.

    ``bounds`` has one row per site, so the join only adds two columns to each tag.
    """
    return split_windows(tags.join(bounds, "site"), "range_start", "range_end", window_seconds)


def realtime_windows(progress: DataFrame, interval_seconds: int, window_seconds: int) -> DataFrame:
    """Windows still to be pulled, from ``last_end`` up to ``now`` floored to the interval."""
    from tagloom.functions import floor_to_interval

    due = progress.withColumn("due_end", floor_to_interval("now", interval_seconds))
    return split_windows(due, "last_end", "due_end", window_seconds).drop("due_end")


def first_realtime_start(now: Column | str, interval_seconds: int, window_seconds: int) -> Column:
    """Where a stream without history begins: one window before now, floored."""
    from tagloom.functions import floor_to_interval

    at = F.col(now) if isinstance(now, str) else now
    return floor_to_interval(at - F.make_interval(secs=F.lit(window_seconds)), interval_seconds)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def to_micros(at: datetime) -> int:
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@dataclass(frozen=True)
class GridSpec:
    """The sampling grid of one run in closed form.

    Cell ``i`` begins at grid instant ``i`` and ends before the next one (or before the
    window end). Cell -1 is everything before the range, cell ``points`` everything after.
    """

    start: datetime
    end: datetime
    interval_seconds: int
    window_seconds: int

    def __post_init__(self) -> None:
        if self.interval_seconds <= 0 or self.window_seconds <= 0:
            raise ValueError("interval_seconds and window_seconds must be greater than zero")

    @property
    def _start(self) -> int:
        return to_micros(self.start)

    @property
    def _span(self) -> int:
        return max(to_micros(self.end) - self._start, 0)

    @property
    def per_window(self) -> int:
        return -(-self.window_seconds // self.interval_seconds)

    @property
    def points(self) -> int:
        whole, rest = divmod(self._span, self.window_seconds * _MICRO)
        return whole * self.per_window + -(-rest // (self.interval_seconds * _MICRO))

    def cell_of(self, ts: Column) -> Column:
        offset = F.unix_micros(ts) - F.lit(self._start)
        length = F.lit(self.window_seconds * _MICRO)
        cell = _div(offset, length) * F.lit(self.per_window) + _div(
            F.pmod(offset, length), F.lit(self.interval_seconds * _MICRO)
        )
        return (
            F.when(offset < 0, F.lit(-1))
            .when(offset >= F.lit(self._span), F.lit(self.points))
            .otherwise(cell)
            .cast("bigint")
        )

    def instant_micros(self, cell: Column) -> Column:
        per = F.lit(self.per_window)
        return (
            F.lit(self._start)
            + _div(cell, per) * F.lit(self.window_seconds * _MICRO)
            + F.pmod(cell, per) * F.lit(self.interval_seconds * _MICRO)
        ).cast("bigint")
