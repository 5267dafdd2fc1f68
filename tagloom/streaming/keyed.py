"""Grid sampling with a state per tag in the state store, instead of a table between micro-batches.

A tag's state is its last sample and the last grid cell emitted, two numbers and a value whatever
its history, in RocksDB. Rows of a tag shrink to the first and last sample of each cell inside the
map tasks, batch by batch of Arrow, so that a tag or a moment with most of the rows is little to
shuffle and little for the task that holds its state. Instants between samples are emitted when
the later one arrives, with the rules of ``operators.value_at_time``.

With ``hold_after`` the watermark lies that much behind the newest sample of all, and an event-time
timer per tag emits what it has passed: a silent tag holds its last value, one that was never
seen has no data (``tags`` begin with a timer each, as initial state). Samples older than the watermark are
dropped by Spark; others that come after their instants are left out as well, and change only what
follows. Without ``hold_after`` there are no timers: a reading at or after the end of the range
(see :func:`closing`) emits the rest of its tag. A value that is no number comes out as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tagloom.operators.enrich import fits_broadcast
from tagloom.operators.grid import GridSpec, to_micros
from tagloom.operators.value_at_time import FIELDS, KEYS
from tagloom.schema import READING_SCHEMA

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "ts timestamp, rval double, istat bigint, status bigint, no_data boolean"
_SAMPLE = "cell bigint, first_t bigint, first_istat bigint, first_v double, last_t bigint, last_istat bigint, last_v double"
_STATE = "t bigint, istat bigint, v double, done bigint"


def instants(grid: GridSpec, cells: np.ndarray) -> np.ndarray:
    """Microseconds of grid instants."""
    whole, rest = np.divmod(cells, grid.per_window)
    return to_micros(grid.start) + whole * (grid.window_seconds * 1_000_000) + rest * (grid.interval_seconds * 1_000_000)


def emitted(grid: GridSpec, cells: np.ndarray, before: tuple | None, after: tuple | None) -> pd.DataFrame:
    """Values at ``cells`` between the samples (t, istat, v) before and after them; either may be missing."""
    g = instants(grid, cells)
    none = np.full(len(g), before is None)
    value = np.full(len(g), np.nan if before is None or before[2] is None else before[2])
    state = np.full(len(g), 0 if before is None else before[1], np.int64)
    if before is not None and after is not None and before[1] >= 0 and after[1] >= 0:
        share = (g - before[0]).astype(np.float64) / float(after[0] - before[0])
        a, b = (np.nan if s[2] is None else s[2] for s in (before, after))
        value, state = a + (b - a) * share, np.zeros(len(g), np.int64)
    if after is not None:
        exact = g == after[0]
        value, state = np.where(exact, np.nan if after[2] is None else after[2], value), np.where(exact, after[1], state)
        none &= ~exact
    shown = pd.Series(state, dtype="Int64").mask(none)
    return pd.DataFrame({
        "ts": pd.to_datetime(g, unit="us", utc=True), "rval": value, "istat": shown, "status": np.zeros(len(g), np.int64), "no_data": none,
    })


class TagSampler(StatefulProcessor):
    """The state of one tag; see the module."""

    def __init__(self, grid: GridSpec, timers: bool):
        self.grid, self.timers = grid, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("last", _STATE)

    def _held(self) -> tuple[tuple | None, int]:
        """The last sample and the last cell emitted."""
        if not self.state.exists():
            return None, -1
        t, istat, v, done = self.state.get()
        return (None if t is None else (t, istat, v)), done

    def _keep(self, last: tuple | None, done: int) -> None:
        self.state.update((*(last or (None, None, None)), done))
        if self.timers:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            if done + 1 < self.grid.points:
                self.handle.registerTimer(int(instants(self.grid, np.array([done + 1]))[0] // 1000))

    def _rows(self, key, cells: np.ndarray, before: tuple | None, after: tuple | None) -> pd.DataFrame:
        made = emitted(self.grid, cells, before, after)
        for place, name in enumerate(KEYS):
            made.insert(place, name, key[place])
        return made

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self._keep(None, -1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, done = self._held()
        frame = pd.concat(list(rows), ignore_index=True)
        edge = instants(self.grid, np.array([done]))[0] if done >= 0 else None
        closing = bool((frame["cell"] >= self.grid.points).any())
        frame = frame[frame["cell"] < self.grid.points]
        # A cell may come from several map tasks; of late samples only the newest matters.
        cells: dict[int, list[tuple]] = {}
        for r in frame.itertuples(index=False):
            for side in ("first", "last"):
                t, istat, v = (getattr(r, f"{side}_{f}") for f in FIELDS)
                sample = (int(t), int(istat), None if pd.isna(v) else float(v))
                if edge is not None and sample[0] <= edge:
                    last = max(last, sample, key=lambda s: s[0]) if last else sample
                else:
                    cells.setdefault(int(r.cell), []).append(sample)
        for cell in sorted(cells):
            first = min(cells[cell], key=lambda s: s[0])
            lo = max(done + 1, 0)
            if first[0] > (last[0] if last else -(1 << 62)) and lo <= cell:
                yield self._rows(key, np.arange(lo, cell + 1), last, first)
            done = max(done, cell)
            newest = max(cells[cell], key=lambda s: s[0])
            last = newest if last is None or newest[0] > last[0] else last
        if closing and done + 1 < self.grid.points:
            yield self._rows(key, np.arange(max(done + 1, 0), self.grid.points), last, None)
            done = self.grid.points - 1
        self._keep(last, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, done = self._held()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        cells = np.arange(max(done + 1, 0), self.grid.points)
        due = cells[instants(self.grid, cells) <= passed]
        if len(due):
            yield self._rows(key, due, last, None)
            done = int(due[-1])
        self._keep(last, done)

    def close(self) -> None:
        pass


def reduced(readings: DataFrame, grid: GridSpec) -> DataFrame:
    """Good samples as the first and last of every (tag, cell) of each Arrow batch, with the time of the last in ``ts``."""
    good = readings.where((F.col("status") == 0) & F.col("ts").isNotNull()).select(
        *KEYS, "ts", grid.cell_of(F.col("ts")).alias("cell"), F.unix_micros("ts").alias("t"),
        F.coalesce(F.col("istat").cast("bigint"), F.lit(0)).alias("istat"), F.col("rval").cast("double").alias("v"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            by = [*KEYS, "cell"]
            table = pa.table({c: batch.column(c) for c in by} | {"t": batch.column("t"), "row": pa.array(np.arange(batch.num_rows))})
            order = table.sort_by([*[(c, "ascending") for c in by], ("t", "ascending")]).column("row").to_numpy()
            placed = batch.take(pa.array(order))
            same = np.ones(len(order) - 1, bool)
            for c in by:
                codes = placed.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                same &= codes[1:] == codes[:-1]
            first = np.flatnonzero(np.append(True, ~same))
            last = np.append(first[1:], len(order)) - 1
            columns = [placed.column(c).take(pa.array(first)) for c in KEYS]
            columns += [placed.column("ts").take(pa.array(last)), placed.column("cell").take(pa.array(first))]
            columns += [placed.column(f).take(pa.array(at)) for at in (first, last) for f in FIELDS]
            names = [*KEYS, "ts", "cell", *[f"{side}_{f}" for side in ("first", "last") for f in FIELDS]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keys = ", ".join(f"{c} string" for c in KEYS)
    return good.select(*KEYS, "ts", "cell", *FIELDS).mapInArrow(run, f"{keys}, ts timestamp, {_SAMPLE}")


def closing(tags: DataFrame, grid: GridSpec) -> DataFrame:
    """A reading at the end of the range for each tag."""
    at = F.timestamp_micros(F.lit(to_micros(grid.end)))
    made = {"ts": at, "rval": F.lit(0.0), "istat": F.lit(0), "status": F.lit(0)}
    return tags.select(*KEYS, *[c.cast(READING_SCHEMA[n].dataType).alias(n) for n, c in made.items()])


def keyed_grid(readings: DataFrame, tags: DataFrame, grid: GridSpec, hold_after: timedelta | None = None) -> DataFrame:
    """The value of every one of ``tags`` at every grid instant, as a stream in append mode.

    Sets the session's state store to RocksDB, which such a state needs. Write the result with the
    file sink, or any other that knows batches, to have every instant once.
    """
    spark = readings.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    named = tags.select(*KEYS)
    rows = reduced(readings, grid)
    if hold_after is not None:
        rows = rows.withWatermark("ts", f"{int(hold_after.total_seconds() * 1000)} milliseconds")
    wanted = rows.join(F.broadcast(named) if fits_broadcast(named) else named, KEYS, "left_semi")
    keys = ", ".join(f"{c} string" for c in KEYS)
    return wanted.groupBy(*KEYS).transformWithStateInPandas(
        TagSampler(grid, hold_after is not None), f"{keys}, {OUTPUT}", "Append", "none" if hold_after is None else "EventTime",
        initialState=named.groupBy(*KEYS),
    )
