"""Grid sampling of a live stream.

Between micro-batches one row per tag is kept: its last sample and ``done``, the last grid cell
emitted. A batch reduces its samples to the first and last of each (tag, cell) and generates the
instants between consecutive cells of a tag, beginning after ``done``: the work follows the
samples and the instants that come due, whatever tags there are besides. An instant is emitted
once its tag has a sample at or after it, so values are the same as in one batch run. With
``hold_after``, a tag whose samples end that much before the newest of all tags holds its last
value from there on, and a tag without any has no data; so do all tags at :meth:`flush`.

A sample at or before an instant that its tag has emitted already comes too late (or once more), and so
does one between the last such instant and the sample that it was computed with:
it changes nothing that is emitted, and is written to the ``late`` table; later instants begin at it if
it is the newest of its tag. :meth:`repair` corrects what was emitted: a late sample changes the
instants between its neighbours and no others, so of all stretches between two samples those that
begin or end at a late one are computed again from the stored samples, up to the last instant
emitted, and replace what was emitted before.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.grid import GridSpec
from tagloom.operators.enrich import enrich
from tagloom.operators.value_at_time import FIELDS, KEYS, cell_summary, interpolated, neighbours, points_between
from tagloom.schema import READING_SCHEMA
from tagloom.session import drop_scratch
from tagloom.sinks.current import names_in, read_or_empty

OUTPUT_SCHEMA = T.StructType([
    *READING_SCHEMA.fields[:4],
    T.StructField("rval", T.DoubleType()),
    T.StructField("istat", T.LongType()),
    T.StructField("status", T.LongType()),
    T.StructField("no_data", T.BooleanType()),
])

_CARRY = T.StructType([
    *READING_SCHEMA.fields[:3],
    T.StructField("t", T.LongType()),
    T.StructField("istat", T.LongType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("done", T.LongType()),
    # The sample after ``done`` that its value was computed with; null where it was held.
    T.StructField("n_t", T.LongType()),
    T.StructField("batch", T.LongType()),
])


class GridStream:
    """``start(stream, grid_stream.on_batch, ...)``, then :meth:`flush` when the range is over.

    ``publish``, if given, gets the readings of every batch as they are read back, and its number.
    """

    def __init__(
        self, spark: SparkSession, tags: DataFrame, grid: GridSpec, path: str, hold_after: timedelta | None = None,
        publish: Callable[[DataFrame, int], None] | None = None,
    ):
        self._spark, self._tags, self._grid = spark, tags.select(*KEYS), grid
        self._path, self._hold_after, self._publish = path.rstrip("/"), hold_after, publish

    def _carried(self, before: int | None = None) -> DataFrame:
        """One row per wanted tag as the last batch (before the given one) left it."""
        rows = read_or_empty(self._spark, f"{self._path}/carry", _CARRY)
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        last = rows.agg(F.max("batch")).first()[0]
        known = rows.where(F.col("batch") == F.lit(-1 if last is None else last)).drop("batch")
        return self._tags.join(known, KEYS, "left").withColumn("done", F.coalesce("done", F.lit(-1).cast("bigint")))

    def _last_batch(self) -> int:
        last = read_or_empty(self._spark, f"{self._path}/carry", _CARRY).agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def on_batch(self, readings: DataFrame, batch: int) -> None:
        carried = self._carried(before=batch)
        at = F.unix_micros("ts")
        good = readings.select(*READING_SCHEMA.fieldNames()).where(
            (F.col("status") == 0) & F.col("ts").isNotNull() & (F.col("ts") < F.lit(self._grid.end))
        )
        known = good.join(carried.select(*KEYS, "done", "n_t"), KEYS)
        # Instant 0 is the first: with nothing emitted, no sample is late.
        emitted = F.when(F.col("done") >= 0, self._grid.instant_micros(F.col("done")))
        late = F.coalesce(at <= emitted, F.lit(False)) | F.coalesce(at < F.col("n_t"), F.lit(False))
        known.where(late).select(*READING_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{self._path}/late/batch={batch}")
        # A tag that was held may have had a sample meanwhile: what comes next begins there.
        overdue = self._spark.read.schema(READING_SCHEMA).parquet(f"{self._path}/late/batch={batch}")
        sample = {"t": F.unix_micros("ts"), "istat": F.col("istat").cast("bigint"), "v": F.col("rval")}
        newest_late = overdue.groupBy(*KEYS).agg(*[F.max_by(c, "ts").alias(f"l_{f}") for f, c in sample.items()])
        newer = F.coalesce(F.col("l_t") > F.coalesce("t", F.lit(-(1 << 62))), F.lit(False))
        carried = carried.join(newest_late, KEYS, "left").withColumns(
            {f: F.when(newer, F.col(f"l_{f}")).otherwise(F.col(f)) for f in FIELDS}
        ).drop(*[f"l_{f}" for f in FIELDS])

        # First and last sample of every cell of a tag, after the one that is carried.
        fresh = cell_summary(known.where(~late), self._grid)
        held = F.col("t").isNotNull()
        edge = carried.select(
            *KEYS, F.when(held, self._grid.cell_of(F.timestamp_micros("t"))).otherwise(F.lit(-2)).alias("cell"),
            *[F.lit(None).cast(kind).alias(f"first_{f}") for f, kind in FIELDS.items()],
            *[F.col(f).alias(f"last_{f}") for f in FIELDS],
        )
        # A fresh sample may lie in the carried one's cell, before or after it.
        picked = [F.max_by(f"last_{f}", "last_t").alias(f"last_{f}") for f in FIELDS]
        firsts = [F.min_by(f"first_{f}", "first_t").alias(f"first_{f}") for f in FIELDS]
        cells = fresh.unionByName(edge).groupBy(*KEYS, "cell").agg(*firsts, *picked)
        order = Window.partitionBy(*KEYS).orderBy("cell")
        ahead = cells.join(carried.select(*KEYS, "done", F.col("n_t").alias("done_n_t")), KEYS).withColumns({
            "next_cell": F.lead("cell").over(order), **{f"n_{f}": F.lead(f"first_{f}").over(order) for f in FIELDS},
        })
        # The last cell of a tag has no successor; it holds where the stream has moved on.
        newest = None
        if self._hold_after is not None:
            newest = fresh.agg(F.max("last_t")).first()[0]
        held_to = F.lit(-1).cast("bigint")
        if newest is not None:
            until = F.timestamp_micros(F.lit(newest - self._hold_after // timedelta(microseconds=1)))
            held_to = F.least(self._grid.cell_of(until), F.lit(self._grid.points - 1).cast("bigint"))
        reached = F.least(F.coalesce("next_cell", F.greatest(held_to, "cell")), F.lit(self._grid.points - 1).cast("bigint"))
        path = f"{self._path}/ahead/batch={batch}"
        ahead.withColumn("hi", reached).write.mode("overwrite").parquet(path)
        ahead = self._spark.read.parquet(path)

        self._emit(ahead, batch)
        newest_cell = Window.partitionBy(*KEYS).orderBy("cell").rowsBetween(0, Window.unboundedFollowing)
        last = ahead.withColumn("done_after", F.greatest("done", F.max("hi").over(newest_cell))).where("next_cell IS NULL")
        # Emitted up to its last cell, a tag was computed with the first sample of that; beyond, it was held.
        with_next = F.when(F.col("done_after") == F.col("done"), F.col("done_n_t")).when(
            F.col("done_after") <= F.col("cell"), F.col("first_t"))
        last.select(
            *KEYS, *[F.col(f"last_{f}").alias(f) for f in FIELDS], F.col("done_after").alias("done"), with_next.alias("n_t")
        ).write.mode("overwrite").parquet(f"{self._path}/carry/batch={batch}")
        # A repeated batch needs the table before its own, and none older.
        drop_scratch(self._spark, path, f"{self._path}/carry/batch={batch - 2}")

    def flush(self) -> None:
        """Emit the rest of the range for every tag, holding its last sample."""
        batch = self._last_batch() + 1
        rest = self._carried(before=batch).select(
            *KEYS, F.col("done").alias("cell"), "done", F.lit(self._grid.points - 1).cast("bigint").alias("hi"),
            *[F.col(f).alias(f"last_{f}") for f in FIELDS], *[F.lit(None).cast(k).alias(f"n_{f}") for f, k in FIELDS.items()],
        )
        self._emit(rest, batch)
        end = F.lit(self._grid.points - 1).cast("bigint")
        self._carried(before=batch).withColumns({"n_t": F.when(F.col("done") == end, F.col("n_t")), "done": end}).select(
            *[f.name for f in _CARRY if f.name != "batch"]).write.mode("overwrite").parquet(f"{self._path}/carry/batch={batch}")

    def _emit(self, ahead: DataFrame, batch: int) -> None:
        """Instants after ``cell`` and ``done`` up to ``hi``. Overwritten by its own number only: a
        repeated batch replaces its earlier output."""
        lo = F.greatest(F.col("cell") + 1, F.col("done") + 1, F.lit(0).cast("bigint"))
        due = ahead.withColumn("lo", lo).where("lo <= hi").select(
            *KEYS, *[F.col(f"last_{f}").alias(f"p_{f}") for f in FIELDS], *[f"n_{f}" for f in FIELDS],
            F.explode(F.sequence("lo", "hi")).alias("cell"),
        )
        at: Column = self._grid.instant_micros(F.col("cell"))
        rows = due.withColumn("g", at).select(*KEYS, F.timestamp_micros("g").alias("ts"), *interpolated())
        path = f"{self._path}/grid/batch={batch}"
        rows.select(*OUTPUT_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)
        if self._publish:
            self._publish(self._spark.read.schema(OUTPUT_SCHEMA).parquet(path), batch)

    def repair(self, samples: DataFrame, publish: Callable[[DataFrame], None] | None = None, **join_options) -> int:
        """Correct the instants that samples have come too late for since the last repair, from ``samples``: all stored
        ones, or (see ``operators.day_summary``) those of the days in question and the edges of others.

        ``publish`` gets the corrected readings; give it a sink that updates, as the merge does. A
        repair that dies is done again as a whole. Returns the number of late samples.
        """
        last = self._last_batch()
        done = [int(n[5:]) for n in names_in(self._spark, f"{self._path}/repaired") if n.startswith("upto=")]
        late = self.late().where((F.col("batch") > max(done, default=-1)) & (F.col("batch") <= last))
        at = F.unix_micros("ts")
        late = late.select(*KEYS, at.alias("t")).distinct()
        path = f"{self._path}/repairing"
        late.write.mode("overwrite").parquet(path)
        late = self._spark.read.parquet(path)
        n_late = late.count()
        if not n_late:
            return 0
        tags = late.select(*KEYS).distinct()
        good = samples.select(*READING_SCHEMA.fieldNames()).where(
            (F.col("status") == 0) & F.col("ts").isNotNull() & (F.col("ts") < F.lit(self._grid.end))
        )
        usable = enrich(good, tags, KEYS, ["ts"], how="left_semi", **join_options)
        gaps = neighbours(usable, tags, self._grid)
        for side in ("p", "n"):
            marks = late.withColumnsRenamed({"t": f"{side}_t"}).withColumn(f"{side}_late", F.lit(True))
            gaps = enrich(gaps, marks, [*KEYS, f"{side}_t"], ["lo"], **join_options)
        emitted = self._carried().select(*KEYS, "done")
        open_ = gaps.where("p_late OR n_late").join(emitted, KEYS)
        open_ = open_.withColumn("hi", F.least("hi", "done")).where("lo <= hi")
        rows = points_between(open_, self._grid).select(*OUTPUT_SCHEMA.fieldNames())
        place = f"{self._path}/repaired/upto={last}"
        if publish:
            rows.write.mode("overwrite").parquet(f"{path}-rows")
            publish(self._spark.read.schema(OUTPUT_SCHEMA).parquet(f"{path}-rows"))
            rows = self._spark.read.schema(OUTPUT_SCHEMA).parquet(f"{path}-rows")
        rows.write.parquet(place)
        drop_scratch(self._spark, path, f"{path}-rows")
        return n_late

    def output(self) -> DataFrame:
        """What was emitted, as repaired."""
        names = OUTPUT_SCHEMA.fieldNames()
        rows = read_or_empty(self._spark, f"{self._path}/grid", OUTPUT_SCHEMA).select(*names)
        numbered = T.StructType([*OUTPUT_SCHEMA.fields, T.StructField("upto", T.LongType())])
        repaired = read_or_empty(self._spark, f"{self._path}/repaired", numbered)
        rest = [c for c in names if c not in (*KEYS, "ts")]
        newest = repaired.groupBy(*KEYS, "ts").agg(F.max_by(F.struct(*rest), "upto").alias("r"))
        newest = newest.select(*KEYS, "ts", *[F.col("r")[c].alias(c) for c in rest])
        return rows.join(newest, [*KEYS, "ts"], "left_anti").select(*names).unionByName(newest.select(*names))

    def late(self) -> DataFrame:
        """Samples that came after their instant, by batch."""
        schema = T.StructType([*READING_SCHEMA.fields, T.StructField("batch", T.LongType())])
        return read_or_empty(self._spark, f"{self._path}/late", schema)
