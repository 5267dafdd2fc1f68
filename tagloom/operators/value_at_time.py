"""The value of every tag at every instant of a sampling grid.

Rules, per tag and over samples with status 0: a sample exactly at the instant is
taken; otherwise, with neighbours before and after that are both numbers, the value is
linear in time; a digital neighbour on either side, or no later sample, holds the
earlier one; with no earlier sample there is no data. Samples are unique by tag and
time, as the archive keeps them; reduce a raw feed with ``latest_per_key`` first.

Plan. Samples are first reduced, with partial aggregation before the shuffle, to the
first and last sample of each (tag, grid cell); a tag or a moment that holds a third
of all rows shrinks to at most one row per cell in every map task. Grid instants are
then generated between consecutive non-empty cells instead of being joined to them.
Cells are processed in blocks of bounded size, each seeded with the last sample of
earlier blocks and the first of later ones, so that a long history of one tag is
spread over many tasks, as many as the number of instants calls for.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tagloom.operators.enrich import enrich
from tagloom.operators.grid import GridSpec

KEYS = ["site", "server", "tag"]
CELLS_PER_BLOCK = 16_384
POINTS_PER_TASK = 250_000

# A sample is kept as three plain columns, not as a struct: buffers of fixed width let
# Spark aggregate by hash, without sorting the raw samples.
_SIDES = ("first", "last")
FIELDS = {"t": "bigint", "istat": "bigint", "v": "double"}
_COLUMNS = [f"{side}_{f}" for side in _SIDES for f in FIELDS]


def _nothing(side: str) -> list[Column]:
    return [F.lit(None).cast(t).alias(f"{side}_{f}") for f, t in FIELDS.items()]


def _earliest(side: str, alias: str, over: WindowSpec | None = None) -> list[Column]:
    return _pick(F.min_by, side, alias, over)


def _latest(side: str, alias: str, over: WindowSpec | None = None) -> list[Column]:
    return _pick(F.max_by, side, alias, over)


def _pick(by, side: str, alias: str, over: WindowSpec | None) -> list[Column]:
    # All three columns are picked by the same comparison, so they are of one sample.
    picked = [by(F.col(f"{side}_{f}"), F.col(f"{side}_t")) for f in FIELDS]
    return [(c.over(over) if over is not None else c).alias(f"{alias}_{f}") for c, f in zip(picked, FIELDS)]


def range_samples(
    samples: DataFrame, grid: GridSpec, lookback: timedelta | None = None, lookahead: timedelta | None = None
) -> DataFrame:
    """Good samples that can affect the grid. The paddings bound the scan; without them
    neighbours are found however far away they are."""
    kept = samples.where(F.col("status") == 0)
    if lookback is not None:
        kept = kept.where(F.col("ts") >= F.lit(grid.start - lookback))
    if lookahead is not None:
        kept = kept.where(F.col("ts") < F.lit(grid.end + lookahead))
    return kept


def cell_summary(samples: DataFrame, grid: GridSpec) -> DataFrame:
    """First and last sample of each tag and cell."""
    sample = {"t": F.unix_micros("ts"), "istat": F.col("istat").cast("bigint"), "v": F.col("rval")}
    return (
        samples.select(*KEYS, grid.cell_of(F.col("ts")).alias("cell"), *[c.alias(f"s_{f}") for f, c in sample.items()])
        .groupBy(*KEYS, "cell")
        .agg(*_earliest("s", "first"), *_latest("s", "last"))
    )


def _block_of(grid: GridSpec, size: int) -> Column:
    """Block of a cell; what lies before and after the grid forms a block of its own each."""
    return (
        F.when(F.col("cell") < 0, F.lit(-1))
        .when(F.col("cell") >= grid.points, F.lit(-(-grid.points // size)))
        .otherwise(F.call_function("div", F.col("cell"), F.lit(size)))
        .cast("bigint")
    )


def _block_edges(cells: DataFrame, tags: DataFrame, grid: GridSpec, size: int) -> DataFrame:
    """For each tag and block, an edge row before its first cell carrying the last earlier
    sample, and one after its last cell carrying the first later sample."""
    blocks = -(-grid.points // size)
    every = tags.select(
        *KEYS,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        *_nothing("first"), *_nothing("last"),
    )
    summary = (
        cells.select(*KEYS, "block", *_COLUMNS)
        .unionByName(every)
        .groupBy(*KEYS, "block")
        .agg(*_earliest("first", "first"), *_latest("last", "last"))
    )
    before = Window.partitionBy(*KEYS).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*KEYS).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *KEYS, "block", *_latest("last", "in", before), *_earliest("first", "out", after)
    ).where((F.col("block") >= 0) & (F.col("block") < blocks))
    low = F.col("block") * F.lit(size) - 1
    high = F.least((F.col("block") + 1) * F.lit(size), F.lit(grid.points).cast("bigint"))
    incoming = [F.col(f"in_{f}").alias(f"last_{f}") for f in FIELDS]
    outgoing = [F.col(f"out_{f}").alias(f"first_{f}") for f in FIELDS]
    edges = F.array(
        F.struct(low.alias("cell"), *_nothing("first"), *incoming),
        F.struct(high.alias("cell"), *outgoing, *_nothing("last")),
    )
    return carried.select(*KEYS, "block", F.explode(edges).alias("edge")).select(*KEYS, "block", "edge.*")


def value_at_time(
    samples: DataFrame,
    tags: DataFrame,
    grid: GridSpec,
    lookback: timedelta | None = None,
    lookahead: timedelta | None = None,
    cells_per_block: int = CELLS_PER_BLOCK,
    **join_options,
) -> DataFrame:
    """Readings at the grid instants: KEYS, ts, rval, istat, status, no_data.

    ``tags`` lists the wanted (site, server, tag) once each.
    """
    wanted = tags.select(*KEYS)
    if grid.points == 0:
        bare = wanted.where(F.lit(False))
        return bare.select(
            *KEYS, F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("double").alias("rval"),
            F.lit(None).cast("bigint").alias("istat"), F.lit(0).cast("bigint").alias("status"),
            F.lit(True).alias("no_data"),
        )
    usable = enrich(
        range_samples(samples, grid, lookback, lookahead), wanted, KEYS, ["ts"], how="left_semi", **join_options
    )
    return points_between(neighbours(usable, wanted, grid, cells_per_block), grid)


def neighbours(usable: DataFrame, wanted: DataFrame, grid: GridSpec, cells_per_block: int = CELLS_PER_BLOCK) -> DataFrame:
    """Stretches of grid instants, ``lo`` to ``hi``, with the samples before and after them in ``p_*``
    and ``n_*``. ``usable`` holds good samples of the ``wanted`` tags only."""
    # Used twice below; nothing is filtered from either use, so that both read one shuffle.
    cells = cell_summary(usable, grid).withColumn("block", _block_of(grid, cells_per_block))
    rows = cells.select(*KEYS, "block", "cell", *_COLUMNS).unionByName(
        _block_edges(cells, wanted, grid, cells_per_block)
    )

    # Few rows can stand for many instants, so the number of tasks follows the output.
    tasks = -(-wanted.count() * grid.points // POINTS_PER_TASK)
    rows = rows.repartition(max(tasks, 1), *KEYS, "block")

    # Edge rows share a cell number with no other row of their block. The single rows of
    # the blocks before and after the grid have no successor and go no further.
    order = Window.partitionBy(*KEYS, "block").orderBy("cell")
    gaps = rows.select(
        *KEYS,
        (F.col("cell") + 1).alias("lo"),
        F.lead("cell").over(order).alias("next_cell"),
        *[F.col(f"last_{f}").alias(f"p_{f}") for f in FIELDS],
        *[F.lead(f"first_{f}").over(order).alias(f"n_{f}") for f in FIELDS],
        F.least(
            (F.col("block") + 1) * F.lit(cells_per_block), F.lit(grid.points).cast("bigint")
        ).alias("block_end"),
    ).where(F.col("next_cell").isNotNull())
    hi = F.least(F.col("next_cell"), F.col("block_end") - 1)
    return gaps.withColumn("hi", hi).where("lo <= hi").drop("next_cell", "block_end")


def points_between(gaps: DataFrame, grid: GridSpec) -> DataFrame:
    """The value at every instant of the stretches that ``neighbours`` gives."""
    points = gaps.select(
        *KEYS, *[f"{side}_{f}" for side in ("p", "n") for f in FIELDS], F.explode(F.sequence("lo", "hi")).alias("cell")
    )
    at = points.withColumn("g", grid.instant_micros(F.col("cell")))
    return at.select(*KEYS, F.timestamp_micros("g").alias("ts"), *interpolated())


def interpolated() -> list[Column]:
    """rval, istat, status, no_data at ``g`` from the neighbours in ``p_*`` and ``n_*``."""
    g = F.col("g")
    p = {f: F.col(f"p_{f}") for f in FIELDS}
    n = {f: F.col(f"n_{f}") for f in FIELDS}
    exact = F.coalesce(n["t"] == g, F.lit(False))
    none = p["t"].isNull()
    hold = n["t"].isNull() | (p["istat"] < 0) | (n["istat"] < 0)
    share = (g - p["t"]).cast("double") / (n["t"] - p["t"]).cast("double")
    linear = p["v"] + (n["v"] - p["v"]) * share
    value = F.when(exact, n["v"]).when(none, None).when(hold, p["v"]).otherwise(linear)
    istat = F.when(exact, n["istat"]).when(none, None).when(hold, p["istat"]).otherwise(F.lit(0))
    return [
        value.cast("double").alias("rval"),
        istat.cast("bigint").alias("istat"),
        F.lit(0).cast("bigint").alias("status"),
        (~exact & none).alias("no_data"),
    ]
