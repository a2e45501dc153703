"""Sorting, deduplicating, gap measuring, gridding and bounded filling of keyed series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwise.functions.columns import floor_div
from tickwise.operators.series import (
    attach, hot_series, over_series, own_rows, percentile_per_key, running, with_halo)
from tickwise.schema import CELL, FILL_LIMIT, FILLED, GAP, SAMPLE_INTERVAL_NS, SEQ, TS
from tickwise.session import settle

# Chunks of the grid cost nothing but their halo of a dozen rows, so they are small enough to use every core.
CHUNK_CELLS = 50_000
# Sorts behind every real sample, so an empty grid cell only wins where no sample is near enough.
NO_SAMPLE = (1 << 63) - 1


def time_sort(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Globally ordered output (a range shuffle); operators order their own windows and do not need it."""
    return df.orderBy(*keys, TS, SEQ)


def drop_duplicate_times(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the first row, by ``seq``, of each time. Spark prunes copies before the shuffle, so piles of them are cheap."""
    first = Window.partitionBy(*keys, TS).orderBy(SEQ)
    return df.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")


def add_gap(df: DataFrame, keys: Sequence[str], *, hot="check", chunk_rows: int | None = None) -> DataFrame:
    """``gap_ms`` to the previous raw sample; NULL on the first one."""

    def step(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumn(GAP, (F.col(TS) - F.lag(TS).over(w)) / F.lit(1e9) * F.lit(1000.0))

    return over_series(df, keys, step, halo=1, hot=hot, chunk_rows=chunk_rows)


def median_gap(gapped: DataFrame, keys: Sequence[str], *, hot="check") -> DataFrame:
    """One row per series: the median of its measured gaps."""
    return percentile_per_key(gapped, keys, GAP, 0.5, "median_gap_ms", hot=hot)


def add_gap_features(df: DataFrame, keys: Sequence[str], *, hot="check", chunk_rows: int | None = None) -> DataFrame:
    """``gap_ms`` with the first sample of each series given the series' median gap. Run this before gridding."""
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)
    gapped = add_gap(df, keys, hot=hot, chunk_rows=chunk_rows)
    medians = settle(median_gap(gapped, keys, hot=hot))
    filled = F.coalesce(F.col(GAP), F.col("median_gap_ms"))
    return attach(gapped, medians, keys, "left").withColumn(GAP, filled).drop("median_gap_ms")


def sample_interval(
    df: DataFrame, keys: Sequence[str], *, order: Sequence[str] = (SEQ,), hot="check", chunk_rows: int | None = None
) -> DataFrame:
    """One row per series: the median step between successive times in row order, cut to whole nanoseconds."""
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)

    def step(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumn("_step", F.col(TS) - F.lag(TS).over(w))

    stepped = over_series(
        df.select(*keys, TS, *[c for c in order if c != TS]), keys, step, halo=1, order=order, hot=hot,
        chunk_rows=chunk_rows)
    median = percentile_per_key(stepped, keys, "_step", 0.5, "_median", hot=hot)
    return median.select(*keys, F.col("_median").cast("long").alias("freq_ns"))


def grid_bounds(
    df: DataFrame, keys: Sequence[str], freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS, unusable: str = "skip"
) -> DataFrame:
    """One settled row per series: first time, grid step and number of cells.

    ``freq_ns`` may be a table by all or some of the keys, for series sampled at different rates.  A series without a
    usable interval there (see ``without_interval``) has no row or, with ``unusable="raise"``, is an error.
    """
    span = df.groupBy(*keys).agg(F.min(TS).alias("t0"), F.max(TS).alias("_t1"))
    if isinstance(freq_ns, DataFrame):
        span = span.join(freq_ns, [k for k in keys if k in freq_ns.columns], "left")
    else:
        if freq_ns < 1:
            raise ValueError("the grid step must be at least one nanosecond")
        span = span.withColumn("freq_ns", F.lit(freq_ns).cast("long"))
    # An interval of zero (most successive times equal) cannot carry a grid.
    fine = F.coalesce(F.col("freq_ns"), F.lit(0)) >= 1
    cells = F.when(fine, floor_div(F.col("_t1") - F.col("t0"), F.when(fine, F.col("freq_ns")))) + 1
    every = settle(span.withColumn("n_cells", cells).drop("_t1"))
    if unusable == "raise":
        lost = [tuple(r) for r in every.where(~fine).select(*keys).limit(5).collect()]
        if lost:
            raise ValueError(f"series without a usable sampling interval, such as {lost}")
    return every.where(fine)


def without_interval(df: DataFrame, keys: Sequence[str], freq_ns: DataFrame) -> DataFrame:
    """The series that a grid leaves out, as they have no usable sampling interval: a single time, or most times equal."""
    by = [k for k in keys if k in freq_ns.columns]
    return df.select(*keys).distinct().join(freq_ns, by, "left").where(F.coalesce("freq_ns", F.lit(0)) < 1).select(*keys)


def regular_grid(bounds: DataFrame, keys: Sequence[str], chunk_cells: int | None = None) -> DataFrame:
    """Every cell of every series' grid. Cells are generated chunk by chunk, so a long grid is made by many tasks."""
    size = chunk_cells or CHUNK_CELLS
    last = floor_div(F.col("n_cells") - 1, size)
    pieces = bounds.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(*keys, "_piece")
    low = F.col("_piece") * F.lit(size)
    high = F.least(low + F.lit(size - 1), F.col("n_cells") - 1)
    return (
        pieces.withColumn(CELL, F.explode(F.sequence(low, high))).drop("_piece")
        .withColumn(TS, F.col("t0") + F.col(CELL) * F.col("freq_ns"))
    )


def nearest_cells(df: DataFrame, keys: Sequence[str], bounds: DataFrame) -> DataFrame:
    """Name the grid cell within half a step of each sample (both cells on an exact tie), replacing an as-of join.

    Adds ``cell`` and ``_dist``.  This is arithmetic per sample: nothing is shuffled to find neighbours.
    """
    joined = attach(df, bounds, keys)
    since = F.col(TS) - F.col("t0")
    left = floor_div(since, F.col("freq_ns"))
    rest = since - left * F.col("freq_ns")
    placed = joined.withColumn("_left", left).withColumn("_rest", rest)
    ahead = F.col("freq_ns") - F.col("_rest")
    cells = (
        F.when(F.col("_rest") == ahead, F.array(F.col("_left"), F.col("_left") + 1))
        .when(F.col("_rest") < ahead, F.array(F.col("_left")))
        .otherwise(F.array(F.col("_left") + 1))
    )
    away = F.abs(F.col(TS) - F.col("t0") - F.col(CELL) * F.col("freq_ns"))
    return (
        placed.withColumn(CELL, F.explode(cells)).where(F.col(CELL) < F.col("n_cells"))
        .withColumn("_dist", away).drop("_left", "_rest")
    )


def on_grid(
    df: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    *,
    carried: Sequence[str] = (),
    freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS,
    fill_limit: int = FILL_LIMIT,
    then: Callable[[DataFrame, WindowSpec], DataFrame] | None = None,
    then_reach: int = 0,
    dense: bool = True,
    bounds: DataFrame | None = None,
    chunk_cells: int | None = None,
) -> DataFrame:
    """Snap samples with distinct times onto the grid, fill, and run ``then(df, window)``, all in one partitioning.

    Rows are spread by (series, chunk of cells); picking the nearest sample, marking, filling and the windows of
    ``then`` share that one shuffle.  ``then`` must use RANGE frames over ``cell`` reaching back ``then_reach`` cells.
    With ``dense=False`` cells too far behind a sample to be filled are not made at all, which is what a caller wants
    who drops them next: an hour-long outage then costs nothing.
    """
    keys, size = list(keys), chunk_cells or CHUNK_CELLS
    cols = [*value_cols, *carried]
    bounds = grid_bounds(df, keys, freq_ns, "raise") if bounds is None else bounds
    frame = ["t0", "freq_ns", "n_cells"]
    near = nearest_cells(df, keys, bounds).select(*keys, CELL, "_dist", TS, SEQ, *cols, *frame)
    if dense:
        types = dict(near.dtypes)
        nothing = [F.lit(None).cast(types[c]).alias(c) for c in (TS, SEQ, *cols)]
        empty = regular_grid(bounds, keys, size).drop(TS)
        near = near.unionByName(empty.select(*keys, CELL, F.lit(NO_SAMPLE).alias("_dist"), *nothing, *frame))
    pieces = with_halo(near.withColumn("_later", -F.col(TS)), CELL, fill_limit + then_reach, size)
    part = [*keys, "_chunk"]
    ranked = Window.partitionBy(*part).orderBy(CELL, "_dist", "_later", SEQ)
    w = Window.partitionBy(*part).orderBy(CELL)
    best = (
        pieces.withColumn("_before", F.lag(CELL).over(ranked))
        .where(F.col("_before").isNull() | (F.col("_before") != F.col(CELL)))
        .drop("_before", "_dist", "_later", TS, SEQ)
    )
    if not dense:
        reach = F.least(
            F.coalesce(F.lead(CELL).over(w) - 1, F.col(CELL) + fill_limit), F.col(CELL) + fill_limit,
            F.col("n_cells") - 1)
        spread = best.withColumn("_own", F.col(CELL)).withColumn("_reach", reach)
        spread = spread.withColumn(CELL, F.explode(F.sequence(F.col("_own"), F.col("_reach"))))
        real = F.col(CELL) == F.col("_own")
        best = spread.select(*part, CELL, *frame, *[F.when(real, F.col(c)).alias(c) for c in cols])
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in value_cols])
    back = w.rangeBetween(-fill_limit, 0)
    filled = best.withColumn(FILLED, missing)
    if fill_limit:
        filled = filled.withColumns({c: F.last(c, ignorenulls=True).over(back) for c in cols})
    if then is not None:
        filled = then(filled, w)
    out = own_rows(filled, CELL, size)
    rest = [c for c in filled.columns if c not in (*part, *frame, CELL)]
    return out.select(*keys, CELL, (F.col("t0") + F.col(CELL) * F.col("freq_ns")).alias(TS), *rest)


def regularize(
    df: DataFrame,
    keys: Sequence[str],
    value_cols: Sequence[str],
    *,
    carried: Sequence[str] = (),
    freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS,
    fill_limit: int = FILL_LIMIT,
    dense: bool = True,
    chunk_cells: int | None = None,
) -> DataFrame:
    """The series on its regular grid: nearest sample within half a step, ``was_filled``, then a bounded forward fill.

    ``was_filled`` looks at ``value_cols`` only; ``carried`` columns (the gap) are filled along with them.
    """
    clean = drop_duplicate_times(df, keys)
    return on_grid(
        clean, keys, value_cols, carried=carried, freq_ns=freq_ns, fill_limit=fill_limit, dense=dense,
        chunk_cells=chunk_cells)


def asof_nearest(
    df: DataFrame, keys: Sequence[str], value_cols: Sequence[str], freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS,
    *, chunk_cells: int | None = None,
) -> DataFrame:
    """Nearest-sample join onto the grid with a tolerance of half a step, and nothing filled."""
    return regularize(df, keys, value_cols, freq_ns=freq_ns, fill_limit=0, chunk_cells=chunk_cells)


def fill_forward(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], limit: int = FILL_LIMIT, *,
    order: Sequence[str] = (TS, SEQ), hot="check", chunk_rows: int | None = None,
) -> DataFrame:
    """Carry the last value at most ``limit`` rows."""

    def step(d: DataFrame, w: WindowSpec) -> DataFrame:
        back = w.rowsBetween(-limit, 0)
        return d.withColumns({c: F.last(c, ignorenulls=True).over(back) for c in cols})

    return over_series(df, keys, step, halo=limit, order=order, hot=hot, chunk_rows=chunk_rows)


def fill_forward_unbounded(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], *, hot="check", chunk_rows: int | None = None
) -> DataFrame:
    """Carry the last value as far as it takes."""
    lasts = {f"_{c}_last": F.col(c) for c in cols}
    done = running(df, keys, lasts=lasts, hot=hot, chunk_rows=chunk_rows)
    return done.withColumns({c: F.col(f"_{c}_last") for c in cols}).drop(*lasts)


def parse_times(df: DataFrame, text: str, fmt: str | None = None) -> DataFrame:
    """Text time to ``ts_ns``; rows whose time does not parse are dropped."""
    parsed = F.try_to_timestamp(F.col(text), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(text))
    stamped = df.withColumn(TS, F.unix_micros(parsed.cast("timestamp")) * F.lit(1000))
    return stamped.where(F.col(TS).isNotNull())


def clean_rows(df: DataFrame, neutral: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Missing rolling statistics become 0.0; rows missing the measurement itself (or gap, or status) go."""
    return df.fillna(0.0, subset=list(neutral)).dropna(subset=list(required))


def enough_rows(df: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """Every series with its clean row count and whether it can be modelled at all."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("usable", F.col("n_rows") >= at_least)


def elapsed_to_ns(seconds: Column, anchor_ns: int) -> Column:
    """Relative seconds to nanoseconds on an arbitrary fixed anchor; only spacing matters downstream."""
    return F.lit(anchor_ns) + F.round(seconds * F.lit(1e9)).cast("long")
