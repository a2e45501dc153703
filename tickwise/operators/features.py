"""Rolling statistics and phase unwrapping."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwise.operators.series import ORDER, hot_series, over_series, running


def rolling_step(col: str, window: int, *, by_cell: bool):
    """A step adding delta, rolling mean, rolling std and deviation of ``col``.

    ``by_cell=True`` uses RANGE frames over the grid cell, so cells that were never made count as missing.
    """

    def step(df: DataFrame, w: WindowSpec) -> DataFrame:
        def reach(low: int, high: int) -> WindowSpec:
            return w.rangeBetween(low, high) if by_cell else w.rowsBetween(low, high)

        frame = reach(1 - window, 0)
        full = F.count(col).over(frame) == window
        mean = F.when(full, F.avg(col).over(frame))
        return df.withColumns({
            f"{col}_delta": F.abs(F.col(col) - F.first(col).over(reach(-1, -1))),
            f"{col}_rolling_mean": mean,
            f"{col}_rolling_std": F.when(full, F.stddev_samp(col).over(frame)),
            f"{col}_dev_from_mean": F.abs(F.col(col) - mean),
        })

    return step


def reach_of(window: int) -> int:
    """How many rows back ``rolling_step`` looks."""
    return max(window - 1, 1)


def add_delta_and_rolling(
    df: DataFrame, keys: Sequence[str], col: str, window: int, *, order: Sequence[str] = ORDER, hot="check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """``<col>_delta``, ``_rolling_mean``, ``_rolling_std``, ``_dev_from_mean`` over trailing rows of each series.

    A rolling value is NULL unless all ``window`` values are present.
    """
    step = rolling_step(col, window, by_cell=False)
    return over_series(df, keys, step, halo=reach_of(window), order=order, hot=hot, chunk_rows=chunk_rows)


def unwrap_phase(
    df: DataFrame, keys: Sequence[str], col: str, period: float = 2 * math.pi, *, order: Sequence[str] = ORDER,
    hot="check", chunk_rows: int | None = None,
) -> DataFrame:
    """``<col>_unwrapped``: jumps of half a period or more are folded back by whole periods, cumulatively.

    From the first missing value of a series on the result is missing, since the fold count is unknown from there.
    """
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)
    half = period / 2

    def fold(d: DataFrame, w: WindowSpec) -> DataFrame:
        jump = F.col(col) - F.lag(col).over(w)
        wrapped = F.pmod(F.col("_jump") + F.lit(half), F.lit(float(period))) - F.lit(half)
        wrapped = F.when((wrapped == -half) & (F.col("_jump") > 0), F.lit(half)).otherwise(wrapped)
        fix = F.when(F.abs(F.col("_jump")) < half, F.lit(0.0)).otherwise(wrapped - F.col("_jump"))
        return d.withColumn("_jump", jump).withColumn("_fix", fix)

    fixes = over_series(df, keys, fold, halo=1, order=order, hot=hot, chunk_rows=chunk_rows)
    sums = {"_fold": F.col("_fix"), "_lost": F.col(col).isNull().cast("long")}
    done = running(fixes, keys, sums, order=order, hot=hot, chunk_rows=chunk_rows)
    value = F.when(F.col("_lost") == 0, F.col(col) + F.col("_fold"))
    return done.withColumn(f"{col}_unwrapped", value).drop("_jump", "_fix", "_fold", "_lost")
