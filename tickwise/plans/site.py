"""One site's series end to end: faults in, gaps, grid, features, model, scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickwise.operators import evaluate, faults, features, forest, timeaxis
from tickwise.operators.series import attach, hot_series, over_series
from tickwise.schema import CELL, FILL_LIMIT, FILLED, GAP, SAMPLE_INTERVAL_NS, SEQ, STATUS, TS, feature_names
from tickwise.session import keep, settle
from tickwise.sources.channels import default_status


@dataclass(frozen=True)
class SiteResult:
    """Scored rows and labels are settled; the metric tables are one aggregation each, run when asked for."""

    scored: DataFrame
    labels: DataFrame
    overall: DataFrame
    by_fault_type: DataFrame
    caught: DataFrame
    features: list[str]
    rows: DataFrame
    keys: list[str]
    settings: forest.Settings

    def model(self) -> forest.Forest:
        """The fitted models of this run, for scoring later data: a forest is a function of its rows and the seed, so they are made when
        asked for and flag the run's rows as the run did."""
        return forest.fit(self.rows, self.features, self.keys, self.settings)


def feature_rows(
    df: DataFrame,
    keys: Sequence[str],
    target: str,
    status: str | None = STATUS,
    *,
    window: int = 10,
    freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS,
    fill_limit: int = FILL_LIMIT,
    unusable: str = "raise",
    hot="check",
    chunk_rows: int | None = None,
    chunk_cells: int | None = None,
) -> DataFrame:
    """Raw samples to clean model rows.

    With a table of intervals, a series without a usable one is an error or, with ``unusable="skip"``, has no rows.

    Two shuffles of the data: one along each series to measure gaps and drop repeated times, one by (series, chunk of
    cells) for everything on the grid.  The measured samples are settled in between, as both the median gap and the grid
    are made from them.  Cells that cleaning would drop are never made.
    """
    keys = list(keys)
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)
    cols = [target, status] if status else [target]

    def gaps(d: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag(TS).over(w)
        gap = (F.col(TS) - before) / F.lit(1e9) * F.lit(1000.0)
        return d.withColumns({GAP: gap, "_again": F.coalesce(before == F.col(TS), F.lit(False))})

    measured = settle(over_series(
        df.select(*keys, TS, SEQ, *cols), keys, gaps, halo=1, hot=hot, chunk_rows=chunk_rows))
    medians = settle(timeaxis.median_gap(measured, keys, hot=hot))
    once = attach(measured.where(~F.col("_again")).drop("_again"), medians, keys, "left")
    once = once.withColumn(GAP, F.coalesce(GAP, "median_gap_ms")).drop("median_gap_ms")
    bounds = timeaxis.grid_bounds(df, keys, freq_ns, unusable)
    gridded = timeaxis.on_grid(
        once, keys, cols, carried=[GAP], fill_limit=fill_limit, bounds=bounds, dense=False, chunk_cells=chunk_cells,
        then=features.rolling_step(target, window, by_cell=True), then_reach=features.reach_of(window))
    names = feature_names(target, status)
    clean = timeaxis.clean_rows(gridded, names[1:4], [target, GAP, *([status] if status else [])])
    return clean.select(*keys, TS, CELL, *names, FILLED)


def detect_timing_faults(
    df: DataFrame,
    keys: Sequence[str] = ("site",),
    target: str = "value",
    status: str = STATUS,
    *,
    window: int = 10,
    settings: forest.Settings = forest.Settings(),
    spec: Sequence[dict] | None = faults.DEFAULT_SPEC,
    windows: DataFrame | None = None,
    short: str = "raise",
    freq_ns: int | DataFrame = SAMPLE_INTERVAL_NS,
    chunk_rows: int | None = None,
    chunk_cells: int | None = None,
) -> SiteResult:
    """Put labelled faults into each series, detect, and score the detection; one model per series.

    ``df`` has ``keys``, ``ts_ns``, ``seq``, the target and possibly a status column.  Without ``windows`` the default
    placement is used, and a series too short for it is an error or, with ``short="skip"``, has no faults; items of
    ``spec`` may bring their own ``start_ns`` and ``end_ns`` instead.
    """
    keys = list(keys)
    # Faults, intervals, gaps and grid all start from these rows, so their source is read once.
    df = keep(default_status(df, status))
    hot = hot_series(df, keys, chunk_rows)
    spec = list(spec or ())
    if spec:
        if windows is None and "start_ns" not in spec[0]:
            windows = faults.default_windows(df, keys, len(spec), short=short, hot=hot, chunk_rows=chunk_rows)
        df, labels = faults.inject_faults(df, keys, spec, windows, status=status, hot=hot, chunk_rows=chunk_rows)
    else:
        labels = settle(df.select(*keys).limit(0).selectExpr(
            "*", "0L start_ns", "0L end_ns", "'' fault_type", "0 ord"))
    rows = settle(feature_rows(
        df, keys, target, status, window=window, freq_ns=freq_ns, hot=hot, chunk_rows=chunk_rows,
        chunk_cells=chunk_cells))
    names = feature_names(target, status)
    scored = settle(forest.detect(rows, names, keys, settings))
    judged = evaluate.truth_mask(scored, labels, keys)
    return SiteResult(
        scored, labels, evaluate.precision_recall(judged, by=keys),
        evaluate.share_by_fault_type(scored, labels, keys, by=keys),
        evaluate.caught_by_fault_type(scored, labels, keys, by=keys), names, rows, keys, settings)
