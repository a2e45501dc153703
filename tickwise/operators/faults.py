"""Labelled timing faults put into a real table, with the label table they give rise to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.columns import gaussian
from tickwise.operators.series import attach, number_rows
from tickwise.operators.timeaxis import sample_interval
from tickwise.schema import SEQ, STATUS, TS
from tickwise.session import settle

JITTER, DROPOUT, STEP, STATUS_FAULT = "timestamp_jitter", "dropout", "clock_step", "tq_corruption"

# The default experiment, in the order it is applied, four rows each.
DEFAULT_SPEC = (
    {"type": DROPOUT},
    {"type": JITTER, "std_ms": 5.0, "seed": 0},
    {"type": STEP, "offset_ms": 33.5},
    {"type": STATUS_FAULT, "bad_value": 1.0},
)
DEFAULT_ROWS = 4
ROWS_PER_STEP = 8


def within(start: Column, end: Column, time: Column | None = None) -> Column:
    """Closed interval test; false where the series has no such window."""
    time = F.col(TS) if time is None else time
    return F.coalesce((time >= start) & (time <= end), F.lit(False))


def jitter(df: DataFrame, start: Column, end: Column, std_ms: float, seed: int = 0) -> DataFrame:
    """Shift times in the window by normal draws that depend on the seed and the row, not on the partitioning."""
    shift = (F.lit(std_ms * 1e6) * gaussian(F.lit(seed), F.col(SEQ))).cast("long")
    return df.withColumn(TS, F.when(within(start, end), F.col(TS) + shift).otherwise(F.col(TS)))


def dropout(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Remove the window's rows altogether."""
    return df.where(~within(start, end))


def clock_step(df: DataFrame, start: Column, end: Column, offset_ms: float) -> DataFrame:
    """Shift times in the window by one fixed offset."""
    moved = F.col(TS) + F.lit(int(offset_ms * 1e6))
    return df.withColumn(TS, F.when(within(start, end), moved).otherwise(F.col(TS)))


def corrupt_status(
    df: DataFrame, start: Column, end: Column, bad_value: float = 1.0, status: str = STATUS
) -> DataFrame:
    """Set the status column to a bad-lock value in the window."""
    return df.withColumn(status, F.when(within(start, end), F.lit(float(bad_value))).otherwise(F.col(status)))


def default_windows(
    df: DataFrame, keys: Sequence[str], items: int = len(DEFAULT_SPEC), *, short: str = "raise", hot="check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """One window per fault and series, evenly spaced: rows i*step .. i*step+3 with step = n // (items + 1).

    A series of fewer than 8 rows a step (40 for the default faults) has no room: that is an error, or with ``short="skip"`` it
    gets no window.  Only the border rows of each window leave the scan.
    """
    keys = list(keys)
    least = ROWS_PER_STEP * (items + 1)
    sizes = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    if short != "skip" and not sizes.where(F.col("_n") < least).isEmpty():
        raise ValueError(f"{sizes.where(F.col('_n') < least).count()} series have fewer than {least} rows")
    sizes = sizes.where(F.col("_n") >= least)
    numbered = number_rows(df.select(*keys, TS, SEQ), keys, "_row", hot=hot, chunk_rows=chunk_rows)
    step = F.call_function("div", F.col("_n"), F.lit(items + 1))
    placed = attach(numbered, sizes, keys).withColumn("_step", step)
    place = F.call_function("div", F.col("_row"), F.col("_step"))
    within_step = F.col("_row") - place * F.col("_step")
    border = placed.withColumn("_place", place).withColumn("_off", within_step).where(
        F.col("_place").between(1, items) & F.col("_off").isin(0, DEFAULT_ROWS - 1))
    return border.groupBy(*keys, "_place").agg(F.min(TS).alias("start_ns"), F.max(TS).alias("end_ns")).select(
        *keys, (F.col("_place") - 1).cast("int").alias("ord"), "start_ns", "end_ns")


def inject_faults(
    df: DataFrame,
    keys: Sequence[str],
    spec: Sequence[dict],
    windows: DataFrame | None = None,
    *,
    status: str = STATUS,
    hot="check",
    chunk_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply faults in list order, each seeing the times the previous one left; returns (table, labels).

    A spec item is ``{"type": ..., parameters}``.  Its window is either given for every series by ``start_ns`` and
    ``end_ns`` or per series by ``windows`` (keys, ord = place in the list, start_ns, end_ns).  Labels have a row per
    series and item; a dropout's end and both ends of a clock step are padded by the series' current sample interval,
    because their evidence is on the neighbouring rows.
    """
    keys = list(keys)
    original = df.columns
    if windows is None:
        ends = settle(df.select(*keys).distinct())
        for i, item in enumerate(spec):
            fixed = {f"_s{i}": F.lit(int(item["start_ns"])).cast("long"), f"_e{i}": F.lit(int(item["end_ns"])).cast("long")}
            ends, df = ends.withColumns(fixed), df.withColumns(fixed)
    else:
        picks = []
        for i in range(len(spec)):
            picks.append(F.max(F.when(F.col("ord") == i, F.col("start_ns"))).alias(f"_s{i}"))
            picks.append(F.max(F.when(F.col("ord") == i, F.col("end_ns"))).alias(f"_e{i}"))
        ends = settle(windows.groupBy(*keys).agg(*picks))
        without = [i for i in range(len(spec)) if not ends.where(F.col(f"_s{i}").isNull() | F.col(f"_e{i}").isNull()).isEmpty()]
        if without:
            raise ValueError(f"some series have no window for item {without} of the faults")
        df = attach(df, ends, keys, "left")
    labels = []
    for i, item in enumerate(spec):
        start, end, kind = F.col(f"_s{i}"), F.col(f"_e{i}"), item["type"]
        label = ends.where(start.isNotNull())
        before = after = F.lit(0)
        if kind in (DROPOUT, STEP):
            interval = settle(sample_interval(df, keys, order=(SEQ,), hot=hot, chunk_rows=chunk_rows))
            label = label.join(interval, keys)
            after = F.col("freq_ns")
            before = F.col("freq_ns") if kind == STEP else before
        labels.append(label.select(
            *keys, (start - before).alias("start_ns"), (end + after).alias("end_ns"),
            F.lit(kind).alias("fault_type"), F.lit(i).alias("ord")))
        if kind == JITTER:
            df = jitter(df, start, end, item["std_ms"], item.get("seed", 0))
        elif kind == DROPOUT:
            df = dropout(df, start, end)
        elif kind == STEP:
            df = clock_step(df, start, end, item["offset_ms"])
        elif kind == STATUS_FAULT:
            df = corrupt_status(df, start, end, item.get("bad_value", 1.0), status)
        else:
            raise ValueError(f"unknown fault type {kind!r}")
    table = labels[0]
    for more in labels[1:]:
        table = table.unionByName(more)
    return df.select(*original), settle(table)
