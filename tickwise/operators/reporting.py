"""Small results for people to look at: decimated series and flags put down to faults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import whole_floor_div
from tickwise.operators.evaluate import match_windows
from tickwise.operators.series import attach, number_rows
from tickwise.schema import SEQ, TS
from tickwise.session import settle

MAX_BUCKETS = 2000


def to_ms(column):
    return whole_floor_div(column, 1_000_000)


def decimate(
    df: DataFrame, keys: Sequence[str], value: str, flag: str = "flagged", max_buckets: int = MAX_BUCKETS, *,
    order: Sequence[str] = (TS, SEQ), hot="check", chunk_rows: int | None = None,
) -> DataFrame:
    """At most 3 rows per bucket of each series: the first minimum, the first maximum and the first flagged row.

    Series of up to ``max_buckets`` rows are kept whole.  Buckets hold equal numbers of rows, with edges at the whole
    part of i*n/B.  Rows are reduced to bucket extremes before they are shuffled.
    """
    keys = list(keys)
    narrow = df.select(*keys, TS, value, flag, *[c for c in order if c not in (TS, value, flag)])
    numbered = number_rows(narrow, keys, "_r", order=order, hot=hot, chunk_rows=chunk_rows)
    sizes = settle(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    b = F.lit(max_buckets).cast("long")
    bucket = F.call_function("div", (F.col("_r") + 1) * b + F.col("_n") - 1, F.col("_n")) - 1
    bucket = F.when(F.col("_n") <= b, F.col("_r")).otherwise(bucket)
    rows = attach(numbered, sizes, keys).withColumn("_bucket", bucket)
    kept = [F.col("_r").alias("r"), F.col(TS).alias(TS), F.col(value).alias(value), F.col(flag).alias(flag)]
    picked = rows.groupBy(*keys, "_bucket").agg(
        F.min(F.struct(F.col(value).alias("by"), F.col("_r").alias("at"), F.struct(*kept).alias("row"))).alias("lo"),
        F.max(F.struct(F.col(value).alias("by"), (-F.col("_r")).alias("at"), F.struct(*kept).alias("row"))).alias("hi"),
        F.min(F.when(F.col(flag), F.struct(F.col("_r").alias("at"), F.struct(*kept).alias("row")))).alias("fl"))
    three = F.array_distinct(F.array_compact(F.array("lo.row", "hi.row", "fl.row")))
    rows = picked.select(*keys, F.explode(three).alias("row"))
    return rows.select(*keys, F.col("row.r").alias("row"), f"row.{TS}", f"row.{value}", f"row.{flag}").withColumn(
        "ts_ms", to_ms(F.col(TS)))


def windows_ms(labels: DataFrame) -> DataFrame:
    """Label windows in whole milliseconds."""
    return labels.withColumns({"start_ms": to_ms(F.col("start_ns")), "end_ms": to_ms(F.col("end_ns"))}).drop(
        "start_ns", "end_ns")


def full_counts(df: DataFrame, keys: Sequence[str], flag: str = "flagged") -> DataFrame:
    """Rows and flags of each series before decimation."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows_full"), F.count_if(F.col(flag)).alias("n_anomalies_full"))


def attribute_flags(
    df: DataFrame, labels: DataFrame, keys: Sequence[str], flag: str = "flagged", time: str = "ts_ms",
    start: str = "start_ms", end: str = "end_ms",
) -> DataFrame:
    """``fault``: a flagged row's fault type by the first listed window around it, else ``other``; NULL if not flagged.

    Windows are cut where they overlap and each stretch given to its first-listed owner, so a row meets one of them.
    """
    keys = list(keys)
    named = labels.select(*keys, F.col(start).alias("start_ns"), F.col(end).alias("end_ns"), "fault_type", "ord")
    owned = first_listed(named, keys)
    met = match_windows(df, owned, keys, "left", time=time)
    fault = F.when(F.col(flag), F.coalesce(F.col("fault_type"), F.lit("other")))
    return met.withColumn("fault", fault).drop("start_ns", "end_ns", "fault_type")


def first_listed(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cut closed windows at each other's ends and keep, for every stretch, the window listed first. Label tables only."""
    keys = list(keys)
    cuts = windows.select(*keys, F.col("start_ns").alias("at")).unionByName(
        windows.select(*keys, (F.col("end_ns") + 1).alias("at"))).distinct()
    along = Window.partitionBy(*keys).orderBy("at")
    stretches = cuts.withColumn("_next", F.lead("at").over(along)).where(F.col("_next").isNotNull())
    pieces = stretches.select(*keys, F.col("at").alias("_lo"), (F.col("_next") - 1).alias("_hi"))
    # A stretch lies wholly inside or outside any window, so its first instant decides.
    owners = match_windows(pieces, windows, keys, "inner", time="_lo").groupBy(*keys, "_lo", "_hi").agg(
        F.min_by("fault_type", "ord").alias("fault_type"))
    return owners.select(*keys, F.col("_lo").alias("start_ns"), F.col("_hi").alias("end_ns"), "fault_type")


def split_by_fault(attributed: DataFrame, ids: Sequence[str], value: str, faults: Sequence[str]) -> DataFrame:
    """One value column per fault type, NULL where the row is not of that type."""
    return attributed.select(*ids, *[F.when(F.col("fault") == f, F.col(value)).alias(f) for f in [*faults, "other"]])
