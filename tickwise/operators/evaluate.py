"""Scoring flags against labelled windows, and rolling flags up to recordings and cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import whole_floor_div
from tickwise.schema import TS
from tickwise.session import is_small, settle


# Into how many time buckets the longest window is cut.
BUCKETS_PER_WINDOW = 64


def merge_windows(labels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join overlapping windows of each group into disjoint ones, so that a time lies in at most one of them."""
    ahead = Window.partitionBy(*by).orderBy("start_ns", "end_ns")
    reached = F.max("end_ns").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("start_ns") > reached), 1).otherwise(0)
    numbered = labels.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(ahead))
    spans = numbered.groupBy(*by, "_island").agg(F.min("start_ns").alias("start_ns"), F.max("end_ns").alias("end_ns"))
    return spans.drop("_island")


def spread_windows(windows: DataFrame, width: int) -> DataFrame:
    """A copy of each window per time bucket that it touches (``_bucket``)."""
    touched = F.sequence(whole_floor_div(F.col("start_ns"), width), whole_floor_div(F.col("end_ns"), width))
    return windows.withColumn("_bucket", F.explode(touched))


def bucketed(windows: DataFrame) -> tuple[DataFrame, int, bool]:
    """Settled windows in time buckets, the width of a bucket, and whether they are few enough to be broadcast.

    It is the copies that are counted. If they are too many in buckets of the longest window's ``BUCKETS_PER_WINDOW``-th part, a bucket
    is at least as wide as the average window, so that there are 3 copies a window on average at most.
    """
    length = F.col("end_ns") - F.col("start_ns")
    longest, average = windows.agg(F.max(length), F.avg(length)).first()
    width = int(longest or 0) // BUCKETS_PER_WINDOW + 1
    spread = spread_windows(windows, width)
    if is_small(spread):
        return spread, width, True
    width = max(width, int(average or 0) + 1)
    spread = spread_windows(windows, width)
    return spread, width, is_small(spread)


def match_windows(df: DataFrame, windows: DataFrame, keys: Sequence[str], how: str, time: str = TS) -> DataFrame:
    """Join rows with the windows that contain their time, as an equi-join on time buckets plus a range test.

    A window is copied into the buckets it touches (``bucketed``), a row has one bucket, so that a very long window spreads over many
    join keys; so a hash join does it, by broadcast if the copies are few.  Columns: the row's, and ``start_ns``, ``end_ns`` and the rest
    of ``windows``.
    """
    keys = list(keys)
    spread, width, small = bucketed(settle(windows))
    for key in keys:
        spread = spread.withColumnRenamed(key, f"_w_{key}")
    spread = F.broadcast(spread) if small else spread
    rows = df.withColumn("_row_bucket", whole_floor_div(F.col(time), width))
    same = F.col("_row_bucket") == F.col("_bucket")
    for key in keys:
        same = same & (F.col(key) == F.col(f"_w_{key}"))
    inside = (F.col(time) >= F.col("start_ns")) & (F.col(time) <= F.col("end_ns"))
    return rows.join(spread, same & inside, how).drop("_row_bucket", "_bucket", *[f"_w_{key}" for key in keys])


def truth_mask(df: DataFrame, labels: DataFrame, keys: Sequence[str], name: str = "truth") -> DataFrame:
    """True where a row's time is in any labelled window (both ends included)."""
    merged = merge_windows(labels.select(*keys, "start_ns", "end_ns"), list(keys))
    return match_windows(df, merged, keys, "left").withColumn(name, F.col("start_ns").isNotNull()).drop(
        "start_ns", "end_ns")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def precision_recall(df: DataFrame, truth: str = "truth", flag: str = "flagged", by: Sequence[str] = ()) -> DataFrame:
    """Counts, precision, recall and F1 in one aggregation."""
    hit = F.col(truth) & F.col(flag)
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(flag)).alias("n_flagged"),
        F.count_if(hit).alias("tp"), F.count_if(~F.col(truth) & F.col(flag)).alias("fp"),
        F.count_if(F.col(truth) & ~F.col(flag)).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def _by_fault_type(df: DataFrame, labels: DataFrame, keys: Sequence[str], out: Column, by: Sequence[str]) -> DataFrame:
    merged = merge_windows(labels.select(*keys, "fault_type", "start_ns", "end_ns"), [*keys, "fault_type"])
    return match_windows(df, merged, keys, "inner").groupBy(*by, "fault_type").agg(out)


def share_by_fault_type(
    df: DataFrame, labels: DataFrame, keys: Sequence[str], flag: str = "flagged", by: Sequence[str] = ()
) -> DataFrame:
    """Share of the rows in a fault type's windows that are flagged; types covering no row are absent."""
    share = F.avg(F.col(flag).cast("double")).alias("share_flagged")
    return _by_fault_type(df, labels, keys, share, by)


def caught_by_fault_type(
    df: DataFrame, labels: DataFrame, keys: Sequence[str], flag: str = "flagged", by: Sequence[str] = (),
    per: str = "fault_type",
) -> DataFrame:
    """Whether any row of a fault type (or, with ``per="window"``, of each single window) is flagged."""
    if per == "fault_type":
        return _by_fault_type(df, labels, keys, F.bool_or(flag).alias("caught"), by)
    single = labels.select(*keys, "ord", "fault_type", "start_ns", "end_ns")
    return match_windows(df, single, keys, "inner").groupBy(*keys, "ord", "fault_type").agg(
        F.bool_or(flag).alias("caught"))


def channel_any(df: DataFrame, keys: Sequence[str], flag: str = "flagged") -> DataFrame:
    """Whether anything at all was flagged in each channel."""
    return df.groupBy(*keys).agg(F.bool_or(flag).alias("any_flagged"))


def recording_rollup(
    channels: DataFrame, recordings: DataFrame, recording: str = "sigid", channel: str = "channel",
    flag: str = "any_flagged", per_channel_map: bool = True,
) -> DataFrame:
    """Channel verdicts to one row per recording; a recording without checked channels stays, with fraction 0.

    The map holds one entry per channel of a recording, so its size is the channel count of one file.
    """
    outcome = [
        F.bool_or(flag).alias("_any"), F.count(F.lit(1)).alias("_n"), F.count_if(F.col(flag)).alias("_hits")]
    if per_channel_map:
        pairs = F.sort_array(F.collect_list(F.struct(F.col(channel), F.col(flag))))
        outcome.append(F.map_from_entries(pairs).alias("channel_flagged"))
    rolled = channels.groupBy(recording).agg(*outcome)
    joined = recordings.join(rolled, recording, "left").withColumns({
        "any_flagged": F.coalesce("_any", F.lit(False)),
        "n_channels_checked": F.coalesce("_n", F.lit(0)),
        "fraction_flagged": ratio(F.coalesce("_hits", F.lit(0)), F.col("_n")),
    })
    if per_channel_map:
        nothing = F.create_map().cast("map<string,boolean>")
        joined = joined.withColumn("channel_flagged", F.coalesce("channel_flagged", nothing))
    return joined.drop("_any", "_n", "_hits")


def cohort_rates(results: DataFrame, threshold: float | None = None) -> DataFrame:
    """Share of positive recordings per cohort: any flagged, or a flagged fraction of at least ``threshold``."""
    positive = F.col("any_flagged") if threshold is None else F.col("fraction_flagged") >= threshold
    return results.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n_recordings"), F.count_if(positive).alias("n_positive"),
        F.avg(positive.cast("double")).alias("positive_rate"))


def threshold_sweep(results: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """``cohort_rates`` at several thresholds over one pass, with no refit.

    Recordings are first reduced to counts per distinct fraction, and only those small counts meet the thresholds.
    """
    counted = results.groupBy("cohort", "fraction_flagged").agg(F.count(F.lit(1)).alias("_n"))
    at = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    hit = F.when(F.col("fraction_flagged") >= F.col("threshold"), F.col("_n")).otherwise(0)
    swept = counted.withColumn("threshold", at).groupBy("threshold", "cohort").agg(
        F.sum("_n").alias("n_recordings"), F.sum(hit).alias("n_positive"))
    return swept.withColumn("positive_rate", ratio(F.col("n_positive"), F.col("n_recordings")))


def suffix_flag_rate(channels: DataFrame, suffix: str = "suffix", flag: str = "any_flagged") -> DataFrame:
    """Flagged and checked channels per measurement suffix."""
    counted = channels.groupBy(suffix).agg(
        F.count(F.lit(1)).alias("n_checked"), F.count_if(F.col(flag)).alias("n_flagged"))
    return counted.withColumn("flag_rate", ratio(F.col("n_flagged"), F.col("n_checked")))


def run_summary(df: DataFrame, flag: str = "flagged") -> DataFrame:
    """Rows scored and rows flagged."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(flag)).alias("n_flagged"))
