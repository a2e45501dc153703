"""Every channel of every recording: one model per channel, or one pooled "known normal" model per measurement type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import evaluate, forest
from tickwise.operators.timeaxis import sample_interval
from tickwise.plans.site import feature_rows
from tickwise.schema import SEQ, TS, feature_names
from tickwise.session import keep, settle
from tickwise.sources.archives import select_channels

CHANNEL = ("sigid", "pmu", "suffix")
FEATURES = feature_names("value")
THRESHOLD = 0.2


def recording_interval(readings: DataFrame) -> DataFrame:
    """Sampling interval per recording, over its distinct times."""
    times = readings.groupBy("sigid", TS).agg(F.min(SEQ).alias(SEQ))
    return settle(sample_interval(times, ["sigid"], order=(TS,)))


def recording_rows(readings: DataFrame, window: int = 10, freq_ns: DataFrame | None = None, **sizes) -> DataFrame:
    """Clean model rows of all channels, each recording on a grid of its own interval.

    A recording without a usable interval (a single time, or most times equal) is an error or, with
    ``unusable="skip"``, has no rows.
    """
    freq_ns = recording_interval(readings) if freq_ns is None else freq_ns
    return feature_rows(readings, CHANNEL, "value", None, window=window, freq_ns=freq_ns, **sizes)


def _checked(readings: DataFrame, intervals: DataFrame) -> DataFrame:
    """The channels that can be put on a grid; those of a recording skipped for its interval were not checked."""
    return readings.select(*CHANNEL).distinct().join(intervals.where("freq_ns >= 1"), "sigid", "left_semi")


def _verdicts(channels: DataFrame, flagged: DataFrame) -> DataFrame:
    """All checked channels; one with too few clean rows to model was checked and is not flagged."""
    joined = channels.join(flagged, list(CHANNEL), "left")
    return joined.withColumn("any_flagged", F.coalesce("any_flagged", F.lit(False))).withColumn(
        "channel", F.concat("pmu", "suffix"))


def channel_verdicts(
    readings: DataFrame, manifest: DataFrame, window: int = 10, settings: forest.Settings = forest.Settings(), **sizes
) -> DataFrame:
    """One verdict per selected channel, each judged by a model fitted on itself."""
    # Archives are opened once; everything else reads what was selected.
    chosen = keep(select_channels(readings, manifest))
    intervals = recording_interval(chosen)
    channels = _checked(chosen, intervals)
    rows = settle(recording_rows(chosen, window, intervals, **sizes))
    usable = _usable(rows)
    found = forest.detect(rows.join(usable, list(CHANNEL), "left_semi"), FEATURES, CHANNEL, settings)
    return settle(_verdicts(channels, evaluate.channel_any(found, CHANNEL)))


def _usable(rows: DataFrame, at_least: int = 2) -> DataFrame:
    return rows.groupBy(*CHANNEL).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= at_least).drop("_n")


def evaluate_recordings(
    readings: DataFrame, manifest: DataFrame, window: int = 10, settings: forest.Settings = forest.Settings(), **sizes
) -> DataFrame:
    """One result row per recording of the manifest, from per-channel models."""
    return evaluate.recording_rollup(channel_verdicts(readings, manifest, window, settings, **sizes), manifest)


def fit_baseline(
    readings: DataFrame, manifest: DataFrame, window: int = 10, settings: forest.Settings = forest.Settings(), **sizes
) -> forest.Forest:
    """One model per measurement suffix, fitted once on the pooled channels of the manifest's recordings."""
    chosen = keep(select_channels(readings, manifest.withColumn("tags", F.array().cast("array<string>"))))
    rows = settle(recording_rows(chosen, window, **sizes))
    pooled = rows.join(_usable(rows), list(CHANNEL), "left_semi")
    return forest.fit(pooled, FEATURES, ["suffix"], settings)


def covered_channels(channels: DataFrame, modelled: DataFrame) -> DataFrame:
    """Channels whose suffix is among the modelled ones; the others are not checked at all."""
    return channels.join(modelled.select("suffix"), "suffix", "left_semi")


def baseline_verdicts(
    readings: DataFrame, manifest: DataFrame, baseline: forest.Forest, window: int = 10, **sizes
) -> DataFrame:
    """One verdict per channel with a baseline model, by that model's fixed cutoff."""
    modelled = baseline.meta.select(F.col(forest.MODEL).alias("suffix"))
    chosen = keep(covered_channels(select_channels(readings, manifest), modelled))
    intervals = recording_interval(chosen)
    channels = _checked(chosen, intervals)
    rows = settle(recording_rows(chosen, window, intervals, **sizes))
    scored = forest.score(rows.join(_usable(rows), list(CHANNEL), "left_semi"), baseline, ["suffix"])
    return settle(_verdicts(channels, evaluate.channel_any(scored, CHANNEL)))


def evaluate_against_baseline(
    readings: DataFrame, manifest: DataFrame, baseline: forest.Forest, window: int = 10, **sizes
) -> DataFrame:
    """One result row per recording of the manifest, from the baseline's models."""
    return evaluate.recording_rollup(baseline_verdicts(readings, manifest, baseline, window, **sizes), manifest)


def run_validation(
    readings: DataFrame, manifest: DataFrame, window: int = 10, settings: forest.Settings = forest.Settings(),
    cohorts: Sequence[str] = ("timing", "negative"), **sizes,
) -> tuple[DataFrame, DataFrame]:
    """(results per recording, rates per cohort) with a model per channel; any flagged channel counts."""
    tested = manifest.where(F.col("cohort").isin(list(cohorts)))
    results = settle(evaluate_recordings(readings, tested, window, settings, **sizes))
    return results, evaluate.cohort_rates(results)


def run_baseline_validation(
    readings: DataFrame, manifest: DataFrame, window: int = 10, settings: forest.Settings = forest.Settings(),
    threshold: float = THRESHOLD, cohorts: Sequence[str] = ("timing", "negative"), baseline_cohort: str = "baseline",
    **sizes,
) -> tuple[DataFrame, DataFrame, forest.Forest]:
    """(results, rates, baseline): fit once on one cohort, judge the others by their share of flagged channels."""
    normal = manifest.where(F.col("cohort") == baseline_cohort)
    baseline = fit_baseline(readings, normal, window, settings, **sizes)
    tested = manifest.where(F.col("cohort").isin(list(cohorts)))
    results = settle(evaluate_against_baseline(readings, tested, baseline, window, **sizes))
    return results, evaluate.cohort_rates(results, threshold), baseline
