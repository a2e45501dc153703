"""The time axis: order, gaps, grid, fill, rolling features and phase."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import features, timeaxis
from tickwise.plans.site import feature_rows
from tickwise.schema import CELL, FILLED, GAP, SEQ, TS
from tickwise.workload.common import (
    HOUR_NS, HOURLY, MISSING, SAMPLES, USER, gap_ctes, grid_ctes, hourly, query, r6, rolling_ctes, samples, with_missing)

WINDOW = 10


@query("time_sort", f"with {SAMPLES} select user_id, ts_ns, seq, value from s order by user_id, ts_ns, seq")
def time_sort(spark, folder):
    return timeaxis.time_sort(samples(spark, folder), USER).select("user_id", TS, SEQ, "value")


@query("dedupe_first", f"""with {HOURLY} select user_id, ts_ns, min(seq) as seq, arg_min(value, seq) as value
from h group by user_id, ts_ns""")
def dedupe_first(spark, folder):
    return timeaxis.drop_duplicate_times(hourly(samples(spark, folder)), USER).select("user_id", TS, SEQ, "value")


@query("gap_delta", f"""with {SAMPLES} select user_id, seq,
  round((ts_ns - lag(ts_ns) over (partition by user_id order by ts_ns, seq)) / 1e9 * 1000, 6) as gap_ms from s""")
def gap_delta(spark, folder):
    return timeaxis.add_gap(samples(spark, folder), USER).select("user_id", SEQ, r6(GAP))


@query("gap_median_fill", f"with {SAMPLES}, {gap_ctes('s', USER)} select user_id, seq, round(gap_ms, 6) as gap_ms from gp")
def gap_median_fill(spark, folder):
    return timeaxis.add_gap_features(samples(spark, folder), USER).select("user_id", SEQ, r6(GAP))


@query("infer_interval", f"""with {SAMPLES}, d as (select user_id,
  ts_ns - lag(ts_ns) over (partition by user_id order by seq) as step from s)
select user_id, trunc(quantile_cont(step::double, 0.5))::bigint as freq_ns from d group by user_id""")
def infer_interval(spark, folder):
    return timeaxis.sample_interval(samples(spark, folder), USER)


@query("regular_grid", f"""with {SAMPLES}, b as (select user_id, min(ts_ns) as t0, max(ts_ns) as t1 from s group by 1),
g as (select user_id, t0, unnest(range(0, (t1 - t0) // {HOUR_NS} + 1)) as cell from b)
select user_id, cell, t0 + cell * {HOUR_NS} as ts_ns from g""")
def regular_grid(spark, folder):
    bounds = timeaxis.grid_bounds(samples(spark, folder), USER, HOUR_NS)
    return timeaxis.regular_grid(bounds, USER).select("user_id", CELL, TS)


@query("asof_nearest", f"""with {SAMPLES}, {grid_ctes('s', USER, str(HOUR_NS), ['value', 'status'], limit=0)}
select user_id, cell, ts_ns, was_filled, value, status from gr""")
def asof_nearest(spark, folder):
    return timeaxis.asof_nearest(samples(spark, folder), USER, ["value", "status"], HOUR_NS).select(
        "user_id", CELL, TS, FILLED, "value", "status")


@query("was_filled", f"""with {MISSING}, {grid_ctes('m', USER, str(HOUR_NS), ['value', 'status'])}
select user_id, was_filled, count(*) as n_cells, count(value) as n_values from gr group by 1, 2""")
def was_filled(spark, folder):
    gridded = timeaxis.regularize(with_missing(samples(spark, folder)), USER, ["value", "status"], freq_ns=HOUR_NS)
    return gridded.groupBy("user_id", FILLED).agg(F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_values"))


@query("ffill_limit", f"""with {MISSING}, {gap_ctes('m', USER)},
{grid_ctes('gp', USER, str(HOUR_NS), ['value', 'status'], ['gap_ms'])}
select user_id, cell, was_filled, value, status, round(gap_ms, 6) as gap_ms from gr""")
def ffill_limit(spark, folder):
    gapped = timeaxis.add_gap_features(with_missing(samples(spark, folder)), USER)
    gridded = timeaxis.regularize(gapped, USER, ["value", "status"], carried=[GAP], freq_ns=HOUR_NS)
    return gridded.select("user_id", CELL, FILLED, "value", "status", r6(GAP))


@query("fill_forward_rows", f"""with {MISSING} select user_id, seq, last_value(value ignore nulls) over (
  partition by user_id order by ts_ns, seq rows between 3 preceding and current row) as value from m""")
def fill_forward_rows(spark, folder):
    return timeaxis.fill_forward(with_missing(samples(spark, folder)), USER, ["value"]).select("user_id", SEQ, "value")


@query("ffill_unbounded", f"""with {MISSING} select user_id, seq, last_value(value ignore nulls) over (
  partition by user_id order by ts_ns, seq rows between unbounded preceding and current row) as value
from m where channel <> 'signup'""")
def ffill_unbounded(spark, folder):
    text = F.when(F.col("channel") == "signup", F.lit("no time")).otherwise(
        F.timestamp_micros((F.col(TS) / 1000).cast("long")).cast("string"))
    written = with_missing(samples(spark, folder)).withColumn("time_text", text).drop(TS)
    parsed = timeaxis.parse_times(written, "time_text")
    return timeaxis.fill_forward_unbounded(parsed, USER, ["value"]).select("user_id", SEQ, "value")


ROLLED = f"with {MISSING}, {rolling_ctes('m', USER, 'ts_ns, seq', 'value', WINDOW)}"


def _rolled(spark, folder):
    return features.add_delta_and_rolling(with_missing(samples(spark, folder)), USER, "value", WINDOW)


@query("abs_delta", f"{ROLLED} select user_id, seq, round(value_delta, 6) as value_delta from ro")
def abs_delta(spark, folder):
    return _rolled(spark, folder).select("user_id", SEQ, r6("value_delta"))


FEW = f"with {MISSING}, {rolling_ctes('m', USER, 'ts_ns, seq', 'value', 3)}"


@query("rolling_mean", f"{FEW} select user_id, seq, round(value_rolling_mean, 6) as value_rolling_mean from ro")
def rolling_mean(spark, folder):
    rolled = features.add_delta_and_rolling(with_missing(samples(spark, folder)), USER, "value", 3)
    return rolled.select("user_id", SEQ, r6("value_rolling_mean"))


FULL = f"with {SAMPLES}, {rolling_ctes('s', USER, 'ts_ns, seq', 'value', WINDOW)}"


@query("rolling_std", f"{FULL} select user_id, seq, round(value_rolling_std, 6) as value_rolling_std from ro")
def rolling_std(spark, folder):
    rolled = features.add_delta_and_rolling(samples(spark, folder), USER, "value", WINDOW)
    return rolled.select("user_id", SEQ, r6("value_rolling_std"))


@query("dev_from_mean", f"{FULL} select user_id, seq, round(value_dev_from_mean, 6) as value_dev_from_mean from ro")
def dev_from_mean(spark, folder):
    rolled = features.add_delta_and_rolling(samples(spark, folder), USER, "value", WINDOW)
    return rolled.select("user_id", SEQ, r6("value_dev_from_mean"))


@query("unwrap_phase", f"""with {SAMPLES}, p as (select user_id, ts_ns, seq, (value * 7) % 360 - 180 as phase from s),
d as (select *, phase - lag(phase) over (partition by user_id order by ts_ns, seq) as dd from p),
w as (select *, ((dd + 180) % 360 + 360) % 360 - 180 as m from d),
c as (select *, case when dd is null or abs(dd) < 180 then 0 when m = -180 and dd > 0 then 180 - dd else m - dd end as fix from w)
select user_id, seq, round(phase + sum(fix) over (partition by user_id order by ts_ns, seq
  rows between unbounded preceding and current row), 6) as phase_unwrapped from c""")
def unwrap_phase(spark, folder):
    phased = samples(spark, folder).withColumn("phase", (F.col("value") * 7) % 360 - 180)
    return features.unwrap_phase(phased, USER, "phase", 360.0).select("user_id", SEQ, r6("phase_unwrapped"))


NAMES = ["value", "value_delta", "value_rolling_std", "value_dev_from_mean", "gap_ms", "status"]
FEATURE_ROWS = f"""{MISSING},
{gap_ctes('m', USER)},
{grid_ctes('gp', USER, str(HOUR_NS), ['value', 'status'], ['gap_ms'])},
{rolling_ctes('gr', USER, 'cell', 'value', 3)},
fe as (select user_id, ts_ns, cell, value, coalesce(value_delta, 0.0) as value_delta,
  coalesce(value_rolling_std, 0.0) as value_rolling_std, coalesce(value_dev_from_mean, 0.0) as value_dev_from_mean,
  gap_ms, status, was_filled
  from ro where value is not null and gap_ms is not null and status is not null)"""
ROUNDED = ", ".join(f"round({n}, 6) as {n}" for n in NAMES)


def site_rows(spark, folder):
    return feature_rows(with_missing(samples(spark, folder)), USER, "value", window=3, freq_ns=HOUR_NS)


@query("feature_matrix", f"with {FEATURE_ROWS} select user_id, ts_ns, {ROUNDED} from fe")
def feature_matrix(spark, folder):
    return site_rows(spark, folder).select("user_id", TS, *[r6(n) for n in NAMES])


@query("clean_rows", f"""with {MISSING}, {rolling_ctes('m', USER, 'ts_ns, seq', 'value', 3)}
select user_id, seq, value, round(coalesce(value_rolling_std, 0.0), 6) as value_rolling_std from ro where value is not null""")
def clean_rows(spark, folder):
    rolled = features.add_delta_and_rolling(with_missing(samples(spark, folder)), USER, "value", 3)
    clean = timeaxis.clean_rows(rolled, ["value_rolling_std"], ["value"])
    return clean.select("user_id", SEQ, "value", r6("value_rolling_std"))


@query("min_rows_guard", f"""with {SAMPLES} select user_id, channel, count(*) as n_rows, count(*) >= 2 as usable
from s group by 1, 2""")
def min_rows_guard(spark, folder):
    return timeaxis.enough_rows(samples(spark, folder), ["user_id", "channel"])
