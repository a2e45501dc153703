"""Scoring flags, rolling them up, and reporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import evaluate, faults, reporting, runlog
from tickwise.plans.recordings import covered_channels
from tickwise.schema import SEQ, TS
from tickwise.sources.archives import select_channels
from tickwise.workload.common import (
    READINGS, SAMPLES, SELECTED, USER, query, r6, readings, recordings, samples)
from tickwise.workload.fault_model import FAULT_LABELS, SPEC

FLAGGED = f"""{FAULT_LABELS},
fl as (select user_id, seq, ts_ns, value, value > 150 as flagged from f4)"""


def _flagged(spark, folder):
    """Faulted samples with a plain level test as the detector, and the labels."""
    changed, labels = faults.inject_faults(samples(spark, folder), USER, SPEC)
    return changed.withColumn("flagged", F.col("value") > 150), labels


IN_ANY = "exists (select 1 from lab l where l.user_id = fl.user_id and fl.ts_ns between l.start_ns and l.end_ns)"
TRUTH = f"with {FLAGGED}, tr as (select fl.*, {IN_ANY} as truth from fl)"


@query("truth_mask", f"{TRUTH} select user_id, seq, truth from tr")
def truth_mask(spark, folder):
    flagged, labels = _flagged(spark, folder)
    return evaluate.truth_mask(flagged, labels, USER).select("user_id", SEQ, "truth")


def prf_sql(by: str) -> str:
    group = f"group by {by}" if by else ""
    return f"""c as (select {by + ',' if by else ''} count(*) as n_rows, count(*) filter (flagged) as n_flagged,
  count(*) filter (truth and flagged) as tp, count(*) filter (not truth and flagged) as fp,
  count(*) filter (truth and not flagged) as fn from tr {group})
select {by + ',' if by else ''} n_rows, n_flagged, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) as precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) as f1 from c"""


@query("prf", f"{TRUTH}, {prf_sql('')}")
def prf(spark, folder):
    flagged, labels = _flagged(spark, folder)
    judged = evaluate.precision_recall(evaluate.truth_mask(flagged, labels, USER))
    return judged.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("prf_by_series", f"{TRUTH}, {prf_sql('user_id')}")
def prf_by_series(spark, folder):
    flagged, labels = _flagged(spark, folder)
    judged = evaluate.precision_recall(evaluate.truth_mask(flagged, labels, USER), by=USER)
    return judged.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


COVERED = f"""with {FLAGGED}, cov as (select distinct fl.user_id, fl.seq, fl.flagged, l.fault_type
  from fl join lab l on l.user_id = fl.user_id and fl.ts_ns between l.start_ns and l.end_ns)"""


@query("share_by_fault_type", f"""{COVERED} select fault_type, round(avg(flagged::int), 6) as share_flagged
from cov group by 1""")
def share_by_fault_type(spark, folder):
    flagged, labels = _flagged(spark, folder)
    return evaluate.share_by_fault_type(flagged, labels, USER).select("fault_type", r6("share_flagged"))


@query("caught_by_fault_type", f"{COVERED} select user_id, fault_type, bool_or(flagged) as caught from cov group by 1, 2")
def caught_by_fault_type(spark, folder):
    flagged, labels = _flagged(spark, folder)
    return evaluate.caught_by_fault_type(flagged, labels, USER, by=USER)


@query("caught_by_window", f"""with {FLAGGED} select fl.user_id, l.ord, l.fault_type, bool_or(flagged) as caught
from fl join lab l on l.user_id = fl.user_id and fl.ts_ns between l.start_ns and l.end_ns group by 1, 2, 3""")
def caught_by_window(spark, folder):
    flagged, labels = _flagged(spark, folder)
    return evaluate.caught_by_fault_type(flagged, labels, USER, per="window")


@query("run_summary", "select count(*) as n_rows, count(*) filter (value > 150) as n_flagged from events")
def run_summary(spark, folder):
    return evaluate.run_summary(samples(spark, folder).withColumn("flagged", F.col("value") > 150))


CHANNELS = f"""{SELECTED}, ch as (select sigid, pmu, suffix, pmu || suffix as channel, bool_or(value > 150) as any_flagged
  from sel group by 1, 2, 3)"""


def _channels(spark, folder):
    """One verdict per selected channel by the level test."""
    chosen = select_channels(readings(spark, folder), recordings(spark, folder))
    flagged = chosen.withColumn("flagged", F.col("value") > 150)
    found = evaluate.channel_any(flagged, ["sigid", "pmu", "suffix"])
    return found.withColumn("channel", F.concat("pmu", "suffix"))


@query("channel_any", f"with {CHANNELS} select sigid, pmu, suffix, channel, any_flagged from ch")
def channel_any(spark, folder):
    return _channels(spark, folder)


ROLLED_UP = f"""{CHANNELS}, ro as (select man.sigid, man.cohort, coalesce(bool_or(any_flagged), false) as any_flagged,
  count(any_flagged) as n_channels_checked,
  coalesce(count(*) filter (any_flagged) / nullif(count(any_flagged), 0), 0.0) as fraction_flagged,
  string_agg(channel || '=' || any_flagged, ',' order by channel) as outcome
  from man left join ch on man.sigid = ch.sigid group by man.sigid, man.cohort)"""


def _rollup(spark, folder):
    return evaluate.recording_rollup(_channels(spark, folder), recordings(spark, folder))


@query("signature_rollup", f"""with {ROLLED_UP} select sigid, cohort, any_flagged, n_channels_checked,
  round(fraction_flagged, 6) as fraction_flagged, coalesce(outcome, '') as outcome from ro""")
def signature_rollup(spark, folder):
    pairs = F.transform(F.map_entries("channel_flagged"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return _rollup(spark, folder).select(
        "sigid", "cohort", "any_flagged", "n_channels_checked", r6("fraction_flagged"),
        F.array_join(pairs, ",").alias("outcome"))


def _rates(condition: str) -> str:
    return f"""with {ROLLED_UP} select cohort, count(*) as n_recordings, count(*) filter ({condition}) as n_positive,
  round(avg(({condition})::int), 6) as positive_rate from ro group by 1"""


@query("cohort_rates", _rates("any_flagged"))
def cohort_rates(spark, folder):
    return evaluate.cohort_rates(_rollup(spark, folder)).withColumn("positive_rate", F.round("positive_rate", 6))


@query("cohort_rates_threshold", _rates("fraction_flagged >= 0.2"))
def cohort_rates_threshold(spark, folder):
    return evaluate.cohort_rates(_rollup(spark, folder), 0.2).withColumn("positive_rate", F.round("positive_rate", 6))


STEPS = [0.1, 0.2, 0.3, 0.5, 0.75]


@query("threshold_sweep", f"""with {ROLLED_UP}, t as (select unnest({STEPS})::double as threshold)
select threshold, cohort, count(*) as n_recordings, (count(*) filter (fraction_flagged >= threshold)) as n_positive,
  round(avg((fraction_flagged >= threshold)::int), 6) as positive_rate from ro, t group by 1, 2""")
def threshold_sweep(spark, folder):
    swept = evaluate.threshold_sweep(_rollup(spark, folder), STEPS)
    return swept.withColumn("positive_rate", F.round("positive_rate", 6))


@query("suffix_flag_rate", f"""with {CHANNELS} select suffix, count(*) as n_checked, count(*) filter (any_flagged) as n_flagged,
  round(count(*) filter (any_flagged) / count(*), 6) as flag_rate from ch group by 1""")
def suffix_flag_rate(spark, folder):
    return evaluate.suffix_flag_rate(_channels(spark, folder)).withColumn("flag_rate", F.round("flag_rate", 6))


@query("baseline_coverage", f"""with {READINGS}, b as (select suffix from r group by 1 having avg(value) >= 50)
select sigid, pmu, suffix, count(*) as n_rows from r where suffix in (select suffix from b) group by 1, 2, 3""")
def baseline_coverage(spark, folder):
    """Channels whose measurement type has a baseline; here the types with a mean reading of at least 50 have one."""
    everything = readings(spark, folder)
    modelled = everything.groupBy("suffix").agg(F.avg("value").alias("mean")).where(F.col("mean") >= 50)
    covered = covered_channels(everything, modelled)
    return covered.groupBy("sigid", "pmu", "suffix").agg(F.count(F.lit(1)).alias("n_rows"))


BUCKETS = 20
DECIMATED = f"""with {SAMPLES}, n as (select *, value > 150 as flagged,
  row_number() over (partition by user_id order by ts_ns, seq) - 1 as r, count(*) over (partition by user_id) as n from s),
b as (select *, case when n <= {BUCKETS} then r else ((r + 1) * {BUCKETS} + n - 1) // n - 1 end as bucket from n),
k as (select *, row_number() over (partition by user_id, bucket order by value, r) as a,
  row_number() over (partition by user_id, bucket order by value desc, r) as z,
  row_number() over (partition by user_id, bucket order by not flagged, r) as f from b)
select user_id, r as row, ts_ns, value, flagged, ts_ns // 1000000 as ts_ms from k where a = 1 or z = 1 or (f = 1 and flagged)"""


@query("decimate", DECIMATED)
def decimate(spark, folder):
    flagged = samples(spark, folder).withColumn("flagged", F.col("value") > 150)
    return reporting.decimate(flagged, USER, "value", max_buckets=BUCKETS)


@query("full_counts", f"""with {SAMPLES} select user_id, count(*) as n_rows_full,
  count(*) filter (value > 150) as n_anomalies_full from s group by 1""")
def full_counts(spark, folder):
    return reporting.full_counts(samples(spark, folder).withColumn("flagged", F.col("value") > 150), USER)


@query("windows_ms", f"""with {FAULT_LABELS} select user_id, fault_type, ord, start_ns // 1000000 as start_ms,
  end_ns // 1000000 as end_ms from lab""")
def windows_ms(spark, folder):
    return reporting.windows_ms(_flagged(spark, folder)[1])


@query("attribute_flags", f"""with {FLAGGED}, a as (select fl.user_id, fl.seq, fl.flagged,
  (select arg_min(l.fault_type, l.ord) from lab l where l.user_id = fl.user_id
   and fl.ts_ns // 1000000 between l.start_ns // 1000000 and l.end_ns // 1000000) as ft from fl)
select user_id, seq, case when flagged then coalesce(ft, 'other') end as fault from a""")
def attribute_flags(spark, folder):
    flagged, labels = _flagged(spark, folder)
    stamped = flagged.withColumn("ts_ms", reporting.to_ms(F.col(TS)))
    found = reporting.attribute_flags(stamped, reporting.windows_ms(labels), USER)
    return found.select("user_id", SEQ, "fault")


FAULTS = [faults.DROPOUT, faults.JITTER, faults.STEP, faults.STATUS_FAULT]


@query("series_by_fault", f"""with {FLAGGED}, a as (select fl.user_id, fl.seq, fl.flagged, fl.value,
  (select arg_min(l.fault_type, l.ord) from lab l where l.user_id = fl.user_id
   and fl.ts_ns // 1000000 between l.start_ns // 1000000 and l.end_ns // 1000000) as ft from fl)
select user_id, seq, {", ".join(f"case when flagged and ft = '{f}' then value end as {f}" for f in FAULTS)},
  case when flagged and ft is null then value end as other from a""")
def series_by_fault(spark, folder):
    flagged, labels = _flagged(spark, folder)
    stamped = flagged.withColumn("ts_ms", reporting.to_ms(F.col(TS)))
    found = reporting.attribute_flags(stamped, reporting.windows_ms(labels), USER)
    return reporting.split_by_fault(found, ["user_id", SEQ], "value", FAULTS)


STATUS_OF = {"signup": runlog.QUEUED, "view": runlog.RUNNING, "click": runlog.COMPLETED, "purchase": runlog.COMPLETED,
             "error": runlog.FAILED}
STATUS_SQL = "case channel " + " ".join(f"when '{k}' then '{v}'" for k, v in STATUS_OF.items()) + " end"


def _log(spark, folder):
    """events as a run log: a run per user, every event a change of its state."""
    status = F.coalesce(*[F.when(F.col("channel") == k, F.lit(v)) for k, v in STATUS_OF.items()])
    return samples(spark, folder).select(
        F.col("user_id").alias("run_id"), (F.col(TS) + F.col(SEQ)).alias("event_ns"), status.alias("status"),
        F.col(TS).alias("created_ns"), F.col("value").alias("duration_s"),
        F.when(F.col("channel") == "error", F.lit("ValueError: bad reading")).alias("error_message"),
        F.when(F.col("channel") == "click", F.create_map(F.lit("dropout"), F.col("value"))).alias("by_fault_type"),
        F.when(F.col("channel") == "click", F.create_map(F.lit("dropout"), F.col("value") > 50)).alias("caught_by_fault_type"),
        (F.col("channel") == "click").alias("has_chart"))


LOG = f"""{SAMPLES}, ev as (select user_id as run_id, ts_ns + seq as event_ns, {STATUS_SQL} as status,
  ts_ns as created_ns, value as duration_s, case when channel = 'error' then 'ValueError: bad reading' end as error_message,
  channel from s),
st as (select * from ev qualify row_number() over (partition by run_id order by event_ns desc) = 1)"""


@query("runlog_current", f"with {LOG} select run_id, event_ns, status, created_ns, duration_s, error_message from st")
def runlog_current(spark, folder):
    return runlog.current_state(_log(spark, folder)).drop("by_fault_type", "caught_by_fault_type", "has_chart")


@query("runlog_page", f"""with {LOG} select run_id, status, created_ns from st
order by created_ns desc, run_id desc limit 20 offset 10""")
def runlog_page(spark, folder):
    state = runlog.current_state(_log(spark, folder))
    return runlog.page(state, 20, 10).select("run_id", "status", "created_ns")


@query("runlog_detail", f"""with {LOG} select run_id, status, channel = 'click' as has_chart,
  case when channel = 'click' then duration_s end as dropout_share,
  case when channel = 'click' then duration_s > 50 end as dropout_caught,
  case when channel = 'click' then 1 else 0 end as n_types from st where run_id = 7""")
def runlog_detail(spark, folder):
    one = runlog.detail(runlog.current_state(_log(spark, folder)), 7)
    return one.select(
        "run_id", "status", "has_chart", F.try_element_at("by_fault_type", F.lit("dropout")).alias("dropout_share"),
        F.try_element_at("caught_by_fault_type", F.lit("dropout")).alias("dropout_caught"),
        F.size("by_fault_type").alias("n_types"))


@query("runlog_after_delete", f"""with {LOG} select run_id, status from st
where status <> 'failed' and run_id in (select run_id from st)""")
def runlog_after_delete(spark, folder):
    """Every failed run is deleted by a later event."""
    log = _log(spark, folder)
    failed = runlog.current_state(log).where(F.col("status") == runlog.FAILED)
    gone = failed.select("run_id", (F.col("event_ns") + 1).alias("event_ns"), F.lit(runlog.DELETED).alias("status"))
    return runlog.current_state(log.unionByName(gone, allowMissingColumns=True)).select("run_id", "status")
