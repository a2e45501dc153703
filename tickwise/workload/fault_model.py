"""Labelled faults and isolation forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import faults, forest
from tickwise.schema import SEQ, TS
from tickwise.session import settle
from tickwise.sources import models
from tickwise.workload.common import (
    DAY_NS, SAMPLES, START_NS, USER, flag_ctes, forest_ctes, query, r6, samples, scratch, table, walk_ctes)
from tickwise.workload.time_axis import FEATURE_ROWS, NAMES, site_rows

LOW, HIGH = START_NS + 9 * DAY_NS, START_NS + 12 * DAY_NS
INSIDE = f"ts_ns between {LOW} and {HIGH}"


def normal_sql(seed: int, row: str) -> str:
    """The SQL form of a repeatable normal draw."""
    text = f"md5(concat_ws('|', '{seed}', {row}::varchar))"
    u1 = f"((('0x' || substr({text}, 1, 8))::bigint + 1) / 4294967296.0::double)"
    u2 = f"(('0x' || substr({text}, 9, 8))::bigint / 4294967296.0::double)"
    return f"(sqrt(-2.0::double * ln({u1})) * cos(2.0::double * pi() * {u2}))"


@query("fault_jitter", f"""with {SAMPLES} select user_id, seq, case when {INSIDE}
  then ts_ns + trunc(5.0 * 1e6 * {normal_sql(0, 'seq')})::bigint else ts_ns end as ts_ns from s""")
def fault_jitter(spark, folder):
    moved = faults.jitter(samples(spark, folder), F.lit(LOW), F.lit(HIGH), 5.0, seed=0)
    return moved.select("user_id", SEQ, TS)


@query("fault_dropout", f"with {SAMPLES} select user_id, seq, ts_ns from s where not ({INSIDE})")
def fault_dropout(spark, folder):
    return faults.dropout(samples(spark, folder), F.lit(LOW), F.lit(HIGH)).select("user_id", SEQ, TS)


@query("fault_clock_step", f"""with {SAMPLES} select user_id, seq,
  case when {INSIDE} then ts_ns + 33500000 else ts_ns end as ts_ns from s""")
def fault_clock_step(spark, folder):
    return faults.clock_step(samples(spark, folder), F.lit(LOW), F.lit(HIGH), 33.5).select("user_id", SEQ, TS)


@query("fault_status", f"""with {SAMPLES} select user_id, seq,
  case when {INSIDE} then 9.0 else status end as status from s""")
def fault_status(spark, folder):
    return faults.corrupt_status(samples(spark, folder), F.lit(LOW), F.lit(HIGH), 9.0).select("user_id", SEQ, "status")


def _days(first: int, last: int) -> dict:
    return {"start_ns": START_NS + first * DAY_NS, "end_ns": START_NS + last * DAY_NS}


SPEC = (
    {"type": faults.DROPOUT, **_days(3, 5)},
    {"type": faults.JITTER, "std_ms": 7_200_000.0, "seed": 7, **_days(9, 12)},
    {"type": faults.STEP, "offset_ms": 100_000_000.0, **_days(11, 15)},
    {"type": faults.STATUS_FAULT, "bad_value": 4.0, **_days(14, 20)},
)
W = [f"ts_ns between {s['start_ns']} and {s['end_ns']}" for s in SPEC]
COMPOSED = f"""{SAMPLES},
f1 as (select * from s where not ({W[0]})),
f2 as (select * replace (case when {W[1]} then ts_ns + trunc(7200000.0 * 1e6 * {normal_sql(7, 'seq')})::bigint
  else ts_ns end as ts_ns) from f1),
f3 as (select * replace (case when {W[2]} then ts_ns + 100000000000000 else ts_ns end as ts_ns) from f2),
f4 as (select * replace (case when {W[3]} then 4.0 else status end as status) from f3)"""


@query("fault_compose", f"with {COMPOSED} select user_id, seq, ts_ns, value, status from f4")
def fault_compose(spark, folder):
    changed, _ = faults.inject_faults(samples(spark, folder), USER, SPEC)
    return changed.select("user_id", SEQ, TS, "value", "status")


def interval_sql(source: str, key: str = "user_id") -> str:
    return f"""select {key}, trunc(quantile_cont(step::double, 0.5))::bigint as f from (
  select {key}, ts_ns - lag(ts_ns) over (partition by {key} order by seq) as step from {source}) group by {key}"""


FAULT_LABELS = f"""{COMPOSED}, i1 as ({interval_sql('s')}), i3 as ({interval_sql('f2')}),
lab as (select user_id, {SPEC[0]['start_ns']} as start_ns, {SPEC[0]['end_ns']} + f as end_ns, 'dropout' as fault_type, 0 as ord from i1
union all select user_id, {SPEC[1]['start_ns']}, {SPEC[1]['end_ns']}, 'timestamp_jitter', 1 from i1
union all select user_id, {SPEC[2]['start_ns']} - f, {SPEC[2]['end_ns']} + f, 'clock_step', 2 from i3
union all select user_id, {SPEC[3]['start_ns']}, {SPEC[3]['end_ns']}, 'tq_corruption', 3 from i1)"""


@query("fault_labels", f"with {FAULT_LABELS} select * from lab")
def fault_labels(spark, folder):
    return faults.inject_faults(samples(spark, folder), USER, SPEC)[1]


@query("default_windows", f"""with {SAMPLES}, n as (select *, row_number() over (partition by user_id order by ts_ns, seq) - 1 as r,
  count(*) over (partition by user_id) as n from s),
p as (select user_id, ts_ns, r // (n // 5) as place, r % (n // 5) as off from n where n >= 40)
select user_id, (place - 1)::int as ord, min(ts_ns) as start_ns, max(ts_ns) as end_ns from p
where place between 1 and 4 and off in (0, 3) group by user_id, place""")
def default_windows(spark, folder):
    return faults.default_windows(samples(spark, folder), USER, short="skip")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES = "li as materialized (select *, row_number() over () as rid, 'all' as one from lineitem)"
SMALL = forest.Settings(n_estimators=3, max_depth=3, contamination=0.05)
LINE_FOREST = f"with {LINES}, {forest_ctes('li', MEASURES, 'one', 3, 3)}"
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(*LINE_KEYS, *MEASURES)


@query("standard_scale", f"""with t as (select {", ".join(f"avg({m}) as a{i}, stddev_pop({m}) as d{i}"
       for i, m in enumerate(MEASURES))} from lineitem)
select {", ".join(LINE_KEYS)}, {", ".join(f"round(({m} - a{i}) / case when d{i} = 0 then 1 else d{i} end, 6) as {m}_scaled"
       for i, m in enumerate(MEASURES))} from lineitem, t""")
def standard_scale(spark, folder):
    scaled = forest.standard_scale(_lines(spark, folder), MEASURES)
    return scaled.select(*LINE_KEYS, *[r6(f"{m}_scaled") for m in MEASURES])


NODE_COLUMNS = "tree::int as tree, node::int as node, coalesce(feature, -1)::int as feature, n"
CUT = "case when feature is not null then round(threshold, 6) end as threshold"


def _node_table(nodes):
    cut = F.when(F.col("feature") >= 0, F.round("threshold", 6)).alias("threshold")
    return nodes.select("tree", "node", "feature", "n", cut)


@query("iforest_fit", f"{LINE_FOREST} select {NODE_COLUMNS}, {CUT} from fo_nodes")
def iforest_fit(spark, folder):
    return _node_table(forest.fit_nodes(_lines(spark, folder), MEASURES, (), SMALL))


@query("iforest_score", f"""{LINE_FOREST} select {", ".join(LINE_KEYS)}, round(score, 6) as score
from fo_scored join li using (rid)""")
def iforest_score(spark, folder):
    lines = _lines(spark, folder)
    nodes = forest.fit_nodes(lines, MEASURES, (), SMALL)
    scored = forest.add_scores(lines, nodes, MEASURES, SMALL.n_estimators)
    return scored.select(*LINE_KEYS, r6("score"))


@query("contamination_cutoff", """select l_returnflag as model, round(quantile_cont(l_extendedprice, 0.99), 6) as cutoff
from lineitem group by 1""")
def contamination_cutoff(spark, folder):
    scored = table(spark, folder, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("score"))
    return forest.cutoffs(scored, ["l_returnflag"], 0.01).select("model", r6("cutoff"))


@query("detect", f"""{LINE_FOREST}, {flag_ctes('fo_scored', 0.05)}
select {", ".join(LINE_KEYS)}, round(score, 6) as score, flagged from fl join li using (rid)""")
def detect(spark, folder):
    found = forest.detect(_lines(spark, folder), MEASURES, (), SMALL)
    return found.select(*LINE_KEYS, r6("score"), "flagged")


@query("iforest_full", f"""with {LINES}, {forest_ctes('li', MEASURES, 'one', 100, 10)}, {flag_ctes('fo_scored', 0.01)}
select {", ".join(LINE_KEYS)}, round(score, 6) as score, flagged from fl join li using (rid)""")
def iforest_full(spark, folder):
    """The forest at its real size: 100 trees over all rows."""
    return forest.detect(_lines(spark, folder), MEASURES).select(*LINE_KEYS, r6("score"), "flagged")


DEEP = forest.Settings(n_estimators=4, contamination=0.01, max_depth=None)
# Deep enough for a million rows; each model stops at its own ceil(log2 n).
DEEP_FOREST = f"with {LINES}, {forest_ctes('li', MEASURES, 'one', 4, 20)}"


@query("iforest_deep_fit", f"{DEEP_FOREST} select {NODE_COLUMNS}, {CUT} from fo_nodes")
def iforest_deep_fit(spark, folder):
    """Every node of trees as deep as ceil(log2 n)."""
    return _node_table(forest.fit_nodes(_lines(spark, folder), MEASURES, (), DEEP)).withColumn("node", F.col("node").cast("int"))


@query("iforest_deep", f"""{DEEP_FOREST}, {flag_ctes('fo_scored', 0.01)}
select {", ".join(LINE_KEYS)}, round(score, 6) as score, flagged from fl join li using (rid)""")
def iforest_deep(spark, folder):
    """Rows scored and flagged by trees of full depth."""
    return forest.detect(_lines(spark, folder), MEASURES, (), DEEP).select(*LINE_KEYS, r6("score"), "flagged")


DIMENSIONS = 64


@query("iforest_vectors", f"""with em as materialized (select *, row_number() over () as rid from embeddings),
{forest_ctes('em', [f'embedding[{i + 1}]' for i in range(DIMENSIONS)], 'label::varchar', 100, 10)},
{flag_ctes('fo_scored', 0.01)}
select vec_id, label, round(score, 6) as score, flagged from fl join em using (rid)""")
def iforest_vectors(spark, folder):
    """The full-size forest over many features: every dimension of the embedding table, one model per label."""
    names = [f"d{i}" for i in range(DIMENSIONS)]
    wide = table(spark, folder, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    found = forest.detect(wide, names, ["label"])
    return found.select("vec_id", "label", r6("score"), "flagged")


FLAG_FOREST = f"""with l0 as materialized (select *, row_number() over () as rid, l_returnflag as one from lineitem),
l1 as (select * from l0 where one <> 'R'), {forest_ctes('l1', MEASURES, 'one', 3, 3)}, {flag_ctes('fo_scored', 0.05)}"""


@query("fit_baseline", f"""{FLAG_FOREST} select fo_cut.model, count(*) as n_train, round(max(cutoff), 6) as cutoff
from fo_scored join fl_cut as fo_cut using (model) group by 1""")
def fit_baseline(spark, folder):
    """One model per return flag, on everything but returned goods, with its fixed cutoff."""
    known = table(spark, folder, "lineitem").where(F.col("l_returnflag") != "R")
    return forest.fit(known, MEASURES, ["l_returnflag"], SMALL).meta.select("model", "n_train", r6("cutoff"))


@query("score_baseline", f"""with l0 as materialized (select *, row_number() over () as rid, 'all' as one from lineitem),
l1 as (select * from l0 where l_returnflag <> 'R'), {forest_ctes('l1', MEASURES, 'one', 3, 3)}, {flag_ctes('fo_scored', 0.05)},
{walk_ctes('l0', MEASURES, 'one', 3, 3)}
select l_returnflag, count(*) as n_rows, count(*) filter (score > cutoff) as n_flagged
from wa_scored join fl_cut using (model) join l0 using (rid) group by 1""")
def score_baseline(spark, folder):
    """All goods scored by the model fitted on unreturned ones; nothing is refitted."""
    lines = table(spark, folder, "lineitem")
    known = forest.fit(lines.where(F.col("l_returnflag") != "R"), MEASURES, (), SMALL)
    scored = forest.score(lines, known)
    return scored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("flagged")).alias("n_flagged"))


@query("model_roundtrip", f"{LINE_FOREST} select {NODE_COLUMNS}, {CUT} from fo_nodes")
def model_roundtrip(spark, folder):
    path = scratch(spark)
    models.save_forest(forest.fit(_lines(spark, folder), MEASURES, (), SMALL), path)
    return _node_table(models.load_forest(spark, path).nodes)


@query("detect_by_series", f"""with {FEATURE_ROWS}, x as materialized (select *, row_number() over () as rid from fe),
{forest_ctes('x', NAMES, 'user_id::varchar', 3, 3)}, {flag_ctes('fo_scored', 0.05)}
select user_id, count(*) as n_rows, count(*) filter (flagged) as n_flagged from fl join x using (rid) group by 1""")
def detect_by_series(spark, folder):
    """A model per user over gridded features."""
    found = forest.detect(settle(site_rows(spark, folder)), NAMES, USER, SMALL)
    return found.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("flagged")).alias("n_flagged"))
