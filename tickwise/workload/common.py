"""How the sample tables are read as sensor data, and the SQL building blocks the checks share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.columns import epoch_ns
from tickwise.schema import SEQ, TS
from tickwise.session import checkpoint_folder

Query = Callable[[SparkSession, str], DataFrame]

HOUR_NS = 3_600_000_000_000
DAY_NS = 24 * HOUR_NS
START_NS = 1_704_067_200_000_000_000  # 2024-01-01, the first day of the events table
TYPES = ("click", "error", "purchase", "signup", "view")
USER = ["user_id"]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its check."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The tables hold zone-less timestamps, which are meant as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """events as samples: a series per user, a channel per event type, and a status that is bad on errors."""
    status = F.when(F.col("event_type") == "error", F.lit(1.0)).otherwise(F.lit(0.0))
    return table(spark, folder, "events").select(
        "user_id", F.col("event_type").alias("channel"), F.col("event_id").alias(SEQ),
        epoch_ns(F.col("ts")).alias(TS), "value", status.alias("status"))


SAMPLES = """s as (select user_id, event_type as channel, event_id as seq, epoch_us(ts) * 1000 as ts_ns, value,
  case when event_type = 'error' then 1.0 else 0.0 end as status from events)"""


def with_missing(df: DataFrame) -> DataFrame:
    """Error samples carry no usable value."""
    return df.withColumn("value", F.when(F.col("channel") != "error", F.col("value")))


MISSING = f"""{SAMPLES},
m as (select user_id, channel, seq, ts_ns, status, case when channel <> 'error' then value end as value from s)"""


def hourly(df: DataFrame) -> DataFrame:
    """Times cut to the hour, so that many samples of a series share one."""
    return df.withColumn(TS, F.call_function("div", F.col(TS), F.lit(HOUR_NS)) * F.lit(HOUR_NS))


HOURLY = f"""{SAMPLES},
h as (select user_id, channel, seq, ts_ns // {HOUR_NS} * {HOUR_NS} as ts_ns, value, status from s)"""


def r6(name: str, alias: str | None = None):
    return F.round(F.col(name), 6).alias(alias or name)


def scratch(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints."""
    return f"{checkpoint_folder(spark)}/scratch-{uuid.uuid4().hex}"


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """events as recordings: a recording per user, one sensor, a measurement suffix per event type."""
    name = F.when(F.col("channel") == "signup", F.lit("_status")).otherwise(F.concat(F.lit("_"), F.col("channel")))
    return samples(spark, folder).select(
        F.col("user_id").alias("sigid"), F.lit("P001").alias("pmu"), name.alias("suffix"), SEQ, TS, "value")


READINGS = f"""{SAMPLES},
r as (select user_id as sigid, 'P001' as pmu, case when channel = 'signup' then '_status' else '_' || channel end as suffix,
  seq, ts_ns, value from s)"""


def recordings(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of all users in three cohorts, the first with tags."""
    users = table(spark, folder, "events").select(F.col("user_id").alias("sigid")).distinct()
    third = F.col("sigid") % 3
    tags = F.when(third == 0, F.array(F.lit("_click"), F.lit("_view"))).otherwise(F.array().cast("array<string>"))
    cohort = F.when(third == 0, "timing").when(third == 1, "negative").otherwise("baseline")
    return users.select("sigid", tags.alias("tags"), cohort.alias("cohort"))


MANIFEST = """man as (select distinct user_id as sigid,
  case when user_id % 3 = 0 then ['_click', '_view'] else [] end as tags,
  case user_id % 3 when 0 then 'timing' when 1 then 'negative' else 'baseline' end as cohort from events)"""
SELECTED = f"""{READINGS},
{MANIFEST},
sel as (select r.*, man.cohort from r join man using (sigid)
  where (len(tags) = 0 and suffix not like '%\\_status' escape '\\') or list_contains(tags, suffix))"""


def gap_ctes(source: str, keys: Sequence[str], out: str = "gp") -> str:
    """Gaps over raw samples with the first one of a series given the median."""
    k = ", ".join(keys)
    return f"""{out}0 as materialized (select *, (ts_ns - lag(ts_ns) over (partition by {k} order by ts_ns, seq)) / 1e9 * 1000 as g
  from {source}),
{out}m as (select {k}, quantile_cont(g, 0.5) as med from {out}0 group by {k}),
{out} as (select {out}0.*, coalesce(g, med) as gap_ms from {out}0 join {out}m using ({k}))"""


def grid_ctes(
    source: str, keys: Sequence[str], freq: str, values: Sequence[str], carried: Sequence[str] = (), limit: int = 3,
    out: str = "gr",
) -> str:
    """Nearest sample per grid cell, filled marker and bounded fill. ``freq`` is an expression over the source."""
    k = ", ".join(keys)
    cols = [*values, *carried]
    listed = ", ".join(cols)
    missing = " or ".join(f"b.{c} is null" for c in values)
    filled = ", ".join(
        f"last_value({c} ignore nulls) over (partition by {k} order by cell rows between {limit} preceding and current row)"
        f" as {c}" for c in cols)
    same = " and ".join(f"g.{x} = b.{x}" for x in keys)
    return f"""{out}d as materialized (select * from (select *, row_number() over (partition by {k}, ts_ns order by seq) as dup
  from {source}) where dup = 1),
{out}b as materialized (select {k}, min(ts_ns) as t0, max(ts_ns) as t1, min({freq}) as f from {source} group by {k}),
{out}c as materialized (select {out}d.*, t0, t1, f, (ts_ns - t0) // f as c0 from {out}d join {out}b using ({k})),
{out}e as (select *, c0 as cell from {out}c union all by name select *, c0 + 1 as cell from {out}c
  where t0 + (c0 + 1) * f <= t1),
{out}r as materialized (select *, row_number() over (partition by {k}, cell order by abs(ts_ns - t0 - cell * f), ts_ns desc) as rn
  from {out}e where abs(ts_ns - t0 - cell * f) <= f // 2),
{out}g as (select {k}, t0, f, unnest(range(0, (t1 - t0) // f + 1)) as cell from {out}b),
{out}n as (select {", ".join("g." + x for x in keys)}, g.cell, g.t0 + g.cell * g.f as ts_ns,
  {", ".join("b." + c for c in cols)}, {missing} as was_filled
  from {out}g g left join (select * from {out}r where rn = 1) b on {same} and g.cell = b.cell),
{out} as (select {k}, cell, ts_ns, was_filled, {filled} from {out}n)"""


def rolling_ctes(source: str, keys: Sequence[str], order: str, col: str, window: int, out: str = "ro") -> str:
    k = ", ".join(keys)
    w = f"(partition by {k} order by {order} rows between {window - 1} preceding and current row)"
    one = f"(partition by {k} order by {order})"
    mean = f"case when count({col}) over {w} = {window} then avg({col}) over {w} end"
    std = f"case when count({col}) over {w} = {window} then stddev_samp({col}) over {w} end"
    return f"""{out} as (select *, abs({col} - lag({col}) over {one}) as {col}_delta, {mean} as {col}_rolling_mean,
  {std} as {col}_rolling_std, abs({col} - ({mean})) as {col}_dev_from_mean from {source})"""


def _expected(c: str) -> str:
    return (f"case when {c} > 2 then 2.0 * (ln({c} - 1.0::double) + 0.5772156649015329::double)"
            f" - 2.0 * ({c} - 1.0::double) / {c} when {c} = 2 then 1.0 else 0.0 end")


def _feature_case(n: int, column: str) -> str:
    return "case feature " + " ".join(f"when {i} then {column}{i}" for i in range(n)) + " end"


def _step(n: int, rows: str, trees: str) -> str:
    """Rows of an inner node to its children."""
    xs = ", ".join(f"a.x{i}" for i in range(n))
    return f"""select a.rid, a.model, a.tree, {xs}, 2 * a.node + 1 + ({_feature_case(n, 'x')} > threshold)::int as node
  from {rows} a join {trees} t on a.model = t.model and a.tree = t.tree and a.node = t.node where feature is not null"""


def _scored(rows: str, fitted: str, out: str, trees: int, depth: int) -> str:
    """Scores from the leaves that the rows of each level end in."""
    leaves = " union all ".join(
        f"""select a.rid, a.model, a.tree, {lv} + {_expected('t.n')} as path from {rows}{lv} a
  join {fitted}_t{lv} t on a.model = t.model and a.tree = t.tree and a.node = t.node where feature is null"""
        for lv in range(depth + 1))
    sums = " + ".join(f"max(path) filter (tree = {t})" for t in range(trees))
    return f"""{out}_leaves as ({leaves}),
{out}_scored as (select rid, model, case when ({_expected('total')}) > 0
  then pow(2.0::double, -(h / {trees} / ({_expected('total')}))) else 0.5 end as score
  from (select rid, model, {sums} as h from {out}_leaves group by rid, model) join {fitted}_cap using (model))"""


def forest_ctes(
    source: str, features: Sequence[str], model: str, trees: int, depth: int, seed: int = 42, out: str = "fo"
) -> str:
    """An isolation forest in SQL: ``{out}_nodes`` and, per row of ``source``, ``{out}_scored`` with a score.

    ``source`` must have a unique ``rid``; ``model`` is an expression naming each row's model.
    """
    n = len(features)
    xs = ", ".join(f"cast({f} as double) as x{i}" for i, f in enumerate(features))
    ranges = ", ".join(f"min(x{i}) as lo{i}, max(x{i}) as hi{i}" for i in range(n))
    varying = " + ".join(f"(hi{i} > lo{i})::int" for i in range(n))
    text = f"concat_ws('|', '{seed}', model, tree::varchar, node::varchar)"
    u1 = f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0::double)"
    u2 = f"(('0x' || substr(md5({text}), 9, 8))::bigint / 4294967296.0::double)"
    pick = "case " + " ".join(
        f"when hi{i} > lo{i} and floor(u1 * m) < " + " + ".join(f"(hi{j} > lo{j})::int" for j in range(i + 1)) + f" then {i}"
        for i in range(n)) + " end"
    parts = [
        f"{out}_x as materialized (select rid, {model} as model, {xs} from {source})",
        f"""{out}_cap as (select model, count(*) as total, case when count(*) > 1
  then least({depth}, greatest(1, ceil(log2(count(*)))::int)) else 0 end as cap from {out}_x group by model)""",
        f"{out}_a0 as (select *, 0 as node from {out}_x, (select unnest(range(0, {trees})) as tree))",
    ]
    for level in range(depth + 1):
        split = f"n > 1 and m > 0 and {level} < cap"
        parts.append(f"""{out}_d{level} as materialized (select *, {_feature_case(n, 'lo')} as lo, {_feature_case(n, 'hi')} as hi
  from (select *, case when {split} then {pick} end as feature from (
  select *, {u1} as u1, {u2} as u2, {varying} as m from (
  select model, tree, node, count(*) as n, {ranges} from {out}_a{level} group by model, tree, node)
  join {out}_cap using (model))))""")
        parts.append(f"""{out}_t{level} as (select model, tree, node, n, feature, {level} as level,
  case when lo + u2 * (hi - lo) >= hi then lo else lo + u2 * (hi - lo) end as threshold from {out}_d{level})""")
        if level < depth:
            parts.append(f"{out}_a{level + 1} as materialized ({_step(n, f'{out}_a{level}', f'{out}_t{level}')})")
    parts.append(f"{out}_nodes as (" + " union all ".join(f"select * from {out}_t{lv}" for lv in range(depth + 1)) + ")")
    parts.append(_scored(f"{out}_a", out, out, trees, depth))
    return ",\n".join(parts)


def walk_ctes(
    source: str, features: Sequence[str], model: str, trees: int, depth: int, fitted: str = "fo", out: str = "wa"
) -> str:
    """``{out}_scored``: rows of another table scored by the forest that ``forest_ctes`` fitted."""
    n = len(features)
    xs = ", ".join(f"cast({f} as double) as x{i}" for i, f in enumerate(features))
    parts = [f"""{out}_a0 as (select *, 0 as node from (select rid, {model} as model, {xs} from {source}),
  (select unnest(range(0, {trees})) as tree))"""]
    for level in range(depth):
        parts.append(f"{out}_a{level + 1} as materialized ({_step(n, f'{out}_a{level}', f'{fitted}_t{level}')})")
    return ",\n".join([*parts, _scored(f"{out}_a", fitted, out, trees, depth)])


def flag_ctes(scored: str, contamination: float, out: str = "fl") -> str:
    return f"""{out}_cut as (select model, quantile_cont(score, {1.0 - contamination}) as cutoff from {scored} group by model),
{out} as (select rid, {scored}.model, score, score > cutoff as flagged from {scored} join {out}_cut using (model))"""
