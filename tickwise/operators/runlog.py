"""An append-only log of runs; the current state of a run is its latest event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUEUED, RUNNING, COMPLETED, FAILED, DELETED = "queued", "running", "completed", "failed", "deleted"

SCHEMA = """
    run_id long, event_ns long, status string, mode string, dataset_key string, target_col string, status_col string,
    window int, n_estimators int, random_state int, contamination double, max_samples double,
    created_ns long, started_ns long, completed_ns long, duration_s double, n_rows long, n_flagged long,
    precision double, recall double, f1 double,
    by_fault_type map<string,double>, caught_by_fault_type map<string,boolean>,
    has_chart boolean, model_path string, error_message string
"""


def append_events(events: DataFrame, path: str) -> None:
    """Add events; nothing already logged changes."""
    events.write.mode("append").parquet(path)


def event(spark: SparkSession, run_id: int, event_ns: int, status: str, **fields) -> DataFrame:
    """One event with the whole record as known by then; fields not given are NULL."""
    names = [f.strip().split(" ")[0] for f in SCHEMA.replace("map<string,double>", "map_d").replace(
        "map<string,boolean>", "map_b").split(",")]
    values = {"run_id": run_id, "event_ns": event_ns, "status": status, **fields}
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"unknown fields {sorted(unknown)}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], SCHEMA)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def current_state(events: DataFrame, order: str = "event_ns") -> DataFrame:
    """The latest event of each run, leaving out deleted runs. One aggregation; no run's history is gathered."""
    latest = events.groupBy("run_id").agg(F.max_by(F.struct(*[c for c in events.columns if c != "run_id"]), order).alias("_e"))
    return latest.select("run_id", "_e.*").where(F.col("status") != DELETED)


def page(state: DataFrame, limit: int = 50, offset: int = 0, created: str = "created_ns") -> DataFrame:
    """Runs, newest first."""
    return state.orderBy(F.desc(created), F.desc("run_id")).offset(offset).limit(limit)


def detail(state: DataFrame, run_id: int) -> DataFrame:
    """One run, with empty maps instead of missing ones. No row: no such run. ``has_chart`` false: no chart yet."""
    one = state.where(F.col("run_id") == run_id)
    return one.withColumns({
        "by_fault_type": F.coalesce("by_fault_type", F.create_map().cast("map<string,double>")),
        "caught_by_fault_type": F.coalesce("caught_by_fault_type", F.create_map().cast("map<string,boolean>")),
        "has_chart": F.coalesce("has_chart", F.lit(False))})


def chart_rows(charts: DataFrame, state: DataFrame, run_id: int) -> DataFrame:
    """The stored chart of one run that still exists."""
    return charts.where(F.col("run_id") == run_id).join(state.select("run_id"), "run_id", "left_semi")


def delete_run(spark: SparkSession, run_id: int, event_ns: int) -> DataFrame:
    """The event that hides a run; its model folder is no longer referenced and may be removed."""
    return event(spark, run_id, event_ns, DELETED)
