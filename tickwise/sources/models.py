"""Fitted forests as Parquet tables, one folder per run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickwise.operators import deepforest
from tickwise.operators.forest import MODEL, NODES_SCHEMA, Forest, Settings


def save_forest(forest: Forest, path: str) -> None:
    """Node and meta tables under ``path``, nodes in order of their model so that a reader of some models skips the rest; an
    existing model there is never overwritten."""
    nodes = forest.nodes.repartitionByRange(MODEL, "tree").sortWithinPartitions(MODEL, "tree", "node")
    nodes.write.mode("errorifexists").parquet(f"{path}/nodes")
    forest.meta.write.mode("errorifexists").parquet(f"{path}/meta")


def load_forest(spark: SparkSession, path: str) -> Forest:
    """A forest that scores exactly as the one that was saved."""
    meta = spark.read.parquet(f"{path}/meta")
    first = meta.first()
    schema = NODES_SCHEMA if first["max_depth"] is not None else deepforest.NODES_SCHEMA
    nodes = spark.read.schema(schema).parquet(f"{path}/nodes")
    cfg = Settings(
        first["n_estimators"], first["contamination"], first["seed"], first["max_samples"], first["max_depth"])
    return Forest(nodes, meta, tuple(first["features"]), cfg)
