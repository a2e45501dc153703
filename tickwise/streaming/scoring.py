"""Scoring model rows as they arrive, against a fitted forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tickwise.operators import forest


def read_rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A stream of the Parquet files that appear in a folder of clean model rows."""
    return spark.readStream.schema(schema).parquet(folder)


def score_stream(rows: DataFrame, fitted: forest.Forest, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``score`` and ``flagged``. A fixed cutoff makes this a map over rows, so the stream keeps no state."""
    return forest.score(rows, fitted, keys)


def write_flagged(scored: DataFrame, folder: str, progress: str) -> DataStreamWriter:
    """Flagged rows, appended to Parquet; ``progress`` is the shared folder a restarted query continues from."""
    return scored.where("flagged").writeStream.format("parquet").option("path", folder).option(
        "checkpointLocation", progress).outputMode("append")
