"""Small helpers the operators share: intermediate tables in the shared folder, batches, size checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import CLEAN_SHUFFLES, checkpoint_folder, set_for_now

# Bytes of rows that a Python worker gets at once while a table is stored. A batch lies in Arrow memory of the executor, grown in steps of
# twice its size, and again in the worker, beside the heap; Spark's own bound is 64 MB a task.
BATCH_BYTES = 8_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Tables up to this many bytes, as measured, are sent whole to every executor; larger ones are joined by shuffle.
BROADCAST_BYTES = 64_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get batches of BATCH_BYTES at most for jobs started inside; no row is left out, a longer one is a batch of its own."""
    with set_for_now(spark, {_BATCH_SETTING: str(BATCH_BYTES)}):
        yield


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into Parquet in the shared folder, so that no later step depends on its executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with small_batches(spark), set_for_now(spark, CLEAN_SHUFFLES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) if not isinstance(c, pa.Array) else c
                                       for c, t in zip(columns, schema, strict=True)], schema=schema)


def column(rows: pa.RecordBatch, name: str) -> pa.Array:
    return rows.column(rows.schema.get_field_index(name))


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def chunks(items: Sequence, size: int) -> Iterator[Sequence]:
    for lo in range(0, len(items), size):
        yield items[lo:lo + size]


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted in taken:
        wanted = "_" + wanted
    return wanted


def small_enough(df: DataFrame, row_bytes: object, limit: int | None = None) -> bool:
    """Whether a stored table's rows, at ``row_bytes`` each, may be sent to every executor."""
    limit = BROADCAST_BYTES if limit is None else limit
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    return (df.agg(F.sum(size)).first()[0] or 0) <= limit


def documents_view(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
