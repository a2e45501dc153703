"""Session settings and the ways this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Shuffle files go as soon as the query that wrote them has ended, not when the driver next collects its garbage.
CLEAN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# One-row-per-series tables up to this many rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only for an unconfigured local session."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return named or current
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tickwise-checkpoint-")
    context.setCheckpointDir(named)
    return named


@contextmanager
def set_for_now(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs started inside."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so that later steps neither repeat it nor depend on its executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Compute ``df`` once into Parquet in the shared folder, or one of ``passing``: for whole tables that several steps read, each only some columns of."""
    path = f"{folder or checkpoint_folder(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    with set_for_now(df.sparkSession, CLEAN_SHUFFLES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[str]:
    """A shared folder for tables that are read only inside; it goes with them."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/passing-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_small(settled: DataFrame, max_rows: int | None = None) -> bool:
    """Whether an already settled table has few enough rows to be broadcast."""
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    return settled.limit(bound + 1).count() <= bound
