"""Named data sets: which channel files, which column is judged, which one holds the status."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schema import STATUS
from tickwise.sources.channels import default_status, merge_channels, scan_channels


@dataclass(frozen=True)
class Dataset:
    label: str
    channels: Mapping[str, str]
    target: str
    status: str = STATUS


def is_available(spark: SparkSession, dataset: Dataset) -> bool:
    """Whether every channel path exists on its file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in dataset.channels.values()]
    return all(p.getFileSystem(conf).exists(p) for p in paths)


def list_datasets(spark: SparkSession, registry: Mapping[str, Dataset]) -> DataFrame:
    """One row per named data set."""
    rows = [(k, d.label, d.target, d.status, is_available(spark, d)) for k, d in registry.items()]
    return spark.createDataFrame(rows, "key string, label string, target string, status string, available boolean")


def load_dataset(spark: SparkSession, registry: Mapping[str, Dataset], key: str) -> DataFrame:
    """The named set as a wide table keyed by ``site``, with a status column in any case."""
    if key not in registry:
        raise KeyError(f"unknown data set {key!r}")
    dataset = registry[key]
    samples = scan_channels(spark, dataset.channels).withColumn("site", F.lit(key))
    return default_status(merge_channels(samples, ["site"], list(dataset.channels)), dataset.status)
