"""Which recordings belong to which cohort, and which of their measurements are in question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "sigid long, source string, tags array<string>, cohort string"

# Recordings labelled with a timing problem, with the measurement suffixes the label is about.
TIMING = {
    5711: ("PMU - Eastern Interconnection", ["_f", "_ip_a", "_vp_a"]),
    5712: ("PMU - Eastern Interconnection", ["_f", "_ip_a", "_vp_a"]),
    5724: ("PMU - Eastern Interconnection", ["_vp_a"]),
    5726: ("PMU - Eastern Interconnection", ["_vp_a"]),
    5735: ("PMU - Eastern Interconnection", ["_vp_a"]),
    5737: ("PMU - Eastern Interconnection", ["_vp_a"]),
    5757: ("PMU - Eastern Interconnection", ["_vp_a"]),
    5790: ("PMU - Western Interconnection", ["_ip_a", "_vp_a"]),
    5791: ("PMU - Western Interconnection", ["_f", "_ip_a", "_vp_a"]),
    5829: ("PMU - Western Interconnection", ["_f", "_vp_a"]),
    5830: ("PMU - Western Interconnection", ["_f", "_vp_a"]),
    5831: ("PMU - Western Interconnection", ["_f", "_vp_a"]),
    5832: ("PMU - Western Interconnection", ["_f", "_vp_a"]),
    5833: ("PMU - Western Interconnection", ["_f", "_vp_a"]),
}
# Recordings with other problems, to measure false positives on.
NEGATIVE = (5716, 5717, 5725, 5728, 5729, 5732, 5745, 5748, 5752, 5772, 5787, 5795, 5801, 5806, 5814)
# Recordings a "known normal" model is fitted on, disjoint from the two sets above.
BASELINE = (
    5718, 5719, 5731, 5734, 5736, 5740, 5750, 5753, 5754, 5755,
    5758, 5762, 5782, 5796, 5802, 5804, 5809, 5811, 5816, 5821,
)


def manifest(spark: SparkSession) -> DataFrame:
    """The three cohorts as one table. Untagged recordings have every non-status measurement checked."""
    rows = [(i, source, tags, "timing") for i, (source, tags) in TIMING.items()]
    rows += [(i, "", [], "negative") for i in NEGATIVE]
    rows += [(i, "", [], "baseline") for i in BASELINE]
    return spark.createDataFrame(rows, SCHEMA)


def overlapping_cohorts(table: DataFrame) -> DataFrame:
    """Recordings listed in more than one cohort; empty in a sound manifest."""
    return table.groupBy("sigid").agg(F.countDistinct("cohort").alias("n_cohorts")).where(F.col("n_cohorts") > 1)


def holdout_sample(pool: DataFrame, known: DataFrame, n: int, seed: int = 42, key: str = "sigid") -> DataFrame:
    """``n`` keys of the pool that are not known yet, in an order fixed by the seed."""
    fresh = pool.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")
    ticket = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return fresh.withColumn("_ticket", ticket).orderBy("_ticket", key).limit(n).drop("_ticket")
