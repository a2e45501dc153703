import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickwise.operators import faults
from tickwise.operators.forest import Settings
from tickwise.plans.site import detect_timing_faults, feature_rows
from tickwise.schema import SAMPLE_INTERVAL_NS as STEP

START = 1_600_000_000_000_000_000


def clean(spark, n, sites=("a",)):
    sites = F.explode(F.array(*[F.lit(s) for s in sites]))
    return spark.range(n).select(
        sites.alias("site"), (F.lit(START) + F.col("id") * STEP).alias("ts_ns"), F.col("id").alias("seq"),
        (60 + 0.01 * F.sin(F.col("id") / 50)).alias("value"), F.lit(0.0).alias("status"))


def at(i):
    return START + i * STEP


def test_each_fault_does_one_thing(spark):
    df = clean(spark, 20)
    low, high = F.lit(at(5)), F.lit(at(8))
    assert faults.dropout(df, low, high).count() == 16
    moved = rows(faults.clock_step(df, low, high, 33.5), "seq")
    assert [r["ts_ns"] - at(i) for i, r in enumerate(moved)] == [33_500_000 if 5 <= i <= 8 else 0 for i in range(20)]
    bad = rows(faults.corrupt_status(df, low, high, 9.0), "seq")
    assert [r["status"] for r in bad] == [9.0 if 5 <= i <= 8 else 0.0 for i in range(20)]
    shaken = rows(faults.jitter(df, low, high, 5.0, seed=1), "seq")
    again = rows(faults.jitter(df.repartition(9), low, high, 5.0, seed=1), "seq")
    other = rows(faults.jitter(df, low, high, 5.0, seed=2), "seq")
    assert shaken == again and shaken != other
    assert [r["ts_ns"] == at(i) for i, r in enumerate(shaken)] == [not 5 <= i <= 8 for i in range(20)]
    assert [r["value"] for r in shaken] == [r["value"] for r in rows(df, "seq")]


def test_jitter_is_normal(spark):
    df = clean(spark, 20_000)
    shaken = faults.jitter(df, F.lit(0), F.lit(1 << 62), 5.0).toPandas().sort_values("seq")
    shift = (shaken["ts_ns"].to_numpy() - START - np.arange(20_000) * STEP) / 1e6
    assert abs(shift.mean()) < 0.15 and abs(shift.std() - 5.0) < 0.15


def test_labels_are_padded_where_the_evidence_is(spark):
    spec = [{"type": faults.DROPOUT, "start_ns": at(3), "end_ns": at(5)},
            {"type": faults.STEP, "offset_ms": 1.0, "start_ns": at(9), "end_ns": at(11)},
            {"type": faults.STATUS_FAULT, "start_ns": at(14), "end_ns": at(15)}]
    changed, labels = faults.inject_faults(clean(spark, 20, ("a", "b")), ["site"], spec)
    assert changed.count() == 34
    got = [(r["site"], r["fault_type"], r["start_ns"], r["end_ns"]) for r in rows(labels, "site", "ord")]
    assert got == [(s, *w) for s in "ab" for w in (
        ("dropout", at(3), at(6)), ("clock_step", at(8), at(12)), ("tq_corruption", at(14), at(15)))]


def test_later_faults_see_earlier_times(spark):
    spec = [{"type": faults.STEP, "offset_ms": 10 * STEP / 1e6, "start_ns": at(0), "end_ns": at(1)},
            {"type": faults.STATUS_FAULT, "start_ns": at(10), "end_ns": at(11)}]
    changed, _ = faults.inject_faults(clean(spark, 20), ["site"], spec)
    assert [r["seq"] for r in rows(changed.where("status = 1"), "seq")] == [0, 1, 10, 11]
    with pytest.raises(ValueError):
        faults.inject_faults(clean(spark, 5), ["site"], [{"type": "other", "start_ns": 0, "end_ns": 1}])


@pytest.mark.parametrize("chunk", [None, 70])
def test_default_placement(spark, chunk):
    df = clean(spark, 200, ("a", "b")).unionByName(clean(spark, 39, ("short",)))
    with pytest.raises(ValueError, match="1 series have fewer than 40 rows"):
        faults.default_windows(df, ["site"], chunk_rows=chunk)
    got = rows(faults.default_windows(df, ["site"], short="skip", chunk_rows=chunk), "site", "ord")
    assert [(r["site"], r["ord"], r["start_ns"], r["end_ns"]) for r in got] == [
        (s, i, at(40 * (i + 1)), at(40 * (i + 1) + 3)) for s in "ab" for i in range(4)]


def test_every_item_has_a_window_or_is_an_error(spark):
    df, spec = clean(spark, 120), [*faults.DEFAULT_SPEC, {"type": faults.STATUS_FAULT, "bad_value": 3.0}]
    with pytest.raises(ValueError, match="item \\[4\\]"):
        faults.inject_faults(df, ["site"], spec, faults.default_windows(df, ["site"]))
    _, labels = faults.inject_faults(df, ["site"], spec, faults.default_windows(df, ["site"], len(spec)))
    assert labels.count() == 5
    with pytest.raises(ValueError):
        detect_timing_faults(clean(spark, 30))
    assert detect_timing_faults(clean(spark, 30), short="skip").labels.count() == 0


@pytest.mark.parametrize("sizes", [{}, {"chunk_rows": 700, "chunk_cells": 500}])
def test_whole_run_finds_the_faults_and_loses_two_rows(spark, sizes):
    result = detect_timing_faults(clean(spark, 5000), settings=Settings(n_estimators=40), **sizes)
    overall = result.overall.first()
    # One row of the dropout and one of the hole the clock step leaves are too far from a sample to be filled.
    assert overall["n_rows"] == 4998
    assert 0 < overall["n_flagged"] <= 50
    assert {r["fault_type"]: r["caught"] for r in result.caught.collect()} == {
        "dropout": True, "timestamp_jitter": True, "clock_step": True, "tq_corruption": True}
    assert result.features == [
        "value", "value_delta", "value_rolling_std", "value_dev_from_mean", "gap_ms", "status"]


def test_chunks_do_not_change_features(spark):
    df, _ = faults.inject_faults(
        clean(spark, 2000), ["site"], faults.DEFAULT_SPEC, faults.default_windows(clean(spark, 2000), ["site"]))
    plain = feature_rows(df, ["site"], "value").toPandas().sort_values("cell").reset_index(drop=True)
    cut = feature_rows(df, ["site"], "value", chunk_rows=130, chunk_cells=90).toPandas()
    cut = cut.sort_values("cell").reset_index(drop=True)
    assert plain.equals(cut)
