import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickwise.operators import evaluate, reporting, runlog
from tickwise.operators.forest import Settings
from tickwise.plans import recordings as plan

SECOND = 1_000_000_000


def flags(spark, flagged, site="a"):
    data = [(site, i * SECOND, i, f) for i, f in enumerate(flagged)]
    return spark.createDataFrame(data, "site string, ts_ns long, seq long, flagged boolean")


def labels(spark, *windows):
    data = [("a", s * SECOND, e * SECOND, t, i) for i, (s, e, t) in enumerate(windows)]
    return spark.createDataFrame(data, "site string, start_ns long, end_ns long, fault_type string, ord int")


def test_mask_is_closed_and_counts_overlaps_once(spark):
    df = flags(spark, [False] * 8).unionByName(flags(spark, [False] * 8, "b"))
    windows = labels(spark, (1, 3, "x"), (2, 4, "y"), (6, 6, "x"))
    got = rows(evaluate.truth_mask(df, windows, ["site"]), "site", "seq")
    assert [r["truth"] for r in got] == [False, True, True, True, True, False, True, False] + [False] * 8


def test_precision_recall(spark):
    pairs = [(True, True), (True, True), (False, True), (True, False), (False, False)]
    got = evaluate.precision_recall(spark.createDataFrame(pairs, "truth boolean, flagged boolean")).first()
    assert got["precision"] == got["recall"] == got["f1"] == pytest.approx(2 / 3)
    nothing = evaluate.precision_recall(spark.createDataFrame([(False, False)], "truth boolean, flagged boolean")).first()
    assert (nothing["precision"], nothing["recall"], nothing["f1"]) == (0.0, 0.0, 0.0)


def test_share_and_caught(spark):
    df = flags(spark, [False, True, False, False, False, False, False, False])
    windows = labels(spark, (0, 3, "x"), (1, 2, "x"), (5, 6, "y"), (50, 60, "far"), (7, 7, "x"))
    share = {r["fault_type"]: r["share_flagged"] for r in evaluate.share_by_fault_type(df, windows, ["site"]).collect()}
    assert share == {"x": 0.2, "y": 0.0}
    caught = {r["fault_type"]: r["caught"] for r in evaluate.caught_by_fault_type(df, windows, ["site"]).collect()}
    assert caught == {"x": True, "y": False}
    single = rows(evaluate.caught_by_fault_type(df, windows, ["site"], per="window"), "ord")
    assert [(r["ord"], r["caught"]) for r in single] == [(0, True), (1, True), (2, False), (4, False)]


def test_many_windows_without_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(4)
    starts = rng.integers(0, 900, 60)
    windows = labels(spark, *[(int(s), int(s + rng.integers(0, 9)), "x") for s in starts])
    df = flags(spark, [False] * 1000)
    wide = [r["truth"] for r in rows(evaluate.truth_mask(df, windows, ["site"]), "seq")]
    monkeypatch.setattr("tickwise.session.BROADCAST_ROWS", 3)
    narrow = [r["truth"] for r in rows(evaluate.truth_mask(df, windows, ["site"]), "seq")]
    brute = [any(r["start_ns"] <= i * SECOND <= r["end_ns"] for r in windows.collect()) for i in range(1000)]
    assert wide == narrow == brute


def test_windows_are_broadcast_by_their_copies(spark, monkeypatch):
    many = [(f"s{k}", k * SECOND, (k + 90) * SECOND, "x", 0) for k in range(100)]
    windows = spark.createDataFrame(many, "site string, start_ns long, end_ns long, fault_type string, ord int")
    df = spark.createDataFrame([(f"s{k}", t * SECOND, t) for k in range(100) for t in range(0, 200, 9)], "site string, ts_ns long, seq long")
    monkeypatch.setattr("tickwise.session.BROADCAST_ROWS", 150)
    spread, _, small = evaluate.bucketed(windows)
    assert not small and spread.count() <= 3 * len(many)
    mask = evaluate.truth_mask(df, windows, ["site"])
    assert "broadcast" not in mask._jdf.queryExecution().analyzed().toString()
    assert mask.where("truth").count() == sum(k <= t <= k + 90 for k in range(100) for t in range(0, 200, 9)) and mask.count() == df.count()


def test_rollup_keeps_empty_recordings(spark):
    channels = spark.createDataFrame(
        [(1, f"P00{i}_f", i < 2) for i in range(4)], "sigid long, channel string, any_flagged boolean")
    known = spark.createDataFrame([(1, "timing"), (2, "negative")], "sigid long, cohort string")
    got = rows(evaluate.recording_rollup(channels, known), "sigid")
    assert (got[0]["fraction_flagged"], got[0]["any_flagged"], got[0]["n_channels_checked"]) == (0.5, True, 4)
    assert got[0]["channel_flagged"] == {"P000_f": True, "P001_f": True, "P002_f": False, "P003_f": False}
    assert (got[1]["fraction_flagged"], got[1]["any_flagged"], got[1]["channel_flagged"]) == (0.0, False, {})


def test_rates_and_thresholds(spark):
    results = spark.createDataFrame(
        [("t", True, 1 / 6), ("t", False, 0.0), ("n", True, 0.5)], "cohort string, any_flagged boolean, fraction_flagged double")
    assert {r["cohort"]: r["positive_rate"] for r in evaluate.cohort_rates(results).collect()} == {"t": 0.5, "n": 1.0}
    swept = {(r["threshold"], r["cohort"]): r["positive_rate"] for r in evaluate.threshold_sweep(results, [0.1, 0.5]).collect()}
    assert swept == {(0.1, "t"): 0.5, (0.1, "n"): 1.0, (0.5, "t"): 0.0, (0.5, "n"): 1.0}


def chart(spark, values, flagged, buckets, **sizes):
    data = pd.DataFrame({"site": "a", "ts_ns": np.arange(len(values)) * SECOND, "seq": range(len(values)),
                         "value": values, "flagged": flagged})
    df = spark.createDataFrame(data).repartition(3)
    return reporting.decimate(df, ["site"], "value", max_buckets=buckets, **sizes).toPandas().sort_values("row")


@pytest.mark.parametrize("n", [50, 100, 101, 1234])
@pytest.mark.parametrize("chunk", [None, 90])
def test_decimation_equals_brute_force(spark, n, chunk):
    rng = np.random.default_rng(n)
    values, flagged = rng.integers(0, 20, n).astype(float), rng.random(n) < 0.1
    kept = set()
    edges = np.linspace(0, n, 101, dtype=int) if n > 100 else np.arange(n + 1)
    for low, high in zip(edges[:-1], edges[1:]):
        if high > low:
            kept |= {low + int(values[low:high].argmin()), low + int(values[low:high].argmax())}
            if flagged[low:high].any():
                kept.add(low + int(flagged[low:high].argmax()))
    got = chart(spark, values, flagged, 100, chunk_rows=chunk)
    assert got["row"].tolist() == sorted(kept)
    assert got["value"].tolist() == values[sorted(kept)].tolist()
    assert (got["ts_ms"] == got["row"] * 1000).all()


def test_spike_survives_and_size_is_bounded(spark):
    values = np.zeros(5000)
    values[3210] = 9.0
    got = chart(spark, values, np.arange(5000) % 2 == 0, 40)
    assert 3210 in set(got["row"]) and len(got) <= 120


def test_flags_are_put_down_to_the_first_listed_window(spark):
    df = flags(spark, [True, True, True, True, False, True])
    windows = labels(spark, (2, 4, "second"), (1, 2, "later"), (2, 2, "never"))
    stamped = df.withColumn("ts_ms", reporting.to_ms(F.col("ts_ns")))
    got = reporting.attribute_flags(stamped, reporting.windows_ms(windows), ["site"])
    assert [r["fault"] for r in rows(got, "seq")] == ["other", "later", "second", "second", None, "other"]
    split = reporting.split_by_fault(got, ["seq"], "ts_ms", ["later", "second"])
    assert [r["second"] for r in rows(split, "seq")] == [None, None, 2000, 3000, None, None]


def test_run_log_life_cycle(spark, tmp_path):
    path = str(tmp_path / "log")
    record = {"dataset_key": "x", "created_ns": 10}
    for e in (
        runlog.event(spark, 1, 10, runlog.QUEUED, **record),
        runlog.event(spark, 1, 11, runlog.RUNNING, started_ns=11, **record),
        runlog.event(spark, 1, 12, runlog.COMPLETED, precision=0.5, by_fault_type={"dropout": 1.0},
                     caught_by_fault_type={"dropout": True}, has_chart=True, model_path="m/1", **record),
        runlog.event(spark, 2, 13, runlog.QUEUED, dataset_key="y", created_ns=13),
        runlog.event(spark, 3, 14, runlog.FAILED, error_message="ValueError: x", dataset_key="y", created_ns=14),
    ):
        runlog.append_events(e, path)
    state = runlog.current_state(runlog.read_events(spark, path))
    assert [r["run_id"] for r in runlog.page(state).collect()] == [3, 2, 1]
    assert [r["run_id"] for r in runlog.page(state, 1, 1).collect()] == [2]
    one = runlog.detail(state, 1).first()
    assert (one["status"], one["by_fault_type"], one["has_chart"]) == ("completed", {"dropout": 1.0}, True)
    assert runlog.detail(state, 2).first()["by_fault_type"] == {}
    assert not runlog.detail(state, 2).first()["has_chart"]
    assert runlog.detail(state, 9).count() == 0
    runlog.append_events(runlog.delete_run(spark, 1, 20), path)
    left = runlog.current_state(runlog.read_events(spark, path))
    assert {r["run_id"] for r in left.collect()} == {2, 3}
    charts = spark.createDataFrame([(1, 0), (2, 0)], "run_id long, ts_ms long")
    assert runlog.chart_rows(charts, left, 1).count() == 0
    with pytest.raises(ValueError):
        runlog.event(spark, 1, 1, runlog.QUEUED, nonsense=1)


@pytest.fixture(scope="module")
def clips(spark):
    """Two normal recordings, a wild one, and one whose second channel is too short to model."""
    rng = np.random.default_rng(6)
    parts = []
    for sigid, level in ((1, 0.0), (2, 0.0), (3, 50.0), (4, 0.0)):
        for suffix in ("_f", "_vp_a") if sigid != 2 else ("_f",):
            n = 1 if (sigid, suffix) == (4, "_vp_a") else 120
            value = rng.normal(size=n)
            value[60:64] += level
            parts.append(pd.DataFrame({
                "sigid": sigid, "pmu": "P001", "suffix": suffix, "seq": range(n), "ts_ns": np.arange(n) * 33_000_000,
                "value": value}))
    cohorts = [(1, [], "baseline"), (2, [], "negative"), (3, ["_f"], "timing"), (4, [], "negative"), (5, [], "negative")]
    manifest = spark.createDataFrame(cohorts, "sigid long, tags array<string>, cohort string")
    return spark.createDataFrame(pd.concat(parts)), manifest


def test_per_channel_models(spark, clips):
    readings, manifest = clips
    results, rates = plan.run_validation(readings, manifest, settings=Settings(n_estimators=20))
    got = {r["sigid"]: r for r in results.collect()}
    assert set(got) == {2, 3, 4, 5}
    assert got[3]["channel_flagged"] == {"P001_f": True}
    assert got[4]["n_channels_checked"] == 2 and got[4]["channel_flagged"]["P001_vp_a"] is False
    assert got[5]["n_channels_checked"] == 0
    assert {r["cohort"] for r in rates.collect()} == {"timing", "negative"}


def test_pooled_baseline(spark, clips):
    readings, manifest = clips
    only_f = readings.where("not (sigid = 1 and suffix = '_vp_a')")
    results, rates, baseline = plan.run_baseline_validation(
        only_f, manifest, settings=Settings(n_estimators=20), threshold=0.5)
    assert {(r["model"], r["n_train"]) for r in baseline.meta.collect()} == {("_f", 120)}
    got = {r["sigid"]: r for r in results.collect()}
    assert got[3]["channel_flagged"] == {"P001_f": True}
    assert got[4]["n_channels_checked"] == 1  # no model for the other suffix, so it was not checked
    assert {r["cohort"]: r["n_positive"] for r in rates.collect()}["timing"] == 1


def test_one_long_window_among_many_short_ones(spark):
    labels = [("a", 0, 10_000_000)] + [("b", k * 1000, k * 1000 + 10) for k in range(300)]
    windows = spark.createDataFrame([(*w, "x", 0) for w in labels], "site string, start_ns long, end_ns long, fault_type string, ord int")
    rows = spark.createDataFrame([(s, t) for s in "ab" for t in range(0, 320_000, 7)], "site string, ts_ns long")
    got = evaluate.truth_mask(rows, windows, ["site"])
    assert got.count() == rows.count()
    assert got.where("truth").count() == sum(any(s == w and a <= t <= b for w, a, b in labels[(0 if s == "a" else 1 + t // 1000):][:2])
                                             for s in "ab" for t in range(0, 320_000, 7))


def test_recordings_without_an_interval_are_not_called_clean(spark, clips):
    readings, manifest = clips
    still = spark.createDataFrame([(5, "P001", "_f", k, 7, 1.0) for k in range(6)], "sigid long, pmu string, suffix string, seq long, ts_ns long, value double")
    with_still = readings.unionByName(still)
    few = Settings(n_estimators=5)
    with pytest.raises(ValueError, match="usable sampling interval"):
        plan.run_validation(with_still, manifest, settings=few)
    results, _ = plan.run_validation(with_still, manifest, settings=few, unusable="skip")
    got = {r["sigid"]: r for r in results.collect()}
    assert got[5]["n_channels_checked"] == 0 and got[4]["n_channels_checked"] == 2
