import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickwise.operators import features, series, timeaxis
from tickwise.plans.site import feature_rows
from tickwise.schema import SAMPLE_INTERVAL_NS

START = 1_600_000_000_000_000_000
KEYS = ["site"]


def frame(spark, times, values, site="a", **more):
    data = pd.DataFrame({"site": site, "ts_ns": times, "seq": range(len(times)), "value": values, **more})
    data["value"] = data["value"].astype(float)
    df = spark.createDataFrame(data)
    return df.withColumn("value", F.when(~F.isnan("value"), F.col("value"))).repartition(5)


@pytest.fixture(scope="module")
def messy(spark):
    """Two series with jitter, repeated times, exact half-step ties, a hole and missing values."""
    rng = np.random.default_rng(3)
    parts = []
    for site, n in (("a", 900), ("b", 150)):
        t = START + np.arange(n) * 1000 + rng.integers(-300, 300, n)
        t[50:60] = START + np.arange(50, 60) * 1000 + 500
        t[70] = t[69]
        t = np.delete(t, np.arange(100, 112))
        v = rng.normal(size=len(t)).round(3)
        v[rng.random(len(t)) < 0.05] = np.nan
        parts.append(pd.DataFrame({"site": site, "ts_ns": t, "seq": np.arange(len(t)), "value": v}))
    data = pd.concat(parts)
    df = spark.createDataFrame(data).withColumn("value", F.when(~F.isnan("value"), F.col("value"))).repartition(7)
    return df.persist(), data


def brute_grid(data: pd.DataFrame, f: int, limit: int) -> pd.DataFrame:
    """Nearest sample per cell by looking at every sample; later sample on a tie; bounded fill."""
    first = data.sort_values(["ts_ns", "seq"]).drop_duplicates("ts_ns", keep="first")
    t, v = first["ts_ns"].to_numpy(), first["value"].to_numpy()
    cells = np.arange((t.max() - t.min()) // f + 1)
    out = []
    for c in cells:
        away = np.abs(t - t.min() - c * f)
        near = np.flatnonzero(away == away.min())[-1]
        out.append(v[near] if away[near] <= f // 2 else np.nan)
    raw = pd.Series(out)
    return pd.DataFrame({"cell": cells, "was_filled": raw.isna(), "value": raw.ffill(limit=limit) if limit else raw})


@pytest.mark.parametrize("chunk", [None, 64])
@pytest.mark.parametrize("limit", [0, 3])
def test_grid_equals_brute_force(messy, chunk, limit):
    df, data = messy
    got = timeaxis.regularize(df, KEYS, ["value"], freq_ns=1000, fill_limit=limit, chunk_cells=chunk).toPandas()
    for site, part in data.groupby("site"):
        want = brute_grid(part, 1000, limit)
        mine = got[got["site"] == site].sort_values("cell").reset_index(drop=True)
        assert mine["cell"].tolist() == want["cell"].tolist()
        assert mine["was_filled"].tolist() == want["was_filled"].tolist()
        np.testing.assert_array_equal(mine["value"].to_numpy(float), want["value"].to_numpy())
        assert (mine["ts_ns"] == part["ts_ns"].min() + mine["cell"] * 1000).all()


@pytest.mark.parametrize("chunk", [None, 64])
def test_sparse_grid_is_the_dense_one_without_unfillable_cells(messy, chunk):
    df, _ = messy
    clean = timeaxis.drop_duplicate_times(df, KEYS)
    step = features.rolling_step("value", 5, by_cell=True)
    both = [
        timeaxis.on_grid(clean, KEYS, ["value"], freq_ns=1000, dense=dense, then=step, then_reach=4, chunk_cells=chunk)
        .where("value is not null").toPandas().sort_values(["site", "cell"]).reset_index(drop=True)
        for dense in (True, False)]
    pd.testing.assert_frame_equal(both[0], both[1])
    want = both[1][both[1]["site"] == "a"].set_index("cell")["value"].reindex(range(900)).rolling(5).std()
    got = both[1][both[1]["site"] == "a"].set_index("cell")["value_rolling_std"]
    np.testing.assert_allclose(got.to_numpy(float), want.reindex(got.index).to_numpy(), atol=1e-9)


@pytest.mark.parametrize("chunk", [None, 50])
def test_gap_fill_and_rolling_equal_pandas(messy, chunk):
    df, data = messy
    a = data[data["site"] == "a"].sort_values(["ts_ns", "seq"]).reset_index(drop=True)
    gaps = timeaxis.add_gap_features(df, KEYS, chunk_rows=chunk).where("site = 'a'").toPandas()
    gaps = gaps.sort_values(["ts_ns", "seq"])
    want = a["ts_ns"].diff() / 1e9 * 1000
    np.testing.assert_allclose(gaps["gap_ms"].to_numpy(), want.fillna(want.median()).to_numpy())

    filled = timeaxis.fill_forward(df, KEYS, ["value"], 2, chunk_rows=chunk).where("site = 'a'").toPandas()
    np.testing.assert_array_equal(
        filled.sort_values(["ts_ns", "seq"])["value"].to_numpy(float), a["value"].ffill(limit=2).to_numpy())
    endless = timeaxis.fill_forward_unbounded(df, KEYS, ["value"], chunk_rows=chunk).where("site = 'a'").toPandas()
    np.testing.assert_array_equal(
        endless.sort_values(["ts_ns", "seq"])["value"].to_numpy(float), a["value"].ffill().to_numpy())

    rolled = features.add_delta_and_rolling(df, KEYS, "value", 4, chunk_rows=chunk).where("site = 'a'").toPandas()
    rolled = rolled.sort_values(["ts_ns", "seq"])
    for name, want in (
        ("delta", a["value"].diff().abs()), ("rolling_mean", a["value"].rolling(4).mean()),
        ("rolling_std", a["value"].rolling(4).std()),
        ("dev_from_mean", (a["value"] - a["value"].rolling(4).mean()).abs()),
    ):
        np.testing.assert_allclose(rolled[f"value_{name}"].to_numpy(float), want.to_numpy(), atol=1e-9)


@pytest.mark.parametrize("chunk", [None, 50])
def test_unwrap_equals_numpy(spark, chunk):
    rng = np.random.default_rng(5)
    phase = rng.integers(-180, 181, 400).astype(float)
    phase[10:13] = [0, 180, 0]
    df = frame(spark, START + np.arange(400) * 1000, phase)
    got = features.unwrap_phase(df, KEYS, "value", 360.0, chunk_rows=chunk).toPandas().sort_values("seq")
    np.testing.assert_allclose(got["value_unwrapped"].to_numpy(), np.unwrap(phase, period=360.0))


def test_unwrap_small_cases(spark):
    df = frame(spark, [START + i for i in range(4)], [160.0, 170.0, -170.0, -160.0])
    got = features.unwrap_phase(df, KEYS, "value", 360.0)
    assert [r["value_unwrapped"] for r in rows(got, "seq")] == [160.0, 170.0, 190.0, 200.0]
    broken = frame(spark, [START + i for i in range(4)], [1.0, float("nan"), 2.0, 3.0])
    got = features.unwrap_phase(broken, KEYS, "value", 360.0)
    assert [r["value_unwrapped"] for r in rows(got, "seq")] == [1.0, None, None, None]


def test_rolling_hand_computed(spark):
    df = frame(spark, [START + i for i in range(5)], [1, 2, 4, 4, 10])
    got = rows(features.add_delta_and_rolling(df, KEYS, "value", 2), "seq")
    assert [r["value_rolling_mean"] for r in got] == [None, 1.5, 3.0, 4.0, 7.0]
    assert [r["value_delta"] for r in got] == [None, 1.0, 2.0, 0.0, 6.0]
    one = rows(features.add_delta_and_rolling(df, KEYS, "value", 1), "seq")
    assert {r["value_rolling_std"] for r in one} == {None}


def test_hole_is_seen_and_only_partly_filled(spark):
    steps = [i for i in range(40) if not 20 <= i < 25]
    df = frame(spark, [START + i * SAMPLE_INTERVAL_NS for i in steps], [1 + i / 1000 for i in steps])
    gaps = timeaxis.add_gap_features(df, KEYS)
    assert max(r["gap_ms"] for r in gaps.collect()) > 5 * SAMPLE_INTERVAL_NS / 1e6
    gridded = timeaxis.regularize(gaps, KEYS, ["value"], carried=["gap_ms"], fill_limit=2)
    assert gridded.count() == 40
    assert gridded.where("was_filled").count() == 5
    assert gridded.where("value is null").count() == 3


def test_repeated_times_keep_the_first_row(spark):
    df = frame(spark, [START, START, START + 10, START + 10], [1.0, 2.0, 3.0, 4.0])
    assert [r["value"] for r in rows(timeaxis.drop_duplicate_times(df, KEYS), "ts_ns")] == [1.0, 3.0]


def test_interval_and_its_guard(spark):
    df = frame(spark, [START + x for x in (0, 33, 67, 100, 133)], range(5))
    assert timeaxis.sample_interval(df, KEYS).first()["freq_ns"] == 33
    same = frame(spark, [START, START, START, START + 5], range(4))
    interval = timeaxis.sample_interval(same, KEYS)
    assert interval.first()["freq_ns"] == 0
    assert timeaxis.grid_bounds(same, KEYS, interval).count() == 0
    with pytest.raises(ValueError):
        timeaxis.grid_bounds(df, KEYS, 0)


@pytest.mark.parametrize("parts", [1, 13])
def test_positions_do_not_depend_on_layout(messy, parts):
    df, data = messy
    got = series.number_rows(df.repartition(parts), KEYS, chunk_rows=100).toPandas()
    got = got.sort_values(["site", "ts_ns", "seq"])
    want = np.concatenate([np.arange((data["site"] == s).sum()) for s in ("a", "b")])
    assert got["row"].tolist() == want.tolist()


@pytest.mark.parametrize("share", [0.0, 0.5, 0.99, 1.0])
def test_percentile_of_a_hot_key_is_exact(spark, share):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=3000), np.zeros(2000)])
    data = pd.DataFrame({"site": ["a"] * 5000 + ["b"] * 3, "value": np.concatenate([values, [1.0, 2.0, 4.0]])})
    got = series.percentile_per_key(
        spark.createDataFrame(data), KEYS, "value", share, "p", chunk_rows=1000).toPandas().set_index("site")["p"]
    assert got["a"] == pytest.approx(np.quantile(values, share), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile([1.0, 2.0, 4.0], share))


def test_parse_times_drops_what_does_not_parse(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("later", 2)], "text string, x int")
    assert [(r["x"], r["ts_ns"]) for r in timeaxis.parse_times(df, "text").collect()] == [(1, 1_704_067_200_000_000_000)]


def test_clean_rows_and_guard(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, 2.0), ("b", 3.0, 4.0)], "site string, x double, d double")
    clean = timeaxis.clean_rows(df, ["d"], ["x"])
    assert [(r["site"], r["d"]) for r in clean.orderBy("site").collect()] == [("a", 0.0), ("b", 4.0)]
    assert [r["usable"] for r in rows(timeaxis.enough_rows(df, KEYS), "site")] == [True, False]


def test_percentile_of_a_hot_key_with_an_outlier(spark):
    rng = np.random.default_rng(12)
    values = np.concatenate([8.33 + rng.normal(size=3000) * 1e-4, [86_400_000.0], np.full(50, 8.33)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), ("b", 1.0), ("c", 5.0)], "k string, v double")
    for share in (0.0, 0.5, 0.99, 1.0):
        got = {r["k"]: r["p"] for r in series.percentile_per_key(df, ["k"], "v", share, "p", chunk_rows=1).collect()}
        assert np.isclose(got["a"], np.quantile(values, share), rtol=1e-12) and got["b"] == 1.0 and got["c"] == 5.0


def test_series_without_an_interval_are_listed(spark):
    df = spark.createDataFrame([("one", 5, 0)] + [("same", 7, k) for k in range(5)] + [("fine", 10 * k, k) for k in range(5)], "k string, ts_ns long, seq long")
    freq = timeaxis.sample_interval(df, ["k"])
    assert {r["k"] for r in timeaxis.without_interval(df, ["k"], freq).collect()} == {"one", "same"}


def test_series_without_an_interval_are_an_error_unless_skipped(spark):
    df = spark.createDataFrame(
        [("one", 5, 0, 1.0)] + [("same", 7, k, 1.0) for k in range(5)] + [("fine", 10 * k, k, float(k)) for k in range(30)],
        "k string, ts_ns long, seq long, value double")
    freq = timeaxis.sample_interval(df, ["k"])
    with pytest.raises(ValueError, match="usable sampling interval"):
        feature_rows(df, ["k"], "value", None, window=2, freq_ns=freq)
    with pytest.raises(ValueError, match="usable sampling interval"):
        timeaxis.regularize(df, ["k"], ["value"], freq_ns=freq)
    kept = feature_rows(df, ["k"], "value", None, window=2, freq_ns=freq, unusable="skip")
    assert {r["k"] for r in kept.select("k").distinct().collect()} == {"fine"}


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 1.0])
def test_percentile_of_a_hot_key_over_the_whole_range_of_doubles(spark, share):
    values = [-1.7e308, 1.7e308, 0.0, 3.5, -2.0, 1e300, -1e-310, 1e-310]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    got = series.percentile_per_key(df, ["k"], "v", share, "p", chunk_rows=1).first()["p"]
    ranked, rank = sorted(values), (len(values) - 1) * share
    low, rest = int(rank), rank - int(rank)
    want = ranked[low] * (1 - rest) + ranked[min(low + 1, len(values) - 1)] * rest
    assert got == pytest.approx(want, rel=1e-9, abs=1e-309)
