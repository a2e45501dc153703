import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwise.functions import isolation as iso
from tickwise.operators import forest
from tickwise.operators.forest import Settings
from tickwise.sources import models

FEATURES = ["x", "y"]


def table(spark, values, key="k", first=0):
    data = pd.DataFrame(values, columns=FEATURES)
    data["key"], data["id"] = key, range(first, first + len(data))
    return spark.createDataFrame(data).repartition(4)


@pytest.fixture(scope="module")
def outliers(spark):
    rng = np.random.default_rng(0)
    return table(spark, np.vstack([rng.normal(size=(200, 2)), rng.normal(20, 1, size=(5, 2))])).persist()


@pytest.fixture()
def over_cluster(monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_ROWS", 50)
    monkeypatch.setattr(forest, "LOCAL_ROWS_FEW", 50)


def test_outliers_are_flagged(outliers):
    found = forest.detect(outliers, FEATURES, ["key"], Settings(contamination=0.05)).toPandas().set_index("id")
    assert found["flagged"][range(200, 205)].all()
    assert 0 < found["flagged"].sum() <= 11


def test_fixed_cutoff_on_new_rows(spark):
    rng = np.random.default_rng(1)
    base = table(spark, rng.normal(size=(500, 2)))
    fitted = forest.fit(base, FEATURES, (), Settings(contamination=0.01))
    fresh = table(spark, np.vstack([rng.normal(size=(200, 2)), rng.normal(20, 1, size=(5, 2))]))
    got = forest.score(fresh, fitted).toPandas().set_index("id")
    assert got["flagged"][range(200, 205)].all()
    assert got["flagged"][range(200)].mean() < 0.05


def sorted_nodes(df):
    return df.toPandas().sort_values(["model", "tree", "node"]).reset_index(drop=True)


def test_both_ways_of_growing_give_the_same_trees(outliers, over_cluster, monkeypatch):
    cfg = Settings(n_estimators=10, max_depth=6)
    wide = sorted_nodes(forest.fit_nodes(outliers, FEATURES, ["key"], cfg))
    spread = sorted_nodes(forest.fit_nodes(outliers.repartition(11), FEATURES, ["key"], cfg))
    monkeypatch.setattr(forest, "LOCAL_ROWS_FEW", 1000)
    local = sorted_nodes(forest.fit_nodes(outliers, FEATURES, ["key"], cfg))
    pd.testing.assert_frame_equal(wide, spread)
    pd.testing.assert_frame_equal(wide, local)
    assert (wide[wide["node"] == 0]["n"] == 205).all()


def test_models_of_all_sizes_together(spark, over_cluster, monkeypatch):
    rng = np.random.default_rng(2)
    both = table(spark, rng.normal(size=(300, 2)), "big").unionByName(
        table(spark, rng.normal(size=(120, 2)), "mid", 1000)).unionByName(
        table(spark, rng.normal(size=(20, 2)), "small", 2000)).persist()
    cfg = Settings(n_estimators=8, max_depth=5, contamination=0.1)
    mixed = forest.detect(both, FEATURES, ["key"], cfg).toPandas().set_index("id").sort_index()
    # One big model at a time, through the stored node table.
    monkeypatch.setattr(forest, "GROW_NODES", 8 * 64)
    one_by_one = forest.detect(both, FEATURES, ["key"], cfg).toPandas().set_index("id").sort_index()
    monkeypatch.setattr(forest, "LOCAL_ROWS_FEW", 10_000)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 10_000)
    local = forest.detect(both, FEATURES, ["key"], cfg).toPandas().set_index("id").sort_index()
    for other in (one_by_one, local):
        np.testing.assert_allclose(mixed["score"], other["score"], rtol=1e-12)
        assert (mixed["flagged"] == other["flagged"]).all()


def test_scoring_without_broadcast(outliers, monkeypatch):
    fitted = forest.fit(outliers, FEATURES, ["key"], Settings(n_estimators=5))
    direct = forest.score(outliers, fitted, ["key"]).toPandas().set_index("id").sort_index()
    monkeypatch.setattr(forest, "NODE_BUDGET", 3)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 30)
    grouped = forest.score(outliers, fitted, ["key"]).toPandas().set_index("id").sort_index()
    pd.testing.assert_frame_equal(direct, grouped)


def test_rows_without_a_model_are_left_out(spark, outliers):
    fitted = forest.fit(outliers, FEATURES, ["key"], Settings(n_estimators=5))
    other = table(spark, np.zeros((3, 2)), "unknown")
    assert forest.score(outliers.unionByName(other), fitted, ["key"]).where("key = 'unknown'").count() == 0


def test_constant_rows_flag_nothing(spark):
    flat = table(spark, np.ones((100, 2)))
    assert forest.detect(flat, FEATURES, ["key"]).where("flagged").count() == 0


@pytest.mark.parametrize("local", [True, False])
def test_share_of_rows_per_tree(outliers, monkeypatch, local):
    if not local:
        monkeypatch.setattr(forest, "LOCAL_ROWS", 50)
        monkeypatch.setattr(forest, "LOCAL_ROWS_FEW", 50)
    nodes = sorted_nodes(forest.fit_nodes(outliers, FEATURES, ["key"], Settings(n_estimators=30, max_samples=0.5)))
    roots = nodes[nodes["node"] == 0]["n"]
    assert len(roots) == 30 and roots.nunique() > 1 and 80 < roots.mean() < 125


def test_a_saved_model_scores_the_same(spark, outliers, tmp_path):
    fitted = forest.fit(outliers, FEATURES, ["key"], Settings(n_estimators=12))
    models.save_forest(fitted, str(tmp_path / "run1"))
    back = models.load_forest(spark, str(tmp_path / "run1"))
    a = forest.score(outliers, fitted, ["key"]).toPandas().sort_values("id").reset_index(drop=True)
    b = forest.score(outliers, back, ["key"]).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    assert back.settings == fitted.settings
    with pytest.raises(Exception):
        models.save_forest(fitted, str(tmp_path / "run1"))


def test_scaling(spark):
    got = forest.standard_scale(table(spark, [[1.0, 5.0], [3.0, 5.0]]), FEATURES).toPandas().sort_values("id")
    assert got["x_scaled"].tolist() == [-1.0, 1.0] and got["y_scaled"].tolist() == [0.0, 0.0]


def test_scaling_does_not_change_a_forest(outliers):
    cfg = Settings(n_estimators=10)
    plain = forest.detect(outliers, FEATURES, (), cfg).toPandas().sort_values("id")["score"]
    scaled = forest.standard_scale(outliers, FEATURES).drop(*FEATURES)
    scaled = scaled.withColumnRenamed("x_scaled", "x").withColumnRenamed("y_scaled", "y")
    np.testing.assert_allclose(plain, forest.detect(scaled, FEATURES, (), cfg).toPandas().sort_values("id")["score"])
    assert scaled.agg(F.count("x")).first()[0] == 205


def test_model_names_do_not_collide(spark):
    keys = [("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), (None, "a"), ("a", None), ("\\N", "a")]
    df = spark.createDataFrame(keys, "x string, y string")
    names = [r[0] for r in df.select(forest.model_name(["x", "y"])).collect()]
    assert len(set(names)) == len(keys)
    assert spark.createDataFrame([("u", "v")], "x string, y string").select(forest.model_name(["x", "y"])).first()[0] == "u|v"


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_training_features_are_an_error(spark, bad):
    df = spark.createDataFrame([(1.0, float(k)) for k in range(50)] + [(2.0, bad)], "x double, y double")
    with pytest.raises(Exception, match="feature y is NULL or NaN"):
        forest.detect(df, ["x", "y"]).collect()


def test_small_models_share_batches_and_go_on_across_them():
    names = ["a"] * 3 + ["b"] + ["c"] * 7 + ["\\N"] * 2
    table = pa.table({"model": names, "x": list(range(len(names)))})
    for size in (1, 2, 3, 5, 20):
        found = []
        for rows, first in forest._whole_models(iter(table.to_batches(max_chunksize=size))):
            found += [rows.slice(a, b - a).column("x").to_pylist() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        assert found == [[0, 1, 2], [3], [4, 5, 6, 7, 8, 9, 10], [11, 12]]
    assert len(list(forest._whole_models(iter(table.to_batches())))) == 2
    few = pa.table({"model": ["a", "a", "b", "b"], "x": [1.0, 2.0, 3.0, 5.0]}).to_batches()
    rows, first = next(forest._whole_models(iter([*few, *few])))
    nodes = list(forest._parts_of(t for _, t in forest._grown_in(rows, first, ["x"], forest.Settings(n_estimators=2, max_depth=2))))
    assert len(nodes) == 1 and nodes[0].num_rows == 6 and set(nodes[0].column("model").to_pylist()) == {"a"}


def test_many_rows_walk_to_the_same_places(monkeypatch):
    rng = np.random.default_rng(5)
    rows = np.column_stack([rng.integers(0, 4, 3000), rng.normal(size=3000), rng.integers(0, 40, 3000) / 8]).astype(float)
    grown = iso.grow_here(rows, "all", 7, 9, 42)
    odd = rows.copy()
    odd[:6] = [[np.nan, 0, 1], [np.inf, -np.inf, 1], [-np.inf, np.inf, np.nan], [0, -0.0, 0], [3, grown.threshold[0, 0], 2], [1, 1e300, -1e300]]
    for trees in (100, 3):
        monkeypatch.setattr(iso, "WALK_TREES", trees)
        for depth in range(10):
            feature, threshold = grown.feature[:, :2**depth - 1], grown.threshold[:, :2**depth - 1]
            places = list(iso.Walker(feature, threshold, depth, 3).places(odd))
            assert (np.array(places) == iso.descend(np.ascontiguousarray(odd.T), feature, threshold, depth)).all()
    leaves = grown.path[:, grown.level(9)]
    walked = iso.Walker(grown.feature, grown.threshold, 9, 3).path_sums(odd, leaves)
    assert (walked == iso.path_sums(np.ascontiguousarray(odd.T), grown.feature, grown.threshold, leaves)).all()


def test_ranges_widen_as_by_sorting():
    rng = np.random.default_rng(6)
    rows, place = rng.normal(size=(2000, 2)).round(1), rng.integers(0, 8, 2000)
    low, high = np.full((2, 8), np.inf), np.full((2, 8), -np.inf)
    low[:, 3], high[:, 3] = -np.inf, np.inf
    for part in (slice(0, 300), slice(300, 301), slice(301, 2000)):
        iso.widen(rows[part], np.ascontiguousarray(rows[part].T), place[part], low, high)
    for k in range(8):
        mine = rows[place == k]
        assert k == 3 or (list(low[:, k]) == list(mine.min(axis=0)) and list(high[:, k]) == list(mine.max(axis=0)))
    assert (low[:, 3] == -np.inf).all() and (high[:, 3] == np.inf).all()


def test_cluster_growth_is_the_same_by_walker_and_step_by_step(spark, monkeypatch):
    rng = np.random.default_rng(7)
    data = [(f"m{k % 2}", float(v), float(k % 7)) for k, v in enumerate(rng.normal(size=4000))]
    df = spark.createDataFrame(data, "site string, a double, b double").repartition(3)
    monkeypatch.setattr(forest, "LOCAL_ROWS_FEW", 100)
    monkeypatch.setattr(iso, "SORTED_PLACES", 4)
    cfg = forest.Settings(n_estimators=5, max_depth=8)
    found = []
    for least in (10, 10**9):
        monkeypatch.setattr(iso, "WALK_ROWS", least)
        found.append(sorted(map(tuple, forest.detect(df, ["a", "b"], ["site"], cfg).collect())))
    assert len(found[0]) == len(data) and found[0] == found[1]
    plain = [iso.grow_here(np.array([r[1:] for r in data if r[0] == m]), m, 5, 8, 42) for m in ("m0", "m1")]
    nodes = forest.fit_nodes(df, ["a", "b"], ["site"], cfg).toPandas()
    assert len(nodes) == sum(int((t.active & (t.count > 0)).sum()) for t in plain)
    for t, name in zip(plain, ("m0", "m1")):
        mine = nodes[(nodes.model == name) & (nodes.feature >= 0)]
        assert (t.threshold[mine.tree, mine.node] == mine.threshold).all()
