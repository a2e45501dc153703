"""Forests of full depth: the sparse ways of growing and scoring against dense trees grown in one task."""

import numpy as np
import pandas as pd
import pytest

from tickwise.operators import deepforest, forest
from tickwise.operators.forest import Settings
from tickwise.sources import models

FEATURES = ["x", "y"]
TREE = ["model", "tree", "node"]


@pytest.fixture(scope="module")
def mixed(spark):
    """A stretched model, a middling one, one of equal rows, one of two rows and one of a single row."""
    rng = np.random.default_rng(7)
    parts = {"big": np.vstack([rng.normal(size=(900, 2)), np.exp(rng.normal(0, 4, size=(300, 2))), np.full((150, 2), 3.0)]),
             "mid": np.round(rng.normal(size=(120, 2)), 1), "flat": np.ones((260, 2)), "two": np.array([[0.0, 1.0], [1.0, 1.0]]), "one": np.zeros((1, 2))}
    data = pd.concat([pd.DataFrame(v, columns=FEATURES).assign(key=k) for k, v in parts.items()], ignore_index=True)
    return spark.createDataFrame(data.assign(id=range(len(data)))).repartition(5).persist()


def nodes_of(df):
    return df.toPandas().sort_values(TREE).reset_index(drop=True)[[*TREE, "feature", "threshold", "n", "path"]]


def lowered(monkeypatch, part, top, **more):
    for name, value in {"PART_ROWS": part, "TOP_LEVELS": top, **more}.items():
        monkeypatch.setattr(deepforest, name, value)


# Parts alone; parts below upper levels; levels split one at a time; all limits low.
WAYS = [(50_000, 10, {}), (200, 6, {}),
        (250, 2, {"EXPLODED_ROWS": 3_500, "UPPER_NODES": 20, "BUCKET_NODES": 300, "BUCKET_ROWS": 500, "ROWS_AT_ONCE": 64})]


@pytest.mark.parametrize("part,top,more", WAYS)
def test_all_ways_give_the_dense_trees_and_scores(mixed, monkeypatch, part, top, more):
    cfg = dict(n_estimators=3, contamination=0.05)
    dense = nodes_of(forest.fit_nodes(mixed, FEATURES, ["key"], Settings(max_depth=14, **cfg)))
    want = forest.detect(mixed, FEATURES, ["key"], Settings(max_depth=14, **cfg)).toPandas().set_index("id").sort_index()
    lowered(monkeypatch, part, top, **more)
    got = nodes_of(forest.fit_nodes(mixed, FEATURES, ["key"], Settings(max_depth=None, **cfg)))
    assert np.floor(np.log2(got["node"] + 1)).max() == 11
    pd.testing.assert_frame_equal(got, dense, check_dtype=False)
    found = forest.detect(mixed, FEATURES, ["key"], Settings(max_depth=None, **cfg)).toPandas().set_index("id").sort_index()
    assert found.columns.tolist() == want.columns.tolist() and len(found) == len(want)
    np.testing.assert_allclose(found["score"], want["score"], rtol=1e-8)
    assert (found["flagged"] == want["flagged"]).mean() > 0.998


@pytest.mark.parametrize("part,top", [(50_000, 10), (200, 6)])
def test_fit_save_and_score_other_rows(spark, mixed, monkeypatch, tmp_path, part, top):
    lowered(monkeypatch, part, top)
    cfg = Settings(n_estimators=5, contamination=0.05, max_depth=None)
    fitted = forest.fit(mixed, FEATURES, ["key"], cfg)
    models.save_forest(fitted, str(tmp_path / "deep"))
    back = models.load_forest(spark, str(tmp_path / "deep"))
    assert back.settings == cfg
    rng = np.random.default_rng(8)
    data = pd.DataFrame(rng.normal(size=(50, 2)), columns=FEATURES).assign(id=range(50), key=["big", "unknown"] * 25)
    fresh = spark.createDataFrame(data)
    dense = forest.fit_nodes(mixed, FEATURES, ["key"], Settings(n_estimators=5, max_depth=14))
    want = forest.add_scores(fresh, dense, FEATURES, 5, ["key"]).toPandas().sort_values("id")
    got = forest.score(fresh, back, ["key"]).toPandas().sort_values("id")
    assert got["id"].tolist() == want["id"].tolist() == list(range(0, 50, 2))
    np.testing.assert_allclose(got["score"], want["score"], rtol=1e-8)


@pytest.mark.parametrize("part,top", [(50_000, 10), (200, 6)])
def test_equal_rows_are_sampled_one_by_one(mixed, monkeypatch, part, top):
    lowered(monkeypatch, part, top)
    nodes = nodes_of(forest.fit_nodes(mixed, FEATURES, ["key"], Settings(n_estimators=20, max_samples=0.5, max_depth=None)))
    roots = nodes[(nodes["node"] == 0) & (nodes["model"] == "flat")]["n"]
    assert len(roots) == 20 and roots.between(90, 170).all() and roots.nunique() > 5
    below = nodes[nodes["node"] > 0]
    sums = below.groupby(["model", "tree", (below["node"] - 1) // 2])["n"].sum()
    inner = nodes[nodes["feature"] >= 0].set_index(TREE)["n"]
    assert sums.tolist() == inner.tolist()


def test_no_rows_and_constant_rows(spark, mixed):
    assert forest.detect(mixed.where("key = 'flat'"), FEATURES, ["key"], Settings(n_estimators=4, max_depth=None)).where("flagged").count() == 0
    assert forest.fit_nodes(mixed.where("false"), FEATURES, ["key"], Settings(n_estimators=4, max_depth=None)).count() == 0


def test_rows_of_trees_that_are_done_leave_the_disk(spark, mixed, monkeypatch):
    import glob

    from tickwise.session import checkpoint_folder

    lowered(monkeypatch, 250, 2, EXPLODED_ROWS=3_500)
    folder = checkpoint_folder(spark).removeprefix("file:")
    schemas = lambda: {p: spark.read.parquet(p).columns for p in glob.glob(f"{folder}/**/kept-*", recursive=True)}
    before = schemas()
    found = forest.detect(mixed, FEATURES, ["key"], Settings(n_estimators=3, max_depth=None))
    assert found.count() == mixed.count()
    # No table of rows by tree is left, only the rows once, nodes and sums.
    left = [columns for path, columns in schemas().items() if path not in before]
    assert left and not [c for c in left if "tree" in c and "_x0" in c] and not glob.glob(f"{folder}/passing-*")
