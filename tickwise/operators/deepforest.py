"""Isolation forests of full depth, ceil(log2 n), whatever the number of rows.

Trees are sparse: one row per node, nodes numbered as in a complete tree (children of i are 2i+1 and 2i+2), which fits 64 bits at any
size. Draws are the digests of ``forest``, so down to a depth both grow the same trees.

Growing has three parts. The first levels of a big model come from passes over its rows (``forest``). Where a node of them still
holds more than ``PART_ROWS`` rows, these rows are written with their node and split one level at a time: a ``groupBy`` merges ranges, tasks
draw the splits of merged ranges, a join sends rows on. Every other open node is a part: its rows meet in one task, which grows all
that is below, many parts side by side; a model of at most ``PART_ROWS`` rows is a part itself. Rows are sent per tree, in blocks of trees.

Scoring walks rows down the upper nodes, which go out in blocks of trees of bounded size, and then by bucket of parts: rows and
nodes of a bucket meet in a cogroup, hot buckets with their rows split and nodes copied. Path lengths are added as whole
multiples of 2^-32, so the sum is the same in any order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions import isolation as iso
from tickwise.operators import forest
from tickwise.operators.forest import MODEL, ROW_ID, Settings
from tickwise.session import is_small, keep, passing, settle

PART_ROWS = 50_000
TOP_LEVELS = 10
ROWS_AT_ONCE = 200_000
EXPLODED_ROWS = 50_000_000
UPPER_NODES = 2_000_000
BUCKET_NODES = 500_000
BUCKET_ROWS = 2_000_000
FIXED = float(1 << 32)
KEY = [MODEL, "tree", "root"]
NODES_SCHEMA = f"{MODEL} string, tree int, node long, feature int, threshold double, n long, path double, root long"
_NODES = pa.schema([(MODEL, pa.string()), ("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("threshold", pa.float64()),
                    ("n", pa.int64()), ("path", pa.float64()), ("root", pa.int64())])


def _level(node: np.ndarray) -> np.ndarray:
    return np.frexp((node + 1).astype(np.float64))[1].astype(np.int64) - 1


def _limit(n):
    """ceil(log2 n) without rounding: the bits of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def grow_sparse(values: np.ndarray, begin: np.ndarray, model: np.ndarray, tree: np.ndarray, root: np.ndarray, limit: np.ndarray, seed: int
                ) -> Iterator[pa.RecordBatch]:
    """All nodes below and at the given roots, whose rows begin at ``begin``; one level of all of them at a time."""
    order, node, level, top = np.arange(len(values)), root, _level(root), root
    while len(begin):
        count = np.diff(np.append(begin, len(order)))
        held = values[order]
        low, high = np.minimum.reduceat(held, begin), np.maximum.reduceat(held, begin)
        split = (count > 1) & (level < limit) & (high > low).any(axis=1)
        feature, threshold = np.full(len(begin), -1), np.full(len(begin), np.nan)
        for name in np.unique(model[split]):
            mine = np.flatnonzero(split & (model == name))
            feature[mine], threshold[mine] = iso.choose_splits(iso.split_draws(seed, name, tree[mine], node[mine]), low[mine], high[mine])
        path = np.where(split, np.nan, level + iso.expected_path(count))
        yield pa.RecordBatch.from_arrays([
            pa.array(c, t.type, from_pandas=t.name in ("threshold", "path")) for c, t in
            zip((model, tree, node, feature, threshold, count, path, top), _NODES, strict=True)], schema=_NODES)
        part = np.repeat(np.arange(len(begin)), count)
        live = split[part]
        order, part = order[live], part[live]
        if not len(order):
            return
        side = part * 2 + (values[order, feature[part]] > threshold[part])
        by = np.argsort(side, kind="stable")
        order, side = order[by], side[by]
        begin = np.concatenate([[0], np.flatnonzero(side[1:] != side[:-1]) + 1])
        up = side[begin] >> 1
        model, tree, limit, top, level = model[up], tree[up], limit[up], top[up], level[up] + 1
        node = 2 * node[up] + 1 + (side[begin] & 1)


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Sorted rows, about ``ROWS_AT_ONCE`` at a time, no part cut in two."""
    held: list[pd.DataFrame] = []
    for some in batches:
        held.append(some.to_pandas())
        if sum(map(len, held)) < ROWS_AT_ONCE:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = rows[KEY].iloc[-1]
        at = int((rows[KEY] == last).all(axis=1).to_numpy().argmax())
        if at:
            yield rows.iloc[:at]
        held = [rows.iloc[at:]]
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def _finish(parts: DataFrame, width: int, cfg: Settings) -> DataFrame:
    """Node rows of all parts. A part with tree -1 stands for all trees of a small model."""
    xs = [f"_x{i}" for i in range(width)]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_parts(batches):
            values = rows[xs].to_numpy(np.float64)
            model, tree, root, limit = (rows[c].to_numpy() for c in (MODEL, "tree", "root", "limit"))
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (tree[1:] != tree[:-1]) | (root[1:] != root[:-1]) | (model[1:] != model[:-1])
            begin = np.flatnonzero(new)
            if tree[0] >= 0:
                yield from grow_sparse(values, begin, model[begin], tree[begin].astype(np.int64), root[begin], limit[begin], cfg.seed)
                continue
            step = max(1, 2 * ROWS_AT_ONCE // len(rows))
            for first in range(0, cfg.n_estimators, step):
                many = min(first + step, cfg.n_estimators) - first
                seen = np.ones((many, len(rows)), dtype=bool)
                if cfg.max_samples < 1.0:
                    seen = iso.in_sample(cfg.seed, first, many, rows[ROW_ID].to_numpy(), cfg.max_samples)
                part = (np.cumsum(new) - 1)[None, :] + (np.arange(many) * len(begin))[:, None]
                part, row = part[seen], np.broadcast_to(np.arange(len(rows)), seen.shape)[seen]
                starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1]) if len(part) else np.zeros(0, np.int64)
                of = begin[part[starts] % len(begin)]
                yield from grow_sparse(values[row], starts, model[of], first + part[starts] // len(begin), root[of], limit[of], cfg.seed)

    return parts.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(grow, NODES_SCHEMA)


class Upper:
    """Upper nodes of a block of trees as arrays with pointers to children; a pointer below -1 leaves to the part of that root."""

    def __init__(self, nodes: pd.DataFrame):
        self.trees = {}
        for (model, tree), part in nodes.groupby([MODEL, "tree"]):
            part = part.sort_values("node")
            node = part["node"].to_numpy()
            children = []
            for side in (1, 2):
                child = 2 * node + side
                at = np.minimum(np.searchsorted(node, child), len(node) - 1)
                children.append(np.where(node[at] == child, at, -2 - child))
            self.trees[model, tree] = (part["feature"].to_numpy(), part["threshold"].to_numpy(), part["path"].to_numpy(), *children)

    def walk(self, model: str, tree: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Path of each row that ends here (else NaN), and the root of the part that it goes on in (else -1)."""
        n = columns.shape[1]
        if (model, tree) not in self.trees:
            return np.full(n, np.nan), np.zeros(n, np.int64)
        feature, threshold, path, left, right = self.trees[model, tree]
        at, rows = np.zeros(n, np.int64), np.arange(n)
        while len(rows):
            here = at[rows]
            inner = feature[here] >= 0
            rows, here = rows[inner], here[inner]
            to = np.where(columns[feature[here], rows] > threshold[here], right[here], left[here])
            at[rows] = to
            rows = rows[to >= 0]
        out = at < -1
        return np.where(out, np.nan, path[np.maximum(at, 0)]), np.where(out, -2 - at, -1)


def _walk(rows: DataFrame, width: int, nodes: pd.DataFrame, trees: range, models: Sequence[str] | None, cfg: Settings | None) -> DataFrame:
    """For each row and tree: ``fixed``, the path in multiples of 2^-32 of rows that end in upper nodes, or ``root``, the part they go on in.

    With ``cfg`` rows outside a tree's sample are left out.
    """
    xs = [f"_x{i}" for i in range(width)]
    shared = rows.sparkSession.sparkContext.broadcast(Upper(nodes))
    names = set(models) if models is not None else None

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = shared.value
        for some in batches:
            ids, values, model = some.column(ROW_ID).to_numpy(), forest._matrix(some, xs), np.array(some.column(MODEL).to_pylist(), dtype=object)
            for name in sorted(set(model) if names is None else set(model) & names):
                mine = model == name
                columns, own = np.ascontiguousarray(values[mine].T), ids[mine]
                for tree in trees:
                    path, root = upper.walk(name, tree, columns)
                    take = np.ones(len(own), dtype=bool)
                    if cfg is not None:
                        take = root >= 0
                        if cfg.max_samples < 1.0:
                            take &= iso.in_sample(cfg.seed, tree, 1, own, cfg.max_samples)[0]
                    k = int(take.sum())
                    fixed = pa.array(np.where(np.isnan(path), 0, np.rint(path * FIXED))[take].astype(np.int64), mask=np.isnan(path)[take])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * k, pa.string()), pa.array(np.full(k, tree, np.int32)), pa.array(root[take]), pa.array(own[take]), fixed,
                         *[pa.array(c[take]) for c in columns]], names=[*KEY, ROW_ID, "fixed", *xs])

    doubles = "".join(f", {x} double" for x in xs)
    return rows.select(MODEL, ROW_ID, *xs).mapInArrow(walk, f"{MODEL} string, tree int, root long, {ROW_ID} long, fixed long{doubles}")


def _split_heavy(heavy: DataFrame, width: int, cfg: Settings, folder: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Node rows, and rows by part, of nodes that hold more than ``PART_ROWS`` rows: a level at a time until no part does.

    The rows lie in ``folder``, and the parts are read from there."""
    xs = [f"_x{i}" for i in range(width)]
    titles = [f"{side}{i}" for i in range(width) for side in ("lo", "hi")]
    nodes, parts = [], []

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            t = some.to_pandas()
            low, high = (t[[f"{side}{i}" for i in range(width)]].to_numpy() for side in ("lo", "hi"))
            level = _level(t["root"].to_numpy())
            split = (t["n"].to_numpy() > 1) & (level < t["limit"].to_numpy()) & (high > low).any(axis=1)
            feature, threshold = np.full(len(t), -1), np.full(len(t), np.nan)
            for name in t.loc[split, MODEL].unique():
                mine = np.flatnonzero(split & (t[MODEL] == name).to_numpy())
                u = iso.split_draws(cfg.seed, name, t["tree"].to_numpy()[mine], t["root"].to_numpy()[mine])
                feature[mine], threshold[mine] = iso.choose_splits(u, low[mine], high[mine])
            path = np.where(split, np.nan, level + iso.expected_path(t["n"].to_numpy()))
            yield pa.RecordBatch.from_arrays([
                pa.array(c, f.type, from_pandas=f.name in ("threshold", "path")) for c, f in
                zip((t[MODEL], t["tree"], t["root"], feature, threshold, t["n"], path, np.full(len(t), -1)), _NODES, strict=True)], schema=_NODES)

    while not heavy.isEmpty():
        ranges = [f(x).alias(f"{side}{i}") for i, x in enumerate(xs) for side, f in (("lo", F.min), ("hi", F.max))]
        merged = heavy.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("limit").alias("limit"), *ranges)
        found = settle(merged.select(*KEY, "n", "limit", *titles).mapInArrow(draw, NODES_SCHEMA))
        nodes.append(found)
        cut = found.where("feature >= 0").select(MODEL, "tree", F.col("node").alias("root"), "feature", "threshold")
        cut = F.broadcast(cut) if is_small(found) else cut
        right = F.element_at(F.array(*xs), F.col("feature") + 1) > F.col("threshold")
        below = keep(heavy.join(cut, KEY).withColumn("root", 2 * F.col("root") + 1 + right.cast("long")).drop("feature", "threshold"), folder)
        sizes = settle(below.groupBy(*KEY).agg(F.count("*").alias("_n")))
        big = sizes.where(F.col("_n") > PART_ROWS).drop("_n")
        big = F.broadcast(big) if is_small(sizes) else big
        parts.append(below.join(big, KEY, "left_anti"))
        heavy = keep(below.join(big, KEY, "left_semi"), folder)
    return nodes, parts


def _rows(df: DataFrame, features: Sequence[str], keys: Sequence[str], training: bool) -> DataFrame:
    """The rows, stored, with their model, a number and the features as ``_x0``, ``_x1``, ..."""
    value = forest._known if training else (lambda f: F.col(f).cast("double"))
    named = df.withColumns({MODEL: forest.model_name(keys), **{f"_x{i}": value(f) for i, f in enumerate(features)}})
    return keep(named.withColumn(ROW_ID, F.monotonically_increasing_id()))


def _grow(rows: DataFrame, width: int, cfg: Settings) -> DataFrame:
    spark = rows.sparkSession
    xs = [f"_x{i}" for i in range(width)]
    lean = rows.select(MODEL, ROW_ID, *xs)
    sizes = settle(lean.groupBy(MODEL).agg(F.count("*").alias("_n")).withColumn("limit", _limit(F.col("_n"))))
    # At most rows / PART_ROWS models are listed here.
    big = sorted((r[MODEL], r["_n"]) for r in sizes.where(F.col("_n") > PART_ROWS).collect())
    few = sizes.where(F.col("_n") <= PART_ROWS).drop("_n")
    small = lean.join(F.broadcast(few) if is_small(few) else few, MODEL)
    small = small.select(MODEL, F.lit(-1).alias("tree"), F.lit(0).cast("long").alias("root"), ROW_ID, *xs, "limit")
    made = [] if few.isEmpty() else [keep(_finish(small, width, cfg))]
    top_cfg, sampled = replace(cfg, max_depth=TOP_LEVELS), cfg.max_samples < 1.0
    for batch in forest._batches(big, top_cfg):
        names = [name for name, _ in batch]
        mine = lean.where(F.col(MODEL).isin(names))
        with passing(spark) as folder:
            blocks = keep(forest._pack(forest._spread(mine, sum(n for _, n in batch)), xs, sampled), folder)
            tops = forest._grow_over_cluster(blocks, width, batch, top_cfg)
        nodes = pd.concat([forest._node_table_of(t).to_pandas() for t in tops]).assign(root=-1)
        depth, full = ({t.model: f(t, n) for t, (_, n) in zip(tops, batch, strict=True)} for f in (lambda t, n: t.depth, lambda t, n: iso.depth_cap(n, 64)))
        goes_on = ((nodes["n"] > 1) & (nodes["feature"] < 0) & (_level(nodes["node"].to_numpy()) == nodes[MODEL].map(depth))
                   & (nodes[MODEL].map(depth) < nodes[MODEL].map(full)))
        upper = nodes[~goes_on]
        made.append(settle(spark.createDataFrame(pa.Table.from_pandas(upper, _NODES, preserve_index=False))))
        large = spark.createDataFrame(nodes.loc[goes_on & (nodes["n"] > PART_ROWS), [MODEL, "tree", "node"]].rename(columns={"node": "root"}),
                                      f"{MODEL} string, tree int, root long")
        step = max(1, EXPLODED_ROWS // sum(n for _, n in batch))
        for first in range(0, cfg.n_estimators, step):
            trees = range(first, min(first + step, cfg.n_estimators))
            # The rows of these trees go when the nodes below are made.
            with passing(spark) as folder:
                exits = _walk(mine, width, upper[upper["tree"].isin(trees)], trees, names, cfg).drop("fixed")
                exits = keep(exits.join(F.broadcast(sizes.where(F.col(MODEL).isin(names)).drop("_n")), MODEL), folder)
                some = large.where(F.col("tree").isin(list(trees)))
                more, parts = _split_heavy(keep(exits.join(F.broadcast(some), KEY, "left_semi"), folder), width, cfg, folder)
                made += more
                for part in [exits.join(F.broadcast(some), KEY, "left_anti"), *parts]:
                    made.append(keep(_finish(part.select(*KEY, ROW_ID, *xs, "limit"), width, cfg)))
    out = spark.createDataFrame([], NODES_SCHEMA)
    for table in made:
        out = out.unionByName(table)
    return out


def fit_nodes(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), settings: Settings = Settings(max_depth=None)) -> DataFrame:
    """The node table of one forest of full depth per distinct ``keys``. ``root``: the part that a node belongs to, -1 for upper nodes."""
    return _grow(_rows(df, features, keys, True), len(features), settings)


def _paths(rows: DataFrame, nodes: DataFrame, width: int, n_trees: int, folder: str) -> DataFrame:
    """``fixed``: the sum of each row's path lengths, read from ``folder``."""
    spark, per_block = rows.sparkSession, max(1, EXPLODED_ROWS // max(1, rows.count()))
    xs = [f"_x{i}" for i in range(width)]
    upper = nodes.where("root = -1")
    per_tree = {r["tree"]: r["count"] for r in upper.groupBy("tree").count().collect()}
    below = nodes.where("root >= 0")
    buckets = max(1, -(-below.count() // BUCKET_NODES))
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")
    models = nodes.select(MODEL).distinct()
    known = rows.join(F.broadcast(models) if is_small(models) else models, MODEL, "left_semi")
    blocks, size = [[]], 0
    for tree in range(n_trees):
        if blocks[-1] and (size + per_tree.get(tree, 0) > UPPER_NODES or len(blocks[-1]) == per_block):
            blocks.append([])
            size = 0
        blocks[-1].append(tree)
        size += per_tree.get(tree, 0)
    sums = None
    for trees in blocks:
        held = upper.where(F.col("tree").between(trees[0], trees[-1])).toPandas()
        with passing(spark) as mine:
            walked = keep(_walk(known, width, held, range(trees[0], trees[-1] + 1), None, None).withColumn("bucket", bucket), mine)
            done = walked.where("fixed is not null").select(ROW_ID, "fixed")
            going = walked.where("fixed is null").drop("fixed")
            copies = settle(going.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET_ROWS).cast("int").alias("_parts")))
            left = going.join(F.broadcast(copies), "bucket").withColumn("_part", F.pmod(F.xxhash64(ROW_ID), F.col("_parts")).cast("int")).drop("_parts")
            right = below.where(F.col("tree").between(trees[0], trees[-1])).withColumn("bucket", bucket).join(F.broadcast(copies), "bucket")
            right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(*KEY, "node", "feature", "threshold", "path", "bucket", "_part")
            walk = left.groupBy("bucket", "_part").cogroup(right.groupBy("bucket", "_part"))
            both = done.unionByName(walk.applyInPandas(lambda a, b: _walk_parts(a, b, xs), f"{ROW_ID} long, fixed long"))
            both = keep(both.groupBy(ROW_ID).agg(F.sum("fixed").alias("fixed")), folder)
        sums = both if sums is None else sums.unionByName(both)
    return sums.groupBy(ROW_ID).agg(F.sum("fixed").alias("fixed"))


def _walk_parts(rows: pd.DataFrame, nodes: pd.DataFrame, xs: list[str]) -> pd.DataFrame:
    """Rows down the parts of one bucket, all trees at once, along child pointers."""
    if not len(rows) or not len(nodes):
        return pd.DataFrame({ROW_ID: np.zeros(0, np.int64), "fixed": np.zeros(0, np.int64)})
    trees, _ = pd.factorize(pd.MultiIndex.from_frame(pd.concat([nodes[[MODEL, "tree"]], rows[[MODEL, "tree"]]])))
    known = np.unique(nodes["node"].to_numpy())
    place = lambda tree, node: tree * len(known) + np.minimum(np.searchsorted(known, node), len(known) - 1)
    node = nodes["node"].to_numpy()
    code = place(trees[:len(nodes)], node)
    order = np.argsort(code)
    code, node, tree = code[order], node[order], trees[:len(nodes)][order]
    feature, threshold, path = (nodes[c].to_numpy()[order] for c in ("feature", "threshold", "path"))
    left, right = (np.minimum(np.searchsorted(code, place(tree, 2 * node + side)), len(code) - 1) for side in (1, 2))
    at = np.searchsorted(code, place(trees[len(nodes):], rows["root"].to_numpy()))
    values, going = rows[xs].to_numpy(np.float64), np.arange(len(rows))
    while len(going):
        going = going[feature[at[going]] >= 0]
        here = at[going]
        at[going] = np.where(values[going, feature[here]] > threshold[here], right[here], left[here])
    fixed = pd.Series(np.rint(path[at] * FIXED).astype(np.int64)).groupby(rows[ROW_ID].to_numpy()).sum()
    return pd.DataFrame({ROW_ID: fixed.index.to_numpy(), "fixed": fixed.to_numpy()})


def _expected(n):
    long = 2.0 * (F.log(n - 1.0) + iso.EULER_GAMMA) - 2.0 * (n - 1.0) / n
    return F.when(n > 2, long).when(n == 2, 1.0).otherwise(0.0)


def _scored(rows: DataFrame, nodes: DataFrame, width: int, n_trees: int) -> DataFrame:
    trained = settle(nodes.where("node = 0").groupBy(MODEL).agg(F.max("n").cast("double").alias("_trained")))
    with passing(rows.sparkSession) as folder:
        sums = keep(_paths(rows, nodes, width, n_trees, folder))
    norm = _expected(F.col("_trained"))
    score = F.when(norm > 0, F.pow(F.lit(2.0), -(F.col("fixed") / FIXED) / n_trees / norm)).otherwise(0.5)
    out = rows.join(sums, ROW_ID).join(F.broadcast(trained) if is_small(trained) else trained, MODEL)
    return out.withColumn("score", score).drop(MODEL, ROW_ID, "fixed", "_trained", *[f"_x{i}" for i in range(width)])


def add_scores(df: DataFrame, nodes: DataFrame, features: Sequence[str], n_trees: int, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``score`` in (0, 1]; rows of a key without a model are left out."""
    if df.isStreaming:
        raise ValueError("a stream cannot be scored against a forest of full depth: fit with max_depth")
    return _scored(_rows(df, features, keys, False), nodes, len(features), n_trees)


def detect(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), settings: Settings = Settings(max_depth=None)) -> DataFrame:
    """Fit and flag the same rows, one model of full depth per distinct ``keys``."""
    rows = _rows(df, features, keys, True)
    nodes = keep(_grow(rows, len(features), settings))
    scored = settle(_scored(rows, nodes, len(features), settings.n_estimators))
    return forest.flag(scored, settle(forest.cutoffs(scored, keys, settings.contamination)), keys)
