"""Isolation forests grown over all rows, level by level, by partial aggregation.

Per level one pass over the rows: each task walks its rows down the trees so far and reduces them to a count and a
range per feature and node; Spark merges those partials with a groupBy; the few merged numbers draw the next splits.
Rows are never sampled away (unless ``max_samples`` asks for it) and never gathered.  Draws are digests of (seed, model,
tree, node), so a forest is a function of the data and the seed alone.

Two sizes of work are told apart by counting first:

* small models are grown whole inside one task per model, all models side by side: up to ``LOCAL_ROWS`` rows if there
  are enough such models to keep every core busy, otherwise up to ``LOCAL_ROWS_FEW``;
* larger models are grown over the cluster, as many at a time as keep the growing trees under ``GROW_NODES`` nodes.

Depth is capped, the rest of a cut-off subtree being estimated by the usual leaf correction: uncapped trees over n rows
have up to n leaves each and could not be sent to the tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions import isolation as iso
from tickwise.operators.series import CHUNK_ROWS, attach, percentile_per_key, split_hot
from tickwise.session import checkpoint_folder, is_small, keep, settle

LOCAL_ROWS = 1_000_000
LOCAL_ROWS_FEW = 20_000
SPREAD_BELOW = 1_000_000
PACK_ROWS = 16_000
ROWS_PER_TASK = 500_000
GROW_NODES = 20_000_000
NODE_BUDGET = 2_000_000
STREAM_NODES = 10_000_000
MODEL = "model"
ROW_ID = "_row_id"
NODES_SCHEMA = f"{MODEL} string, tree int, node int, feature int, threshold double, n long, path double"
NODES_ARROW = pa.schema([
    (MODEL, pa.string()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()),
    ("threshold", pa.float64()), ("n", pa.int64()), ("path", pa.float64())])


@dataclass(frozen=True)
class Settings:
    n_estimators: int = 100
    contamination: float = 0.01
    seed: int = 42
    max_samples: float = 1.0
    # None: ceil(log2 n), grown and scored by ``deepforest``.
    max_depth: int | None = 10


@dataclass(frozen=True)
class Forest:
    """Fitted models as two tables: ``nodes`` and one ``meta`` row per model."""

    nodes: DataFrame
    meta: DataFrame
    features: tuple[str, ...]
    settings: Settings


def standard_scale(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Add ``<feature>_scaled``: (x - mean) / population std, a zero std counting as 1."""
    wide = df.withColumn(MODEL, model_name(keys))
    moments = wide.groupBy(MODEL).agg(
        *[F.avg(f).alias(f"_m_{f}") for f in features], *[F.stddev_pop(f).alias(f"_s_{f}") for f in features])
    wide = attach(wide, settle(moments), [MODEL])
    for f in features:
        spread = F.when(F.col(f"_s_{f}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{f}"))
        wide = wide.withColumn(f"{f}_scaled", (F.col(f) - F.col(f"_m_{f}")) / spread)
    return wide.drop(MODEL, *[f"_m_{f}" for f in features], *[f"_s_{f}" for f in features])


def model_name(keys: Sequence[str]):
    """One string per distinct keys: parts joined by ``|``, which is escaped inside them; NULL is ``\\N``."""
    if not keys:
        return F.lit("all")
    parts = [F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for k in keys]
    return F.concat_ws("|", *[F.coalesce(part, F.lit("\\N")) for part in parts])


def _known(feature: str):
    """The feature as a double; a missing one would silently switch the feature off in every node that holds its row."""
    value = F.col(feature).cast("double")
    missing = F.raise_error(F.lit(f"feature {feature} is NULL or NaN in a training row")).cast("double")
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(value)


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([
        np.asarray(batch.column(f).to_numpy(zero_copy_only=False), dtype=np.float64) for f in features])


def _per_model(batch: pa.RecordBatch, names: dict[str, int]) -> Iterator[tuple[int, np.ndarray | None]]:
    """(model index, its row numbers in the batch, or None for all of them)."""
    coded = batch.column(MODEL).dictionary_encode()
    present = [names.get(v, -1) for v in coded.dictionary.to_pylist()]
    if len(present) == 1:
        if present[0] >= 0:
            yield present[0], None
        return
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for code, index in enumerate(present):
        if index >= 0:
            yield index, np.flatnonzero(codes == code)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _pack(lean: DataFrame, features: list[str], sampled: bool) -> DataFrame:
    """Rows as blocks of one model's values each, with their count and ranges.

    Every level reads all rows once more; a block crosses to Python as one copy of bytes, not value by value.
    """
    width = len(features)
    ranges = [f"{side}{i}" for i in range(width) for side in ("lo", "hi")]
    schema = f"{MODEL} string, n long, values binary, ids binary" + "".join(f", {r} double" for r in ranges)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, PACK_ROWS):
            everything = _matrix(batch, features)
            ids = batch.column(ROW_ID).to_numpy() if sampled else None
            coded = batch.column(MODEL).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for code, model in enumerate(coded.dictionary.to_pylist()):
                mine = codes == code
                rows = everything[mine]
                low, high = rows.min(axis=0), rows.max(axis=0)
                columns = [[model], [len(rows)], [rows.tobytes()], [ids[mine].tobytes() if sampled else None]]
                for i in range(width):
                    columns += [[low[i]], [high[i]]]
                types = [pa.string(), pa.int64(), pa.binary(), pa.binary()] + [pa.float64()] * len(ranges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=[MODEL, "n", "values", "ids", *ranges])

    return lean.mapInArrow(pack, schema)


def _grow_over_cluster(blocks: DataFrame, width: int, sizes: list[tuple[str, int]], cfg: Settings) -> list[iso.Trees]:
    """Grow the forests of a few big models together, one aggregation per level."""
    context = blocks.sparkSession.sparkContext
    n_trees = cfg.n_estimators
    grown = [iso.Trees(name, n_trees, iso.depth_cap(n, cfg.max_depth), cfg.seed) for name, n in sizes]
    names = {name: i for i, (name, _) in enumerate(sizes)}
    sampled = cfg.max_samples < 1.0
    walk_rows, sorted_places = iso.WALK_ROWS, iso.SORTED_PLACES

    def whole_table() -> list:
        """Level 0 needs no walking: every tree has the same root, whose range the blocks already know."""
        ranges = []
        for i in range(width):
            ranges += [F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}")]
        found = blocks.groupBy(MODEL).agg(F.sum("n").alias("n"), *ranges).collect()
        return sorted((names[r[MODEL]], r) for r in found if r[MODEL] in names)

    for level in range(max(t.depth for t in grown) + 1):
        if level == 0 and not sampled:
            for index, r in whole_table():
                low = np.array([[r[f"lo{i}"] for i in range(width)]] * n_trees)
                high = np.array([[r[f"hi{i}"] for i in range(width)]] * n_trees)
                grown[index].grow(0, np.arange(n_trees), np.full(n_trees, r["n"]), low, high)
            continue
        growing = [i for i, t in enumerate(grown) if t.depth >= level and t.active[:, t.level(level)].any()]
        if not growing:
            break
        places = 2**level
        upper = slice(0, places - 1)
        shared = context.broadcast({
            i: (grown[i].feature[:, upper].copy(), grown[i].threshold[:, upper].copy(),
                grown[i].active[:, grown[i].level(level)].copy()) for i in growing})
        lookup = {name: i for name, i in names.items() if i in growing}
        # Nodes of the last level are leaves whatever their ranges are, so they only need counting.
        counting = {i for i in growing if grown[i].depth == level}
        ranged = width if len(counting) < len(growing) else 0
        titles = ["slot", "n"] + [f"{side}{i}" for i in range(ranged) for side in ("lo", "hi")]
        schema = "slot long, n long" + "".join(f", {t} double" for t in titles[2:])
        merged = [F.sum("n").alias("n")] + [
            (F.min(t) if t.startswith("lo") else F.max(t)).alias(t) for t in titles[2:]]

        def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slots = n_trees * places
            seen: dict[int, tuple] = {}  # a task holds sums only for the models it meets
            walker, walking = None, None  # and tables for walking only for the one it met last
            for batch in batches:
                for model, values, ids in zip(*[batch.column(c) for c in (MODEL, "values", "ids")]):
                    index = lookup.get(model.as_py())
                    if index is None:
                        continue
                    feature, threshold, active = shared.value[index]
                    if index not in seen:
                        # Ranges per feature, tree and place.
                        low, high = (np.full((ranged, n_trees, places), side) for side in (np.inf, -np.inf))
                        # No row may widen the range of a place that is not looked at.
                        low[:, ~active], high[:, ~active] = -np.inf, np.inf
                        seen[index] = np.zeros(slots, dtype=np.int64), low, high
                    count, low, high = seen[index]
                    rows = np.frombuffer(values.as_buffer(), dtype=np.float64).reshape(-1, width)
                    columns = np.ascontiguousarray(rows.T)
                    row_ids = np.frombuffer(ids.as_buffer(), dtype=np.int64) if sampled else None
                    if len(rows) >= walk_rows:
                        if walking != index:
                            walker, walking = iso.Walker(feature, threshold, level, width), index
                        walked = ((t, place[None, :]) for t, place in enumerate(walker.places(rows)))
                    else:
                        block = max(1, 20_000 // len(rows))
                        walked = ((t, iso.descend(columns, feature[t:t + block], threshold[t:t + block], level))
                                  for t in range(0, n_trees, block))
                    for first, place in walked:
                        live = active[first:first + len(place)]
                        if sampled:
                            live = np.take_along_axis(live, place.astype(np.int64, copy=False), axis=1) & iso.in_sample(
                                cfg.seed, first, len(place), row_ids, cfg.max_samples)
                        # Sorting all rows by place is cheaper only where the places are few.
                        widen = len(place) == 1 and places > sorted_places and not sampled
                        if index in counting or widen:
                            at, n = iso.node_counts(place, places, live)
                            count[at + first * places] += n
                            if index not in counting:
                                iso.widen(rows, columns, place[0].astype(np.int64, copy=False), low[:, first], high[:, first])
                            continue
                        at, n, lo, hi = iso.node_ranges(rows, place, places, live)
                        tree, at = at // places + first, at % places
                        count[tree * places + at] += n
                        low[:, tree, at] = np.minimum(low[:, tree, at], lo.T)
                        high[:, tree, at] = np.maximum(high[:, tree, at], hi.T)
            for index, (count, low, high) in seen.items():
                used = np.flatnonzero(count)
                arrays = [pa.array(used + index * slots), pa.array(count[used])]
                for i in range(ranged):
                    arrays += [pa.array(low[i].ravel()[used]), pa.array(high[i].ravel()[used])]
                for start in range(0, len(used), 50_000):
                    yield pa.RecordBatch.from_arrays([a.slice(start, 50_000) for a in arrays], names=titles)

        table = blocks.select(MODEL, "values", "ids").mapInArrow(partials, schema).groupBy("slot").agg(*merged).toArrow()
        slot = table.column("slot").to_numpy()
        count = table.column("n").to_numpy()
        low, high = (
            np.column_stack([table.column(f"{side}{i}").to_numpy() for i in range(ranged)]) if ranged else
            np.empty((len(slot), 0)) for side in ("lo", "hi"))
        owner = slot // (n_trees * places)
        for index in growing:
            mine = owner == index
            grown[index].grow(level, slot[mine] % (n_trees * places), count[mine], low[mine], high[mine])
        shared.destroy()
    return grown


def _node_table_of(trees: iso.Trees) -> pa.Table:
    """The nodes rows can reach, for storing. ``feature`` is -1 at a leaf."""
    tree, node = np.nonzero(trees.active & (trees.count > 0))
    inner = np.isfinite(trees.threshold[tree, node])
    return pa.Table.from_arrays([
        pa.repeat(pa.scalar(trees.model, pa.string()), len(tree)), pa.array((tree + trees.first).astype(np.int32)),
        pa.array(node.astype(np.int32)), pa.array(np.where(inner, trees.feature[tree, node], -1).astype(np.int32)),
        pa.array(trees.threshold[tree, node], mask=~inner), pa.array(trees.count[tree, node]),
        pa.array(trees.path[tree, node], mask=inner)], schema=NODES_ARROW)


def _trees_from(rows: pd.DataFrame | Mapping[str, np.ndarray], model: str, n_trees: int) -> iso.Trees:
    """Inverse of ``_node_table_of``."""
    rows = {c: np.asarray(rows[c]) for c in NODES_ARROW.names[1:]}
    node, tree = rows["node"], rows["tree"]
    depth = int(math.floor(math.log2(node.max() + 1))) if len(node) else 0
    trees = iso.Trees(model, n_trees, depth, 0)
    inner = rows["feature"] >= 0
    trees.feature[tree[inner], node[inner]] = rows["feature"][inner]
    trees.threshold[tree[inner], node[inner]] = rows["threshold"][inner]
    trees.count[tree, node] = rows["n"]
    trees.active[tree, node] = True
    t, i, path = tree[~inner], node[~inner].astype(np.int64), rows["path"][~inner]
    level = np.floor(np.log2(i + 1)).astype(int)
    trees.path[t, i] = path
    for _ in range(depth):
        i = np.where(level < depth, 2 * i + 1, i)
        level = np.minimum(level + 1, depth)
        trees.path[t, i] = path
    return trees


def _prepare(df: DataFrame, features: Sequence[str], keys: Sequence[str], cfg: Settings) -> DataFrame:
    named = df.withColumn(MODEL, model_name(keys))
    if cfg.max_samples < 1.0:
        plain = [c for c, t in named.dtypes if not t.startswith("map")]
        named = named.withColumn(ROW_ID, F.xxhash64(*plain))
    return named.withColumns({f: _known(f) for f in features})


def _batches(sizes: list[tuple[str, int]], cfg: Settings) -> Iterator[list[tuple[str, int]]]:
    per_model = cfg.n_estimators * 2 ** (cfg.max_depth + 1)
    step = max(1, GROW_NODES // per_model)
    for start in range(0, len(sizes), step):
        yield sizes[start:start + step]


def _local_limit(sizes: DataFrame) -> int:
    """How many rows a model may have to be grown in a single task."""
    middling = sizes.where((F.col("_n") > LOCAL_ROWS_FEW) & (F.col("_n") <= LOCAL_ROWS)).count()
    return LOCAL_ROWS if middling >= sizes.sparkSession.sparkContext.defaultParallelism else LOCAL_ROWS_FEW


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Give every core a share of a table too small to have come in enough partitions by itself."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if rows < cores * SPREAD_BELOW else df


def _by_model(df: DataFrame, rows: int) -> DataFrame:
    """Rows of a model together, models spread wide: growing trees is work that row counts and bytes understate."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism * 4, rows // ROWS_PER_TASK)
    return df.repartition(int(tasks), MODEL)


def _whole_models(batches: Iterator[pa.RecordBatch], key: str = MODEL) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that come sorted by model, as batches of whole models, each with the places where a model begins and the end.

    Models share batches, because a batch costs more than a small model; the last model of a batch may go on in the next.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if len(held) > 1 and batch.column(key)[-1] == held[0].column(key)[0]:
            continue
        rows = pa.concat_batches(held)
        first = _begins(rows, key)
        held = [rows.slice(int(first[-1]))]
        if len(first) > 1:
            yield rows.slice(0, int(first[-1])), first
    if held:
        rows = pa.concat_batches(held)
        yield rows, np.append(_begins(rows, key), rows.num_rows)


def _begins(rows: pa.RecordBatch, key: str) -> np.ndarray:
    codes = rows.column(key).dictionary_encode().indices.to_numpy()
    return np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])


@dataclass(frozen=True)
class _Grown:
    """Forests just grown: over the cluster and held here, or in tasks and stored as a node table."""

    trees: list[iso.Trees]
    stored: DataFrame | None
    rows: int
    largest: int

    def nodes(self, spark: SparkSession) -> DataFrame:
        if not self.trees:
            return spark.createDataFrame([], NODES_SCHEMA) if self.stored is None else self.stored
        made = settle(_node_table(spark, self.trees))
        return made if self.stored is None else made.unionByName(self.stored)

    def hot(self) -> str | None:
        """No model needs its percentile taken in bins if the largest one fits a task."""
        return "check" if self.largest > CHUNK_ROWS else None


def _grown_in(
    rows: pa.RecordBatch, first: np.ndarray, features: Sequence[str], cfg: Settings
) -> Iterator[tuple[np.ndarray, iso.Trees]]:
    """Each model's values and its trees, grown here."""
    everything = _matrix(rows, features)
    ids = rows.column(ROW_ID).to_numpy() if cfg.max_samples < 1.0 else None
    names = rows.column(MODEL).take(pa.array(first[:-1])).to_pylist()
    for name, a, b in zip(names, first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield everything[a:b], iso.grow_here(
            everything[a:b], name, cfg.n_estimators, cfg.max_depth, cfg.seed, None if ids is None else ids[a:b], cfg.max_samples)


def _parts_of(trees: Iterable[iso.Trees]) -> Iterator[pa.Table]:
    """The nodes of many models in tables of some size, not one a model."""
    held, n = [], 0
    for one in trees:
        held.append(_node_table_of(one))
        n += held[-1].num_rows
        if n >= 50_000:
            yield pa.concat_tables(held)
            held, n = [], 0
    if held:
        yield pa.concat_tables(held)


def _fit(df: DataFrame, features: Sequence[str], keys: Sequence[str], cfg: Settings) -> _Grown:
    features = list(features)
    named = _prepare(df, features, keys, cfg)
    lean = named.select(MODEL, *features, *([ROW_ID] if cfg.max_samples < 1.0 else []))
    sizes = settle(lean.groupBy(MODEL).agg(F.count(F.lit(1)).alias("_n")))
    limit = _local_limit(sizes)
    # At most rows / limit models are big enough to be listed here.
    big = sorted((r[MODEL], r["_n"]) for r in sizes.where(F.col("_n") > limit).collect())
    fitting = sizes.where(F.col("_n") <= limit)
    few = fitting.agg(F.sum("_n").alias("rows"), F.max("_n").alias("largest")).first()
    n_few = few["rows"] or 0

    def grow_models(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in _whole_models(batches):
            for made in _parts_of(trees for _, trees in _grown_in(rows, first, features, cfg)):
                yield from made.to_batches(50_000)

    small_nodes = None
    if n_few:
        small = attach(lean, fitting.drop("_n"), [MODEL]) if big else lean
        small_nodes = settle(_by_model(small, n_few).sortWithinPartitions(MODEL).mapInArrow(grow_models, NODES_SCHEMA))
    grown, stored = [], []
    batches = list(_batches(big, cfg))
    sampled = cfg.max_samples < 1.0
    if len(batches) == 1:
        mine = lean.where(F.col(MODEL).isin([name for name, _ in big])) if n_few else lean
        blocks = _pack(_spread(mine, sum(n for _, n in big)), features, sampled).persist()
        grown = _grow_over_cluster(blocks, len(features), big, cfg)
        blocks.unpersist()
    elif batches:
        turns = [(name, turn) for turn, batch in enumerate(batches) for name, _ in batch]
        by_turn = _store_by_turn(lean, df.sparkSession.createDataFrame(turns, f"{MODEL} string, _turn int"), features, sampled)
        for turn, batch in enumerate(batches):
            trees = _grow_over_cluster(by_turn.where(F.col("_turn") == turn), len(features), batch, cfg)
            stored.append(settle(_node_table(df.sparkSession, trees)))
    for more in stored:
        small_nodes = more if small_nodes is None else small_nodes.unionByName(more)
    return _Grown(
        grown, small_nodes, n_few + sum(n for _, n in big), max([few["largest"] or 0] + [n for _, n in big]))


def _store_by_turn(lean: DataFrame, turns: DataFrame, features: list[str], sampled: bool) -> DataFrame:
    """Blocks of all big models, written once, in one folder per turn of growing, so that a turn reads its own only.

    Range partitioning puts few models into each file and splits a model that is larger than the rest.
    """
    side = F.broadcast(turns) if is_small(turns) else turns
    blocks = _pack(lean.join(side.select(MODEL), MODEL, "left_semi"), features, sampled).join(side, MODEL)
    path = f"{checkpoint_folder(lean.sparkSession)}/blocks-{uuid.uuid4().hex}"
    blocks.repartitionByRange("_turn", MODEL, F.xxhash64("values")).write.partitionBy("_turn").parquet(path)
    return lean.sparkSession.read.schema(blocks.schema).parquet(path)


def _node_table(spark: SparkSession, trees: Sequence[iso.Trees]) -> DataFrame:
    return spark.createDataFrame(pa.concat_tables([_node_table_of(t) for t in trees]))


def _deep():
    """The module of full-depth forests, which builds on this one."""
    from tickwise.operators import deepforest

    return deepforest


def fit_nodes(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), settings: Settings = Settings()) -> DataFrame:
    """The node table of one forest per distinct ``keys`` (one forest in all, when there are none)."""
    if settings.max_depth is None:
        return _deep().fit_nodes(df, features, keys, settings)
    return _fit(df, features, keys, settings).nodes(df.sparkSession)


def add_scores(df: DataFrame, nodes: DataFrame, features: Sequence[str], n_trees: int, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``score`` in (0, 1]; rows of a key without a model are left out.

    The node table is sent to every task while it is small. Beyond that, rows and nodes meet in a sorted stream by model, with
    each big model's rows split over several groups and its nodes copied to them.  A stream cannot be cogrouped: its nodes are
    always sent, and more than ``STREAM_NODES`` are an error.
    """
    if "root" in nodes.columns:
        return _deep().add_scores(df, nodes, features, n_trees, keys)
    if df.isStreaming and not is_small(nodes, STREAM_NODES):
        raise ValueError(f"a stream is scored against at most {STREAM_NODES} nodes; split the models over several streams")
    if df.isStreaming or is_small(nodes, NODE_BUDGET):
        table = nodes.toArrow().to_pandas()
        trees = [_trees_from(part, m, n_trees) for m, part in table.groupby(MODEL)]
        return _score_by_broadcast(df, trees, features, n_trees, keys)
    return _score_by_cogroup(df, nodes, features, n_trees, keys)


def _score_by_broadcast(
    df: DataFrame, trees: Sequence[iso.Trees], features: Sequence[str], n_trees: int, keys: Sequence[str]
) -> DataFrame:
    features, walk_rows = list(features), iso.WALK_ROWS
    named = df.withColumn(MODEL, model_name(keys))
    fields = ", ".join(f"`{n}` {t}" for n, t in named.dtypes)
    shared = df.sparkSession.sparkContext.broadcast({
        t.model: (t.feature, t.threshold, t.path[:, t.level(t.depth)].copy(), t.rows()) for t in trees})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = list(shared.value)
        names = {m: i for i, m in enumerate(models)}
        walker, walking = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch, features)
            score = np.full(len(rows), np.nan)
            for index, chosen in _per_model(batch, names):
                mine = slice(None) if chosen is None else chosen
                feature, threshold, leaves, n = shared.value[models[index]]
                own = rows[mine]
                if len(own) >= walk_rows:
                    if walking != index:
                        depth = int(leaves.shape[1]).bit_length() - 1
                        walker, walking = iso.Walker(feature, threshold, depth, len(features)), index
                    sums = walker.path_sums(own, leaves)
                else:
                    sums = iso.path_sums(np.ascontiguousarray(own.T), feature, threshold, leaves)
                score[mine] = iso.anomaly_score(sums, n_trees, n)
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "score"])
            known = ~np.isnan(score)
            yield out if known.all() else out.filter(pa.array(known))

    return named.mapInArrow(walk, f"{fields}, score double").drop(MODEL)


def _score_by_cogroup(
    df: DataFrame, nodes: DataFrame, features: Sequence[str], n_trees: int, keys: Sequence[str]
) -> DataFrame:
    """Rows and nodes in one stream sorted by model and part, the nodes first, so that many small models share a batch."""
    features = list(features)
    named = df.withColumn(MODEL, model_name(keys))
    fields = ", ".join(f"`{n}` {t}" for n, t in named.dtypes)
    columns = named.columns
    sizes = settle(named.groupBy(MODEL).agg(F.ceil(F.count(F.lit(1)) / LOCAL_ROWS).cast("int").alias("_parts")))
    # By row number, not by value: equal rows go to different parts like any others.
    spread = attach(named, sizes, [MODEL]).withColumn(
        "_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int"))
    copies = attach(nodes, sizes, [MODEL]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    group = F.concat_ws("|", "_part", MODEL).alias("_group")
    both = spread.select(group, F.lit(1).alias("_kind"), *columns).unionByName(
        copies.select(group, F.lit(0).alias("_kind"), *[F.col(c).alias(f"_node_{c}") for c in NODES_ARROW.names]),
        allowMissingColumns=True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in _whole_models(batches, "_group"):
            kind = rows.column("_kind").to_numpy()
            begin = first[:-1] + np.add.reduceat(kind == 0, first[:-1])
            score, known = np.zeros(rows.num_rows), np.zeros(rows.num_rows, dtype=bool)
            for a, m, b in zip(first[:-1].tolist(), begin.tolist(), first[1:].tolist(), strict=True):
                if a == m or m == b:
                    continue
                grown = {c: rows.column(f"_node_{c}").slice(a, m - a).to_numpy(zero_copy_only=False) for c in NODES_ARROW.names[1:]}
                t = _trees_from(grown, "", n_trees)
                sums = t.paths(np.ascontiguousarray(_matrix(rows.slice(m, b - m), features).T))
                score[m:b], known[m:b] = iso.anomaly_score(sums, n_trees, t.rows()), True
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in columns], pa.array(score)], names=[*columns, "score"]).filter(pa.array(known))

    together = both.repartition("_group").sortWithinPartitions("_group", "_kind")
    return together.mapInArrow(walk, f"{fields}, score double").drop(MODEL)


def _score_grown(
    df: DataFrame, grown: _Grown, features: Sequence[str], cfg: Settings, keys: Sequence[str]
) -> DataFrame:
    """Scores straight from the forests just grown, without a round trip through the node table where possible."""
    if grown.stored is None:
        return _score_by_broadcast(_spread(df, grown.rows), grown.trees, features, cfg.n_estimators, keys)
    return add_scores(df, grown.nodes(df.sparkSession), features, cfg.n_estimators, keys)


def cutoffs(scored: DataFrame, keys: Sequence[str], contamination: float, *, hot="check") -> DataFrame:
    """Per model the (1 - contamination) percentile of its training scores."""
    named = scored.select(model_name(keys).alias(MODEL), "score")
    return percentile_per_key(named, [MODEL], "score", 1.0 - contamination, "cutoff", hot=hot)


def flag(scored: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``flagged`` where the score is strictly above the model's cutoff, so a constant channel flags nothing."""
    joined = attach(scored.withColumn(MODEL, model_name(keys)), limits, [MODEL], "left")
    above = F.coalesce(F.col("score") > F.col("cutoff"), F.lit(False))
    return joined.withColumn("flagged", above).drop(MODEL, "cutoff")


def fit(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), settings: Settings = Settings()) -> Forest:
    """Fit once, on rows taken as normal, and fix the cutoff from their own scores."""
    features, keys, cfg = list(features), list(keys), settings
    if cfg.max_depth is None:
        nodes, hot = keep(fit_nodes(df, features, keys, cfg)), "check"
        scored = settle(add_scores(df.select(*keys, *features), nodes, features, cfg.n_estimators, keys))
    else:
        grown = _fit(df, features, keys, cfg)
        nodes, hot = grown.nodes(df.sparkSession), grown.hot()
        scored = _score_grown(df.select(*keys, *features), grown, features, cfg, keys).persist()
    limits = settle(cutoffs(scored, keys, cfg.contamination, hot=hot))
    moments = scored.withColumn(MODEL, model_name(keys)).groupBy(MODEL).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.array(*[F.avg(f) for f in features]).alias("means"),
        F.array(*[F.stddev_pop(f) for f in features]).alias("stds"))
    meta = settle(moments.join(limits, MODEL).withColumns({
        "features": F.array(*[F.lit(f) for f in features]), "keys": F.array(*[F.lit(k) for k in keys]).cast("array<string>"),
        "n_estimators": F.lit(cfg.n_estimators), "contamination": F.lit(cfg.contamination), "seed": F.lit(cfg.seed),
        "max_samples": F.lit(cfg.max_samples), "max_depth": F.lit(cfg.max_depth).cast("int")}))
    scored.unpersist()
    return Forest(nodes, meta, tuple(features), cfg)


def score(df: DataFrame, forest: Forest, keys: Sequence[str] = ()) -> DataFrame:
    """``score`` and ``flagged`` against a fitted forest; never refits. Rows of a key without a model are left out."""
    scored = add_scores(df, forest.nodes, forest.features, forest.settings.n_estimators, keys)
    return flag(scored, forest.meta.select(MODEL, "cutoff"), keys)


def detect(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), settings: Settings = Settings()) -> DataFrame:
    """Fit and flag the same rows, one model per distinct ``keys``.

    Small models are fitted, scored and flagged in one task each; big ones are grown over the cluster, scored once, and
    cut at the percentile of those same scores.
    """
    features, keys, cfg = list(features), list(keys), settings
    if cfg.max_depth is None:
        return _deep().detect(df, features, keys, cfg)

    def detect_large(rows: DataFrame) -> DataFrame:
        grown = _fit(rows, features, keys, cfg)
        scored = settle(_score_grown(rows, grown, features, cfg, keys))
        return flag(scored, settle(cutoffs(scored, keys, cfg.contamination, hot=grown.hot())), keys)

    if not keys:
        return detect_large(df)
    named = _prepare(df, features, keys, cfg)
    sizes = settle(named.groupBy(MODEL).agg(F.count(F.lit(1)).alias("_n")))
    large = sizes.where(F.col("_n") > _local_limit(sizes)).drop("_n")
    extra = [MODEL] + ([ROW_ID] if cfg.max_samples < 1.0 else [])
    types = ", ".join(f"`{n}` {t}" for n, t in named.drop(*extra).dtypes)

    def detect_models(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first in _whole_models(batches):
            scores, limits = np.empty(rows.num_rows), np.empty(rows.num_rows)
            grown = _grown_in(rows, first, features, cfg)
            for (values, trees), a, b in zip(grown, first[:-1].tolist(), first[1:].tolist(), strict=True):
                scores[a:b] = iso.anomaly_score(trees.paths(np.ascontiguousarray(values.T)), cfg.n_estimators, trees.rows())
                limits[a:b] = iso.percentile_linear(scores[a:b], 1.0 - cfg.contamination)
            kept = [c for c in rows.schema.names if c not in extra]
            columns = [rows.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores), pa.array(scores > limits)], names=[*kept, "score", "flagged"])

    def in_tasks(some: DataFrame) -> DataFrame:
        return _by_model(some, total).sortWithinPartitions(MODEL).mapInArrow(detect_models, out)

    total = sizes.agg(F.sum("_n")).first()[0] or 0
    out = f"{types}, score double, flagged boolean"
    if large.isEmpty():
        return in_tasks(named)
    short, long = split_hot(named, [MODEL], settle(large))
    return in_tasks(short).unionByName(detect_large(long.drop(*extra)))
