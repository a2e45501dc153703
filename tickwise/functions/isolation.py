"""Array helpers run inside tasks by the isolation forest: walking rows down trees, node ranges, split draws.

Trees are complete binary heaps (children of i are 2i+1 and 2i+2) stored as one row per tree.  A leaf above the last
level has an infinite threshold, so rows drift to its leftmost descendant, and walking needs no branching.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np

EULER_GAMMA = 0.5772156649015329
# Levels that a ``Walker`` takes in one step: the leaves below them are the bits of one number.
UPPER_LEVELS = 6
# Trees that share the cuts of a ``Walker``, and the rows from which one is worth its tables.
WALK_TREES = 100
WALK_ROWS = 4_000
# Up to how many places of a level all rows are sorted by place to find its ranges.
SORTED_PLACES = 64


def expected_path(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among ``n`` rows (Liu, Ting and Zhou, ICDM 2008)."""
    n = np.asarray(n, dtype=np.float64)
    safe = np.maximum(n, 3)
    long = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def depth_cap(n: int, max_depth: int) -> int:
    return min(max_depth, max(1, math.ceil(math.log2(n)))) if n > 1 else 0


def split_draws(seed: int, model: str, trees: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Two numbers in [0, 1) per node, from one digest: independent of partitioning and of the order of growth."""
    text = [f"{seed}|{model}|{t}|{i}".encode() for t, i in zip(trees.tolist(), nodes.tolist())]
    digests = b"".join(hashlib.md5(x, usedforsecurity=False).digest() for x in text)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4)[:, :2] / 4294967296.0


def choose_splits(u: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A feature among those that vary in the node (-1 if none) and a threshold in [low, high)."""
    varies = high > low
    count = varies.sum(axis=1)
    pick = np.floor(u[:, 0] * count).astype(np.int64)
    feature = np.argmax(np.cumsum(varies, axis=1) > pick[:, None], axis=1)
    rows = np.arange(len(feature))
    lo, hi = low[rows, feature], high[rows, feature]
    threshold = lo + u[:, 1] * (hi - lo)
    threshold = np.where(threshold >= hi, lo, threshold)
    return np.where(count > 0, feature, -1), threshold


def descend(columns: np.ndarray, feature: np.ndarray, threshold: np.ndarray, depth: int) -> np.ndarray:
    """Place of every row at level ``depth`` of every tree: shape (trees, rows). ``columns`` is (features, rows)."""
    n = columns.shape[1]
    trees, width = feature.shape
    if depth == 0:
        return np.zeros((trees, n), dtype=np.int64)
    flat, rows = np.ascontiguousarray(columns).ravel(), np.arange(n)
    offset = (np.arange(trees) * width)[:, None]
    start, cut = feature.ravel() * np.int64(n), threshold.ravel()
    # All rows are at the root, so the first step needs no lookup per row.
    node = (columns[feature[:, 0]] > threshold[:, :1]).astype(np.int64) + 1
    for _ in range(depth - 1):
        at = node + offset if trees > 1 else node
        index = start.take(at)
        index += rows
        right = flat.take(index) > cut.take(at)
        node += node
        node += 1
        node += right
    node -= 2**depth - 1
    return node


def _right_masks(levels: int) -> np.ndarray:
    """Per inner node of a tree of ``levels``, the leaves that a row may still reach after a step to the right there."""
    whole, masks = 2 ** 2**levels - 1, []
    for level in range(levels):
        half = 2 ** (levels - level - 1)
        masks += [whole & ~((2**half - 1) << (2 * half * place)) for place in range(2**level)]
    return np.array(masks, dtype=np.uint64)


class Walker:
    """Walks many rows down the trees of one forest, to the same places as ``descend``.

    For the upper levels a row's leaf is the first that none of the tests it meets rules out. Which leaves a feature rules out depends only on
    how many of its thresholds lie below the row's value; so values are ranked once among the thresholds of all trees, and each tree looks
    up one mask per feature instead of walking. The levels below are walked.
    """

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, depth: int, width: int):
        self.feature, self.threshold, self.depth = feature.astype(np.int64), threshold, depth
        self.levels = min(depth, UPPER_LEVELS)
        leaves, inner = 2**self.levels, 2**self.levels - 1
        bits = np.uint8 if leaves <= 8 else np.uint16 if leaves <= 16 else np.uint32 if leaves <= 32 else np.uint64
        right = _right_masks(self.levels)
        # Per group of trees and feature: the thresholds in order, and per tree what is left after each of them.
        self.groups: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        for first in range(0, len(feature), WALK_TREES):
            some, cut = feature[first:first + WALK_TREES, :inner], threshold[first:first + WALK_TREES, :inner]
            group = []
            for k in range(width):
                tree, node = np.nonzero((some == k) & (cut < np.inf))
                value = cut[tree, node]
                order = np.argsort(value, kind="stable")
                left = np.full((len(some), len(order) + 1), 2**leaves - 1, dtype=np.uint64)
                left[tree[order], np.arange(1, len(order) + 1)] = right[node[order]]
                if len(order):
                    group.append((k, value[order], np.bitwise_and.accumulate(left, axis=1).astype(bits)))
            self.groups.append(group)

    def places(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Per tree the place of every row at level ``depth``. ``rows`` is (rows, features)."""
        n, width = rows.shape
        flat, begin = np.ascontiguousarray(rows).ravel(), np.arange(0, n * width, width)
        for first, group in zip(range(0, len(self.feature), WALK_TREES), self.groups, strict=True):
            ranks = []
            for k, value, _ in group:
                rank = np.searchsorted(value, rows[:, k])
                rank[np.isnan(rows[:, k])] = 0
                ranks.append(rank)
            for tree in range(first, min(first + WALK_TREES, len(self.feature))):
                if not group or self.levels == 0:
                    place = np.zeros(n, dtype=np.uint8)
                else:
                    left = group[0][2][tree - first].take(ranks[0])
                    for (_, _, masks), rank in zip(group[1:], ranks[1:], strict=True):
                        left &= masks[tree - first].take(rank)
                    # The place of the lowest bit is the number of bits below it.
                    place = np.bitwise_count((left & (~left + left.dtype.type(1))) - left.dtype.type(1))
                if self.depth > self.levels:
                    place = self._below(flat, begin, self.feature[tree], self.threshold[tree], place)
                yield place

    def _below(self, flat: np.ndarray, begin: np.ndarray, feature: np.ndarray, threshold: np.ndarray, place: np.ndarray) -> np.ndarray:
        node = place.astype(np.int64)
        node += 2**self.levels - 1
        for _ in range(self.depth - self.levels):
            index = feature.take(node)
            index += begin
            right = flat.take(index) > threshold.take(node)
            node += node
            node += 1
            node += right
        node -= 2**self.depth - 1
        return node

    def path_sums(self, rows: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """As the function of this name: always added in tree order."""
        total = np.zeros(len(rows))
        for place, path in zip(self.places(rows), leaves, strict=True):
            total += path.take(place)
        return total


def node_ranges(rows: np.ndarray, place: np.ndarray, width: int, active: np.ndarray):
    """Count, minimum and maximum of each feature per occupied (tree, place); ids are tree * width + place.

    ``active`` says which (tree, place) pairs, or which (tree, row) pairs, are to be looked at.
    """
    trees, n = place.shape
    ids = (place + (np.arange(trees) * width)[:, None]).ravel() if trees > 1 else place.ravel()
    row = None
    if not active.all():
        keep = active.ravel() if active.shape == place.shape else active.ravel().take(ids)
        row = np.flatnonzero(keep)
        ids = ids.take(row)
    if not len(ids):
        empty = np.empty((0, rows.shape[1]))
        return ids, ids, empty, empty
    slots = trees * width
    small = ids.astype(np.uint8 if slots <= 256 else np.int16 if slots < 32768 else np.int32, copy=False)
    order = np.argsort(small, kind="stable")
    small = small.take(order)
    begin = np.flatnonzero(small[1:] != small[:-1])
    begin += 1
    begin = np.concatenate(([0], begin))
    row = order if row is None else row.take(order)
    # A column at a time: least and largest values of a stretch are found fastest in neighbouring places.
    values = np.ascontiguousarray(rows.take(row % n if trees > 1 else row, axis=0).T)
    count = np.diff(np.append(begin, len(ids)))
    found = small.take(begin).astype(np.int64)
    return found, count, np.minimum.reduceat(values, begin, axis=1).T, np.maximum.reduceat(values, begin, axis=1).T


def widen(rows: np.ndarray, columns: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Widen the ranges of a tree's places, (features, places) each, by rows; ``columns`` is ``rows`` turned.

    Only rows outside the ranges so far are sorted by place, which are few once a task has seen some rows of every place.
    """
    outside = np.zeros(len(place), dtype=bool)
    for values, least, most in zip(columns, low, high, strict=True):
        outside |= values < least.take(place)
        outside |= values > most.take(place)
    row = np.flatnonzero(outside)
    if len(row):
        at, _, lo, hi = node_ranges(rows.take(row, axis=0), place.take(row)[None, :], low.shape[1], np.ones((1, 1), dtype=bool))
        low[:, at] = np.minimum(low[:, at], lo.T)
        high[:, at] = np.maximum(high[:, at], hi.T)


def node_counts(place: np.ndarray, width: int, active: np.ndarray):
    """Count per occupied (tree, place); all that the last level needs."""
    trees = place.shape[0]
    ids = (place + (np.arange(trees) * width)[:, None]).ravel() if trees > 1 else place.ravel()
    if active.shape == place.shape:
        count = np.bincount(ids[active.ravel()], minlength=trees * width)
    else:
        count = np.bincount(ids, minlength=trees * width) * active.ravel()
    found = np.flatnonzero(count)
    return found, count[found]


class Trees:
    """The growing trees of one model: arrays of shape (trees, nodes)."""

    def __init__(self, model: str, n_trees: int, depth: int, seed: int, first_tree: int = 0):
        nodes = 2 ** (depth + 1) - 1
        self.model, self.depth, self.seed, self.first = model, depth, seed, first_tree
        self.feature = np.zeros((n_trees, nodes), dtype=np.int16)
        self.threshold = np.full((n_trees, nodes), np.inf)
        self.path = np.zeros((n_trees, nodes))
        self.count = np.zeros((n_trees, nodes), dtype=np.int64)
        self.active = np.zeros((n_trees, nodes), dtype=bool)
        self.active[:, 0] = True

    def level(self, level: int) -> slice:
        return slice(2**level - 1, 2 ** (level + 1) - 1)

    def grow(self, level: int, ids: np.ndarray, count: np.ndarray, low=None, high=None) -> None:
        """Split the level's nodes from their ranges; what cannot or need not be split becomes a leaf."""
        width = 2**level
        tree, node = ids // width, ids % width + width - 1
        self.count[tree, node] = count
        leaf_path = level + expected_path(count)
        if level < self.depth:
            feature, threshold = choose_splits(
                split_draws(self.seed, self.model, tree + self.first, node), low, high)
            split = (count > 1) & (feature >= 0)
            t, i = tree[split], node[split]
            self.feature[t, i], self.threshold[t, i] = feature[split], threshold[split]
            self.active[t, 2 * i + 1] = self.active[t, 2 * i + 2] = True
        else:
            split = np.zeros(len(ids), dtype=bool)
        t, i, path = tree[~split], node[~split], leaf_path[~split]
        self.path[t, i] = path
        for _ in range(level, self.depth):
            i = 2 * i + 1
            self.path[t, i] = path

    def rows(self) -> int:
        """How many rows a tree was grown on."""
        return int(self.count[:, 0].max())

    def paths(self, columns: np.ndarray) -> np.ndarray:
        return path_sums(columns, self.feature, self.threshold, self.path[:, self.level(self.depth)])


def path_sums(columns: np.ndarray, feature: np.ndarray, threshold: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """Sum of each row's path lengths over the trees, always added in tree order."""
    total = np.zeros(columns.shape[1])
    depth = int(leaves.shape[1]).bit_length() - 1
    block = max(1, 20_000 // max(columns.shape[1], 1))
    for first in range(0, len(leaves), block):
        part = slice(first, first + block)
        for place, path in zip(descend(columns, feature[part], threshold[part], depth), leaves[part]):
            total += path.take(place)
    return total


def in_sample(seed: int, first_tree: int, trees: int, row_ids: np.ndarray, share: float) -> np.ndarray:
    """Which rows each tree sees when it sees a share of them: a 64-bit mix of seed, tree and row."""
    with np.errstate(over="ignore"):
        tree = (np.arange(first_tree, first_tree + trees, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003))[:, None]
        z = row_ids.astype(np.int64).view(np.uint64)[None, :] + (tree + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


def anomaly_score(path_sum: np.ndarray, n_trees: int, n_train: float) -> np.ndarray:
    norm = float(expected_path(np.array([n_train]))[0])
    return np.exp2(-path_sum / n_trees / norm) if norm > 0 else np.full(len(path_sum), 0.5)


def percentile_linear(values: np.ndarray, share: float) -> float:
    ordered = np.sort(values)
    rank = (len(ordered) - 1) * share
    low = math.floor(rank)
    a, b = ordered[low], ordered[math.ceil(rank)]
    return float(a + (b - a) * (rank - low))


def grow_here(rows: np.ndarray, model: str, n_trees: int, max_depth: int, seed: int, row_ids=None, share: float = 1.0):
    """Grow a whole forest from rows that fit in this task. Same trees as level-by-level growth over the cluster."""
    n = len(rows)
    trees = Trees(model, n_trees, depth_cap(n, max_depth), seed)
    block = max(1, 20_000 // max(n, 1))
    columns = np.ascontiguousarray(rows.T)
    for first in range(0, n_trees, block):
        part = slice(first, min(first + block, n_trees))
        some = Trees(model, part.stop - first, trees.depth, seed, first)
        sampled = None if share >= 1.0 else in_sample(seed, first, part.stop - first, row_ids, share)
        for level in range(trees.depth + 1):
            place = descend(columns, some.feature, some.threshold, level)
            live = some.active[:, some.level(level)]
            if sampled is not None:
                live = np.take_along_axis(live, place, axis=1) & sampled
            last = level == some.depth
            found = node_counts(place, 2**level, live) if last else node_ranges(rows, place, 2**level, live)
            if len(found[0]):
                some.grow(level, *found)
        for name in ("feature", "threshold", "path", "count", "active"):
            getattr(trees, name)[part] = getattr(some, name)
    return trees
