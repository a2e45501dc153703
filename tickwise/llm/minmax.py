"""Near-duplicate documents by min-max hashing: each permutation gives both its least and its largest value.

A signature of 2 * PERMUTATIONS values costs PERMUTATIONS hash evaluations; least and largest are both unbiased for the
Jaccard similarity, and together vary less than as many least values of half the permutations. BANDS bands of values_per_band values each
make the buckets; with 32 bands of 4, a pair at similarity 0.8 shares no bucket with probability 5e-8.

Links are found without emitting the pairs of a bucket. Documents with equal shingle sets are one class from the start. First
every member of a bucket is compared with the bucket's least document; in a group of near copies that links nearly all. What then still is in
different components is compared in tiles, all members of a bucket against those outside its largest component. Each
link is confirmed on the full sets, and none that joins two components is left out, as every pair of a bucket is compared unless it
already is in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.components import components
from tickwise.llm.frames import batch, column, documents_view, small_enough, stored
from tickwise.llm.words import mix, shingles, slices, split, strings

PERMUTATIONS = 64
BANDS = 32
TILE_ROWS = 512
TILE_SHINGLES = 16_384
_SEED = np.random.default_rng(7_919)
_FACTORS = _SEED.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _SEED.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)

_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
                     ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def shingle_sets(column_in: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin."""
    values, first = shingles(split(column_in), size)
    parts = [np.unique(values[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    count = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts) if parts else values, np.concatenate([[0], np.cumsum(count)])


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts by 2 * PERMUTATIONS values: the least and the largest shingle under each permutation. Texts must not be empty."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    x ^= values.astype(np.uint32)
    out = np.empty((2 * PERMUTATIONS, len(first) - 1), np.uint32)
    at = first[:-1]
    for k in range(PERMUTATIONS):
        y = x * _FACTORS[k] + _SHIFTS[k]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        out[2 * k] = np.minimum.reduceat(y, at)
        out[2 * k + 1] = np.maximum.reduceat(y, at)
    return out.T


def _signed(rows: Iterator[pa.RecordBatch], size: int, with_sets: bool) -> Iterator[pa.RecordBatch]:
    width = 2 * PERMUTATIONS // BANDS
    for some in rows:
        texts, numbers = strings(column(some, "text")), column(some, "doc_id")
        for lo, hi in slices(texts):
            values, first = shingle_sets(pa.concat_arrays([texts.slice(lo, hi - lo)]), size)
            ids = numbers.slice(lo, hi - lo)
            if with_sets:
                yield batch(_SETS, [ids, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))])
                continue
            count = np.diff(first)
            full = count > 0
            bands = np.zeros((int(full.sum()), BANDS), np.uint64)
            a = np.zeros(len(count), np.uint64)
            b = np.zeros(len(count), np.uint64)
            if full.any():
                at = first[:-1][full]
                signature = signatures(values, np.append(at, first[-1])).astype(np.uint64)
                bands += np.arange(BANDS, dtype=np.uint64)
                for k in range(width):
                    # A band takes its values from as many permutations as it has values.
                    bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + signature[:, (np.arange(BANDS) + k * BANDS)])
                a[full] = np.add.reduceat(mix(values), at)
                b[full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full)]) * BANDS, pa.int32()),
                                             pa.array(bands.view(np.int64).ravel()))
            yield batch(_SIGNED, [ids, count, a.view(np.int64), b.view(np.int64), lists])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    close = F.lit(100) * both >= F.lit(percent) * (F.size("su") + F.size("sv") - both)
    return stored(pairs.join(right, "v").join(left, "u").where(close).select("u", "v"), "links")


def _tile(members: pa.Table, others: pa.Table, percent: int) -> pa.Table:
    """Links between some members of a bucket and some of those outside its largest component.

    The sizes of all intersections are one product of two 0/1 matrices over the shingles that both sides have, taken in
    runs of TILE_SHINGLES columns.
    """
    sides = []
    for t in (members, others):
        lists = t.column("shingles").combine_chunks()
        sides.append((np.repeat(np.arange(t.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()))
    common = np.intersect1d(sides[0][1], sides[1][1])
    both = np.zeros((members.num_rows, others.num_rows), np.float32)
    for lo in range(0, len(common), TILE_SHINGLES):
        some = common[lo:lo + TILE_SHINGLES]
        grids = []
        for (row, value), t in zip(sides, (members, others), strict=True):
            at = np.minimum(np.searchsorted(some, value), len(some) - 1)
            held = some[at] == value
            grid = np.zeros((t.num_rows, len(some)), np.float32)
            grid[row[held], at[held]] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    n, m = (t.column("n").to_numpy() for t in (members, others))
    close = 100 * both >= percent * (n[:, None] + m[None, :] - both)
    close &= members.column("component").to_numpy()[:, None] != others.column("component").to_numpy()[None, :]
    i, j = np.nonzero(close)
    a, b = members.column("doc_id").to_numpy()[i], others.column("doc_id").to_numpy()[j]
    return pa.table({"u": pa.array(np.minimum(a, b)), "v": pa.array(np.maximum(a, b))})


def _across(pending: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket that are in different components (columns key, doc_id, n, component).

    All members meet all those outside the bucket's largest component, in tiles of TILE_ROWS by TILE_ROWS, so that a very large
    bucket is many tasks and no pair is a row unless it is a link.
    """
    share = pending.groupBy("key", "component").agg(F.count("*").alias("share"))
    mixed = share.groupBy("key").agg(F.count("*").alias("components"), F.sum("share").alias("size"), F.max(F.struct("share", "component")).alias("most"))
    mixed = mixed.where("components > 1").select(
        "key", F.col("most.component").alias("largest"), F.ceil(F.col("size") / TILE_ROWS).alias("chunks"),
        F.ceil((F.col("size") - F.col("most.share")) / TILE_ROWS).alias("blocks"))
    whole = pending.join(mixed, "key").join(sets, "doc_id")
    chunk, block = F.pmod(F.xxhash64("doc_id"), F.col("chunks")), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("blocks"))
    kept = ["key", "doc_id", "n", "component", "shingles"]
    members = whole.select(*kept, chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # Aliases tell the two sides of the cogroup apart.
    others = whole.where(F.col("component") != F.col("largest")).select(
        *[F.col(c).alias(c) for c in kept], F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), block.alias("block"))
    tile = ["key", "chunk", "block"]
    return members.groupBy(*tile).cogroup(others.groupBy(*tile)).applyInArrow(
        lambda a, b: _tile(a, b, percent), "u long, v long").distinct()


def _links(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """Component of every class representative that has a link to another; ``members``: key, doc_id, n."""
    buckets = members.groupBy("key").agg(F.count("*").alias("in_bucket"), F.min(F.struct("doc_id", "n")).alias("head"))
    buckets = buckets.where("in_bucket > 1").select("key", F.col("head.doc_id").alias("a"), F.col("head.n").alias("n_a"))
    pending = stored(members.join(buckets, "key"), "buckets")
    active = stored(pending.select("doc_id").distinct(), "active")
    wanted = F.broadcast(active) if small_enough(active, 16) else active
    sets = stored(documents_view(docs).join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(
        lambda rows: _signed(rows, size, True), "doc_id long, shingles array<long>"), "sets")
    # First all against the least document of their bucket, which in a group of near copies links nearly all.
    near = F.lit(100) * F.least("n", "n_a") >= F.lit(percent) * F.greatest("n", "n_a")
    first = pending.where(F.col("doc_id") != F.col("a")).where(near)
    found = _confirmed(first.select(F.col("a").alias("u"), F.col("doc_id").alias("v")).distinct(), sets, percent)
    label = stored(components(found), "labels")
    # Then what still is in different components; the least document has met all others.
    rest = pending.where(F.col("doc_id") != F.col("a")).select("key", "doc_id", "n")
    rest = rest.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    more = stored(_across(rest.withColumn("component", F.coalesce("component", "doc_id")), sets, percent), "links")
    return label if more.isEmpty() else stored(components(found.unionByName(more)), "labels")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text; other columns are not read).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded; a text's set holds its distinct shingles of ``shingle`` words, or its
    whole sequence if it has fewer. Documents are linked if 100 * intersection >= ``percent`` * union, ``percent`` being
    80 or more for the stated recall. A document without words has an empty set, no link and is kept. Rows that repeat a
    doc_id give a row each and are one document for linking; a null doc_id is never linked. An empty table gives an empty result.
    """
    signed = stored(documents_view(docs).mapInArrow(lambda rows: _signed(rows, shingle, False),
                                                    "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "signed")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    same = ["set_a", "set_b", "n_shingles"]
    classes = full.groupBy(*same).agg(F.min("doc_id").alias("class_id"))
    number = signed.drop("bands").join(classes, same, "left")
    number = stored(number.withColumn("class_id", F.coalesce("class_id", "doc_id")), "classes")
    representatives = full.join(classes, same).where("doc_id = class_id")
    members = representatives.dropDuplicates(["doc_id"]).select(
        "doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    label = _links(docs, members, shingle, percent)
    # A doc_id whose rows differ ties their classes together.
    split_ids = number.where("doc_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("u"), F.max("class_id").alias("v")).where("u <> v")
    if not split_ids.isEmpty():
        every = number.where("doc_id is not null").select(F.col("doc_id").alias("u"), F.col("class_id").alias("v")).distinct()
        label = stored(components(every.unionByName(label.select(F.col("node").alias("u"), F.col("component").alias("v")))), "labels")
    out = number.join(label, number["class_id"] == label["node"], "left")
    component = F.coalesce("component", "class_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
