"""Exact top-k inner products: query tiles times data tiles, the best of each tile, merged in a tree."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, stored

TILE_ROWS = 4_096
QUERY_TILE = 512
# Queries of one pass over the data: what is sent to every executor stays below this.
PASS_BYTES = 32_000_000
MERGE_WAYS = 16
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantize(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and the components as floor(scale * x); rows that are null or hold null or non-finite components go."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), whole.alias("components"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Integer rows; shorter ones are filled with zeros."""
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _largest(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products, by float arithmetic where no sum can leave its whole numbers."""
    dims = min(q.shape[1], x.shape[1])
    q, x = q[:, :dims], x[:, :dims]
    top = _largest(q) * _largest(x) * max(dims, 1)
    if top >= 2 ** 63:
        raise OverflowError("components are so large that a score may not fit in 64 bits")
    if top < 2 ** 53:
        kind = np.float32 if top < 2 ** 24 else np.float64
        return (q.astype(kind) @ x.astype(kind).T).astype(np.int64)
    return q @ x.T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Column numbers of the k best of each row and their scores; ids ascend, so of equal scores the leftmost is best."""
    n = scores.shape[1]
    if n <= k:
        take = np.broadcast_to(np.arange(n), scores.shape)
    else:
        # No two keys of a row are equal; scores this large would not fit beside a position.
        if int(np.abs(scores).max(initial=0)) < (1 << 62) // n:
            take = np.argpartition(scores * -n + np.arange(n), k - 1, axis=1)[:, :k]
        else:
            take = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return take, np.take_along_axis(scores, take, 1)


def _search(rows: Iterator[pa.RecordBatch], tiles: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of this task for each query."""
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(tiles)
    for some in rows:
        for lo in range(0, some.num_rows, TILE_ROWS):
            part = some.slice(lo, TILE_ROWS)
            ids = column(part, "vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, data = ids[order], _matrix(pa.concat_arrays([column(part, "components")]))[order]
            for t, (query_ids, queries) in enumerate(tiles):
                scores = _products(queries, data)
                # A query's own row is never its match, however often the row is repeated.
                own_lo, own_hi = np.searchsorted(ids, query_ids), np.searchsorted(ids, query_ids, "right")
                drop = np.flatnonzero(own_hi > own_lo)
                allowed = np.ones(scores.shape, dtype=bool) if len(drop) else None
                for q in drop.tolist():
                    allowed[q, own_lo[q]:own_hi[q]] = False
                if allowed is not None:
                    scores[~allowed] = np.iinfo(np.int64).min // (1 << 20)
                take, best = _best(ids, scores, k)
                q = np.broadcast_to(np.arange(len(query_ids))[:, None], take.shape)
                fine = np.take_along_axis(allowed, take, 1) if allowed is not None else np.ones(take.shape, dtype=bool)
                new = (q[fine], ids[take][fine], best[fine])
                if kept[t] is not None:
                    new = tuple(np.concatenate([a, b]) for a, b in zip(kept[t], new, strict=True))
                order = np.lexsort((new[1], -new[2], new[0]))
                new = tuple(a[order] for a in new)
                place = np.arange(len(order)) - np.searchsorted(new[0], new[0])
                kept[t] = tuple(a[place < k] for a in new)
    for (query_ids, _), found in zip(tiles, kept, strict=True):
        if found is not None and len(found[0]):
            yield batch(_FOUND, [query_ids[found[0]], found[1], found[2]])


def _top(df: DataFrame, keys: list, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("vec_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pass_bytes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of ``vectors`` with the largest integer inner product with each query.

    Both tables have vec_id and components (see ``quantize``). Ties go to the smaller vec_id; a query never finds its own vec_id; of fewer rows
    than k all are returned; repeated rows of ``vectors`` count each; of queries
    with one vec_id the least vector counts; components too large for 64-bit scores are an error; shorter vectors are filled with zeros; empty
    tables give an empty result.

    Queries are taken in passes of bounded size, each sent to all executors, so that the data is read but never shuffled.
    Each task keeps k rows per query, which then meet in two rounds: groups of tasks first, then all.
    """
    spark = vectors.sparkSession
    pass_bytes = PASS_BYTES if pass_bytes is None else pass_bytes
    queries = stored(queries.groupBy("vec_id").agg(F.min("components").alias("components")), "queries")
    size, rows = queries.agg(F.sum(24 + 8 * F.size("components")), F.count("*")).first()
    passes = max(1, -(-(size or 0) // pass_bytes))
    found = None
    for p in range(passes):
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p).toArrow()
        ids, lists = mine.column("vec_id").combine_chunks(), mine.column("components").combine_chunks()
        matrix = _matrix(lists) if len(ids) else np.zeros((0, 0), np.int64)
        numbers = ids.to_numpy()
        tiles = [(numbers[lo:lo + QUERY_TILE], matrix[lo:lo + QUERY_TILE]) for lo in range(0, len(numbers), QUERY_TILE)]
        sent = spark.sparkContext.broadcast(pickle.dumps(tiles, protocol=5))
        part = vectors.select("vec_id", "components").mapInArrow(
            lambda it, sent=sent: _search(it, pickle.loads(sent.value), k), "query_id long, vec_id long, score long")
        part = stored(part.withColumn("way", F.spark_partition_id() % MERGE_WAYS), "found")
        found = part if found is None else found.unionByName(part)
    merged = _top(found, ["query_id", "way"], k).drop("rank")
    return _top(merged, ["query_id"], k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
