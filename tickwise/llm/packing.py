"""Packing documents into sequences of fixed length as a cutting-stock problem.

A document longer than a sequence is cut into full sequences and a rest. Piece lengths are counted in classes of ``GRID`` ids
(rounded up, so that what fits by class fits). How often to use which *pattern* (so many pieces of each class in one
sequence) is a linear program over the histogram of classes; its columns are generated: a knapsack by dynamic
programming finds the pattern that the current prices value most, and it enters the basis until none is worth more than
a sequence. The whole parts are used as they are; what they leave is packed first-fit decreasing. Each pattern then gets
pieces by their rank within their class.

Only the histogram (at most ``length / GRID`` counts, whatever the input) reaches the driver. Ranks come from counts per class and
bucket, so that a length which a third of all pieces share is spread over all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, documents_view, stored
from tickwise.llm.tokens import encoded

LENGTH = 4_096
GRID = 16
PIVOTS = 4_000
BUCKET_PIECES = 1_000

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
PIECE_TYPE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(rows: Iterator[pa.RecordBatch], length: int, path: str | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for some in rows:
        numbers = column(some, "doc_id")
        for lo, ids, first in encoded(column(some, "text"), path):
            raw = memoryview(ids.astype("<u4").tobytes())
            size = np.diff(first)
            pieces = -(-size // length)
            doc = np.repeat(np.arange(len(size)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            begin = first[:-1][doc] + start
            end = np.minimum(begin + length, first[1:][doc])
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            columns = [numbers.take(pa.array(doc + lo)), start, end - begin, crc, size[doc]]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, first[-1]), pa.int32()), pa.array(ids.astype(np.int32))))
            yield batch(_PIECES if with_ids else pa.schema(list(_PIECES)[:-1]), columns)


def cut(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids of every document (null text: empty), the end id included; optionally with their ids."""
    kind = PIECE_TYPE + (", ids array<int>" if with_ids else "")
    return documents_view(docs).mapInArrow(lambda rows: _cut(rows, length, tokenizer, with_ids), kind)


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits ``room`` (unbounded knapsack by dynamic programming)."""
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for space in range(int(sizes[0]), room + 1):
        fits = int(np.searchsorted(sizes, space, "right"))
        worth = value[space - sizes[:fits]] + prices[:fits]
        top = int(worth.argmax())
        # Leaving the last place empty may be better than any piece that ends there.
        value[space], choice[space] = (worth[top], top) if worth[top] > value[space - 1] else (value[space - 1], -1)
    taken, space = np.zeros(len(sizes)), room
    while space > 0:
        if choice[space] < 0:
            space -= 1
        else:
            taken[choice[space]] += 1
            space -= int(sizes[choice[space]])
    return float(value[room]), taken


def generate_columns(sizes: np.ndarray, demand: np.ndarray, room: int, pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used in an optimal fractional solution; ``sizes`` ascend.

    Revised simplex with one entering column a turn. ``pivots`` bounds the turns: stopping early costs padding, never a piece.
    """
    fill = room // sizes
    basis = np.diag(fill.astype(float))
    inverse = np.diag(1.0 / fill)
    amount = demand / fill
    for _ in range(pivots):
        prices = inverse.sum(0)
        worth, column_in = best_pattern(sizes, np.maximum(prices, 0), room)
        if worth <= 1 + 1e-7:
            break
        # Sums and outer products only: threaded linear algebra may wait forever in a driver that also runs a JVM.
        direction = (inverse * column_in).sum(1)
        up = direction > 1e-11
        ratio = np.full(len(sizes), np.inf)
        ratio[up] = amount[up] / direction[up]
        out = int(ratio.argmin())
        step = ratio[out]
        amount = np.maximum(amount - step * direction, 0)
        amount[out] = step
        basis[:, out] = column_in
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
    return basis.T.round().astype(np.int64), amount


def first_fit(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[np.ndarray]:
    """Sequences for what is left, largest pieces first, each sequence filled before the next is begun."""
    left, out = demand.copy(), []
    while left.any():
        taken, space = np.zeros(len(sizes), np.int64), room
        for c in range(len(sizes) - 1, -1, -1):
            if left[c] and sizes[c] <= space:
                taken[c] = min(left[c], space // sizes[c])
                space -= taken[c] * sizes[c]
        # As often as the pieces allow.
        times = int((left[taken > 0] // taken[taken > 0]).min())
        out += [taken] * times
        left = left - taken * times
    return out


def plan(histogram: dict[int, int], length: int = LENGTH, grid: int = GRID, pivots: int = PIVOTS) -> list[tuple[np.ndarray, int]]:
    """Patterns over the classes of ``histogram`` (class to number of pieces) and how often each is used; all pieces are placed."""
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[c] for c in sizes.tolist()], np.int64)
    if not len(sizes):
        return []
    patterns, amount = generate_columns(sizes, demand.astype(float), length // grid, pivots)
    out, left = [], demand.copy()
    for k in np.argsort(-amount, kind="stable"):
        taken = patterns[k]
        # Rounded down, and never more pieces than there are.
        times = min(int(amount[k] + 1e-9), int((left[taken > 0] // taken[taken > 0]).min()))
        if times:
            out.append((taken, times))
            left = left - taken * times
    rest = first_fit(sizes, left, length // grid)
    counted: dict[bytes, int] = {}
    for taken in rest:
        counted[taken.tobytes()] = counted.get(taken.tobytes(), 0) + 1
    return out + [(np.frombuffer(key, np.int64), times) for key, times in counted.items()]


def _places(chosen: list[tuple[np.ndarray, int]], classes: list[int]) -> list[dict]:
    """For each class and pattern: from which rank on pieces of the class go to it, how many to a sequence, from which sequence on."""
    used, sequence, out = np.zeros(len(classes), np.int64), 0, []
    for taken, times in chosen:
        for c in np.flatnonzero(taken).tolist():
            out.append((classes[c], int(used[c]), int(taken[c]), sequence))
        used += taken * times
        sequence += times
    return out


def ranked(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """Adds ``rank``, the number of each piece within its class from 0, without bringing a class together in one task."""
    buckets = max(1, -(-n_pieces // BUCKET_PIECES))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    counts = spread.groupBy("class", "bucket").agg(F.count("*").alias("in_bucket"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("class", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("earlier"))
    order = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    inner = spread.withColumn("inner", F.row_number().over(order) - 1)
    return inner.join(offsets, ["class", "bucket"]).withColumn("rank", F.col("earlier") + F.col("inner")).drop("bucket", "inner", "earlier")


def pack(pieces: DataFrame, length: int = LENGTH, grid: int = GRID, pivots: int = PIVOTS) -> DataFrame:
    """Gives each piece its sequence_id (long, from 0) and offset (long; pieces of a sequence follow each other from 0).

    ``pieces`` is a stored table with doc_id, start, length (1 to ``length``), ids_crc32 and doc_tokens; an empty one gives an
    empty result, repeated rows are pieces of their own.
    """
    spark = pieces.sparkSession
    by_class = pieces.withColumn("class", F.ceil(F.col("length") / F.lit(grid)).cast("int"))
    histogram = {r["class"]: r["n"] for r in by_class.groupBy("class").agg(F.count("*").alias("n")).collect()}
    chosen = plan(histogram, length, grid, pivots)
    places = _places(chosen, sorted(histogram))
    # At most one row for each class and pattern, and both are bounded by length / grid but for the patterns of the rest.
    table = spark.createDataFrame(places, "class int, from_rank long, each long, first_sequence long")
    following = Window.partitionBy("class").orderBy("from_rank")
    table = table.withColumn("to_rank", F.coalesce(F.lead("from_rank").over(following), F.lit(1 << 62)))
    with_rank = ranked(by_class, sum(histogram.values()))
    here = F.col("rank") - F.col("from_rank")
    placed = (with_rank.join(F.broadcast(table), "class").where((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
              .withColumn("sequence_id", F.col("first_sequence") + F.floor(here / F.col("each")).cast("long")))
    along = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in pieces.columns]
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0))).select(*kept, "sequence_id", "offset")


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """All documents as placed pieces: doc_id, start, length, ids_crc32, doc_tokens (, ids), sequence_id, offset."""
    pieces = stored(cut(docs, length, tokenizer, with_ids), "pieces")
    return pack(pieces, length)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids (the whole sequence without padding), doc_ids and lengths of its pieces, from ``pack_documents(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"),
                          F.col("parts.length").alias("lengths"))
