"""Token ids in files compressed by a grammar of pairs (Re-Pair), readable from any token on.

A *block* holds some whole documents. In it the frequent pairs of neighbouring ids are replaced by new symbols, round
after round, until no pair is worth a rule; a rule never spans two documents. Stored are the symbols, the rules and the
number of ids each symbol stands for, so that a reader finds and expands just the symbols that cover the wanted ids.

Files are Parquet, one row per block, written by Spark's own committed writer: a lost executor costs a repeated task. Blocks are
in ascending document order (``part``, ``block``), and none needs more memory than ``BLOCK_IDS`` ids or one document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, documents_view
from tickwise.llm.tokens import encoded

BLOCK_IDS = 400_000
MIN_COUNT = 6
ROUNDS = 6
RULES_PER_ROUND = 3_000
_SLOT_BITS = 16

BLOCK_TYPE = ("part int, block int, first_id long, n_ids long, doc_ids binary, no_id binary, doc_ends binary, base int, "
              "left_symbol binary, right_symbol binary, symbol_ids binary, symbols binary")
_BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                    *((n, pa.binary()) for n in ("doc_ids", "no_id", "doc_ends")), ("base", pa.int32()),
                    *((n, pa.binary()) for n in ("left_symbol", "right_symbol", "symbol_ids", "symbols"))])
_DIGEST = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_crc32", pa.int64())])
_IDS = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("ids", pa.list_(pa.int32()))])


def compress(ids: np.ndarray, first: np.ndarray, base: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, and left and right side of each rule; symbol ``base + k`` stands for rule ``k``.

    ``first`` says where each document's ids begin (one more than documents).
    """
    symbols = ids.astype(np.int64)
    base = int(symbols.max()) + 1 if base is None and len(symbols) else (base or 0)
    border = np.zeros(len(symbols) + 1, dtype=bool)
    border[first] = True
    border = border[:-1]
    left, right, count = [], [], base
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        code = (symbols[:-1] << 32) | symbols[1:]
        code[border[1:]] = -1
        ordered = np.sort(code)
        change = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        times = np.diff(change, append=len(ordered))
        pairs = ordered[change]
        good = np.flatnonzero((times >= MIN_COUNT) & (pairs >= 0))
        if len(good) == 0:
            break
        if len(good) > RULES_PER_ROUND:
            good = good[np.argpartition(-times[good], RULES_PER_ROUND)[:RULES_PER_ROUND]]
        good = good[np.argsort(-times[good], kind="stable")]
        wanted = pairs[good]
        # Most frequent pairs take their slot first; a pair that finds its slot taken waits for a later round.
        slots = _slot(wanted)
        free = np.sort(np.unique(slots, return_index=True)[1])
        wanted, slots = wanted[free], slots[free]
        table = np.full(1 << _SLOT_BITS, -2, np.int64)
        rank = np.full(1 << _SLOT_BITS, 1 << 30, np.int32)
        table[slots], rank[slots] = wanted, np.arange(len(wanted), dtype=np.int32)
        slots = _slot(code)
        place = np.where(table[slots] == code, rank[slots], 1 << 30)
        # Overlapping pairs: the more frequent wins, the left one of equals.
        win = place < (1 << 30)
        win[1:] &= place[1:] < place[:-1]
        win[:-1] &= place[:-1] <= place[1:]
        at = np.flatnonzero(win)
        used = np.zeros(len(wanted), dtype=bool)
        used[place[at]] = True
        number = count + np.cumsum(used) - 1
        left.append(wanted[used] >> 32)
        right.append(wanted[used] & 0xFFFFFFFF)
        count += int(used.sum())
        symbols[at] = number[place[at]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        before = len(symbols)
        symbols, border = symbols[keep], border[keep]
        if len(symbols) > 0.985 * before:
            break
    none = np.zeros(0, np.int64)
    return symbols.astype(np.uint32), np.concatenate([none, *left]).astype(np.uint32), np.concatenate([none, *right]).astype(np.uint32), base


def _slot(code: np.ndarray) -> np.ndarray:
    return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def rule_lengths(left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for; a rule only names symbols made before it."""
    size = np.ones(base + len(left), np.int64)
    done = 0
    while done < len(left):
        # All rules up to the first that names a rule of this stretch.
        newest = np.maximum(left[done:], right[done:])
        late = np.flatnonzero(newest >= base + done)
        stop = done + int(late[0]) if len(late) else len(left)
        size[base + done:base + stop] = size[left[done:stop]] + size[right[done:stop]]
        done = stop
    return size[base:]


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    symbols = symbols.astype(np.int64)
    while len(symbols) and int(symbols.max()) >= base:
        rule = symbols >= base
        at = np.cumsum(1 + rule) - 1 - rule
        out = np.empty(len(symbols) + int(rule.sum()), np.int64)
        out[at] = symbols
        where = at[rule]
        out[where], out[where + 1] = left[symbols[rule] - base], right[symbols[rule] - base]
        symbols = out
    return symbols.astype(np.uint32)


class Block:
    """One stored block, opened for reading."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.left, self.right, self.symbols = (np.frombuffer(row[n], np.uint32) for n in ("left_symbol", "right_symbol", "symbols"))
        self.symbol_ids = np.frombuffer(row["symbol_ids"], np.uint32)
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.no_id = np.frombuffer(row["no_id"], np.bool_)
        self.doc_ends = np.frombuffer(row["doc_ends"], np.int64)
        self._ends: np.ndarray | None = None

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block, expanding only the symbols that cover them."""
        if self._ends is None:
            size = np.ones(len(self.symbols), np.int64)
            rule = self.symbols >= self.base
            size[rule] = self.symbol_ids[self.symbols[rule] - self.base]
            self._ends = np.cumsum(size)
        if stop <= start:
            return np.zeros(0, np.uint32)
        lo, hi = int(np.searchsorted(self._ends, start, "right")), int(np.searchsorted(self._ends, stop, "left")) + 1
        begin = int(self._ends[lo - 1]) if lo else 0
        return expand(self.symbols[lo:hi], self.left, self.right, self.base)[start - begin:stop - begin]

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.left, self.right, self.base)


def _blocks(rows: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    held, docs, size, block, first = [], [], 0, 0, 0

    def close():
        nonlocal held, docs, size, block, first
        ids = np.concatenate(held)
        numbers = pa.concat_arrays([d for d, _ in docs])
        ends = np.concatenate([e for _, e in docs])
        symbols, left, right, base = compress(ids, np.concatenate([[0], ends]))
        missing = np.asarray(numbers.is_null())
        out = batch(_BLOCK, [[part], [block], [first], [len(ids)], [numbers.fill_null(0).to_numpy().astype(np.int64).tobytes()],
                             [missing.tobytes()], [ends.astype(np.int64).tobytes()], [base], [left.tobytes()], [right.tobytes()],
                             [rule_lengths(left.astype(np.int64), right.astype(np.int64), base).astype(np.uint32).tobytes()],
                             [symbols.tobytes()]])
        held, docs, size, block, first = [], [], 0, block + 1, first + len(ids)
        return out

    for rows_in in rows:
        numbers = column(rows_in, "doc_id")
        for lo, ids, begin in encoded(column(rows_in, "text"), path):
            row = 0
            while row < len(begin) - 1:
                # As many whole documents as still fit, and one at least into an empty block.
                last = int(np.searchsorted(begin, begin[row] + BLOCK_IDS - size, "right")) - 1
                last = min(last, len(begin) - 1)
                if last <= row:
                    if size:
                        yield close()
                        continue
                    last = row + 1
                held.append(ids[begin[row]:begin[last]])
                docs.append((numbers.slice(lo + row, last - row), begin[row + 1:last + 1] - begin[row] + size))
                size += int(begin[last] - begin[row])
                row = last
    if docs:
        yield close()


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Encode every whole text of ``docs`` (doc_id, text), end id 2 after each, into block files in ``folder``.

    Null texts count as empty, documents without a number come first, those with equal numbers in the order of a hash
    of their text, an empty table gives a folder without blocks. Other columns are not read. One range shuffle by document puts
    the files in document order; long runs of one number are split like any other.
    """
    ordered = documents_view(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    ordered.mapInArrow(lambda rows: _blocks(rows, tokenizer), BLOCK_TYPE).write.parquet(folder)


def _opened(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for some in rows:
        for k in range(some.num_rows):
            row = some.slice(k, 1).to_pylist()[0]
            yield row, Block(row)


def _digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, block in _opened(rows):
        raw = memoryview(block.all().astype("<u4").tobytes())
        starts = np.concatenate([[0], block.doc_ends[:-1]])
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), block.doc_ends.tolist(), strict=True)]
        yield batch(_DIGEST, [np.full(len(crc), row["part"], np.int32), pa.array(block.doc_ids, mask=block.no_id),
                              row["first_id"] + starts, block.doc_ends - starts, crc])


def _id_lists(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, block in _opened(rows):
        starts = np.concatenate([[0], block.doc_ends[:-1]])
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], block.doc_ends]), pa.int32()), pa.array(block.all().astype(np.int32)))
        yield batch(_IDS, [np.full(len(starts), row["part"], np.int32), pa.array(block.doc_ids, mask=block.no_id),
                           row["first_id"] + starts, ids])


def _with_start(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before; sums run over parts, of which there are as many as files."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    return df.join(F.broadcast(bases), "part").withColumn("start", F.col("part_start") + F.col("at"))


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK_TYPE).parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and the whole list of ids of each document."""
    blocks = read_blocks(spark, folder)
    lists = blocks.mapInArrow(_id_lists, "part int, doc_id long, at long, ids array<int>")
    return _with_start(lists, blocks).select("doc_id", "start", "ids")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers, decoded from the files."""
    blocks = read_blocks(spark, folder)
    found = blocks.mapInArrow(_digests, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return _with_start(found, blocks).select("doc_id", "start", "n_tokens", "ids_crc32")
