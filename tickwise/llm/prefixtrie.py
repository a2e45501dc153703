"""The trie of conversation prefixes, with totals of every node's subtree, by time-forward processing.

A node is a distinct sequence of turns; the conversations that start with it are its members. The smallest member and the depth
name a node, so that no text is kept. A prefix is known by the sums of two 60-bit hashes of (place, role, text), which running
sums over blocks of places give without walking a conversation in one task.

Totals go upwards as messages, in time-forward order: nodes are sorted by reverse level order, each takes what its children sent
from a priority queue, adds its own and sends the sum to its parent. The queue spills sorted runs beyond a size. A shard is a largest
subtree part whose nodes' member counts lie in one band (up to 1,000, up to 1,000,000, ...): it has fewer than
1,000 nodes a level whatever the table's size. Shards of the lowest band are worked off first, side by side; what their roots have
in all is summed per parent and handed to the next band, until the root of the trie is reached. Nodes of a single member are chains without
savings, whose totals need no messages.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, small_enough, stored

BAND = 1_000
PLACES = 10_000
HEAVY = 1_000
QUEUE = 500_000
ROWS_OUT = 50_000

_NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])
_ENDS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])


class SpillingQueue:
    """A priority queue of tuples; beyond ``most`` in memory, the later half is written as a sorted run, read back as it is reached."""

    def __init__(self, most: int):
        self.most, self.heap, self.runs = most, [], []

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, (entry, -1))
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        everything = sorted(self.heap)
        later = [e for e, run in everything[self.most // 2:] if run < 0]
        self.heap = everything[:self.most // 2] + [e for e in everything[self.most // 2:] if e[1] >= 0]
        heapq.heapify(self.heap)
        # Like Spark's own spills and beside them: a nameless file that nobody else reads and that goes with the task.
        file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        for lo in range(0, len(later), 1_000):
            pickle.dump(later[lo:lo + 1_000], file, protocol=5)
        file.seek(0)
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heap, (entry, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """The entries that begin with ``key``, which must be the least of the queue or absent."""
        n = len(key)
        while self.heap and self.heap[0][0][:n] == key:
            entry, run = heapq.heappop(self.heap)
            if run >= 0:
                self._advance(run)
            yield entry

    def clear(self) -> None:
        self.heap, self.runs = [], []


def _forward(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Totals of all nodes of this task's shards, which come one after another, each in reverse level order."""
    queue, shard, out = SpillingQueue(most), None, []
    names = ["top_conv", "top_depth", "conv_id", "depth", "own", "parent_conv_id", "is_top", "children", "leaves", "saved"]
    for some in rows:
        for top_conv, top_depth, conv, depth, own, parent, is_top, children, leaves, saved in zip(
                *(column(some, n).to_pylist() for n in names), strict=True):
            if (top_conv, top_depth) != shard:
                shard = (top_conv, top_depth)
                queue.clear()
            for _, _, more_leaves, more_saved in queue.take((-depth, -conv)):
                children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
            leaves, saved = leaves if children else 1, saved + own
            if not is_top:
                queue.push((1 - depth, -parent, leaves, saved))
            out.append((conv, depth, children, leaves, saved))
            if len(out) >= ROWS_OUT:
                yield batch(_NODE, list(zip(*out, strict=True)))
                out = []
    if out:
        yield batch(_NODE, list(zip(*out, strict=True)))


def _ends(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, which come in ascending order; only the digest's state is held."""
    node, digest = None, None
    for some in rows:
        out = []
        conv, depth, member = (column(some, n).to_numpy() for n in ("conv_id", "depth", "member"))
        cut = np.flatnonzero((np.diff(conv) != 0) | (np.diff(depth) != 0)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(conv)], strict=True):
            if lo == hi:
                continue
            here, ids = (int(conv[lo]), int(depth[lo])), ",".join(map(str, member[lo:hi].tolist())).encode()
            if here == node:
                digest.update(b"," + ids)
                continue
            if node is not None:
                out.append((*node, digest.hexdigest()))
            node, digest = here, hashlib.sha256(ids)
        if out:
            yield batch(_ENDS, list(zip(*out, strict=True)))
    if node is not None:
        yield batch(_ENDS, [[node[0]], [node[1]], [digest.hexdigest()]])


def _number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's place within its conversation's part in this task."""
    last, count = None, 0
    for some in rows:
        conv = column(some, "conv_id").to_numpy()
        if len(conv):
            first = np.concatenate([[0], np.flatnonzero(np.diff(conv)) + 1])
            place = np.arange(len(conv)) - np.repeat(first, np.diff([*first, len(conv)])) + 1
            if last == conv[0]:
                place[:first[1] if len(first) > 1 else len(conv)] += count
            last, count = int(conv[-1]), int(place[-1])
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(place, pa.int64())], names=[*some.schema.names, "part_place"])


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text, stored: a conversation that lies over several tasks is numbered through all of them."""
    clean = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    spread = clean.repartitionByRange(parts, "conv_id", "turn", "role", F.xxhash64("text")).sortWithinPartitions("conv_id", "turn", "role", "text")
    spread = spread.withColumn("task", F.spark_partition_id()).drop("turn")
    numbered = stored(spread.mapInArrow(_number, "conv_id long, role string, text string, task int, part_place long"), "turns")
    # Each task but the last leaves one conversation open at most, so these rows are no more than tasks.
    counts = numbered.groupBy("conv_id", "task").agg(F.max("part_place").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.withColumn("before", F.sum("n").over(before)).where("before is not null").select("conv_id", "task", "before"), "starts")
    placed = numbered.join(F.broadcast(starts), ["conv_id", "task"], "left")
    return placed.select("conv_id", (F.col("part_place") + F.coalesce("before", F.lit(0))).alias("place"), "role", "text")


def _shared_heads(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 6


def rebuilt_conversations(ordered: DataFrame, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, role, text) of every rebuilt conversation, and (conv_id, length) of all, turnless ones included.

    The first h turns come from the conversation conv_id - conv_id % group, the others are the own ones after the h-th; h is crc32(conv_id) % 6.
    """
    sizes = stored(ordered.groupBy("conv_id").agg(F.max("place").alias("own")), "sizes")
    base = F.col("conv_id") - F.col("conv_id") % group
    wanted = sizes.select("conv_id", "own", _shared_heads(F.col("conv_id")).alias("h"), base.alias("base"))
    known = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    wanted = wanted.join(known, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    wanted = stored(wanted.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "rebuilt")
    heads = ordered.where("place <= 5").select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "role", "text")
    heads = wanted.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("depth <= taken")
    # h needs the conversation's number alone; only whether its base is missing or short takes a join, and few conversations need it.
    h = _shared_heads(F.col("conv_id"))
    own = ordered.where(F.col("place") > h)
    short = wanted.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    tail = own.join(F.broadcast(short) if small_enough(stored(short, "short"), 16) else short, "conv_id", "left")
    tail = tail.select("conv_id", (F.col("place") - F.coalesce("less", F.lit(0))).alias("depth"), "role", "text")
    return heads.select("conv_id", "depth", "role", "text").unionByName(tail), wanted.select("conv_id", "length")


def _prefix_sums(rebuilt: DataFrame) -> DataFrame:
    """conv_id, depth, size (code points of the turn) and the two sums that stand for the prefix: per block of places, then within blocks."""
    said = F.sha2(F.concat_ws("\n", F.col("depth").cast("string"), F.length("role").cast("string"), F.concat("role", "text")), 256)
    part = lambda at: F.conv(F.substring(said, at, 15), 16, 10).cast("decimal(38,0)")
    marked = stored(rebuilt.select("conv_id", "depth", F.length("text").cast("long").alias("size"), part(1).alias("a"), part(16).alias("b"),
                                   F.floor(F.col("depth") / PLACES).alias("block")), "marked")
    blocks = marked.groupBy("conv_id", "block").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in "ab"])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.sum(c).over(before).cast("decimal(38,0)").alias(f"{c}0") for c in "ab"]).where("a0 is not null")
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = marked.select("conv_id", "block", "depth", "size", *[F.sum(c).over(inside).cast("decimal(38,0)").alias(c) for c in "ab"])
    sums = sums.join(blocks, ["conv_id", "block"], "left")
    return sums.select("conv_id", "depth", "size", *[(F.col(c) + F.coalesce(f"{c}0", F.lit(0))).cast("decimal(38,0)").alias(c) for c in "ab"])


def _with_nodes(places: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each place with its node's owner and member count. Nodes of many members are sent to all tasks if measured small, the others meet by shuffle."""
    keys, named = ["depth", "a", "b"], ["owner", "n_convs"]
    heavy = nodes.where(F.col("n_convs") > HEAVY)
    if not small_enough(heavy, 64):
        return places.join(nodes.select(*keys, *named), keys)
    heavy = heavy.select(*keys, *[F.col(c).alias(f"heavy_{c}") for c in named])
    marked = places.join(F.broadcast(heavy), keys, "left")
    found = marked.where("heavy_owner is not null").select("conv_id", *keys, "size", *[F.col(f"heavy_{c}").alias(c) for c in named])
    light = marked.where("heavy_owner is null").select("conv_id", *keys, "size")
    light = light.join(nodes.where(F.col("n_convs") <= HEAVY).select(*keys, *named), keys)
    return found.unionByName(light.select(*found.columns))


def prefix_trie(turns: DataFrame, group: int = 100, band: int | None = None, queue: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Rows without conv_id belong to no conversation and take no part; null roles
    and texts count as empty; turns with equal numbers are ordered by role and text, null numbers first; repeated rows are turns of
    their own. An empty table has no conversations and gives no rows. The ids that end in one node are hashed in order by one task, which holds
    none of them; all else of a node with very many members or children is summed before it is shuffled.
    """
    band, queue = BAND if band is None else band, QUEUE if queue is None else queue
    rebuilt, lengths = rebuilt_conversations(ordered_turns(turns), group)
    sums = stored(_prefix_sums(rebuilt), "prefixes")
    total, root = lengths.agg(F.count("*"), F.min("conv_id")).first()
    nodes = stored(sums.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")), "nodes")
    long = lambda value: F.lit(value).cast("long")
    places = stored(_with_nodes(sums, nodes).select("conv_id", "depth", "size", "owner", "n_convs"), "places")

    above = places.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"), F.col("n_convs").alias("parent_n"))
    owned = places.where("conv_id = owner").join(above, ["conv_id", "depth"], "left")
    owned = owned.select("conv_id", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("own"),
                         F.coalesce("parent_conv_id", long(root)).alias("parent_conv_id"), F.coalesce("parent_n", long(total)).alias("parent_n"))
    tree = stored(owned, "tree")
    ends = _end_digests(places, lengths, root)

    # Chains of one member: their nodes are known, and their top sends one leaf to its parent.
    alone = tree.where("n_convs = 1").join(lengths, "conv_id")
    alone = alone.select("conv_id", "depth", "parent_conv_id", "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
                         long(1).alias("n_leaves"), long(0).alias("saved_tokens"))
    sent = tree.where("n_convs = 1 and (parent_n > 1 or depth = 1)").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    sent = stored(sent.agg(F.count("*").alias("children"), F.count("*").alias("leaves"), long(0).alias("saved")), "messages")

    spark = turns.sparkSession
    top = spark.createDataFrame([(root, 0, total, 0, None, None)] if total else [],
                                "conv_id long, depth long, n_convs long, own long, parent_conv_id long, parent_n long")
    # The root is worked off even when it has one member alone.
    shared = stored(tree.where("n_convs > 1").unionByName(top).withColumn("band", _band("n_convs", band)), "shared")
    tops = places.where("n_convs > 1").select("conv_id", "depth", "owner", _band("n_convs", band).alias("band"))
    tops = tops.groupBy("conv_id", "band").agg(F.min(F.struct("depth", "owner")).alias("top"))
    last = shared.agg(F.max("band")).first()[0]
    done = []
    for level in range(0, last + 1 if last is not None else 0):
        mine = shared.where(F.col("band") == level).join(tops.where(F.col("band") == level).drop("band"), "conv_id", "left")
        in_top = _band("n_convs", band) == (_band("parent_n", band) if level < last else F.lit(-1))
        if level == last:
            # The root's own band is one shard.
            mine = mine.withColumn("top_conv", long(root)).withColumn("top_depth", long(0))
            in_top = F.col("parent_n").isNotNull()
        else:
            mine = mine.withColumn("top_conv", F.col("top.owner")).withColumn("top_depth", F.col("top.depth"))
        mine = mine.withColumn("is_top", ~in_top).drop("top").join(sent, ["conv_id", "depth"], "left").fillna(0, ["children", "leaves", "saved"])
        ready = mine.select("top_conv", "top_depth", "conv_id", "depth", "own", "parent_conv_id", "is_top", "children", "leaves", "saved")
        ready = ready.repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", F.desc("depth"), F.desc("conv_id"))
        totals = ready.mapInArrow(lambda it: _forward(it, queue), "conv_id long, depth long, n_children long, n_leaves long, saved_tokens long")
        finished = stored(shared.where(F.col("band") == level).select("conv_id", "depth", "n_convs", "parent_conv_id", "parent_n")
                          .join(totals, ["conv_id", "depth"]), f"band-{level}")
        done.append(finished)
        leaving = finished.where(F.col("parent_n").isNotNull() & (_band("parent_n", band) > level) & F.lit(level < last))
        leaving = leaving.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
            F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        sent = stored(sent.unionByName(leaving).groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]), "messages")
    out = alone
    for finished in done:
        out = out.unionByName(finished.select(*alone.columns))
    out = out.join(ends, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _band(members: str, band: int) -> Column:
    """How often ``band`` must be multiplied, above once, to reach the member count: 0 up to ``band``, 1 up to its square, and so on."""
    level = F.lit(0)
    for k in range(1, 7):
        level = level + (F.col(members) > F.lit(float(band) ** k)).cast("int")
    return level


def _end_digests(places: DataFrame, lengths: DataFrame, root: int | None) -> DataFrame:
    """conv_id, depth, ends_sha256 of the nodes in which conversations end."""
    last = places.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    last = last.select(F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    empty = lengths.where("length = 0").select(F.lit(root).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    return last.unionByName(empty).repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member").mapInArrow(
        _ends, "conv_id long, depth long, ends_sha256 string")
