"""Ranked lexical search without a document index: an automaton of all query terms scans the texts.

The terms of all items go into one Aho-Corasick automaton, each guarded by a boundary on either side, so that a match is a whole term.
Texts are scanned twice: the first pass sums, over all documents, how many there are, how many terms they have and how
many documents hold each query term; the second counts each term's occurrences again, scores, and keeps the best
documents of each item per task. Nothing is written per document, and documents are never shuffled. Items are taken in blocks of
bounded size; the automaton's outputs map to items by two matrices, one dense for terms that many items share.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, documents_view, shared_path, stored
from tickwise.llm.words import SLICE_BYTES, process_state

ITEM_BYTES = 4_000_000
ITEM_COUNT = 4_096
SCORE_CELLS = 2_000_000
DENSE_SHARE = 16
MERGE_WAYS = 32

# All ASCII signs and controls part terms; A-Z are lowered; bytes of other scripts stay.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

_STATS = pa.schema([("term", pa.int32()), ("n", pa.int64())])
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
DOCUMENTS, TERMS = -1, -2


def folded(text: str | bytes) -> bytes:
    """The terms of a text, lowered and parted by spaces, with a space on either side."""
    return b" " + (text.encode() if isinstance(text, str) else text).translate(_FOLD) + b" "


class Items:
    """The terms of a block of items and which item holds which term how often."""

    def __init__(self, texts: list[str | None]):
        self.terms: dict[str, int] = {}
        held = [{} for _ in texts]
        for mine, text in zip(held, texts, strict=True):
            for term in folded(text or "").decode("latin-1").split(" "):
                if term:
                    k = self.terms.setdefault(term, len(self.terms))
                    mine[k] = mine.get(k, 0) + 1
        self.n_items = len(texts)
        triples = np.array([(t, i, c) for i, mine in enumerate(held) for t, c in mine.items()], np.int64).reshape(-1, 3)
        triples = triples[np.lexsort((triples[:, 1], triples[:, 0]))]
        self.items, self.times = triples[:, 1], triples[:, 2]
        self.first = np.searchsorted(triples[:, 0], np.arange(len(self.terms) + 1))
        self.dense = np.flatnonzero(np.diff(self.first) * DENSE_SHARE > max(self.n_items, DENSE_SHARE))

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, k in self.terms.items():
            found.add_word(f" {term} ", k)
        found.make_automaton()
        return found

    def dense_matrix(self, kind: type) -> np.ndarray:
        out = np.zeros((len(self.dense), self.n_items), kind)
        for row, t in enumerate(self.dense.tolist()):
            span = slice(self.first[t], self.first[t + 1])
            out[row, self.items[span]] = self.times[span]
        return out


def _texts(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Rows and folded texts, about ``SLICE_BYTES`` of text at a time, or one text if that is longer."""
    texts, rows, held, size = column(part, "text"), [], [], 0
    for k in range(part.num_rows):
        buffer = texts[k].as_buffer()
        if buffer is None:
            continue
        rows.append(k)
        held.append(folded(buffer.to_pybytes()))
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield np.array(rows), held
            rows, held, size = [], [], 0
    if rows:
        yield np.array(rows), held
    pa.default_memory_pool().release_unused()


def _matches(automaton, texts: list[bytes], n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs, as one number text * n_terms + term, how often each is matched, and the number of terms of each text."""
    joined = b"".join(texts)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    space = np.frombuffer(joined, np.uint8) == 32
    begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    counts = np.diff(np.searchsorted(begins, edges))
    if not n_terms:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    pairs = np.fromiter(chain.from_iterable(automaton.iter(joined.decode("latin-1"))), np.int64).reshape(-1, 2)
    keys = (np.searchsorted(edges, pairs[:, 0], "right") - 1) * n_terms + pairs[:, 1]
    keys, tf = np.unique(keys, return_counts=True)
    return keys, tf, counts


def _loaded(name: str, data) -> tuple[Items, object]:
    """The items and their automaton, made once per worker process."""
    held = process_state("termscan")
    if name not in held:
        held.clear()
        items = pickle.loads(data.value)
        held[name] = (items, items.automaton() if items.terms else None)
    return held[name]


def _count(rows: Iterator[pa.RecordBatch], name: str, data) -> Iterator[pa.RecordBatch]:
    items, automaton = _loaded(name, data)
    n_terms = len(items.terms)
    df, documents, length = np.zeros(n_terms, np.int64), 0, 0
    for some in rows:
        for _, texts in _texts(some):
            keys, _, counts = _matches(automaton, texts, n_terms)
            if n_terms:
                df += np.bincount(keys % n_terms, minlength=n_terms)
            documents += int(np.count_nonzero(counts))
            length += int(counts.sum())
    seen = np.flatnonzero(df)
    yield batch(_STATS, [[DOCUMENTS, TERMS, *seen.tolist()], [documents, length, *df[seen].tolist()]])


def _scores(items: Items, dense: np.ndarray, n_texts: int, doc: np.ndarray, term: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Sums of ``part`` over each item's terms: in doubles where no sum can leave their whole numbers, else in 64-bit integers."""
    where = np.full(len(items.terms), -1)
    where[items.dense] = np.arange(len(items.dense))
    many = where[term] >= 0
    table = np.zeros((n_texts, len(items.dense)), dense.dtype)
    table[doc[many], where[term[many]]] = part[many]
    out = table @ dense
    doc, term, part = doc[~many], term[~many], part[~many]
    size = items.first[term + 1] - items.first[term]
    at = np.repeat(items.first[term] - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size, size) + np.arange(size.sum())
    cells = np.repeat(doc, size) * items.n_items + items.items[at]
    more = np.repeat(part, size) * items.times[at]
    if dense.dtype == np.float64:
        out += np.bincount(cells, more, minlength=out.size).reshape(out.shape)
    else:
        np.add.at(out.reshape(-1), cells, more)
    return out


def _keep_best(item: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, item))
    item, ids, score = item[order], ids[order], score[order]
    best = np.arange(len(item)) - np.searchsorted(item, item) < k
    return item[best], ids[best], score[best]


def _rank(rows: Iterator[pa.RecordBatch], name: str, data, weights, n_docs: int, n_terms_all: int, k: int) -> Iterator[pa.RecordBatch]:
    items, automaton = _loaded(name, data)
    n_terms, weight = len(items.terms), pickle.loads(weights.value)
    most = np.bincount(items.items, weight[np.repeat(np.arange(n_terms), np.diff(items.first))] * items.times).max()
    dense = items.dense_matrix(np.float64 if most * 1e6 < 2 ** 53 else np.int64)
    none = np.zeros(0, np.int64)
    best, least = (none, none, none), np.zeros(items.n_items, np.int64)
    step = max(1, SCORE_CELLS // max(items.n_items, len(items.dense), 1))
    for some in rows:
        ids = column(some, "doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        for row, texts in _texts(some):
            keys, tf, counts = _matches(automaton, texts, n_terms)
            doc, term = keys // n_terms, keys % n_terms
            # Exact for texts of any length: counts of terms times counts of documents may leave 64 bits, so Python integers divide.
            m = np.array([100 - 25 + 25 * int(n) * n_docs // n_terms_all for n in counts], np.int64)
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            for lo in range(0, len(texts), step):
                hi = min(lo + step, len(texts))
                a, b = np.searchsorted(doc, [lo, hi])
                scores = _scores(items, dense, hi - lo, doc[a:b] - lo, term[a:b], part[a:b])
                # What is below an item's k-th best so far cannot enter; an equal score may, by a smaller doc_id.
                d, i = np.nonzero((scores >= np.maximum(least, 1)) & known[row[lo:hi]][:, None])
                if len(d):
                    new = (i, ids[row[lo:hi]][d], scores[d, i].astype(np.int64))
                    best = _keep_best(*(np.concatenate(p) for p in zip(best, new, strict=True)), k)
                    full = np.flatnonzero(np.bincount(best[0], minlength=items.n_items) == k)
                    least[full] = best[2][np.searchsorted(best[0], full, "right") - 1]
    if len(best[0]):
        yield batch(_FOUND, [best[0].astype(np.int32), best[1], best[2]])


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int | None = None, item_count: int | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text) with a score above 0.

    Terms are the longest runs of letters, digits and characters outside ASCII, only A-Z lowered. A null or empty text has no terms:
    such an item finds nothing, such a document is not counted. Every row of ``docs`` is a document, repeated ones too; rows without
    doc_id count in the statistics but are never listed. Every row of ``items`` is an item: a repeated item_id, null included, has a
    list for each of its rows. Ties go to the smaller doc_id. Empty tables give no rows; other columns are not read. One text
    is the least that a task holds, folded, whatever its length.
    """
    spark = docs.sparkSession
    item_bytes, item_count = ITEM_BYTES if item_bytes is None else item_bytes, ITEM_COUNT if item_count is None else item_count
    docs = documents_view(docs)
    items = stored(items.select("item_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("_row")), "items")
    size, rows = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    blocks = max(1, -(-(size or 0) // item_bytes), -(-rows // item_count))
    results = None
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == b).orderBy("_row").toArrow()
        block = Items(mine.column("text").to_pylist())
        name = shared_path(spark, "terms")
        sent = spark.sparkContext.broadcast(pickle.dumps(block, protocol=5))
        counted = docs.select("text").mapInArrow(lambda it, name=name, sent=sent: _count(it, name, sent), "term int, n long")
        counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n_docs, length = counts.get(DOCUMENTS, 0), counts.get(TERMS, 0)
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
        if len(block.terms) and n_docs:
            weights = spark.sparkContext.broadcast(pickle.dumps(weight, protocol=5))
            found = docs.mapInArrow(lambda it, name=name, sent=sent, weights=weights, n_docs=n_docs, length=length:
                                    _rank(it, name, sent, weights, n_docs, length, k), "item int, doc_id long, score long")
            found = stored(found.withColumn("way", F.spark_partition_id() % MERGE_WAYS), "found")
            weights.destroy()
            best = _top(_top(found, ["item", "way"], k).drop("rank"), ["item"], k)
            named = spark.createDataFrame(mine.select(["item_id"]).append_column("item", pa.array(np.arange(block.n_items), pa.int32())))
            best = best.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
            results = best if results is None else results.unionByName(best)
        sent.destroy()
    if results is None:
        return spark.createDataFrame([], items.select("item_id").schema.add("rank", "integer").add("doc_id", "long").add("score", "long"))
    return results
