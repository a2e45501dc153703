"""Benchmark decontamination: BM25 retrieval of test items for every passage of every document, then exact verification.

The inverted index is over the test items; the passages of the corpus are the queries. An item's impacts are divided by its own full score, so
that one threshold (``SHARE`` of the item's score) holds for all items. Retrieval is block-max WAND, worked on many passages at once:

1. Terms that all together cannot lift an item over the threshold are not essential to it; only passages that hold an essential term of
   a block of items meet that block.
2. The sum of the block's largest impacts over the passage's terms bounds each item's score; blocks below the threshold are skipped.
3. The items of blocks that are left are scored exactly; all above the threshold are retrieved.

Each is then verified: five-word shingles shared with the passage must cover ``OVERLAP`` of the words of the question and of the answer; a part of
fewer words is one shingle by itself, so that a label or other words may stand between question and answer.
Words are runs of letters and digits with A-Z folded, so marks glued to a word do not hide it. Passages are twice as long as the longest item and
overlap by half, so that any copy lies whole in one.

The index of a block of test items (``INDEX_BYTES`` of text) goes to every task; a larger benchmark is taken in several passes
with common statistics. Documents are never shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import arrow_schema, batch, column, documents_view, stored
from tickwise.llm.words import Words, slices, split, strings

SHARE = 0.6
OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
LEAST_STRIDE = 64
INDEX_BYTES = 8_000_000
DENSE = 20_000_000
_FILTER_BITS = 20

_TERMS = pa.schema([("item_id", pa.int64()), ("place", pa.int32()), ("term", pa.int64()), ("answer", pa.bool_())])
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                   ("answer_overlap", pa.float64()), ("first_word", pa.int64())])
HIT_TYPE = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def plain_words(texts: pa.Array) -> Words:
    """Runs of letters and digits; pieces of signs alone are left out."""
    words = split(texts, pieces=True)
    if not len(words.starts):
        return words
    lead = words.data[words.starts]
    keep = (lead >= 128) | ((lead >= 48) & (lead < 58)) | ((lead >= 65) & (lead < 91)) | ((lead >= 97) & (lead < 123))
    before = np.concatenate([[0], np.cumsum(keep)])
    return Words(words.data, words.starts[keep], words.ends[keep], words.hashes[keep], before[words.first], words.sums)


def _answer_start(text: bytes, words: Words, lo: int, hi: int) -> int:
    """From which word on an item is its answer: its last line, else its last sentence, else its last quarter."""
    for marks in (b"\n", b".?!"):
        for k in range(hi - 1, lo, -1):
            between = text[words.ends[k - 1]:words.starts[k]]
            if any(m in between for m in marks):
                return k
    return max(lo + (0 if hi - lo == 1 else 1), hi - max(1, (hi - lo) // 4)) if hi > lo else hi


def _item_terms(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in rows:
        texts = strings(column(some, "text"))
        for lo, hi in slices(texts):
            words = plain_words(pa.concat_arrays([texts.slice(lo, hi - lo)]))
            data = words.data.tobytes()
            size = np.diff(words.first)
            starts = np.array([_answer_start(data, words, int(a), int(b)) for a, b in zip(words.first[:-1], words.first[1:], strict=True)], np.int64)
            item = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(item)) - words.first[:-1][item]
            yield batch(_TERMS, [column(some, "item_id").take(pa.array(item + lo)), place.astype(np.int32), words.hashes.view(np.int64),
                                 np.arange(len(item)) >= starts[item]])


class Index(NamedTuple):
    """Postings of a block of test items, by term and by (term, item block)."""

    items: np.ndarray
    word_first: np.ndarray
    word_terms: np.ndarray
    is_answer: np.ndarray
    terms: np.ndarray
    known: np.ndarray
    essential_first: np.ndarray
    essential_block: np.ndarray
    keys: np.ndarray
    largest: np.ndarray
    posting_first: np.ndarray
    posting_item: np.ndarray
    posting_impact: np.ndarray
    blocks: int
    share: float


def build_index(rows: dict[str, np.ndarray], n_items: int, mean_words: float, share: float) -> Index:
    """``rows``: item_id, place, term, answer, df of every word of the items of this block, in item and place order."""
    items, first = np.unique(rows["item_id"], return_index=True)
    word_first = np.append(first, len(rows["item_id"]))
    item = np.repeat(np.arange(len(items)), np.diff(word_first))
    terms, term = np.unique(rows["term"].view(np.uint64), return_inverse=True)
    key, at, tf = np.unique(term.astype(np.int64) * max(len(items), 1) + item, return_index=True, return_counts=True)
    p_term, p_item, df = key // max(len(items), 1), key % max(len(items), 1), rows["df"][at]
    idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * np.diff(word_first)[p_item] / max(mean_words, 1))
    weight = idf * tf * (K1 + 1) / (tf + norm)
    impact = weight / np.bincount(p_item, weight, len(items))[p_item]
    # Essential: all but the smallest impacts of an item whose sum stays below the threshold.
    order = np.lexsort((impact, p_item))
    sums = np.cumsum(impact[order])
    start = np.searchsorted(p_item[order], np.arange(len(items)))
    inside = sums - np.where(start > 0, sums[start - 1], 0)[p_item[order]]
    essential = np.zeros(len(key), dtype=bool)
    essential[order] = inside >= share - 1e-9
    blocks = -(-len(items) // BLOCK_ITEMS)
    pair = np.unique(p_term[essential] * max(blocks, 1) + p_item[essential] // BLOCK_ITEMS)
    block_key = p_term * max(blocks, 1) + p_item // BLOCK_ITEMS
    keys, posting_first = np.unique(block_key, return_index=True)
    known = np.zeros(1 << _FILTER_BITS, dtype=bool)
    known[(terms & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    return Index(items, word_first, rows["term"].view(np.uint64), rows["answer"], terms, known,
                 np.searchsorted(pair, np.arange(len(terms) + 1) * max(blocks, 1)), pair % max(blocks, 1), keys,
                 np.maximum.reduceat(impact, posting_first) if len(keys) else impact, np.append(posting_first, len(key)), p_item, impact, blocks, share)


def _expand(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``at`` of a ragged table: the row number of each entry, and the entry's position."""
    size = first[at + 1] - first[at]
    row = np.repeat(np.arange(len(at)), size)
    return row, np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def retrieve(words: Words, index: Index, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document row, first word, item number and score (share of the item's own score) of every passage and item above the threshold."""
    none = np.zeros(0, np.int64)
    n = np.diff(words.first)
    passages = np.maximum(1, -(-n // stride) - 1)
    passage_first = np.concatenate([[0], np.cumsum(passages)])
    maybe = np.flatnonzero(index.known[(words.hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    if not len(maybe) or not len(index.terms):
        return none, none, none, none.astype(float)
    term = np.minimum(np.searchsorted(index.terms, words.hashes[maybe]), len(index.terms) - 1)
    fine = index.terms[term] == words.hashes[maybe]
    at, term = maybe[fine], term[fine]
    doc = np.searchsorted(words.first, at, "right") - 1
    step = (at - words.first[doc]) // stride
    here = passage_first[doc] + step
    one, two = step < passages[doc], step > 0
    key = np.unique(np.concatenate([here[one] * len(index.terms) + term[one], (here[two] - 1) * len(index.terms) + term[two]]))
    p, t = key // len(index.terms), key % len(index.terms)
    row, entry = _expand(index.essential_first, t)
    met = np.unique(p[row] * index.blocks + index.essential_block[entry])
    mp, mb = met // index.blocks, met % index.blocks
    term_first = np.searchsorted(p, np.arange(passage_first[-1] + 1))
    out_p, out_item, out_score = [], [], []
    dense = None
    if len(index.terms) * index.blocks <= DENSE:
        dense = np.zeros(len(index.terms) * index.blocks, np.float32)
        dense[index.keys] = index.largest
    # In runs of bounded size, whatever the slice holds.
    for lo in range(0, len(mp), 50_000):
        a, b = mp[lo:lo + 50_000], mb[lo:lo + 50_000]
        row, entry = _expand(term_first, a)
        wanted = t[entry] * index.blocks + b[row]
        if dense is not None:
            value = dense[wanted]
        else:
            place = np.minimum(np.searchsorted(index.keys, wanted), len(index.keys) - 1)
            value = np.where(index.keys[place] == wanted, index.largest[place], 0)
        bound = np.bincount(row, value, len(a))
        left = np.flatnonzero(bound >= index.share - 1e-6)
        if not len(left):
            continue
        a, b = a[left], b[left]
        row, entry = _expand(term_first, a)
        wanted = t[entry] * index.blocks + b[row]
        place = np.minimum(np.searchsorted(index.keys, wanted), len(index.keys) - 1)
        held = index.keys[place] == wanted
        row, place = row[held], place[held]
        inner, posting = _expand(index.posting_first, place)
        cell = row[inner] * BLOCK_ITEMS + index.posting_item[posting] % BLOCK_ITEMS
        score = np.bincount(cell, index.posting_impact[posting], len(a) * BLOCK_ITEMS)
        good = np.flatnonzero(score >= index.share)
        out_p.append(a[good // BLOCK_ITEMS])
        out_item.append(b[good // BLOCK_ITEMS] * BLOCK_ITEMS + good % BLOCK_ITEMS)
        out_score.append(score[good])
    if not out_p:
        return none, none, none, none.astype(float)
    p, item, score = np.concatenate(out_p), np.concatenate(out_item), np.concatenate(out_score)
    doc = np.searchsorted(passage_first, p, "right") - 1
    return doc, words.first[doc] + (p - passage_first[doc]) * stride, item, score


def _run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k:k + len(out)]
        out ^= out >> np.uint64(29)
    return out


def _spread(found: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a found run of ``size`` words."""
    covered = np.zeros(n, dtype=bool)
    for k in range(size if len(found) else 0):
        covered[k:k + len(found)] |= found
    return covered


def _covered(passage: np.ndarray, part: np.ndarray) -> np.ndarray:
    size = min(SHINGLE, len(part))
    return _spread(np.isin(_run_hashes(part, size), _run_hashes(passage, size)), size, len(part))


def overlaps(passage: np.ndarray, item: np.ndarray, is_answer: np.ndarray) -> tuple[float, float]:
    """Share of the words of question and answer that lie in shingles the passage has; an empty question counts as covered.

    Shingles are of the item and of each part alone, shorter ones if that has fewer words. An answer shorter than a shingle may stand
    anywhere in the passage but in the words of the question, which may name it without giving it.
    """
    if not len(item):
        return 0.0, 0.0
    covered = _covered(passage, item)
    question, answer = item[~is_answer], item[is_answer]
    of_question, of_answer = covered[~is_answer], covered[is_answer]
    if len(question):
        of_question = of_question | _covered(passage, question)
    if len(answer) >= SHINGLE:
        of_answer = of_answer | _covered(passage, answer)
    elif len(answer) and len(question):
        size = min(SHINGLE, len(question))
        asked = _spread(np.isin(_run_hashes(passage, size), _run_hashes(question, size)), size, len(passage))
        said = np.flatnonzero(_run_hashes(passage, len(answer)) == _run_hashes(answer, len(answer)))
        if any(not asked[k:k + len(answer)].any() for k in said.tolist()):
            of_answer = np.ones(len(answer), dtype=bool)
    return float(of_question.mean()) if len(question) else 1.0, float(of_answer.mean()) if len(answer) else 1.0


def _hits(texts: pa.Array, index: Index, stride: int):
    """Verified (document row, item number, score, question overlap, answer overlap, first word), the best passage of each pair."""
    words = plain_words(texts)
    doc, start, item, score = retrieve(words, index, stride)
    best: dict[tuple[int, int], tuple] = {}
    for d, a, i, s in zip(doc.tolist(), start.tolist(), item.tolist(), score.tolist(), strict=True):
        span = slice(index.word_first[i], index.word_first[i + 1])
        q, r = overlaps(words.hashes[a:min(a + 2 * stride, int(words.first[d + 1]))], index.word_terms[span], index.is_answer[span])
        if q >= OVERLAP and r >= OVERLAP and (min(q, r), s) > best.get((d, i), ((0.0, 0.0),))[0]:
            best[(d, i)] = ((min(q, r), s), s, q, r, a - int(words.first[d]))
    return [(d, i, *v[1:]) for (d, i), v in sorted(best.items())]


def _search(rows: Iterator[pa.RecordBatch], sent: bytes, stride: int) -> Iterator[pa.RecordBatch]:
    index = Index(*pickle.loads(sent))
    for some in rows:
        texts, numbers = strings(column(some, "text")), column(some, "doc_id")
        for lo, hi in slices(texts):
            found = _hits(pa.concat_arrays([texts.slice(lo, hi - lo)]), index, stride)
            if found:
                doc, item, *rest = zip(*found, strict=True)
                yield batch(_HITS, [numbers.take(pa.array(np.array(doc) + lo)), index.items[list(item)], *rest])


def _drop(rows: Iterator[pa.RecordBatch], sent: bytes, stride: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    index = Index(*pickle.loads(sent))
    for some in rows:
        texts, keep = strings(column(some, "text")), np.ones(some.num_rows, dtype=bool)
        for lo, hi in slices(texts):
            for found in _hits(pa.concat_arrays([texts.slice(lo, hi - lo)]), index, stride):
                keep[lo + found[0]] = False
        kept = some.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(kept.columns, schema, strict=True)], schema=schema)


def _indexes(benchmark: DataFrame, share: float, index_bytes: int) -> Iterator[tuple[object, int]]:
    """The index of each block of test items, sent to the executors, and the passage stride that suits it."""
    spark = benchmark.sparkSession
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stored(items.groupBy("item_id").agg(F.min("text").alias("text")), "items")
    terms = stored(items.mapInArrow(_item_terms, "item_id long, place int, term long, answer boolean"), "item-terms")
    n_items, n_words = terms.agg(F.count_distinct("item_id"), F.count("*")).first()
    if not n_items:
        return
    df = stored(terms.groupBy("term").agg(F.count_distinct("item_id").alias("df")), "item-df")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // index_bytes))
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).join(df, "term").orderBy("item_id", "place").toArrow()
        if not mine.num_rows:
            continue
        rows = {n: mine.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("item_id", "place", "term", "answer", "df")}
        index = build_index(rows, n_items, n_words / n_items, share)
        yield spark.sparkContext.broadcast(pickle.dumps(tuple(index), protocol=5)), max(LEAST_STRIDE, int(np.diff(index.word_first).max()))


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word of every document that holds a test item.

    ``score`` is the BM25 score of the best passage over the item's score for itself; first_word is where that passage begins. Texts that are
    null or empty hold nothing; items without words are in no document; of items with one item_id the least text counts;
    repeated documents give a row each; an empty table on either side gives an empty result; other columns are not read.
    """
    found = None
    for sent, stride in _indexes(benchmark, share, index_bytes):
        part = documents_view(docs).mapInArrow(lambda it, sent=sent, stride=stride: _search(it, sent.value, stride), HIT_TYPE)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], HIT_TYPE) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns; documents stay in their tasks.

    Where the items need several indexes, what one of them leaves is stored before the next is sent, so that a task holds one at a time.
    """
    schema, last = docs.schema, None
    for sent, stride in _indexes(benchmark, share, index_bytes):
        if last is not None:
            docs = stored(docs, "unleaked")
            last.unpersist()
        last = sent
        docs = docs.mapInArrow(lambda it, sent=sent, stride=stride: _drop(it, sent.value, stride, arrow_schema(schema)), schema)
    return docs
