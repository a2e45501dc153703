"""Toxic spans and document scores by a linear-chain conditional random field over words.

Words are runs of letters and digits or of signs. Two states, toxic and other; a word speaks for a state by its identity and its
beginnings of 4 to 8 bytes, neighbouring states by a table of transitions. Training tokens come from labelled documents: a word of
a toxic document counts as toxic if it or one of its beginnings is in clearly more toxic than clean documents (lower confidence
bound of the log-odds). Weights are fitted by maximum likelihood with forward-backward gradients. A document is scored from
the forward-backward marginals of all its words; the words above one half give the offending offsets.

Chains are runs of CHAIN words of one document. Bounds: TRAIN_ROWS labelled rows, FEATURES features, TRAIN_CHAINS chains; the model is
therefore of bounded size and sent to every task. Scores read the text alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column, documents_view, stored
from tickwise.llm.words import Words, mix, ranges, slices, split, strings

CHAIN = 64
BEGINNINGS = (4, 5, 6, 7, 8)
TRAIN_ROWS = 30_000
FEATURES = 60_000
TRAIN_CHAINS = 6_000
BOUND = 2.0
_SLOT_BITS = 18

_COUNTS = pa.schema([("feature", pa.int64()), ("toxic_docs", pa.int64()), ("clean_docs", pa.int64())])
_CHAINS = pa.schema([("toxic", pa.int64()), ("hits", pa.int64()), ("draw", pa.int64()), ("features", pa.binary())])
_STATS = pa.schema([("toxic", pa.int64()), ("stats", pa.list_(pa.float64()))])
_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_toxic_words", pa.int64()),
                     ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])


class Model(NamedTuple):
    """Feature hashes by slot with their weights, the bias of a word, log-odds of transitions, and the document's logistic weights."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray


def word_features(words: Words) -> np.ndarray:
    """Words by features: identity and beginnings; a beginning as long as the word is the word's own."""
    out = np.empty((len(words.starts), 1 + len(BEGINNINGS)), np.uint64)
    out[:, 0] = words.hashes
    for k, size in enumerate(BEGINNINGS):
        out[:, k + 1] = mix(ranges(words.sums, words.starts, np.minimum(words.starts + size, words.ends)) + np.uint64(size))
    return out


def _parts(rows: Iterator[pa.RecordBatch]):
    for some in rows:
        texts = strings(column(some, "text"))
        for lo, hi in slices(texts):
            yield some.slice(lo, hi - lo), split(pa.concat_arrays([texts.slice(lo, hi - lo)]), pieces=True)


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each feature, toxic and clean, summed over a slice."""
    for some, words in _parts(rows):
        toxic = column(some, "toxic").to_numpy() == 1
        found = word_features(words)
        doc = np.repeat(np.arange(len(toxic)), np.diff(words.first))
        totals = []
        for k in range(found.shape[1]):
            # Each feature once a document: sort by feature within document order.
            order = np.lexsort((doc, found[:, k]))
            f, d = found[order, k], doc[order]
            new = np.ones(len(f), dtype=bool)
            new[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
            f, d = f[new], d[new]
            at = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else np.zeros(0, np.int64)
            bad = np.add.reduceat(toxic[d].astype(np.int64), at) if len(at) else at
            totals.append((f[at], bad, np.diff(at, append=len(f)) - bad))
        feature, bad, good = (np.concatenate(x) for x in zip(*totals, strict=True))
        yield batch(_COUNTS, [feature.view(np.int64), bad, good])


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their values."""
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def _look(known: np.ndarray, held: np.ndarray, found: np.ndarray, empty):
    """Values of ``found``, by binary search of those whose low bits some key has."""
    low = np.uint64((1 << _SLOT_BITS) - 1)
    taken = np.zeros(1 << _SLOT_BITS, dtype=bool)
    taken[(known & low).astype(np.int64)] = True
    out = np.full(found.shape, empty, held.dtype)
    maybe = np.nonzero(taken[(found & low).astype(np.int64)])
    if len(known) and len(maybe[0]):
        wanted = found[maybe]
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        out[maybe] = np.where(known[at] == wanted, held[at], empty)
    return out


def _chains(rows: Iterator[pa.RecordBatch], known: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each chain's feature numbers (-1: none), how many words have one, and a repeatable draw."""
    for some, words in _parts(rows):
        toxic = column(some, "toxic").to_numpy()
        numbers = _look(known, number, word_features(words), -1).astype(np.int32)
        first, chain_of = _chain_starts(words.first)
        hit = np.concatenate([[0], np.cumsum((numbers >= 0).any(1))])
        hits = hit[first[1:]] - hit[first[:-1]]
        # Of all words in order, so that equal chains can be told and chains that begin alike cannot fill the sample.
        place = np.arange(len(words.hashes)) - np.repeat(first[:-1], np.diff(first))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words.hashes + mix(place.astype(np.uint64))))])
        draw = mix(total[first[1:]] - total[first[:-1]] + np.uint64(17)).view(np.int64)
        # A sixteenth of the chains without any known word is plenty.
        for c in np.flatnonzero((hits > 0) | (draw % 16 == 0)).tolist():
            yield batch(_CHAINS, [[int(toxic[chain_of[c]])], [int(hits[c])], [int(draw[c])], [numbers[first[c]:first[c + 1]].tobytes()]])


def _chain_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chains begin (one more than chains) and the text of each."""
    count = -(-np.diff(first) // CHAIN)
    text = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return np.append(first[:-1][text] + within * CHAIN, first[-1]).astype(np.int64), text


def marginals(emission: np.ndarray, real: np.ndarray, moves: np.ndarray, gradient: bool = False):
    """Probability of the toxic state at each place of equally long chains (chains by places), by forward-backward.

    ``real`` marks places that are words; padding stands at chain ends. With ``gradient`` also the expected transitions.
    """
    n, length = emission.shape
    move = np.exp(moves)
    up = np.exp(np.clip(emission, -30, 30))
    forward = np.empty((length, n, 2))
    state = np.stack([np.ones(n), up[:, 0]], 1)
    scale = state.sum(1, keepdims=True)
    forward[0] = state / scale
    for t in range(1, length):
        a, b = forward[t - 1, :, 0], forward[t - 1, :, 1]
        state = np.stack([a * move[0, 0] + b * move[1, 0], (a * move[0, 1] + b * move[1, 1]) * up[:, t]], 1)
        state /= state.sum(1, keepdims=True)
        forward[t] = np.where(real[:, t, None], state, forward[t - 1])
    out = np.empty((n, length))
    back = np.ones((n, 2))
    pairs = np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        both = forward[t] * back
        out[:, t] = both[:, 1] / both.sum(1)
        if t:
            step = back * np.stack([np.ones(n), up[:, t]], 1)
            if gradient:
                joint = forward[t - 1][:, :, None] * move * step[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                pairs += joint[real[:, t]].sum(0)
            earlier = np.stack([step[:, 0] * move[k, 0] + step[:, 1] * move[k, 1] for k in (0, 1)], 1)
            earlier /= earlier.sum(1, keepdims=True)
            back = np.where(real[:, t, None], earlier, back)
    out[~real] = 0
    return (out, pairs) if gradient else out


def fit_chains(features: np.ndarray, labels: np.ndarray, real: np.ndarray, n_features: int, steps: int = 120,
               penalty: float = 1.0) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions by gradient ascent (Adam) on the penalized likelihood; features are chains by places by slots."""
    weights, bias, moves = np.zeros(n_features + 1), -3.0, np.zeros((2, 2))
    mean, square = np.zeros(n_features + 6), np.zeros(n_features + 6)
    used = np.where(features >= 0, features, n_features)
    told = np.zeros((2, 2))
    both_real = real[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            told[a, b] = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & both_real).sum()
    size = max(1.0, float(real.sum()))
    for step in range(1, steps + 1):
        weights[n_features] = 0
        emission = weights[used].sum(2) + bias
        found, pairs = marginals(emission, real, moves, gradient=True)
        miss = np.where(real, labels - found, 0)
        slope = np.zeros(n_features + 6)
        slope[:n_features + 1] = np.bincount(used.ravel(), np.repeat(miss.ravel(), used.shape[2]), n_features + 1) - penalty * 0.02 * weights
        slope[n_features] = 0
        slope[n_features + 1] = miss.sum()
        slope[n_features + 2:] = (told - pairs).ravel() - penalty * moves.ravel()
        slope /= size ** 0.5
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        change = 0.25 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-6)
        weights += change[:n_features + 1]
        bias += change[n_features + 1]
        moves = moves + change[n_features + 2:].reshape(2, 2)
    weights[n_features] = 0
    return weights, float(bias), moves


def _word_marginals(words: Words, model: Model) -> np.ndarray:
    emission = _look(model.keys, model.weights, word_features(words), 0.0).sum(1) + model.bias
    first, _ = _chain_starts(words.first)
    count = np.diff(first)
    real = np.arange(CHAIN) < count[:, None]
    grid = np.zeros((len(count), CHAIN))
    grid[real] = emission
    if not len(count):
        return emission
    # A chain of words none of which is known has the same marginals as any other of its length.
    return marginals(grid, real, model.moves)[real]


def _doc_stats(words: Words, p: np.ndarray) -> np.ndarray:
    """For each text: log of one plus the expected toxic words, the largest marginal, words per 100, an intercept."""
    n = np.diff(words.first)
    total = np.concatenate([[0.0], np.cumsum(p)])
    expected = total[words.first[1:]] - total[words.first[:-1]]
    top = np.zeros(len(n))
    if (n > 0).any():
        top[n > 0] = np.maximum.reduceat(p, words.first[:-1][n > 0])
    return np.stack([np.log1p(np.maximum(expected, 0)), top, np.log1p(n / 100), np.ones(len(n))], 1)


def _train_stats(rows: Iterator[pa.RecordBatch], sent: bytes) -> Iterator[pa.RecordBatch]:
    model = Model(*pickle.loads(sent))
    for some, words in _parts(rows):
        yield batch(_STATS, [column(some, "toxic").to_numpy(), list(_doc_stats(words, _word_marginals(words, model)))])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(1), -30, 30)))
        h = np.einsum("ni,nj,n->ij", x, x, p * (1 - p)) + penalty * np.eye(x.shape[1])
        w += np.linalg.solve(h, (x * (y - p)[:, None]).sum(0) - penalty * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES, chains: int = TRAIN_CHAINS) -> Model:
    """Fit on the labelled rows (doc_id, toxic 0/1) that have a document: at most ``rows`` of them, by a hash of doc_id.

    Null labels are not used; of labels that contradict each other the toxic one counts. Without toxic or without clean rows the model knows no toxic word and gives every text the rate of the labels.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    train = stored(documents_view(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxic-train")
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    rate = (bad + 0.5) / (bad + good + 1)
    nothing = _table(np.zeros(0, np.uint64), np.zeros(0))
    dull = Model(*nothing, -9.0, np.zeros((2, 2)), np.array([0, 0, 0, np.log(rate / (1 - rate))]))
    if not bad or not good:
        return dull
    counts = train.mapInArrow(_count, "feature long, toxic_docs long, clean_docs long").groupBy("feature").agg(
        F.sum("toxic_docs").alias("a"), F.sum("clean_docs").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (bad + 1)) - F.log((F.col("b") + 0.5) / (good + 1))
    bound = odds - F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    least = 3 if bad >= 100 else 2
    strong = counts.where(F.col("a") >= least).withColumn("bound", bound).where(F.col("bound") >= BOUND / 2)
    best = strong.orderBy(F.desc("bound"), "feature").limit(features).toPandas()
    if not len(best):
        return dull
    keys, numbers = best["feature"].to_numpy(np.int64).view(np.uint64), np.arange(len(best), dtype=np.int32)
    clear = best["bound"].to_numpy() >= BOUND
    table = _table(keys, numbers)
    sent = spark.sparkContext.broadcast(pickle.dumps(table, protocol=5))
    found = stored(train.mapInArrow(lambda it: _chains(it, *pickle.loads(sent.value)), "toxic long, hits long, draw long, features binary"), "chains")
    picked = [r for want in ("toxic = 1 and hits > 0", "toxic = 0 and hits > 0", "hits = 0")
              for r in found.where(want).dropDuplicates(["toxic", "draw"]).orderBy("draw", "toxic").limit(chains // 3).select("toxic", "features").collect()]
    slots = 1 + len(BEGINNINGS)
    grid = np.full((len(picked), CHAIN, slots), -1, np.int32)
    real, mark = np.zeros((len(picked), CHAIN), dtype=bool), np.zeros((len(picked), CHAIN))
    for k, r in enumerate(picked):
        own = np.frombuffer(r["features"], np.int32).reshape(-1, slots)
        grid[k, :len(own)], real[k, :len(own)] = own, True
        if r["toxic"]:
            mark[k, :len(own)] = (clear[own] & (own >= 0)).any(1)
    weights, bias, moves = fit_chains(grid, mark, real, len(keys))
    model = Model(*_table(keys, weights[:len(keys)]), bias, moves, dull.document)
    sent_model = pickle.dumps(tuple(model), protocol=5)
    stats = train.mapInArrow(lambda it: _train_stats(it, sent_model), "toxic long, stats array<double>").toPandas()
    document = _logistic(np.stack(stats["stats"].to_numpy()), stats["toxic"].to_numpy().astype(float))
    return model._replace(document=document)


def _scores(rows: Iterator[pa.RecordBatch], sent: bytes) -> Iterator[pa.RecordBatch]:
    model = Model(*pickle.loads(sent))
    for some, words in _parts(rows):
        p = _word_marginals(words, model)
        score = 1 / (1 + np.exp(-np.clip(_doc_stats(words, p) @ model.document, -30, 30)))
        at = np.flatnonzero(p >= 0.5)
        doc = np.searchsorted(words.first, at, "right") - 1
        # Code points before each byte, counted from the start of the document.
        points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
        begin = np.zeros(len(words.first) - 1, np.int64)
        lengths = offsets_of(some)
        begin[:] = points[lengths[:-1]]
        count = np.bincount(doc, minlength=len(score))
        ends = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
        yield batch(_SCORED, [column(some, "doc_id"), score, count,
                              pa.ListArray.from_arrays(ends, pa.array(points[words.starts[at]] - begin[doc])),
                              pa.ListArray.from_arrays(ends, pa.array(points[words.ends[at]] - begin[doc]))])


def offsets_of(some: pa.RecordBatch) -> np.ndarray:
    """Byte offsets of a batch's texts from its first."""
    texts = strings(column(some, "text"))
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    return at - at[0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), n_toxic_words, span_starts and span_ends (code points of toxic words) for every row of ``docs``.

    Null and empty texts have no words and get the score of none; repeated rows are scored alike; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(tuple(model), protocol=5))
    return documents_view(docs).mapInArrow(
        lambda it: _scores(it, sent.value), "doc_id long, score double, n_toxic_words long, span_starts array<long>, span_ends array<long>")
