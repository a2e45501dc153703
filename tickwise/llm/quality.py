"""Document quality by hierarchical empirical Bayes.

A logistic classifier over whole-text measures gives each document its own evidence. All documents then speak for their site: host and
path rates are posterior means that shrink a sparse path towards its host and a sparse host towards the overall rate, with
prior strengths estimated from how much rates differ beyond chance (method of moments). A document's score adds what its path's
posterior says beyond the overall rate to its own log-odds.

Labels are fitted on at most TRAIN_ROWS rows; all counts and rates cover every document. Grouped sums are partial sums
first, so that a host with a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.frames import arrow_schema, column, free_name, small_enough, stored
from tickwise.llm.words import Words, slices, split, strings

TRAIN_ROWS = 20_000
MEASURES = ("log_words", "word_length", "signs", "sign_words", "bars", "upper", "digits", "repeat_1", "repeat_2", "repeat_3",
            "repeat_4", "stops", "lines", "distinct")
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in "#$%&*!|~^@<>{}[]\\=+_"]] = True


def measures(words: Words, texts: pa.Array) -> np.ndarray:
    """Texts by MEASURES; a text without words has zeros."""
    n = np.diff(words.first)
    count = np.maximum(n, 1).astype(float)
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = at - at[0]

    def bytes_of(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    def words_of(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[words.first[1:]] - total[words.first[:-1]]) / count

    data, hashes = words.data, words.hashes
    ascii_upper = (data >= 65) & (data <= 90)
    ascii_lower = (data >= 97) & (data <= 122)
    letters = np.maximum(bytes_of(ascii_upper | ascii_lower), 1)
    last = data[words.ends - 1] if len(hashes) else data
    single = (words.ends - words.starts) == 1
    doc = np.repeat(np.arange(len(n)), n)

    def repeats(back: int) -> np.ndarray:
        same = np.zeros(len(hashes), dtype=bool)
        same[back:] = (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back]) if len(hashes) > back else False
        return words_of(same)

    # Of all words of a text, how many differ: by a hash of text and word, sorted once.
    keys = np.sort(hashes ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[1:] != keys[:-1]
    order = np.argsort(hashes ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    marked = np.zeros(len(keys), dtype=bool)
    marked[order] = fresh
    distinct = words_of(marked)
    # Longer texts repeat more words by nature; the exponent levels that.
    out = [np.log1p(n), bytes_of(~np.isin(data, (32, 9, 10, 11, 12, 13))) / count / 10, bytes_of(_SIGN[data]) / count,
           words_of(_SIGN[last]), words_of(single & (last == ord("|"))), bytes_of(ascii_upper) / letters,
           bytes_of((data >= 48) & (data <= 57)) / count, *(repeats(k) for k in (1, 2, 3, 4)),
           words_of((last == ord(".")) | (last == ord("!")) | (last == ord("?"))), bytes_of(data == 10) / count,
           distinct ** (1 / np.log2(count + 2))]
    found = np.stack(out, 1)
    found[n == 0] = 0
    return found


def _measured(rows: Iterator[pa.RecordBatch]):
    for some in rows:
        texts = strings(column(some, "text"))
        for lo, hi in slices(texts):
            part = pa.concat_arrays([texts.slice(lo, hi - lo)])
            yield some.slice(lo, hi - lo), measures(split(part, lower=False), part)


def _train(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("quality", pa.int64()), ("x", pa.list_(pa.float64()))])
    for some, x in _measured(rows):
        yield pa.RecordBatch.from_arrays([column(some, "quality"), pa.array(list(x), schema[1].type)], schema=schema)


class Classifier:
    """Standardized logistic regression with a ridge; ``rate`` is the share of good rows it was fitted on."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.rate = float((y.sum() + 0.5) / (len(y) + 1))
        self.middle = x.mean(0) if len(x) else np.zeros(len(MEASURES))
        self.width = np.maximum(x.std(0), 1e-3) if len(x) else np.ones(len(MEASURES))
        self.weights = np.zeros(len(MEASURES))
        self.bias = float(np.log(self.rate / (1 - self.rate)))
        if 0 < y.sum() < len(y):
            z = np.concatenate([(x - self.middle) / self.width, np.ones((len(x), 1))], 1)
            w = np.append(self.weights, self.bias)
            keep = np.append(np.full(len(MEASURES), ridge), 1e-6)
            for _ in range(40):
                p = 1 / (1 + np.exp(-np.clip((z * w).sum(1), -30, 30)))
                # Sums only: threaded linear algebra may wait forever in a driver that also runs a JVM.
                step = np.linalg.solve(np.einsum("ni,nj,n->ij", z, z, p * (1 - p)) + np.diag(keep), (z * (y - p)[:, None]).sum(0) - keep * w)
                w = w + step
                if np.abs(step).max() < 1e-8:
                    break
            self.weights, self.bias = w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on the labelled rows (doc_id, quality 0/1) that have a document: at most ``rows`` of them, by a hash of doc_id.

    Null labels are not used; of labels that contradict each other the lower one counts; without rows of both kinds every document gets the rate of the labels.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("long")).alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    train = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "quality")
    found = train.mapInArrow(_train, "quality long, x array<double>").toPandas()
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, len(MEASURES)))
    return Classifier(x, found["quality"].to_numpy().astype(float))


def with_logit(docs: DataFrame, model: Classifier, name: str = "_quality_logit") -> DataFrame:
    """``docs`` with the classifier's log-odds of each whole text as a further column; null text counts as empty."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    middle, width, weights, bias = model.middle, model.width, model.weights, model.bias

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for some, x in _measured(rows):
            logit = np.clip(((x - middle) / width * weights).sum(1) + bias, -30, 30)
            columns = [c.cast(f.type) for c, f in zip(some.columns, out, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(logit)], schema=out)

    return docs.mapInArrow(run, schema)


def _strength(groups: DataFrame, n: str, s: str, prior: object) -> float:
    """Prior strength of rates s/n around ``prior`` by the method of moments: large if they differ no more than chance."""
    rate = F.col(s) / F.col(n)
    row = groups.withColumn("_prior", prior).agg(
        F.sum(F.col(n) * (rate - F.col("_prior")) ** 2).alias("spread"), F.sum(F.col("_prior") * (1 - F.col("_prior"))).alias("chance"),
        F.sum(n).alias("n"), F.sum(F.col(n) * F.col("_prior") * (1 - F.col("_prior"))).alias("within")).first()
    if not row["n"]:
        return 1.0
    between = max((row["spread"] - row["chance"]) / row["n"], 1e-6)
    return float(min(max(row["within"] / row["n"] / between - 1, 1.0), 1e6))


def site_rates(evidence: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """host, path, n_docs, host_rate, path_rate, overall_rate from one row a document (host, path, evidence between 0 and 1).

    Null hosts and paths are sites like others. An empty table gives no sites.
    """
    paths = stored(evidence.groupBy(host, path).agg(F.count("*").alias("n_docs"), F.sum("evidence").alias("good")), "paths")
    hosts = stored(paths.groupBy(host).agg(F.sum("n_docs").alias("host_docs"), F.sum("good").alias("host_good")), "hosts")
    total = hosts.agg(F.sum("host_docs"), F.sum("host_good")).first()
    overall = float((total[1] or 0) + 0.5) / float((total[0] or 0) + 1)
    strength = _strength(hosts, "host_docs", "host_good", F.lit(overall))
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + strength * overall) / (F.col("host_docs") + strength))
    named = hosts.select(F.col(host).alias("_host"), "host_rate")
    both = stored(paths.join(named, paths[host].eqNullSafe(named["_host"])).drop("_host"), "sites")
    strength = _strength(both, "n_docs", "good", F.col("host_rate"))
    rate = (F.col("good") + strength * F.col("host_rate")) / (F.col("n_docs") + strength)
    return both.select(host, path, "n_docs", "host_rate", rate.alias("path_rate"), F.lit(overall).alias("overall_rate"))


def _log_odds(p) -> object:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, host: object = None, path: object = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with quality_logit, host_rate, path_rate, quality_score and quality_keep (score of 0.5 or more) added.

    ``host`` and ``path`` are column expressions; by default source is the host and its languages are its paths. Every row is
    scored, repeated rows alike; empty and null texts are scored by their measures of zero. Columns that have the names of added
    ones are replaced. A document that has a label speaks for its site by the label, others by the classifier.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    added = ("quality_logit", "host_rate", "path_rate", "quality_score", "quality_keep")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    model = fit(docs, labels, rows)
    h, p = free_name(docs.columns, "_host"), free_name(docs.columns, "_path")
    need = docs.select("doc_id", F.col("text").cast("string").alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    own = stored(with_logit(need, model).drop("text"), "quality")
    known = labels.where("quality is not null and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("double")).alias("label"))
    soft = 1 / (1 + F.exp(-F.col("_quality_logit")))
    evidence = own.join(known, "doc_id", "left").select("host", "path", F.coalesce("label", soft).alias("evidence"))
    sites = stored(site_rates(evidence), "rates").select(F.col("host").alias(h), F.col("path").alias(p), "host_rate", "path_rate", "overall_rate")
    size = F.coalesce(F.length(h), F.lit(0)) + F.coalesce(F.length(p), F.lit(0)) + 64
    sites = F.broadcast(sites) if small_enough(sites, size) else sites
    scored = with_logit(docs, model, "quality_logit")
    joined = scored.join(sites, host.cast("string").eqNullSafe(F.col(h)) & path.cast("string").eqNullSafe(F.col(p)), "left")
    logit = F.col("quality_logit") + _log_odds(F.col("path_rate")) - _log_odds(F.col("overall_rate"))
    score = 1 / (1 + F.exp(-logit))
    return joined.select(*docs.columns, "quality_logit", "host_rate", "path_rate", score.alias("quality_score"), (logit >= 0).alias("quality_keep"))
