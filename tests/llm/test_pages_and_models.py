"""Page text by wrappers, quality, toxicity and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickwise.llm import crf, quality, wrappers

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul>{nav}</ul></nav><!-- x --><div class="cookie-notice">We use cookies</div>
<div id="main-content"><article><header><h1>{title}</h1></header>{body}<form><input name=q><button>Go</button></form></article>
<aside class="sidebar"><p>Side</p></aside><section id="comments"><p>First!</p></section></div>
<footer>&copy; 2020</footer></body></html>"""


def page(title, *paragraphs, nav=3):
    return PAGE.format(title=title, body="".join(f"<p>{p}</p>" for p in paragraphs), nav="".join(f"<li><a href='/{k}'>n{k}</a></li>" for k in range(nav)))


def test_main_text(spark):
    rows = [
        (1, "http://A.org/x", page("One", "a &amp; b", "c<b>d</b> e\n\n f"), "q"),
        (2, "http://a.org/y", page("Two", "only", nav=1), "q"),
        (3, "https://u@a.org:80/z", page("Three", *[f"p{k}" for k in range(300)]), "q"),
        (4, "http://a.org/t", "<html><body><nav>n</nav><article><h1>Cut</h1><p>open <i>end", "q"),
        (5, None, None, "q"), (6, "http://b.org", "", "q"), (None, "nohost", "plain &lt;text&gt; only", "q"),
        (7, "http://c.org", "<div class='ad'>Buy</div><div class='post'>Body <br>line</div><p class='related'>More</p>", "q"),
        (8, "http://d.org", "<p>x</p><div class=sidebar>no</div><p>y", "q"), (1, "http://A.org/x", page("One", "a &amp; b", "c<b>d</b> e\n\n f"), "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = {r["page_id"]: r for r in wrappers.main_text(df).collect()}
    want = {1: "One a & b cd e f", 2: "Two only", 3: "Three " + " ".join(f"p{k}" for k in range(300)), 4: "Cut open end", 5: "", 6: "",
            None: "plain <text> only", 7: "Body line", 8: "x y"}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert wrappers.main_text(df).count() == len(rows)
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_pages_of_other_templates_keep_their_text(spark):
    htmls = [page("One", "a"), "<body><nav>n</nav><main><p>main text</p></main><p>out</p></body>",
             "<body><div class=content><p>named text</p></div><p>out</p></body>", "<body><nav>n</nav><p>plain text</p></body>"]
    for url in ("http://shop.org/{}", None):
        df = spark.createDataFrame([(k, url and url.format(k), h) for k, h in enumerate(htmls)], "page_id long, url string, html string")
        got = {r["page_id"]: (r["text"], r["wrapped"]) for r in wrappers.main_text(df).collect()}
        assert got == {0: ("One a", True), 1: ("main text", False), 2: ("named text", False), 3: ("plain text", False)}


def test_wrappers_generalize():
    a = wrappers.fold(wrappers.skeleton("<div><h1>t</h1><p>1</p><p>2</p></div>"))
    b = wrappers.fold(wrappers.skeleton("<div><p>1</p><em>x</em></div>"))
    both = wrappers.align(a, b)
    assert both == [["<div", ["?", ["<h1", "#"]], ["+", ["<p", "#"]], ["?", "#"]]]
    assert wrappers.fold(wrappers.skeleton("<div>" * 3000 + "<p>x</p>"))
    assert wrappers.slots(both) == {"div", "div/h1", "div/p"}
    # The order in which pages come does not change which slots there are.
    pages = [wrappers.fold(wrappers.skeleton(page("t", *"abc"[:k], nav=k))) for k in (1, 2, 3)]
    assert len({frozenset(wrappers.slots(wrappers._merge(list(p)))) for p in itertools.permutations(pages)}) == 1


def corpus(spark, n=400, seed=3):
    """Prose, symbol junk and repeated words from two hosts; toxic words in some prose."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        w = [rng.choice("river stone cloud green walk table seven bright under garden".split()) + rng.choice(["", "s", "ing", ","]) for _ in range(rng.randrange(20, 120))]
        bad, toxic = rng.random() < 0.25, rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["grumbles", "grumblish", "Grumbled", "zork!"]))
        if bad:
            w = [x + rng.choice(["$$$", "%%%"]) for x in w] if rng.random() < 0.5 else [w[0]] * len(w)
            toxic = toxic and len(set(w)) > 1
        docs.append((k, " ".join(w), "en" if k % 3 else None, f"host{k % 2}", 1.0))
        if rng.random() < 0.7:
            labels.append((k, int(not bad), int(toxic)))
    docs += [(n, None, "en", None, 1.0), (n + 1, "", None, "host1", 1.0), (0, docs[0][1], "en", "host0", 1.0), (None, "no number here", "en", "rare", 1.0)]
    labels += [(n + 50, 1, 1), (None, 1, 0), (n, None, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    even = labels.where("doc_id % 2 = 0")
    scored = crf.score(docs, crf.fit(docs, even))
    found = scored.join(labels, "doc_id").where("doc_id % 2 = 1 and toxic is not null").toPandas()
    assert ((found["score"] >= 0.3) == (found["toxic"] == 1)).mean() > 0.9
    every = scored.toPandas()
    assert len(every) == docs.count() and every["score"].between(0, 1).all()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in every[every["n_toxic_words"] > 0].itertuples():
        spans = [texts[r.doc_id][a:b].lower() for a, b in zip(r.span_starts, r.span_ends)]
        assert all(s.startswith(("grumbl", "zork")) for s in spans)
    for none in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert crf.score(docs, crf.fit(docs, none)).where("score between 0 and 1").count() == docs.count()
    assert crf.score(docs.limit(0), crf.fit(docs.limit(0), labels)).count() == 0


def test_no_feature_is_dropped_and_chains_are_drawn_by_all_words():
    rng = np.random.default_rng(12)
    keys = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64))
    table = crf._table(keys, np.arange(len(keys)))
    assert (crf._look(*table, keys, -1) == np.arange(len(keys))).all()
    assert (crf._look(*table, keys[:90].reshape(30, 3) + np.uint64(1 << 20), -1) == -1).all()
    import pyarrow as pa

    texts = [f"same first {k}" for k in range(50)] + ["same first 7"]
    rows = pa.RecordBatch.from_pydict({"text": texts, "toxic": [1] * 51})
    known = np.unique(crf.word_features(crf.split(pa.array(["first"], pa.large_string()), pieces=True)))
    draws = [d for b in crf._chains(iter([rows]), *crf._table(known, np.arange(len(known), dtype=np.int32))) for d in b.column(2).to_pylist()]
    assert len(draws) == 51 and len(set(draws)) == 50 and draws[7] == draws[50]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    real = np.arange(5) < np.array([5, 3, 1])[:, None]
    got, pairs = crf.marginals(emission, real, moves, gradient=True)
    want_pairs = np.zeros((2, 2))
    for k, n in enumerate((5, 3, 1)):
        weight, on, both = 0.0, np.zeros(5), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(emission[k, t] * y[t] for t in range(n)) + sum(moves[y[t], y[t + 1]] for t in range(n - 1)))
            weight += w
            for t in range(n):
                on[t] += w * y[t]
            for t in range(n - 1):
                both[y[t], y[t + 1]] += w
        assert np.allclose(got[k], on / weight)
        want_pairs += both / weight
    assert np.allclose(pairs, want_pairs)


def test_quality_and_its_rates(spark):
    docs, labels = corpus(spark)
    judged = quality.judge(docs.withColumn("quality_keep", F.lit("old")), labels.where("doc_id % 2 = 0 or doc_id is null")).toPandas()
    assert len(judged) == docs.count()
    found = judged.merge(labels.where("quality is not null and doc_id is not null").toPandas(), on="doc_id")
    assert (found["quality_keep"] == (found["quality"] == 1)).mean() > 0.97
    sparse = judged[judged["source"] == "rare"].iloc[0]
    big = judged[judged["source"] == "host0"].iloc[0]
    overall = judged["quality_keep"].mean()
    assert abs(sparse["path_rate"] - overall) < 0.2 and 0 < big["path_rate"] < 1


def test_site_rates_shrink_as_the_formula_says(spark):
    rng = np.random.default_rng(5)
    rows = [(f"h{h}", f"p{p}", float(rng.random() < 0.2 + 0.15 * h)) for h in range(5) for p in range(3) for _ in range(int(rng.integers(1, 60)))]
    got = quality.site_rates(spark.createDataFrame(rows, "host string, path string, evidence double")).toPandas()
    overall = (sum(e for *_, e in rows) + 0.5) / (len(rows) + 1)

    def strength(groups):
        n, s, prior = (np.array(x, float) for x in zip(*groups))
        between = max(((n * (s / n - prior) ** 2).sum() - (prior * (1 - prior)).sum()) / n.sum(), 1e-6)
        return min(max((n * prior * (1 - prior)).sum() / n.sum() / between - 1, 1.0), 1e6)

    by_host, by_path = {}, {}
    for h, p, e in rows:
        by_host.setdefault(h, []).append(e)
        by_path.setdefault((h, p), []).append(e)
    k = strength([(len(v), sum(v), overall) for v in by_host.values()])
    host = {h: (sum(v) + k * overall) / (len(v) + k) for h, v in by_host.items()}
    k = strength([(len(v), sum(v), host[h]) for (h, _), v in by_path.items()])
    for r in got.itertuples():
        v = by_path[(r.host, r.path)]
        assert abs(r.host_rate - host[r.host]) < 1e-9 and abs(r.path_rate - (sum(v) + k * host[r.host]) / (len(v) + k)) < 1e-9


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_on_odd_rows(spark, tmp_path, name):
    docs, labels = corpus(spark, 60)
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("host_rate", F.lit("own")).withColumn("key", F.lit(7))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    item = docs.where("doc_id = 5").first()["text"]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, str(tmp_path))
    if name != "packing":
        assert out.columns == docs.columns
        assert {r["host_rate"] for r in out.collect()} == {"own"}
    numbers = [r["doc_id"] for r in out.collect()]
    if name == "near_dedup":
        assert numbers.count(0) == 1 and numbers.count(None) == 1
    if name == "decontamination":
        assert 5 not in numbers and 6 in numbers
    if name == "packing":
        assert set(numbers) == {r["doc_id"] for r in docs.collect()}
    nothing = stage(spark, docs.limit(0), str(tmp_path))
    assert nothing.count() == 0


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    assert len(out) and (out.groupby("sequence_id")["length"].sum() <= 4096).all()


def test_contradictory_labels_have_a_defined_meaning(spark):
    docs = spark.createDataFrame([(k, ("good prose, said at length. " if k % 2 else "x# $$ ") * (k + 3)) for k in range(12)], "doc_id long, text string")
    labels = [(k, k % 2, (k + 1) % 2) for k in range(12)]
    plain = spark.createDataFrame(labels + [(1, 0, 1)], "doc_id long, quality long, toxic long").where("not (doc_id = 1 and quality = 1)")
    twice = spark.createDataFrame([(1, 0, 1), *labels], "doc_id long, quality long, toxic long")
    one, two = quality.fit(docs, plain), quality.fit(docs, twice)
    assert one.rate == two.rate and (one.weights == two.weights).all()
    first, second = crf.fit(docs, plain), crf.fit(docs, twice)
    assert (first.document == second.document).all() and first.bias == second.bias
