"""Near-duplicates, repeated passages, top-k and decontamination against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwise.llm import components, decontaminate, minmax, topk, windows

SOME = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def sentence(rng, n):
    return " ".join(rng.choice(SOME) + str(rng.randrange(40)) for _ in range(n))


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(SOME)
    return " ".join(w)


def brute_components(texts, k, percent=80):
    sets = {d: shingle_set(t, k) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}, {d: len(s) for d, s in sets.items()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out, base, other = {}, sentence(rng, 60), sentence(rng, 12)
    for k in range(90):
        out[k] = changed(rng, base, rng.randrange(0, 8))
    for k in range(90, 120):
        out[k] = changed(rng, other, rng.randrange(0, 3)).upper() if k % 2 else other
    for k in range(120, 150):
        out[k] = sentence(rng, rng.randrange(1, 30))
    out |= {150: "", 151: None, 152: " \n\t", 153: "one", 154: "ONE", 155: "One two", 156: "é É", 157: "the " * 5000, 158: "The " * 400}
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, texts, k, monkeypatch):
    monkeypatch.setattr(minmax, "TILE_ROWS", 16)
    monkeypatch.setattr(minmax, "TILE_SHINGLES", 64)
    rows = [(d, t, "x") for d, t in texts.items()] + [(5, texts[5], "x"), (None, texts[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(5)
    got = minmax.near_duplicates(df, shingle=k).collect()
    expected, sizes = brute_components(texts, k)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (expected[r["doc_id"]], sizes[r["doc_id"]], r["doc_id"] == expected[r["doc_id"]])


def test_near_duplicates_of_nothing(spark):
    assert minmax.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1500], rng.integers(0, 1 << 63, 500, dtype=np.uint64)])
    both = minmax.signatures(np.concatenate([a, b]), np.array([0, 2000, 4000]))
    assert abs((both[0] == both[1]).mean() - 0.6) < 0.15


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 200)] + [(300, 299), (300, 300), (299, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 200)} | {299: 299, 300: 299}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_compact_windows_hold_every_stretch():
    rng = np.random.default_rng(4)
    order = rng.integers(0, 12, 70).astype(np.uint32)
    first = np.array([0, 25, 25, 31, 70])
    l, c, r = windows.compact_windows(order, first, 6)
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            for j in range(i + 5, b):
                inside = [x for x in range(len(c)) if l[x] <= i <= c[x] <= j <= r[x]]
                assert len(inside) == 1 and order[c[inside[0]]] == order[i:j + 1].min()


def test_windows_overlap_equals_all_pairs(monkeypatch):
    monkeypatch.setattr(windows, "COMBINATIONS", 30)
    rng = np.random.default_rng(3)
    size = rng.integers(1, 9, 60)
    first = np.concatenate([[0], np.cumsum(size)])
    f, lo = rng.integers(0, 6, first[-1]), rng.integers(0, 60, (first[-1], 2))
    boxes = np.stack([lo[:, 0], lo[:, 0] + rng.integers(45, 90, len(lo)), lo[:, 1], lo[:, 1] + rng.integers(45, 90, len(lo))], 1)

    def room(x, y, k):
        return min(x[k + 1], y[k + 1]) - max(x[k], y[k]) + 1 >= 46

    want = [any(len({f[j] for j in range(a, b) if room(boxes[i], boxes[j], 0) and room(boxes[i], boxes[j], 2)}) >= 2 for i in range(a, b))
            for a, b in zip(first[:-1], first[1:])]
    assert windows.windows_overlap(first, f, boxes).tolist() == want and 0 < sum(want) < 60


def passage_documents(rng):
    shared, near = sentence(rng, 60), sentence(rng, 80)
    docs = {k: sentence(rng, 90) for k in range(20)}
    for k in (3, 7, 11):
        docs[k] = sentence(rng, 40) + " " + shared + " " + sentence(rng, 30)
    docs[12] = sentence(rng, 30) + " " + near
    docs[13] = changed(rng, near, 1) + "\n" + sentence(rng, 30)
    docs[15] = docs[14].title()
    short = sentence(rng, 30)
    docs[16], docs[17] = sentence(rng, 60) + " " + short, short + " " + sentence(rng, 60)
    return docs, shared


def test_repeated_passages_are_found_and_cut(spark):
    docs, shared = passage_documents(random.Random(8))
    rows = [(d, t, len(t), 1) for d, t in docs.items()] + [(50, None, 0, 1), (51, "", 0, 1), (None, shared, 9, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, key int").repartition(3)
    got = windows.repeated_passages(df).collect()
    assert {r["doc_id"] for r in got} == {7, 11, 13, 15}
    assert {r["source_doc_id"] for r in got} <= {3, 7, 12, 14}
    for r in got:
        assert r["end_word"] - r["first_word"] >= 50 and r["similarity"] >= 0.8
    seven = next(r for r in got if r["doc_id"] == 7)
    assert " ".join(docs[7].split()[seven["first_word"]:seven["end_word"]]) == shared
    left = {r["doc_id"]: r for r in windows.without_repeats(df).collect()}
    assert set(left) == {None, 50, 51, *docs} - {15}
    assert shared in left[3]["text"] and shared not in left[7]["text"] and shared not in left[11]["text"]
    assert left[7]["n_chars"] == len(left[7]["text"]) and left[1]["text"] == docs[1] and left[50]["text"] is None


@pytest.mark.parametrize("gap", [0, 5, 40])
def test_each_occurrence_in_the_later_document_is_cut(spark, gap):
    rng = random.Random(31)
    shared = sentence(rng, 60)
    own = [sentence(rng, gap) for _ in range(4)]
    docs = {1: sentence(rng, 40) + " " + shared + " " + sentence(rng, 40),
            2: " ".join(f"{o} {shared}" for o in own[:3]) + " " + own[3], 3: "the " * 60, 4: "the " * 700 + sentence(rng, 30)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(2)
    left = {r["doc_id"]: r["text"] for r in windows.without_repeats(df).collect()}
    assert left.get(2, "").split() == " ".join(own).split() and left[1] == docs[1]
    assert left[4].split() == docs[4].split()[700:]


def test_a_frequent_line_hides_no_shared_passage(spark):
    rng = random.Random(5)
    line = sentence(rng, 30)
    docs = {}
    for k in range(60):
        own = sentence(rng, 21)
        # Partners lie 60 numbers apart, each among strangers with the same line; every other one says the line once more before.
        for d in (k, k + 60):
            docs[d] = (line + " " + sentence(rng, 60) + " " if k % 2 else "") + sentence(rng, 30) + " " + line + " " + own + " " + sentence(rng, 30)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(7)
    got = {(r["source_doc_id"], r["doc_id"]) for r in windows.repeated_passages(df).collect()}
    assert got == {(k, k + 60) for k in range(60)}


def test_a_changed_passage_in_a_large_group_finds_its_partner(spark):
    rng = random.Random(9)
    base = sentence(rng, 300).split()

    def version(d, every, phase):
        return " ".join(f"x{d}y{k}" if k % every == phase else w for k, w in enumerate(base))

    # All runs of 20 shingles of the passage are in many strangers, which are too different from it as a whole.
    docs = {d: version(d, 28, d % 28) for d in range(124)}
    docs[60], docs[124] = " ".join(base), version(124, 48, 47)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {r["source_doc_id"]: r["end_word"] - r["first_word"] for r in windows.repeated_passages(df).collect() if r["doc_id"] == 124}
    assert got.get(60, 0) > 280


def test_a_text_is_ranked_once_for_all_its_pairs_and_ids_decide_the_source(monkeypatch):
    rng = random.Random(12)
    shared = sentence(rng, 60)
    hub = sentence(rng, 300) + " " + shared
    partners = {d: sentence(rng, 10) + " " + shared for d in (1, 2, 8, 9)}
    calls = []
    plain = windows.ranked
    monkeypatch.setattr(windows, "ranked", lambda s: calls.append(len(s)) or plain(s))
    rows = pa.record_batch({"stay": [5] * 4, "sent": list(partners), "text_stay": [hub] * 4, "text_sent": list(partners.values())})
    got = [r for some in windows._verify(iter([rows])) for r in some.to_pylist()]
    assert calls.count(len(hub.split()) - 4) == 1 and len(calls) == 5
    assert {(r["source_doc_id"], r["doc_id"], r["first_word"], r["end_word"]) for r in got} == {
        (1, 5, 300, 360), (2, 5, 300, 360), (5, 8, 10, 70), (5, 9, 10, 70)}


def test_pairs_of_many_windows_take_memory_by_their_windows():
    n = 3_000
    boxes = np.repeat(np.arange(n)[:, None] * 100, 4, 1) + np.array([0, 50, 0, 50])
    tracemalloc.start()
    assert not windows.windows_overlap(np.array([0, n]), np.arange(n) % 6, boxes).any()
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
    boxes[-1] = boxes[0]
    assert windows.windows_overlap(np.array([0, n]), np.arange(n) % 6, boxes).all()


def test_windows_travel_in_four_numbers():
    big = 70_000
    got = list(windows._sent(np.array([7], np.uint64), np.array([3]), np.array([big]), np.array([big + 5]), np.array([big + 90]), 2))[0].to_pylist()
    assert [(r["doc_id"], r["spot"] >> 32, r["spot"] & 0xFFFFFFFF, r["reach"] >> 1, r["reach"] & 1) for r in got] == [(3, big, big + 5, big + 90, 0)]


def test_repeated_passages_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert windows.repeated_passages(none).count() == 0 and windows.without_repeats(none).count() == 0


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_TILE", 2)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 7)).round(1)
    rows = [(k, v.tolist(), "a") for k, v in enumerate(x)] + [(200, x[3].tolist(), "a"), (201, None, "a"), (None, x[2].tolist(), "a"),
                                                             (250, [1.0, None], "a"), (300, [float("nan")] * 7, "a"), (301, [float("inf")], "a"), (302, [0.5, 0.25], "a"), (303, [], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    vectors = topk.quantize(df)
    good = {k: np.floor(256 * np.pad(np.array(v, float), (0, 7 - len(v)))).astype(int) for k, v, _ in rows
            if k is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()}
    want = []
    for q in (k for k in good if k % 50 == 0):
        found = sorted(((-int(good[q] @ v), k) for k, v in good.items() if k != q))[:5]
        want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(found)]
    for size in (topk.PASS_BYTES, 100):
        got = topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), pass_bytes=size)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    few = vectors.where("vec_id in (50, 51)")
    assert [tuple(r) for r in topk.top_k(few, few.where("vec_id = 50")).collect()] == [(50, 1, 51, int(good[50] @ good[51]))]
    assert topk.top_k(few.limit(0), few.limit(0)).count() == 0


def test_large_products_stay_exact():
    q, x = np.array([[1 << 30, 3]]), np.array([[1 << 31, 1], [(1 << 31) + 1, 0]])
    assert topk._products(q, x).tolist() == [[(1 << 61) + 3, (1 << 61) + (1 << 30)]]


@pytest.mark.parametrize("index_bytes", [decontaminate.INDEX_BYTES, 400])
def test_leaks_are_found_and_clean_documents_stay(spark, index_bytes):
    rng = random.Random(21)
    items = {k: sentence(rng, rng.randrange(12, 50)) + ". " + sentence(rng, 6) + "." for k in range(30)}
    docs = {k: sentence(rng, rng.randrange(1, 500)) for k in range(60)}
    docs[5] = sentence(rng, 300) + "\n" + items[2] + "&&& " + sentence(rng, 200)
    docs[6] = items[3].upper()
    docs[7] = sentence(rng, 61) + " " + items[4] + " " + items[5]
    docs[8] = " ".join(items[6].split()[:8])
    docs[9] = " ".join(sorted(items[7].split()))
    rows = [(k, t, 1.0) for k, t in docs.items()] + [(70, None, 1.0), (71, "", 1.0), (None, items[2], 1.0), (5, docs[5], 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    bench = spark.createDataFrame([(k, t) for k, t in items.items()] + [(40, None), (41, ""), (None, "x y"), (2, items[2])], "item_id long, text string")
    got = decontaminate.find_leaks(df, bench, index_bytes=index_bytes).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"]) for r in got) == [(-1, 2), (5, 2), (5, 2), (6, 3), (7, 4), (7, 5)]
    left = decontaminate.without_leaks(df, bench, index_bytes=index_bytes)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {*docs, 70, 71} - {5, 6, 7}
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0 and decontaminate.find_leaks(df.limit(0), bench).count() == 0


@pytest.mark.parametrize("answer", ["Paris", "the Seine", "in the old town"])
def test_short_answers_behind_a_label_are_leaks(spark, answer):
    rng = random.Random(17)
    question = sentence(rng, 10) + f" {answer} or " + sentence(rng, 9)
    docs = {1: f"{sentence(rng, 80)} {question}\nAnswer: {answer} {sentence(rng, 80)}", 2: f"{sentence(rng, 80)} {question} {sentence(rng, 80)}",
            3: f"{sentence(rng, 80)} {question}\n{answer} {sentence(rng, 80)}", 4: f"{sentence(rng, 80)} Answer: {answer}", 5: f"{question} Answer:\n{answer}"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, f"{question}\n{answer}")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.find_leaks(df, bench).collect()} == {1, 3, 5}
    assert {r["doc_id"] for r in decontaminate.without_leaks(df, bench).collect()} == {2, 4}


def test_block_max_retrieval_equals_scoring_all():
    rng = np.random.default_rng(9)
    item = np.repeat(np.arange(20), 12)
    term = rng.zipf(1.5, len(item)).astype(np.int64) % 60 + 1
    df = np.array([len(set(item[term == t])) for t in term])
    rows = {"item_id": item, "place": np.tile(np.arange(12), 20), "term": term, "answer": np.zeros(len(item), bool), "df": df}
    index = decontaminate.build_index(rows, 20, 12.0, 0.6)
    import pyarrow as pa

    from tickwise.llm.words import Words

    hashes = (rng.zipf(1.3, 4000).astype(np.uint64) % np.uint64(70)) + np.uint64(1)
    w = Words(np.zeros(0, np.uint8), np.arange(4000), np.arange(4000) + 1, hashes, np.array([0, 50, 50, 1000, 4000]), np.zeros(1, np.uint64))
    doc, start, found, score = decontaminate.retrieve(w, index, 64)
    got = {(int(s), int(i)): v for s, i, v in zip(start, found, score, strict=True)}
    impact = {}
    for c in range(len(index.keys)):
        for p in range(index.posting_first[c], index.posting_first[c + 1]):
            impact[(int(index.terms[index.keys[c] // index.blocks]), int(index.posting_item[p]))] = index.posting_impact[p]
    want = {}
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        for k in range(max(1, -(-(b - a) // 64) - 1)):
            own = set(hashes[a + 64 * k:min(b, a + 64 * k + 128)].tolist())
            for i in range(20):
                s = sum(v for (t, j), v in impact.items() if j == i and t in own)
                if s >= 0.6 + 1e-9:
                    want[(a + 64 * k, i)] = s
    assert set(want) <= set(got) and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert pa and all(v >= 0.6 - 1e-9 for v in got.values())


def test_compact_windows_hold_every_stretch_in_spite_of_ties():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = rng.integers(0, 40, 3)
        order, first = rng.integers(0, 4, sizes.sum()).astype(np.uint32), np.concatenate([[0], np.cumsum(sizes)])
        found = list(zip(*windows.compact_windows(order, first, 5), strict=True))
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            for a in range(lo, hi):
                for b in range(a + 4, hi):
                    held = [c for l, c, r in found if l <= a <= c <= b <= r]
                    assert len(held) == 1 and order[held[0]] == order[a:b + 1].min()


def test_compact_windows_of_one_word_said_again_and_again():
    n = 200_000
    l, c, r = windows.compact_windows(np.zeros(n, np.uint32), np.array([0, n]), 46)
    assert len(c) < 3 * n // 46


def test_several_indexes_are_held_one_at_a_time(spark):
    rng = random.Random(23)
    items = [(k, f"{sentence(rng, 12)}?\n{sentence(rng, 8)}") for k in range(30)]
    docs = [(k, f"{sentence(rng, 40)} {items[k][1]} {sentence(rng, 40)}") for k in range(0, 30, 2)] + [(k, sentence(rng, 90)) for k in range(1, 30, 2)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    left = decontaminate.without_leaks(table, benchmark, index_bytes=1_500)
    assert left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(1, 30, 2))


def test_top_k_of_components_beyond_64_bits_is_an_error(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e30, 2.0]), (2, [0.5, 0.25])]
    vectors = topk.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(vectors, vectors.where("vec_id = 0")).collect()


def test_top_k_takes_the_least_of_contradictory_queries(spark):
    vectors = spark.createDataFrame([(1, [3, 0]), (2, [0, 3])], "vec_id long, components array<long>")
    queries = spark.createDataFrame([(9, [5, 0]), (9, [0, 5])], "vec_id long, components array<long>")
    assert [tuple(r) for r in topk.top_k(vectors, queries, 1).collect()] == [(9, 1, 2, 15)]


def test_stored_tables_are_made_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    from tickwise.llm import frames

    def sizes(rows):
        for some in rows:
            yield pa.RecordBatch.from_pydict({"n": pa.array([some.num_rows], pa.int64())})

    monkeypatch.setattr(frames, "BATCH_BYTES", 100_000)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    table = spark.range(900).repartition(2).select("id", F.repeat(F.lit("word "), 400).alias("text")).mapInArrow(sizes, "n long")
    found = [r["n"] for r in frames.stored(table, "sizes").collect()]
    assert sum(found) == 900 and max(found) <= 51
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_pairs_that_the_ties_leave_out_are_met_in_blocks(spark, monkeypatch):
    rng = random.Random(21)
    line, parts = sentence(rng, 30), [sentence(rng, 60) for _ in range(6)]
    # Each document says the frequent line and two of six passages, so all pairs are alike in part only.
    docs = {d: f"{parts[d % 6]} {line} {sentence(rng, 15)} {parts[(d * 5 + d // 6) % 6]}" for d in range(70)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)

    def found():
        return sorted(tuple(r) for r in windows.repeated_passages(df).collect())

    plain = found()
    rest = windows._rest

    def by_all_pairs(view, docs, spots, passages, pairs, all_words):
        """Each pair that the ties leave out, verified by itself."""
        every = docs.select(F.col("doc_id").alias("a")).join(docs.select(F.col("doc_id").alias("b")), F.col("a") < F.col("b"))
        left = every.join(pairs, ["a", "b"], "left_anti").join(
            docs.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a").join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
        out = []
        for r in left.collect():
            one, two = (windows.ranked(windows.shingles(windows.split(windows.strings(pa.array([t]))), windows.SHINGLE)[0]) for t in (r["x"], r["y"]))
            out += [(r["b"], x, y + 4, r["a"], i, j + 4, s) for i, j, x, y, s in windows.shared_passages(one, two)]
        return spark.createDataFrame(out, windows.PASSAGE_TYPE) if out else rest(view, docs, spots, passages, pairs, all_words).limit(0)

    monkeypatch.setattr(windows, "TILE", 4)
    monkeypatch.setattr(windows, "TILE_WORDS", 700)
    monkeypatch.setattr(windows, "TILE_SENT", 8)
    monkeypatch.setattr(windows, "ROUND", 1)
    assert found() == plain
    monkeypatch.setattr(windows, "_rest", by_all_pairs)
    assert {r[:2] for r in found()} >= {r[:2] for r in plain} and set(plain) <= set(found())


def test_stored_tables_leave_no_shuffle_files(spark):
    import glob
    import os

    from tickwise import session
    from tickwise.llm import frames

    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in local for f in glob.glob(os.path.join(d, "**", "shuffle_*"), recursive=True)}
    for store in (lambda df: frames.stored(df, "spread"), session.keep):
        before = files()
        table = store(spark.range(5_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
        assert not files() - before and table.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
