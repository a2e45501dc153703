"""Term scan, prefix trie and line rules: against brute force on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickwise.llm import linerules, prefixtrie, termscan

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0 and d is not None:
                found.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=3, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, termscan.search(d, q, k, **options).collect()), key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "B", "the", "Ünder", "ünder", "x9", "9x", "日本", "naïve", "don't", "a-b", "\x7f", "É", "the"]
    docs = [(k, rng.choice([" ", ", ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(30)))) for k in range(80)]
    docs += [(7, "the the x9"), (7, "the the x9"), (None, "the naïve"), (200, None), (201, ""), (202, "... !"), (203, "the " * 300_000 + "日本")]
    items = [(1, "the a b"), (1, "日本 the the"), (2, None), (3, ""), (4, "nowhere found"), (None, "x9 under ÜNDER"), (5, "NAÏVE naïve a-b don't")]
    items += [(100 + k, " ".join(rng.choice(words) for _ in range(6))) for k in range(30)]
    want = brute_search(docs, items, 3)
    assert searched(spark, docs, items) == want
    # Blocks of items and small tiles of scores change nothing, nor do sums in integers.
    monkeypatch.setattr(termscan, "SCORE_CELLS", 50)
    assert searched(spark, docs, items, item_bytes=200) == want


def test_search_in_integers(spark):
    docs = [(1, "a b"), (2, "b c c")]
    many = "a b c " * 700_000
    assert searched(spark, docs, [(1, many)]) == brute_search(docs, [(1, many)], 3)


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def brute_trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own_cost = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        saved[p] = own_cost + sum(saved[q] for q in children[p])
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if full[c] == p).encode()).hexdigest()) for p, m in members.items())


def trie(spark, turns, **options):
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, depth string").repartition(3)
    return sorted(map(tuple, prefixtrie.prefix_trie(df, **options).collect()))


def some_turns(rng, convs, longest=9):
    return [(c, rng.choice([k, k, k, 3, None]), rng.choice(["user", "assistant", "", None]), rng.choice(["a", "bb", "", None, "ccc"]))
            for c in convs for k in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("options", [{}, {"band": 3, "queue": 2}])
def test_trie_equals_brute_force(spark, options, monkeypatch):
    rng = random.Random(11)
    turns = some_turns(rng, [*range(0, 30), *range(101, 150), 7000, 7001, 90_000_000_001])
    # A group of copies, a long shared conversation, a base that is missing, and rows without conversation.
    turns += [(c, k, "user", f"same {k}") for c in range(300, 345) for k in range(4)]
    turns += [(c, k, "user", f"long {k}") for c in (500, 501, 502) for k in range(200)]
    turns += [(None, 1, "user", "nobody"), (12, 1, "user", "twice"), (12, 1, "user", "twice"), (601, 0, "user", "x" * 2_000_000)]
    if options:
        monkeypatch.setattr(prefixtrie, "PLACES", 7)
        monkeypatch.setattr(prefixtrie, "HEAVY", 2)
        monkeypatch.setattr(prefixtrie, "small_enough", lambda *_: False)
    assert trie(spark, turns, **options) == brute_trie(turns)


def test_small_tries(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    for one in ([(5, 0, "user", "x")], [(c, 0, "user", "y") for c in range(40)], [(100, 2, None, None), (100, 1, "a", "b")]):
        assert trie(spark, one) == brute_trie(one)


def test_queue_spills_and_keeps_order():
    rng = random.Random(1)
    entries = [(rng.randrange(50), k) for k in range(3_000)]
    queue = prefixtrie.SpillingQueue(20)
    for e in entries:
        queue.push(e)
    assert len(queue.runs) > 10
    got = [e for key in range(50) for e in queue.take((key,))]
    assert got == sorted(entries)


def test_queue_takes_between_pushes():
    queue = prefixtrie.SpillingQueue(4)
    for k in range(20):
        queue.push((20 - k, k))
    assert list(queue.take((1,))) == [(1, 19)]
    queue.push((2, 99))
    assert list(queue.take((2,))) == [(2, 18), (2, 99)]
    assert list(queue.take((2,))) == [] and list(queue.take((3,))) == [(3, 17)]


def brute_rules(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    repeated = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    kept = []
    for line in dict.fromkeys(lines):
        if (re.search(linerules.SENTENCE_END.replace(r"\z", r"\Z"), line) and not re.search(linerules.NAVIGATION, line)
                and 10 * len(re.findall(linerules.MARKS, line)) <= len(line) and not re.search(linerules.BOILERPLATE, line)):
            kept.append(line)
    chars, left = sum(map(len, words)), sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in kept)
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed,
            not failed and 100 * (chars - left) <= linerules.MAX_LOST * chars, "\n".join(kept))


GOOD = "The river rose slowly in spring. Nobody in town had seen that before, and it was told for years."


def test_line_rules_equal_brute_force(spark):
    rng = random.Random(5)
    parts = [GOOD, "Home | News | Sport | About", "Read more", "no end here", "Fine line, it ends.", "  ", "", "\t\x0b", "!!!! $$$$ #### !", "Ça va « bien ». Oui!",
             "a b c.", "\x85\x1c x.", "one two three four five six. one two three four five six.", "Said \"so.\"", "1|2|3|4."]
    texts = [None, "", " \n ", GOOD, "x" * 2_000_000, "word " * 200_000, (GOOD + "\n") * 3, GOOD + "\r\n" + GOOD]
    texts += ["\n".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(150)] + [GOOD]
    df = spark.createDataFrame([(k, t, "own", 1) for k, t in enumerate(texts)], "doc_id long, text string, kept string, _words int").repartition(3)
    got = linerules.judge_lines(df).orderBy("doc_id").select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                                                             "clean_text", "_words").collect()
    assert [tuple(r)[:8] for r in got] == [brute_rules(t) for t in texts]
    assert {r["_words"] for r in got} == {1}
    assert linerules.judge_lines(df.where(F.lit(False))).count() == 0


def test_line_rules_reject_what_loses_its_text(spark):
    menu = "\n".join(f"Section{k} | Prices{k} | Contact{k} | Imprint{k}" for k in range(12))
    df = spark.createDataFrame([(1, GOOD + "\n" + menu), (2, GOOD + "\nHome | News | Sport")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in linerules.judge_lines(df).collect()}
    assert not got[1]["kept"] and not got[1]["base_failed"] and got[1]["clean_text"] == GOOD
    assert got[2]["kept"] and got[2]["n_removed_lines"] == 1
