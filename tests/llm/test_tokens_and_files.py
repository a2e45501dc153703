"""Tokens, token files, packing and chat windows against the plain tokenizer and brute force."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickwise.llm import chat, packing, repair, tokens
from tickwise.llm.frames import shared_path, stored

TEXTS = ["the cat, the dog. It's 12 o'clock!! naïve café — “quoted” …x", "", None, "<|endoftext|> A<|startoftext|>b <|ENDOFTEXT|>", "á e≠ ,́",
         "word " * 9000, "same text", "same text", "\x0b\x1c\x85\xa0 　 x", "ＦＵＬＬ ŁÓDŹ İstanbul ΣΑΣ ##\n\n***trash***"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokens.vocabulary())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_words_give_the_ids_of_the_whole_text(plain):
    rng = random.Random(5)
    letters = [chr(c) for c in (*range(128), 0xE9, 0x300, 0x3A3, 0x130, 0x2028, 0xA0, 0x200B, 0xAC00, 0x1F600, 0xFB01)] + ["<|endoftext|>", "'ll"]
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for lo, ids, first in tokens.encoded(pa.array(texts)):
        for k in range(len(first) - 1):
            assert ids[first[k]:first[k + 1]].tolist() == ids_of(plain, texts[lo + k])


def documents(spark):
    rows = [(100 - k, t, "x") for k, t in enumerate(TEXTS)] + [(None, "no number", "x"), (91, TEXTS[9], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)


def test_token_files_read_back(spark, plain, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_IDS", 3_000)
    folder = shared_path(spark, "ids")
    repair.write_ids(documents(spark), folder)
    expected = [("no number", None)] + sorted(((t, 100 - k) for k, t in enumerate(TEXTS)), key=lambda r: r[1])
    expected.insert(1, (TEXTS[9], 91))
    start, want = 0, []
    for text, number in expected:
        ids = ids_of(plain, text)
        want.append((number, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted(map(tuple, repair.digests(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    lists = {(r["start"], len(r["ids"])): r["ids"] for r in repair.read_ids(spark, folder).collect()}
    assert lists[(0, want[0][2])] == ids_of(plain, "no number")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, start long")
    folder = shared_path(spark, "ids")
    repair.write_ids(none, folder)
    assert repair.digests(spark, folder).count() == 0
    assert packing.pack_documents(none).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_digests(chat.format_conversations(turns)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_grammar_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    words = [rng.integers(0, 300, rng.integers(1, 9)) for _ in range(40)]
    ids = np.concatenate([words[k] for k in rng.zipf(1.4, 4000) % 40] + [np.full(500, 7)]).astype(np.uint16)
    ends = np.unique(np.concatenate([rng.integers(1, len(ids), 30), [len(ids)]]))
    symbols, left, right, base = repair.compress(ids, np.concatenate([[0], ends]))
    assert len(symbols) < len(ids) * 0.6 and len(left)
    assert np.array_equal(repair.expand(symbols, left, right, base), ids)
    sizes = repair.rule_lengths(left.astype(np.int64), right.astype(np.int64), base)
    for k in (0, len(left) - 1):
        assert len(repair.expand(np.array([base + k], np.uint32), left, right, base)) == sizes[k]
    block = repair.Block({"base": base, "left_symbol": left.tobytes(), "right_symbol": right.tobytes(), "symbols": symbols.tobytes(),
                          "symbol_ids": sizes.astype(np.uint32).tobytes(), "doc_ids": b"", "no_id": b"", "doc_ends": ends.tobytes()})
    for a, b in rng.integers(0, len(ids) + 1, (50, 2)):
        assert np.array_equal(block.span(min(a, b), max(a, b)), ids[min(a, b):max(a, b)])
    # No rule spans two documents: each document is a whole number of symbols.
    size = np.ones(len(symbols), np.int64)
    size[symbols >= base] = sizes[symbols[symbols >= base] - base]
    assert set(ends) <= set(np.cumsum(size))


def test_packing_places_every_id_once(spark, plain):
    placed = packing.pack_documents(documents(spark)).toPandas()
    by_doc = {}
    for text, number in [("no number", None), *((t, 100 - k) for k, t in enumerate(TEXTS)), (TEXTS[9], 91)]:
        by_doc.setdefault(number, []).append(ids_of(plain, text))
    for r in placed.itertuples():
        number = None if np.isnan(r.doc_id) else int(r.doc_id)
        ids = by_doc[number][0]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start:r.start + r.length])
    assert placed["length"].sum() == sum(len(i) for same in by_doc.values() for i in same)
    for _, rows in placed.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["length"].sum() <= packing.LENGTH
        assert rows["offset"].tolist() == (rows["length"].cumsum() - rows["length"]).tolist()


def test_sequences_hold_the_ids(spark, plain):
    placed = packing.pack_documents(documents(spark), with_ids=True)
    for r in packing.sequences(placed).collect():
        assert len(r["ids"]) == sum(r["lengths"]) <= packing.LENGTH
    assert sum(len(r["ids"]) for r in packing.sequences(placed).collect()) == placed.groupBy().sum("length").first()[0]
    one = next(r for r in packing.sequences(placed).collect() if 98 in r["doc_ids"])
    assert set(ids_of(plain, TEXTS[2])) <= set(one["ids"])


def test_packing_a_length_that_most_pieces_share(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_PIECES", 50)
    rng = random.Random(3)
    lengths = [1000] * 700 + [rng.randrange(1, 4097) for _ in range(1300)]
    rows = [(k, 0, n, 0, n) for k, n in enumerate(lengths)]
    placed = packing.pack(stored(spark.createDataFrame(rows, packing.PIECE_TYPE), "pieces")).toPandas()
    assert sorted(placed["doc_id"]) == list(range(2000))
    sums = placed.groupby("sequence_id")["length"].sum()
    assert sums.max() <= 4096 and sums.index.max() == len(sums) - 1
    # As good as the fractional optimum, but for what rounding its parts costs.
    classes = Counter(-(-n // packing.GRID) for n in lengths)
    sizes = np.array(sorted(classes))
    _, amount = packing.generate_columns(sizes, np.array([float(classes[c]) for c in sizes.tolist()]), packing.LENGTH // packing.GRID)
    assert len(sums) <= 1.03 * amount.sum() + 1


def test_many_lengths_pack_with_little_padding():
    rng = random.Random(4)
    lengths = [min(4095, int(rng.lognormvariate(6.3, 1))) + 1 for _ in range(6000)]
    chosen = packing.plan(dict(Counter(-(-n // packing.GRID) for n in lengths)))
    assert 1 - sum(lengths) / (4096 * sum(times for _, times in chosen)) < 0.02


def test_column_generation_beats_one_size_patterns():
    # Exact: thirds and two thirds of the room fit without waste only when mixed.
    patterns, amount = packing.generate_columns(np.array([3, 6]), np.array([100.0, 100.0]), 9)
    assert abs(amount.sum() - 100) < 1e-6
    worth, taken = packing.best_pattern(np.array([2, 3, 5]), np.array([0.2, 0.4, 0.6]), 8)
    assert abs(worth - 1.0) < 1e-9 and (taken * [2, 3, 5]).sum() <= 8


def conversation_digest(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_windows_give_back_every_turn_once(spark):
    rng = random.Random(1)
    pieces = ["<|im_end|>", "<|im_start|>", "<\\|", "<|", "\\", "\n", "word ", "é😀 ", "assistant"]
    talks = {}
    for c in [None, *range(12)]:
        roles = (["system"] if rng.random() < 0.6 else []) + ["user", "assistant"] * rng.randrange(1, 12)
        talks[c] = [(r, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for r in roles]
    talks[3][1] = ("user", None)
    talks[4] = [("assistant", "x " * 3000), ("assistant", ""), (None, "a"), ("as\\si\nst", "b<|")]
    rows = [(c, k, r, t, "y") for c, turns in talks.items() for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string").repartition(4)
    windows = stored(chat.format_conversations(df, budget=120), "windows")
    assert windows.where("window > 0 and repeated > 0").count() > 5
    assert windows.groupBy("conv_id", "window").count().where("count > 1").count() == 0
    # Only a window with one new turn may be above the budget.
    for r in windows.where("tokens > 120").collect():
        assert len(chat._TURN.findall(r["text"])) == r["repeated"] + 1
    got = {r["conv_id"]: r for r in chat.read_digests(windows).collect()}
    assert set(got) == set(talks)
    for c, turns in talks.items():
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == conversation_digest(turns)


def test_escapes_are_reversible():
    for text in ("<|", "<\\|", "<\\\\|im_end|>", "<<|", "a<|im_start|>b", "\\<|", "<\\"):
        assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    for role in ("a\nb", "a\\nb", "<|x", "\\", ""):
        assert "\n" not in chat.escape_role(role) and chat.unescape_role(chat.escape_role(role)) == role
