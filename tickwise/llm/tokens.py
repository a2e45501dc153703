"""Whole text columns to token ids with a public tokenizer, each distinct word encoded once."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tickwise.llm.words import process_state, slices, split, strings

WORD_BPE = "word_bpe_49k.json"
END_ID = 2
_TABLE_BITS = 21
_POOL_IDS = 3_000_000


def vocabulary(name: str = WORD_BPE) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder of a tokenizer file; None: the word BPE of 49,408 ids."""
    path = path or vocabulary()
    encoders = process_state("encoders")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


class Encoder:
    """Encodes texts word by word and remembers words.

    Valid for tokenizers whose pieces never span white space and to which kinds of white space are alike, such as
    the word BPE: the ids of a text are then those of its words, one after another. The remembered words are bounded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(names.values()) + 1
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.final = np.zeros(size, dtype=bool)
        self.final[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(1 << _TABLE_BITS, np.uint64)
        self.word = np.zeros(1 << _TABLE_BITS, np.int32)
        self.pool = np.zeros(1 << 16, self.kind)
        self.used = 1
        # Word 0 is the end mark.
        self.pool[0] = END_ID
        self.begin = np.zeros(1 << 14, np.int32)
        self.length = np.ones(1 << 14, np.int32)
        self.words = 1

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after another, and how many each has."""
        one_by_one = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lengths = np.fromiter((len(e.ids) for e in one_by_one), np.int32, len(texts))
        return np.fromiter((i for e in one_by_one for i in e.ids), self.kind, int(lengths.sum())), lengths

    def _plain_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters or of signs alone: joined, as the last id of each bears the end-of-word mark."""
        ids, lengths = [np.zeros(0, self.kind)], [np.zeros(0, np.int32)]
        for lo in range(0, len(texts), 1024):
            some = texts[lo:lo + 1024]
            joined = " ".join(some)
            got = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.final[got]) + 1
            if len(ends) != len(some) or "<|" in joined:
                got, each = self._ids(some)
            else:
                each = np.diff(ends, prepend=0)
            ids.append(got)
            lengths.append(each)
        return np.concatenate(ids), np.concatenate(lengths)

    def _learn(self, texts: list[str]) -> np.ndarray:
        """Remember words; returns the number of each."""
        plain = np.fromiter((t.isalpha() or (t.isascii() and "'" not in t and not any(map(str.isalnum, t))) for t in texts),
                            bool, len(texts))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        count = int(plain.sum())
        a, b = self._plain_ids([texts[k] for k in order[:count].tolist()]), self._ids([texts[k] for k in order[count:].tolist()])
        lengths = np.concatenate([a[1], b[1]])
        total, first = int(lengths.sum()), self.words
        while len(self.pool) < self.used + total:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.begin) < self.words + len(texts):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.pool[self.used:self.used + total] = np.concatenate([a[0], b[0]])
        self.length[first:first + len(texts)] = lengths
        self.begin[first:first + len(texts)] = self.used + np.cumsum(lengths) - lengths
        self.used += total
        self.words += len(texts)
        numbers = np.empty(len(texts), np.int32)
        numbers[order] = first + np.arange(len(texts), dtype=np.int32)
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with the end id after each, and where each text's ids begin (one more than texts).

        Null counts as empty. The column should be a slice of bounded size.
        """
        if self.used > _POOL_IDS:
            self.forget()
        column = strings(column)
        raw = column.buffers()[2]
        special = raw is not None and b"<|" in raw.to_pybytes()
        words = split(column, lower=not special, pieces=not special)
        slot = (words.hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        index = self.word[slot]
        missed = np.flatnonzero(self.known[slot] != words.hashes)
        if len(missed):
            new, where, back = np.unique(words.hashes[missed], return_index=True, return_inverse=True)
            data = words.data.tobytes()
            at = missed[where]
            texts = [data[a:b].decode("utf-8", "replace")
                     for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
            numbers = self._learn(texts)
            # Of two new words in one slot the later stays; both get their ids here.
            self.word[slot[at]] = numbers
            self.known[slot[at]] = new
            index[missed] = numbers[back]
        ends = words.first + np.arange(len(words.first))
        inner = np.ones(ends[-1], dtype=bool)
        inner[ends[1:] - 1] = False
        marked = np.zeros(ends[-1], np.int32)
        marked[inner] = index
        index = marked
        lengths = self.length[index]
        begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        source = np.repeat(self.begin[index] - begin[:-1], lengths) + np.arange(begin[-1])
        return self.pool[source], begin[ends]


def encoded(column: pa.Array, path: str | None = None):
    """Slices of bounded size of a text column: first row, ids, where each row's ids begin."""
    column = strings(column)
    tool = encoder(path)
    for lo, hi in slices(column):
        # A copy, so that the slice's buffers hold its own bytes alone.
        part = pa.concat_arrays([column.slice(lo, hi - lo)])
        ids, first = tool.encode(part)
        yield lo, ids, first
