"""Quality rules, lines first: what single lines give away is judged and removed before the document is.

A line fails if it holds no sentence end (punctuation), is a row of links parted by separators (navigation), is full of
signs or shouting (symbols), says what pages say to visitors (boilerplate), or repeats an earlier line of its document. What is left is the
clean text; a document that loses more than ``MAX_LOST`` percent of its word characters goes, as one that fails the base rules does.

Columns and SQL functions only: a document's words, lines and word windows are arrays within its row, so nothing is shuffled and
each document costs what its own length costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import free_name

MIN_WORDS = 10
MAX_REPEATED = 20
MAX_LOST = 30
WINDOW = 5
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
# A sentence mark, perhaps closed by quotes or brackets, before white space or the line's end.
SENTENCE_END = r"""[.!?…。！？؟।]["'”’»)\]]*([\x20\x09-\x0D]|\z)"""
# Three separators, each at most forty characters after the one before.
NAVIGATION = r"([|»›•][^|»›•]{0,40}){3}"
# Signs of which a line must not be made up by more than a tenth.
MARKS = r"[#*$%&<>!]"
BOILERPLATE = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|(accept|use|uses) cookies|cookie policy|enable javascript"
               r"|lorem ipsum|subscribe to our|sign up for|click here|read more|skip to content|back to top)")

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines", "kept_chars", "base_failed", "kept",
         "clean_text")


def _long(value: Column) -> Column:
    return value.cast("long")


def _word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, ""))


def line_passes(line: Column) -> Column:
    """Whether a line, without what is before or after it, is worth keeping."""
    marks = F.length(F.regexp_replace(line, "[^" + MARKS[1:-1] + "]", ""))
    return (F.rlike(line, F.lit(SENTENCE_END)) & ~F.rlike(line, F.lit(NAVIGATION)) & (marks * 10 <= F.length(line))
            & ~F.rlike(line, F.lit(BOILERPLATE)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it within lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(starts: Column) -> Column:
    """How many words lie in the windows that start at these ascending places, each word once."""
    def steps(at: Column) -> Column:
        following = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(following, F.lit(0).cast("long"), lambda total, x: total + x)

    return _let(starts, steps)


def _repeated_words(windows: Column) -> Column:
    """Words within windows that are found twice or more: windows are sorted by hash and place, then meet their equals as neighbours."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(all_: Column) -> Column:
        hits = F.filter(all_, lambda x, k: (x["h"] == F.get(all_, k - 1)["h"]) | (x["h"] == F.get(all_, k + 1)["h"]))
        return F.sort_array(F.transform(hits, lambda x: x["i"]))

    found = _covered(_let(placed, lambda all_: twice(all_)))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(found)


def judge_lines(docs: DataFrame, text: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """The columns of ``docs`` but the text, then counts, ``base_failed``, ``kept`` and ``clean_text`` (the passing lines, joined by newlines).

    ``kept``: not ``base_failed`` (under ``MIN_WORDS`` words, or over ``MAX_REPEATED`` percent of them in repeated five-word windows), and at most
    ``max_lost`` percent of the word characters are in removed lines. A null text counts as empty and fails; blank lines are no lines; of equal lines the first
    stays; repeated rows are judged alone, each the same; an empty table gives no rows; own columns with the names of added ones are dropped.
    """
    taken = {c.lower() for c in ADDED}
    own = [c for c in docs.columns if c.lower() not in taken and c.lower() != text.lower()]
    body, words, lines, windows, clean = (free_name([*own, *ADDED], n) for n in ("_text", "_words", "_lines", "_windows", "_clean"))
    out = docs.select(*own, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(body))
    trimmed = F.btrim(F.col(body), F.lit(SPACES))
    has_word = lambda line: F.btrim(line, F.lit(SPACES)) != ""
    out = out.select("*", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+")).alias(words),
                     F.filter(F.split(F.col(body), "\n"), has_word).alias(lines))
    w = F.col(words)
    heads = F.transform(F.slice(w, F.lit(1), F.size(w) - (WINDOW - 1)),
                        lambda first, i: F.xxhash64(first, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    out = out.select("*", F.when(F.size(w) >= WINDOW, heads).otherwise(F.array().cast("array<bigint>")).alias(windows),
                     F.array_distinct(F.col(lines)).alias("clean_text"))
    out = out.withColumn(clean, F.filter(F.col("clean_text"), line_passes))
    n_lines = F.size(lines)
    out = out.select(
        *own, body, _long(F.size(w)).alias("n_words"), _long(_word_chars(F.col(body))).alias("word_chars"),
        _long(F.regexp_count(F.col(body), F.lit(SYMBOLS))).alias("n_symbols"),
        _long(n_lines - F.size("clean_text")).alias("n_dup_lines"), _repeated_words(F.col(windows)).alias("n_repeat_words"),
        _long(n_lines).alias("n_lines"), _long(n_lines - F.size(clean)).alias("n_removed_lines"), F.array_join(clean, "\n").alias("clean_text"))
    out = out.withColumn("kept_chars", _long(_word_chars(F.col("clean_text"))))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > max_lost * F.col("word_chars")
    return out.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~lost).select(*own, *ADDED)
