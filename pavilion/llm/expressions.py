"""Column expressions that several operators share. No Python runs on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def upto(n: Column) -> Column:
    """0 to n - 1 as an array; empty if n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def _covered(positions: Column) -> Column:
    """Number of words in the windows that begin at the sorted ``positions``."""
    width = F.lit(SHINGLE_WORDS)
    return total(
        F.transform(positions, lambda p, i: F.least(width, F.coalesce(F.get(positions, i + 1) - p, width)).cast("long"))
    )


def _same_as_neighbour(pairs: Column) -> Column:
    def alike(pair: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(pairs, i - 1)["h"] == pair["h"]).otherwise(F.lit(False))
        after = F.coalesce(F.get(pairs, i + 1)["h"] == pair["h"], F.lit(False))
        return before | after

    return F.sort_array(F.transform(F.filter(pairs, alike), lambda pair: pair["i"]))


def repeated_words(words: Column) -> Column:
    """Number of ``words`` that lie in five-word windows found twice or more.

    Windows are compared by 64-bit hashes. Only a text that has a repeat pays for
    sorting its windows.
    """
    n = F.size(words)

    def hash_at(hashes: Column) -> Callable[[Column], Column]:
        return lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE_WORDS)])

    def count(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(pairs, lambda p: let(_same_as_neighbour(p), _covered))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(repeated)

    windows = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(upto(F.size(hashes) - SHINGLE_WORDS + 1), hash_at(hashes)),
    )
    return F.when(n <= SHINGLE_WORDS, F.lit(0).cast("long")).otherwise(let(windows, count))


def _count_chars(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def text_statistics(text: Column) -> Column:
    """A struct of counts over a whole text; a null text counts as empty.

    ``n_words``, ``n_distinct`` words, ``word_chars`` (code points in words),
    ``n_symbols`` of ``#*$%&|<>``, ``n_capitals`` A-Z, ``n_digits`` 0-9, ``n_marks``
    (exclamation marks), ``n_stops`` (sentence ends), ``n_lines`` that hold a word,
    ``n_dup_lines`` equal to an earlier one, ``n_repeat_words`` in five-word windows
    found twice.
    """
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column, lines: Column) -> Column:
        joined = F.array_join(words, "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            F.char_length(joined).cast("long").alias("word_chars"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            _count_chars(joined, r"[^#*$%&|<>]+").alias("n_symbols"),
            _count_chars(joined, r"[^A-Z]+").alias("n_capitals"),
            _count_chars(joined, r"[^0-9]+").alias("n_digits"),
            (F.char_length(joined) - F.char_length(F.replace(joined, F.lit("!"), F.lit("")))).cast("long").alias("n_marks"),
            F.regexp_count(text, F.lit(r"[.?!](?=[\x20\x09-\x0D]|$)")).cast("long").alias("n_stops"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: let(lines, lambda found: of_words(words, found))
    )
