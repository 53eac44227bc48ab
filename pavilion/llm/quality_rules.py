"""Document quality by rules that vote, weighed by expectation-maximisation.

No document has to pass every rule: each rule votes for or against a document, or
abstains, and the posterior chance of quality decides. A document is good, or bad in
the way that one of the rules looks for. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm import votes
from pavilion.llm.expressions import let, text_statistics
from pavilion.llm.storage import stored

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.5


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def rule_votes(s: Column) -> list[Column]:
    """The votes of all rules on a struct of text statistics.

    Bounds are shares of the words or of their characters: symbols, capitals,
    repeated windows, distinct words, word length, repeated lines, exclamation
    marks, sentence ends, digits.
    """
    n, chars = s["n_words"], s["word_chars"]
    share = lambda part, whole, percent: 100 * part > percent * whole
    return [
        _vote(~share(s["n_symbols"], n, 2), share(s["n_symbols"], n, 15)),
        _vote(~share(s["n_capitals"], chars, 15), share(s["n_capitals"], chars, 40)),
        _vote(~share(s["n_repeat_words"], n, 5), share(s["n_repeat_words"], n, 25)),
        _vote((n >= 30) & share(s["n_distinct"], n, 35), (n >= 30) & ~share(s["n_distinct"], n, 15)),
        _vote(chars.between(3 * n, 12 * n), (chars < 2 * n) | (chars > 20 * n)),
        _vote((s["n_lines"] >= 3) & ~share(s["n_dup_lines"], s["n_lines"], 10), share(s["n_dup_lines"], s["n_lines"], 40)),
        _vote(~share(s["n_marks"], n, 5), share(s["n_marks"], n, 30)),
        _vote(share(s["n_stops"], n, 2) & ~share(s["n_stops"], n, 35), (n >= 50) & (s["n_stops"] == 0)),
        _vote(~share(s["n_digits"], chars, 10), (n >= 30) & share(s["n_digits"], chars, 40)),
    ]


def base_failed(s: Column) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def fitted(statistics: DataFrame, column: str) -> votes.Model:
    """The rules' reliabilities, from the statistics of all documents."""
    rules = rule_votes(F.col(column))
    patterns = votes.pattern_counts(statistics, rules)
    # Rules are written to reject hardly any good row, whatever the corpus is like.
    return votes.fit(patterns, votes.a_class_per_failure(patterns, len(rules)), trust_yes=1.0)


def judged(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, the statistics, ``quality``, ``base_failed``, ``kept`` per row of ``docs``.

    ``quality`` is the posterior chance; ``kept`` is false for rows that fail the
    base rules or have a chance below ``THRESHOLD``. Null, empty and wordless texts
    have zero counts and fail the base. Repeated rows are judged alike, each one.
    """
    given = docs.select(
        F.col(id_column).alias("id"), text_statistics(F.col(text_column)).alias("s")
    )
    known = stored(given, "statistics")
    model = fitted(known, "s")
    chance = model.probability(rule_votes(F.col("s")))
    failed = base_failed(F.col("s"))
    return known.select(
        F.col("id").alias(id_column), "s.*", chance.alias("quality"), failed.alias("base_failed"),
        (~failed & (chance >= THRESHOLD)).alias("kept"),
    )


def filtered(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, unchanged.

    Reliabilities come from a first pass over all rows; the second filters row by
    row, so texts are neither shuffled nor stored.
    """
    statistics = text_statistics(F.col(f"`{text_column}`"))
    model = fitted(stored(docs.select(statistics.alias("s")), "statistics"), "s")

    def good(s: Column) -> Column:
        return ~base_failed(s) & (model.probability(rule_votes(s)) >= THRESHOLD)

    return docs.where(let(statistics, good))
