"""Weak supervision: rules vote, expectation-maximisation says how far to trust each.

A rule votes 1 (yes), -1 (no) or 0 (abstains). Rows are counted by their pattern
of votes; there are at most 3**rules patterns, whatever the number of rows, and
only these counts reach the driver. Rows belong to classes that are not observed,
the first of which is yes; in each a rule has its own chance of each vote.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOTES = (1, 0, -1)
Patterns = list[tuple[tuple[int, ...], int]]


@dataclass(frozen=True)
class Model:
    """Share of each class, and per class and rule the chance of each vote."""

    shares: tuple[float, ...]
    chances: tuple[tuple[dict[int, float], ...], ...]

    def beliefs(self, votes: Sequence[int]) -> list[float]:
        """The posterior chance of each class."""
        logs = [
            math.log(share) + sum(math.log(rule[v]) for rule, v in zip(rules, votes, strict=True))
            for share, rules in zip(self.shares, self.chances, strict=True)
        ]
        weights = [math.exp(x - max(logs)) for x in logs]
        return [w / sum(weights) for w in weights]

    def probability(self, votes: Sequence[Column]) -> Column:
        """The posterior chance of yes, as a column over vote columns."""

        def odds(other: int) -> Column:
            terms = [F.lit(math.log(self.shares[other] / self.shares[0]))]
            for yes, no, vote in zip(self.chances[0], self.chances[other], votes, strict=True):
                weight = {v: math.log(no[v] / yes[v]) for v in VOTES}
                terms.append(F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0]))
            return F.exp(reduce(lambda a, b: a + b, terms))

        return 1 / (1 + reduce(lambda a, b: a + b, [odds(k) for k in range(1, len(self.shares))]))


def pattern_counts(df: DataFrame, votes: Sequence[Column]) -> Patterns:
    """Number of rows per pattern of votes; tasks count before the shuffle."""
    names = [f"v{i}" for i in range(len(votes))]
    counted = df.select(*[v.alias(n) for v, n in zip(votes, names, strict=True)]).groupBy(*names)
    rows = counted.agg(F.count("*").alias("rows")).collect()
    return sorted((tuple(int(row[n]) for n in names), int(row["rows"])) for row in rows)


def _silence(patterns: Patterns, rules: int) -> list[float]:
    """How often each rule abstains, kept away from 0 and 1."""
    rows = sum(count for _, count in patterns)
    shares = [sum(c for p, c in patterns if p[r] == 0) / rows if rows else 0.3 for r in range(rules)]
    return [min(0.9, max(0.05, s)) for s in shares]


def two_classes(patterns: Patterns, rules: int, share: float = 0.5, accuracy: float = 0.85) -> Model:
    """A start with yes and no, where a rule that votes is mostly right."""
    yes, no = [], []
    for silent in _silence(patterns, rules):
        right, wrong = (1 - silent) * accuracy, (1 - silent) * (1 - accuracy)
        yes.append({1: right, 0: silent, -1: wrong})
        no.append({1: wrong, 0: silent, -1: right})
    return Model((share, 1 - share), (tuple(yes), tuple(no)))


def a_class_per_failure(patterns: Patterns, rules: int, share: float = 0.85, false_alarm: float = 0.01) -> Model:
    """A start with yes, and one class for each rule that it alone is sure to reject.

    Bad rows are bad in different ways, which two classes cannot tell apart from
    good rows that one rule happens to reject.
    """
    silence = _silence(patterns, rules)
    usual = tuple({1: (1 - s) * (1 - false_alarm), 0: s, -1: (1 - s) * false_alarm} for s in silence)
    mixed = [{1: (1 - s) * 0.8, 0: s, -1: (1 - s) * 0.2} for s in silence]
    failing = {1: 0.02, 0: 0.03, -1: 0.95}
    others = (tuple(failing if q == r else mixed[q] for q in range(rules)) for r in range(rules))
    return Model((share, *[(1 - share) / rules] * rules), (usual, *others))


def fit(
    patterns: Patterns, start: Model, trust: float = 0.02, trust_yes: float | None = None, rounds: int = 100
) -> Model:
    """Expectation-maximisation from ``start``.

    The start stays in play with the weight of ``trust`` times the rows in each
    class (ten rows at least), so that classes keep their meaning and a handful of
    rows changes little; ``trust_yes`` is that of the first class, if it differs.
    Without rows the result is the start.
    """
    rows = sum(count for _, count in patterns)
    model = start
    weights = [max(10.0, trust * rows)] * len(start.shares)
    if trust_yes is not None:
        weights[0] = max(10.0, trust_yes * rows)
    for _ in range(rounds if rows else 0):
        beliefs = [model.beliefs(p) for p, _ in patterns]
        shares, chances = [], []
        for k, first in enumerate(start.chances):
            sums = [dict.fromkeys(VOTES, 0.0) for _ in first]
            whole = 0.0
            for (pattern, count), belief in zip(patterns, beliefs, strict=True):
                part = count * belief[k]
                whole += part
                for table, vote in zip(sums, pattern, strict=True):
                    table[vote] += part
            weight, shared = weights[k], max(10.0, trust * rows)
            shares.append((whole + shared * start.shares[k]) / (rows + shared))
            chances.append(
                tuple(
                    {v: (table[v] + weight * rule[v]) / (whole + weight) for v in VOTES}
                    for table, rule in zip(sums, first, strict=True)
                )
            )
        model = Model(tuple(shares), tuple(chances))
    return model
