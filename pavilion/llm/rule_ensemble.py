"""A quality classifier of few rules: tree paths, weighed by a lasso.

Statistics of the texts are columns. On a bounded sample of labelled rows, small
trees are boosted; every path from a root to a node is a rule, a conjunction of
comparisons. A logistic regression with an absolute penalty gives most rules no
weight. The rest is compiled into a column expression, so scoring runs without
Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm.expressions import text_statistics
from pavilion.llm.storage import stored

# At most so many labelled rows are learnt from: those with the smallest hashed ids.
TRAINING_ROWS = 20_000
TREES, DEPTH, RATE, LEAF_ROWS = 40, 3, 0.3, 20
CUTS = 32
PENALTY = 0.001
THRESHOLD = 0.3

FEATURES = (
    "words", "distinct", "word_length", "line_words", "repeated_lines", "repeated_words", "symbols", "capitals",
    "digits", "marks", "stops",
)


def features(s: Column) -> list[Column]:
    """Numbers in the order of ``FEATURES``, from a struct of text statistics."""
    n, chars, lines = (F.greatest(s[c], F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    return [
        F.log1p(s["n_words"].cast("double")), s["n_distinct"] / n, s["word_chars"] / n, s["n_words"] / lines,
        s["n_dup_lines"] / lines, s["n_repeat_words"] / n, s["n_symbols"] / n, s["n_capitals"] / chars,
        s["n_digits"] / chars, s["n_marks"] / n, s["n_stops"] / n,
    ]


# A condition is a feature, whether it has to be above the bound, and the bound.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Ensemble:
    """Weighted conjunctions; the score is the chance of label 1."""

    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, values: list[Column]) -> Column:
        total = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for feature, above, bound in conditions:
                holds = holds & (values[feature] > bound if above else values[feature] <= bound)
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _tree(bins: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> tuple[list, np.ndarray]:
    """Paths to all nodes of one boosted tree, and its prediction for every row."""
    paths, value = [], np.zeros(len(slope))

    def grow(rows: np.ndarray, path: tuple[Condition, ...], taken: tuple) -> None:
        if path:
            paths.append((path, taken))
        g, h = slope[rows], curve[rows]
        value[rows] = g.sum() / (h.sum() + 1)
        if len(taken) == DEPTH or len(rows) < 2 * LEAF_ROWS:
            return
        best, whole = (1e-6, None), g.sum() ** 2 / (h.sum() + 1)
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            place = bins[rows, f]
            gs = np.cumsum(np.bincount(place, g, len(edges) + 1))[:-1]
            hs = np.cumsum(np.bincount(place, h, len(edges) + 1))[:-1]
            ns = np.cumsum(np.bincount(place, minlength=len(edges) + 1))[:-1]
            gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - whole
            gain[(ns < LEAF_ROWS) | (len(rows) - ns < LEAF_ROWS)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (f, k))
        if best[1] is None:
            return
        f, k = best[1]
        above = bins[rows, f] > k
        for side in (False, True):
            condition = (f, side, float(cuts[f][k]))
            grow(rows[above == side], (*path, condition), (*taken, (f, k, side)))

    grow(np.arange(len(slope)), (), ())
    return paths, value


def trained(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """An ensemble for features ``x`` and labels ``y``; constant if there is one label only."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Ensemble(float(np.log(share / (1 - share))), ())
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    found: dict[tuple, tuple] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        paths, value = _tree(bins, cuts, y - p, p * (1 - p))
        score += RATE * value
        for path, taken in paths:
            found.setdefault(tuple(sorted(taken)), path)
    rules = list(found.items())
    holds = np.ones((len(y), len(rules)), dtype=np.float32)
    for j, (taken, _) in enumerate(rules):
        for f, k, side in taken:
            holds[:, j] *= (bins[:, f] > k) == side
    weights, bias = _lasso(holds, y.astype(np.float32))
    kept = [(path, float(w)) for (_, path), w in zip(rules, weights, strict=True) if w]
    return Ensemble(bias, tuple(kept))


def _lasso(x: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an absolute penalty, by accelerated proximal gradient."""
    n, size = len(y), x.shape[1]
    speed = 4 * n / max(1e-9, float(np.linalg.norm(np.column_stack([x, np.ones(n, np.float32)]), 2) ** 2))
    w = at = np.zeros(size)
    b = b_at = float(np.log(y.mean() / (1 - y.mean())))
    pace = 1.0
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-(x @ at.astype(np.float32) + np.float32(b_at)))) - y
        new = at - speed * (x.T @ wrong) / n
        new = np.sign(new) * np.maximum(np.abs(new) - speed * PENALTY, 0)
        new_b = b_at - speed * float(wrong.mean())
        next_pace = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        push = (pace - 1) / next_pace
        at, b_at = new + push * (new - w), new_b + push * (new_b - b)
        w, b, pace = new, new_b, next_pace
    return w, float(b)


def is_held_out(id_column: str) -> Column:
    """A fifth of the ids, by checksum; their labels are never learnt from."""
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def fitted(known: DataFrame, labels: DataFrame, id_column: str, label_column: str, rows: int = TRAINING_ROWS) -> Ensemble:
    """An ensemble from the features ``x`` of ``known`` and the labels that are not held out.

    Null labels and ids count for nothing; of several labels for an id the largest
    counts, and of several rows with an id one.
    """
    usable = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & ~is_held_out(id_column))
    own = usable.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("double").alias("y"))
    chosen = known.join(stored(own, "labels"), "id").orderBy(F.xxhash64("id"), "id", "x").limit(rows)
    sample = {row.id: (row.x, row.y) for row in chosen.select("id", "x", "y").collect()}
    x = np.array([v[0] for v in sample.values()], dtype=float).reshape(len(sample), len(FEATURES))
    return trained(x, np.array([v[1] for v in sample.values()]))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """``id_column``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    Only statistics of the whole text enter the score; a null text counts as empty.
    Without usable labels every score is a half. A null id is not held out.
    """
    texts = docs.select(F.col(id_column).alias("id"), text_statistics(F.col(text_column)).alias("s"))
    given = texts.select("id", F.array(*features(F.col("s"))).alias("x"))
    known = stored(given, "features")
    ensemble = fitted(known, labels, id_column, label_column, training_rows)
    score = ensemble.score([F.get("x", F.lit(i)) for i in range(len(FEATURES))])
    return known.select(
        F.col("id").alias(id_column),
        F.coalesce(is_held_out("id"), F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )
