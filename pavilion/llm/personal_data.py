"""Personal data in texts: patterns, word lists and context vote on spans.

Base patterns find e-mail addresses, IP addresses, card and telephone numbers, and
these always stay. Wider patterns propose more spans. Labelers then vote on every
span, base or proposed: its shape, its place in the text, the variety of its
characters, words known to go with it and words known to speak against it.
Expectation-maximisation over the counts of vote patterns estimates how reliable
the labelers are, and its posterior trains a logistic span classifier on votes,
kind and length, which decides about the proposed spans.

DataFrame functions only; spans count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm import votes
from pavilion.llm.expressions import let, total, upto
from pavilion.llm.storage import fresh, stored

BASE = ("email", "ip", "card", "phone")
PROPOSED = ("hidden_email", "local_phone", "national_id", "iban", "secret", "name")
KINDS = BASE + PROPOSED
THRESHOLD = 0.5

_NONE = "array<struct<start: int, k: int, end: int, hit: string>>"
# Matches of the base patterns begin where a run of their first characters begins, or
# where the last match ended; saying so spares a search from every character of a run.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_NUMBERS = r"[0-9][0-9().\x20-]{5,}[0-9]"
# Stands between the digits of a card in place of one space or hyphen; no text character.
_JOIN, _NOT_JOIN = "￿", "￾"

_LOCAL_PHONE = r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
_NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}\b"
_HIDDEN_EMAIL = r"\b[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?[A-Za-z0-9-]{1,63}){1,4}"
_SECRET_WORD = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)"
_SECRET = _SECRET_WORD + r"[\"']?\x20{0,2}[=:]\x20{0,2}[\"']?[A-Za-z0-9_/+.-]{6,}"
_TITLE = r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)"
_NAME = _TITLE + r"\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"

# Words before a span that speak for its kind, and words that speak against any.
_CUES = {
    "email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel)",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|login)",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|contact|telefon|téléphone|teléfono)",
    "hidden_email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel)",
    "local_phone": r"(?i)(?:phone|tel|call|mobile|fax|contact|telefon|téléphone|teléfono)",
    "national_id": r"(?i)(?:ssn|social security|national id|identity|passport)",
    "iban": r"(?i)(?:iban|account|bank|konto|compte|cuenta)",
    "secret": r"(?i)(?:login|user|account|key|auth|export|config)",
    "name": r"(?i)(?:name|signed|dear|contact|author|attn)",
}
_AGAINST = r"(?i)(?:version|isbn|order no|invoice|page|chapter|section|figure|example|serial|part no)"
_CONTEXT = 40


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """All matches of ``pattern``, leftmost first and apart, that ``keep`` accepts."""

    def place(gaps: Column, hits: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_NONE).alias("out"))

        def add(state: Column, i: Column) -> Column:
            begin = state["at"] + F.char_length(F.get(gaps, i))
            end = begin + F.char_length(F.get(hits, i))
            span = F.struct(
                begin.alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.alias("end"), F.get(hits, i).alias("hit")
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        return F.aggregate(upto(F.size(hits)), start, add, lambda state: state["out"])

    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: F.when(F.size(hits) == 0, F.array().cast(_NONE)).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: place(gaps, hits))
        ),
    )
    return F.filter(found, lambda span: keep(span["hit"])) if keep else found


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _luhn(hit: Column) -> Column:
    def check(digits: Column) -> Column:
        size = F.char_length(digits)

        def weighed(i: Column) -> Column:
            digit = F.substring(digits, size - i, F.lit(1)).cast("int")
            twice = 2 * digit
            return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice).cast("long")

        return F.when(size.between(12, 19), total(F.transform(upto(size), weighed)) % 10 == 0).otherwise(False)

    return let(_digits(hit), check)


def _cards(text: Column) -> Column:
    joined = F.regexp_replace(
        F.translate(text, _JOIN, _NOT_JOIN), r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN
    )
    return let(joined, lambda t: _spans(t, f"[0-9{_JOIN}]{{2,}}", "card", _luhn))


def _base_spans(text: Column) -> Column:
    none = F.array().cast(_NONE)
    numbers = F.concat(
        _spans(text, _IP, "ip", lambda hit: hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        _cards(text),
        F.when(
            F.contains(text, F.lit("+")),
            _spans(text, _PHONE, "phone", lambda hit: F.char_length(_digits(hit)).between(9, 15)),
        ).otherwise(none),
    )
    return F.concat(
        F.when(F.contains(text, F.lit("@")), _spans(text, _EMAIL, "email")).otherwise(none),
        F.when(text.rlike(_NUMBERS), numbers).otherwise(none),
    )


def _proposed_spans(text: Column) -> Column:
    none = F.array().cast(_NONE)
    guarded = [
        ("hidden_email", _HIDDEN_EMAIL, text.rlike(r"[\[(] ?(?:at|AT) ?[\])]")),
        ("local_phone", _LOCAL_PHONE, text.rlike(r"[0-9]{3}[ .-][0-9]{4}")),
        ("national_id", _NATIONAL_ID, text.rlike(r"[0-9]{2}-[0-9]{4}")),
        ("iban", _IBAN, text.rlike(r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{12}")),
        ("secret", _SECRET, (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(_SECRET_WORD)),
        ("name", _NAME, text.rlike(_TITLE + r"\.? \p{Lu}")),
    ]
    return F.concat(*[F.when(guard, _spans(text, pattern, kind)).otherwise(none) for kind, pattern, guard in guarded])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _span_votes(text: Column, span: Column) -> Column:
    """The labelers' votes on one span."""
    size = F.char_length(text)
    before = F.substring(text, F.greatest(span["start"] - _CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(_CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    cue = F.lit(False)
    for kind, words in _CUES.items():
        cue = F.when(span["k"] == KINDS.index(kind), before.rlike(words)).otherwise(cue)
    hit, digits = span["hit"], _digits(span["hit"])
    variety = F.size(F.array_distinct(F.split(F.regexp_replace(hit, r"[^\p{L}0-9]+", ""), "")))
    shapely = hit.rlike(r"^(?:[^\x20]+|[+(0-9][0-9 ().-]*)$")
    glued = before.rlike(r"[\p{L}0-9_/]$") | after.rlike(r"^[\p{L}0-9_/]")
    base = span["k"] < len(BASE)
    return F.array(
        _vote(cue, before.rlike(_AGAINST)),
        _vote(variety >= 5, variety <= 2),
        _vote(~glued & (span["end"] <= size), glued),
        _vote(shapely, F.char_length(hit) > 100),
        _vote(base, F.lit(False)),
        _vote((F.char_length(digits) >= 4) | hit.rlike("@|(?i)at|[.]"), F.char_length(hit) < 4),
    ).cast("array<int>")


LABELERS = 6
_LENGTHS = (8, 16, 32)


def candidate_spans(text: Column) -> Column:
    """Base and proposed spans as ``start``, ``k`` (place in ``KINDS``), ``end``, ``votes``.

    In order of start, then kind. A proposed span that overlaps a base span, or a
    proposed one of an earlier kind, is left out.
    """
    text = F.coalesce(text, F.lit(""))

    def overlap(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def both(base: Column, more: Column) -> Column:
        free = F.filter(more, lambda s: ~F.exists(base, lambda b: overlap(s, b)))
        apart = let(free, lambda f: F.filter(f, lambda s: ~F.exists(f, lambda o: (o["k"] < s["k"]) & overlap(s, o))))
        return F.sort_array(F.concat(base, apart))

    spans = let(
        _base_spans(text),
        lambda base: let(
            _proposed_spans(text), lambda more: F.when(F.size(more) == 0, F.sort_array(base)).otherwise(both(base, more))
        ),
    )
    return let(
        spans,
        lambda found: F.transform(
            found, lambda s: F.struct(s["start"], s["k"], s["end"], _span_votes(text, s).alias("votes"))
        ),
    )


@dataclass(frozen=True)
class Classifier:
    """Logistic weights on each labeler's vote, the kind and the length of a span."""

    bias: float
    vote_weights: tuple[dict[int, float], ...]
    kind_weights: tuple[float, ...]
    length_weights: tuple[float, ...]

    def probability(self, span: Column) -> Column:
        score = F.lit(self.bias)
        for i, weights in enumerate(self.vote_weights):
            vote = F.get(span["votes"], F.lit(i))
            score += F.when(vote == 1, weights[1]).when(vote == -1, weights[-1]).otherwise(weights[0])
        score += F.get(F.array(*map(F.lit, self.kind_weights)), span["k"])
        score += F.get(F.array(*map(F.lit, self.length_weights)), _length_class(span))
        return 1 / (1 + F.exp(-score))


def _length_class(span: Column) -> Column:
    length = span["end"] - span["start"]
    return sum((length > bound).cast("int") for bound in _LENGTHS)


def trained(spans: DataFrame) -> Classifier:
    """The span classifier, from the candidate spans (column ``span``) of all texts.

    The driver gets one count per cell of votes, kind and length class: at most
    3**6 * 10 * 4, whatever the number of spans.
    """
    cells = spans.select(F.col("span.votes").alias("v"), F.col("span.k").alias("k"), _length_class(F.col("span")).alias("l"))
    rows = [(tuple(r.v), r.k, r.l, r.n) for r in cells.groupBy("v", "k", "l").agg(F.count("*").alias("n")).collect()]
    rows.sort()
    patterns: dict[tuple[int, ...], int] = {}
    for v, _, _, n in rows:
        patterns[v] = patterns.get(v, 0) + n
    found = sorted(patterns.items())
    model = votes.fit(found, votes.two_classes(found, LABELERS, share=0.7), trust=0.2)
    columns = 1 + 3 * LABELERS + len(KINDS) + len(_LENGTHS) + 1
    x = np.zeros((len(rows), columns))
    y, n = np.zeros(len(rows)), np.zeros(len(rows))
    for i, (v, k, length, count) in enumerate(rows):
        x[i, 0] = 1
        for r, vote in enumerate(v):
            x[i, 1 + 3 * r + votes.VOTES.index(vote)] = 1
        x[i, 1 + 3 * LABELERS + k] = 1
        x[i, 1 + 3 * LABELERS + len(KINDS) + length] = 1
        y[i], n[i] = model.beliefs(v)[0], count
    w = np.zeros(columns)
    for _ in range(30):  # Newton steps on the ridge-penalised likelihood
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n * (y - p)) - w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(columns)
        w = w + np.clip(np.linalg.solve(curve, slope), -2, 2)
    w = w.tolist()
    by_vote = [w[1 + 3 * r : 4 + 3 * r] for r in range(LABELERS)]
    at = 1 + 3 * LABELERS
    return Classifier(
        w[0],
        tuple(dict(zip(votes.VOTES, ws, strict=True)) for ws in by_vote),
        tuple(w[at : at + len(KINDS)]),
        tuple(w[at + len(KINDS) :]),
    )


def _accepted(spans: Column, classifier: Classifier) -> Column:
    return F.filter(spans, lambda s: (s["k"] < len(BASE)) | (classifier.probability(s) >= THRESHOLD))


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.transform(
        spans, lambda s: F.struct(F.get(kinds, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def found(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``base``, ``spans`` for every row of ``docs``.

    Both are arrays of ``kind``, ``start``, ``end``, by start and then by kind as
    listed in ``KINDS``: the spans of the base patterns, and these with the proposed
    ones that the classifier accepts. Null and empty texts have none. Repeated rows
    are searched each.
    """
    given = docs.select(F.col(id_column).alias("id"), candidate_spans(F.col(text_column)).alias("spans"))
    known = stored(given, "spans")
    classifier = trained(known.select(F.explode("spans").alias("span")))
    base = F.filter("spans", lambda s: s["k"] < len(BASE))
    return known.select(
        F.col("id").alias(id_column), _named(base).alias("base"), _named(_accepted(F.col("spans"), classifier)).alias("spans")
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by ``<KIND>`` of its first."""
    kinds = F.array(*[F.lit(f"<{kind.upper()}>") for kind in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(
            s["start"] >= state["at"], F.concat(state["out"], F.array(gap, F.get(kinds, s["k"])))
        ).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    def close(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.char_length(text)))

    return F.aggregate(spans, start, add, close)


def masked(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the found spans of ``text_column`` replaced by ``<KIND>``.

    The classifier comes from a first pass over all rows; the second works row by
    row. Texts without spans, nulls among them, stay as they are.
    """
    text = F.col(f"`{text_column}`")
    (spans,) = fresh(docs, "spans")
    first = stored(docs.select(candidate_spans(text).alias("spans")), "spans")
    classifier = trained(first.select(F.explode("spans").alias("span")))
    known = docs.withColumn(spans, _accepted(candidate_spans(text), classifier))
    clean = F.when(F.size(F.col(spans)) == 0, text).otherwise(_masked(text, F.col(spans)))
    return known.withColumn(text_column, clean).drop(spans)
