"""Prose without licences is left alone; texts that do speak of one are not."""

from __future__ import annotations

import pytest

from pavilion.llm import license_scan

PROSE = [
    "You may like this recipe.", "The commercial break was long.", "She gave her permission.", "The licensed pub was shut.",
    "He lost his driving licence in May.", "The warranty on the car had run out.", "You may kiss the bride.",
    "All rights turns are forbidden here.", "Gnu herds cross the river in summer.", "We had no permission to enter the park.",
    "A commercial flight leaves at nine.", "Police arrested him without a warrant.", "Unauthorised visitors must leave.",
    "You may work tomorrow if you like.", "The proprietary sauce tastes of plums.", "Licences for fishing are sold at the harbour.",
    "You may use the back door.\nThe bell does not work.", "Copyright lawyers earn well.", "His poetic licence knew no bounds.",
]
LICENCES = [
    "You may not copy the software without a license.", "Use of this material requires the written permission of its owner.",
    "Some rights are granted under a licence agreement.", "This file is licensed under the Wibble licence.",
    "Unauthorised reproduction of this document is a crime.", "Redistribution is forbidden.",
    "The program is provided as is, without warranty.",
]


@pytest.fixture(scope="module")
def judged(spark):
    texts = [*PROSE, *LICENCES, " ".join(PROSE), " ".join(PROSE) + "\n\n" + LICENCES[0], "\n".join(PROSE) * 200, "", None]
    df = spark.createDataFrame(list(enumerate([*texts, PROSE[0]])), "id int, text string")
    result, (_, licenses, unmatched, kind, usable) = license_scan.scanned(df)
    return texts, {r.id: (list(r[licenses]), list(r[unmatched]), r[kind], r[usable]) for r in result.collect()}


def test_prose_is_left_alone(judged):
    texts, found = judged
    for i in [*range(len(PROSE)), len(PROSE) + len(LICENCES), *range(len(texts) - 3, len(texts) + 1)]:
        assert found[i] == ([], [], None, True), texts[i] if i < len(texts) else PROSE[0]


def test_unknown_licences_are_still_told(judged):
    texts, found = judged
    for i in [*range(len(PROSE), len(PROSE) + len(LICENCES)), len(PROSE) + len(LICENCES) + 1]:
        assert found[i][2] in ("unknown", "reserved") and not found[i][3], texts[i]


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "text string, licenses int")
    assert license_scan.scanned(df)[0].count() == 0
