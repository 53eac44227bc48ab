"""The search for benchmark windows and the longest matches, against brute force and on repeated words."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from pavilion.llm import decontamination
from pavilion.llm.decontamination import Block


def searched(block, texts):
    """Marked words, and the longest match of every text and item that meet."""
    first, ids, mask, docs, items = block.search(texts)
    plain = np.flatnonzero(mask)
    ranges = np.searchsorted(plain, first)
    found = []
    for d, item in zip(docs.tolist(), items.tolist(), strict=True):
        start, words, there = block.longest(ids, plain[ranges[d] : ranges[d + 1]], item)
        found.append((d, item, start - int(first[d]), words, there))
    return mask.tolist(), found


def brute_force(items, texts, window):
    marks, found = [], []
    for d, text in enumerate(texts):
        mark = [False] * len(text)
        for i, item in enumerate(items):
            w, met = min(window, len(item)), False
            for j in range(len(item) - w + 1 if item else 0):
                for p in range(len(text) - w + 1):
                    if text[p : p + w] == item[j : j + w]:
                        met = True
                        mark[p : p + w] = [True] * w
            best = (0, 0, 0)
            for p in range(len(text) if met else 0):
                for j in range(len(item)):
                    n = 0
                    while p + n < len(text) and j + n < len(item) and text[p + n] == item[j + n]:
                        n += 1
                    best = max(best, (n, -p, -j))
            if met:
                found.append((d, i, -best[1], best[0], -best[2]))
        marks += mark
    return marks, found


@pytest.mark.parametrize("seed", range(4))
def test_windows_and_matches_of_random_words(seed):
    """Few different words, so that windows repeat, overlap and end texts."""
    rng = random.Random(seed)
    for _ in range(300):
        letters, window = "abcdef"[: rng.choice([1, 2, 3, 6])], rng.choice([1, 2, 3, 5])
        words = lambda most: [rng.choice(letters) for _ in range(rng.randint(0, most))]  # noqa: B023, E731
        items, texts = [words(9) for _ in range(rng.randint(1, 3))], [words(20) + ["q"] * rng.randint(0, 1) + words(9) for _ in range(3)]
        block = Block([(str(i), " ".join(x).encode()) for i, x in enumerate(items)], window)
        assert searched(block, [" ".join(t).encode() for t in texts]) == brute_force(items, texts, window)


def test_repeated_words_take_time_in_proportion():
    block = Block([("a", b"word " * 1600), ("zero", b"0 " * 500)])
    begin = time.process_time()
    mask, found = searched(block, [b"word " * 40_000, b"0 " * 300_000])
    assert all(mask) and found == [(0, 0, 0, 1600, 0), (1, 1, 0, 500, 0)]
    assert time.process_time() - begin < 3


def test_matches_of_documents(spark):
    item = " ".join(f"w{i}" for i in range(40))
    texts = [f"x {item} y", " ".join(f"w{i}" for i in range(5, 25)), "w1 w2 w3", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([("i", item), ("j", item + " end"), (None, "w20 w21")], "item_id string, text string")
    result, names = decontamination.measured(docs, bench)
    found = {r.doc_id: sorted((m.start, m.words, m.item or "", m.item_start) for m in r[names[3]]) for r in result.collect()}
    assert found == {
        0: [(1, 40, "i", 0), (1, 40, "j", 0), (21, 2, "", 0)], 1: [(0, 20, "i", 5), (0, 20, "j", 5), (15, 2, "", 0)], 2: [], 3: [], 4: [],
    }
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} == {2, 3, 4}
    assert decontamination.decontaminated(docs, bench.where("false")).count() == 5
