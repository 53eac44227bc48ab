"""Packing along a Hilbert curve: against the tokenizers library, on edge cases, and the curve itself."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pavilion.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"
PROSE = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        return packing.TextEncoder(file.read())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, expected, length):
    """Every piece has its document's ids; sequences have no gap and no overlap, and all but the last are full."""
    by_sequence, by_doc = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length and 0 < p.length <= length and p.ids_crc32 == zlib.crc32(p.ids)
        by_doc.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert by_doc.keys() == expected.keys()
    for doc, found in by_doc.items():
        found.sort()
        whole = [i for _, ids, _ in found for i in ids]
        assert whole == expected[doc] and {n for *_, n in found} == {len(whole)}
        assert [s for s, *_ in found] == [0, *itertools.accumulate(len(ids) for _, ids, _ in found)][:-1]
    sizes = []
    for _, found in sorted(by_sequence.items()):
        end = 0
        for offset, n in sorted(found):
            assert offset == end
            end += n
        sizes.append(end)
    assert sorted(by_sequence) == list(range(len(by_sequence))) and set(sizes[:-1]) <= {length} and sizes[-1] <= length


def test_documents_fill_sequences(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    expected = {i: ids_of(library, t) for i, t in texts.items()}
    pieces = packing.packed(docs, queries.tokenizer_path())
    check(pieces.collect(), expected, 1024)
    told = {(r.doc_id, r.start): r for r in queries.op11_curve_packing(spark, FOLDER).collect()}
    for (doc, start), r in told.items():
        ids = expected[doc][start : start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(expected[doc])
    whole = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 4 * r.tokens for r in whole)
    assert sum(r.tokens for r in whole) == sum(map(len, expected.values()))


def test_edges(spark, library):
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \n\t ", "c"), (4, PROSE, "d"), (5, "x" * 60000, "e"), (6, PROSE * 3000, "f"),
        (7, "<|endoftext|> in text, 中文   it's 10½ \x1c", "g"), (8, "Ärger über ñandú, don't I'LL", "h"),
    ]
    # Columns with the names of results and of helpers.
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").selectExpr("*", "1 AS row", "2 AS start", "3 AS tokens", "4 AS key")
    expected = {i: ids_of(library, t) for i, t, _ in rows}
    for length in (1, 64, 1024):
        part = docs.where("doc_id < 5") if length == 1 else docs
        check(packing.packed(part, queries.tokenizer_path(), length=length).collect(), {r.doc_id: expected[r.doc_id] for r in part.collect()}, length)
    assert packing.packed(docs.where("false"), queries.tokenizer_path()).count() == 0
    again = packing.packed(docs.where("doc_id = 4").unionAll(docs.where("doc_id = 4")), queries.tokenizer_path())
    assert sum(r.length for r in again.collect()) == 2 * len(expected[4])
    texts = packing.packed(docs.selectExpr("cast(doc_id AS string) AS name", "text"), queries.tokenizer_path(), "name")
    assert {r.name for r in texts.collect()} == {str(i) for i in expected}
    with pytest.raises(ValueError, match="start"):
        packing.packed(docs, queries.tokenizer_path(), "start")


def test_long_texts_are_cut_between_words(monkeypatch, encoder, library):
    monkeypatch.setattr(packing, "_LONG_TEXT", 7)
    text = "It's   a long\n\ntext with  gaps , stops ... and 123456 numbers " * 20
    assert np.frombuffer(encoder.text(text), encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids


_PIECES = st.sampled_from([" ", "  ", "\n", "\t", "'s", "'ll", "'", "_", "don", "É", "ß1", "½", "²x", "7", "...", "—", "Ж", "\xa0", "\x85", "中", "😀", "<|endoftext|>", "ab", "́"])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(_PIECES, max_size=12).map("".join)))
def test_ids_are_those_of_the_library(encoder, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(encoder.text(text), encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_by_rank_and_by_merges(encoder, monkeypatch):
    """Tokens, halves of tokens and any bytes that are text, run together in words."""
    rng, ranks = random.Random(1), encoder.pieces
    tokens = [t for t in map(encoder.library.id_to_token, range(50000)) if len(t) > 1]
    letters = {letter: byte for byte, letter in encoder.letters.items()}
    for _ in range(20000):
        parts = [rng.choice(tokens)[rng.randint(0, 2) :] for _ in range(rng.randint(1, 4))]
        raw = bytes(letters[c] for c in "".join(parts)) + bytes(rng.choice(b"etaoin hr") for _ in range(rng.randint(0, 6)))
        word = raw.decode("utf-8", "ignore") or "a"
        by_rank = encoder.word(word)
        encoder.pieces = None
        by_merges = encoder.word(word)
        encoder.pieces = ranks
        assert by_rank == by_merges, word


def test_words_forgotten_are_found_again(encoder, library, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED_WORDS", 3)
    for _ in range(3):
        assert np.frombuffer(encoder.text(PROSE), encoder.kind).tolist() == library.encode(PROSE, add_special_tokens=False).ids


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_are_alike(spark):
    """Copies come one after the other, and languages stay together."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    copies = docs.selectExpr("doc_id + 1000000 AS doc_id", "text")
    pieces = packing.packed(docs.select("doc_id", "text").unionAll(copies), queries.tokenizer_path()).where("start = 0")
    order = [r.doc_id % 1000000 for r in pieces.orderBy("sequence_id", "offset").collect()]
    places: dict[int, list[int]] = {}
    for place, doc in enumerate(order):
        places.setdefault(doc, []).append(place)
    # Others of the same text may stand between.
    texts = {r.doc_id: r.text for r in rows}
    alike = Counter(texts.values())
    assert all(b - a < 2 * alike[texts[d]] for d, (a, b) in places.items())
    langs = [{r.doc_id: r.lang for r in rows}[d] for d in order]
    same = np.mean([a == b for a, b in itertools.pairwise(langs)])
    chance = sum((n / len(langs)) ** 2 for n in Counter(langs).values())
    assert same > chance + 0.5 * (1 - chance)
