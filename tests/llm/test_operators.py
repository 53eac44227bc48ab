"""Every operator against brute force, on the smallest tables and on edge cases."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re

import pytest
from compare import differences, oracle_connection

import corpus_pipeline
from pavilion.llm import (
    byte_pairs,
    decontamination,
    license_scan,
    near_dedup,
    personal_data,
    quality_rules,
    queries,
    repeated_passages,
    rule_ensemble,
    url_rules,
    warc,
)

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"

# Nulls, empty and blank texts, ties, repeated rows, a long word, few words, and
# columns whose names operators use themselves.
EDGES = [
    (1, PROSE, "a"), (2, PROSE, "b"), (2, PROSE, "b"), (3, None, "c"), (4, "", None), (5, " \n\t ", "e"),
    (6, "few words", "f"), (7, "few words", "g"), (None, PROSE, "h"), (8, "x" * 60000, "i"),
    (9, (PROSE + " ") * 200, "j"), (10, "Mail a.b@c.de or call +49 (30) 123-45678.", "k"),
    (11, PROSE.upper() + " tail", "l"), (None, None, None),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("false")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(texts):
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates(spark, texts):
    result = queries.op1_minhash_near_dedup(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result} == groups(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in result)


def test_near_duplicates_at_the_edges(edges, empty):
    result = near_dedup.near_duplicates(edges).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result if r.doc_id is not None}
    assert len(result) == len(EDGES)
    assert found[1] == found[2][:1] + (1, True) and found[2] == (12, 1, False)
    assert found[3] == (0, 3, True) and found[5] == (0, 5, True)
    assert found[6] == (1, 6, True) and found[7] == (1, 6, False)
    assert found[11][1] == 1  # 12 of 13 shingles
    kept = near_dedup.deduplicated(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 8, 9, 10]
    assert near_dedup.near_duplicates(empty).count() == 0


def test_a_chain_of_copies_is_one_group(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(words[:k] + [f"x{k}_{j}" for j in range(3)] + words[k + 3 :])) for k in range(0, 180, 9)]
    rows += [(1000, " ".join(words))]
    result = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in result.collect()} == {i: c for i, (_, c) in groups(dict(rows)).items()}


def test_bands_follow_the_threshold(spark):
    assert near_dedup.banding(85) == (near_dedup.BANDS, near_dedup.ROWS) and near_dedup.banding(100) == (1, 6)
    for percent in range(30, 100):
        bands, rows = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS
    rows = []
    for i in range(300):  # pairs 0.6 alike
        both = " ".join(f"c{i // 2}_{j}" for j in range(154))
        rows.append((i, both + " " + " ".join(f"o{i}_{j}" for j in range(50))))
    result = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=60)
    assert {r.doc_id: r.component_id for r in result.collect()} == {i: i - i % 2 for i, _ in rows}


def test_pairs_on_one_template(spark):
    """Nearly every key of a pair (0.86 alike) is crowded by the other pairs (0.84 alike)."""
    base = " ".join(f"t{i}" for i in range(917))
    rows = []
    for i in range(200):
        pair = " ".join(f"p{i // 2}_{j}" for j in range(12))
        rows.append((i, f"{base} {pair} " + " ".join(f"o{i}_{j}" for j in range(75))))
    first, second, third = (shingles(rows[i][1]) for i in (0, 1, 2))
    assert 100 * len(first & second) >= 85 * len(first | second) and 100 * len(first & third) < 85 * len(first | third)
    result = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in result.collect()} == {i: i - i % 2 for i, _ in rows}


def test_licenses(spark):
    rows = [
        (1, "/* The MIT License */\n// Permission is hereby granted, free of charge, to any person obtaining a copy of this software now\n"
            " * The above copyright notice and this permission notice shall be included in all copies or parts."),
        (2, "Text. Licensed under the Apache Licence, Version 2.0."),
        (3, "Copyright 2020 X. All rights reserved."),
        (4, "A licence of an odd sort"), (5, "no such thing here"), (6, None), (7, ""),
        (8, "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3."),
        (9, "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame(rows, "scan long, text string")
    result, (ids, licenses, _, kind, usable) = license_scan.scanned(df)
    found = {r.scan: (r[licenses], r[kind], r[usable]) for r in result.collect()}
    assert found == {
        1: (["MIT"], "permissive", True), 2: (["Apache-2.0"], "permissive", True),
        3: (["proprietary"], "reserved", False), 4: ([], "unknown", False), 5: ([], None, True), 6: ([], None, True),
        7: ([], None, True), 8: (["MIT", "GPL-3.0"], "copyleft", True), 9: (["CC-BY-NC"], "restricted", False),
    }


MIT = """MIT License

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
BSD2 = """Copyright (c) 2020, X
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
{}
THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR
ANY DIRECT DAMAGES."""
BSD3 = BSD2.format("""
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL DAMAGES."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_wrapped_licences(spark):
    """Standard texts, plain, in comments, and on one line."""
    wanted = [(MIT, "MIT"), (BSD2.format(""), "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (ISC, "ISC"), (APACHE, "Apache-2.0"), (GPL, "GPL-3.0")]
    rows = []
    for text, name in wanted:
        rows += [(name, text), (name, text.replace("\n", "\r\n"))]
        rows += [(name, "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n"))) for mark in ("#", "//", ";;", " *", "--")]
        rows += [(name, "/*\n * " + text.replace("\n", "\n * ") + "\n */\nint x;"), (name, "Words before\n" + text + "\nWords after")]
        if name != "MIT":
            rows += [(name, re.sub(r"\s+", " ", text.partition("All rights reserved.\n")[2] or text))]
    result, (ids, licenses, rest, kind, usable) = license_scan.scanned(spark.createDataFrame(rows, "name string, text string"))
    for r in result.collect():
        assert (r[licenses], r[rest]) == ([r.name], []), r
        assert r[usable] and r[kind] == ("copyleft" if r.name == "GPL-3.0" else "permissive")


def test_every_licence_line_is_recognised(spark, texts):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    result = {r.doc_id: r.licenses.split(",") for r in queries.op2_license_scan(spark, FOLDER).collect()}
    assert len(result) == len(texts)
    for i, text in texts.items():
        for line, name in lines.items():
            assert line not in text.split("\n") or name in result[i]


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark, documents, texts):
    result = queries.op3_quality_rules(spark, FOLDER).collect()
    assert {r.doc_id: tuple(r[1:6]) for r in result} == {i: base_counts(t) for i, t in texts.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [r for r in result if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert all(r.kept for r in good)
    kept = {r.doc_id for r in quality_rules.filtered(documents).collect()}
    assert kept == {r.doc_id for r in result if r.kept}


def test_quality_rules_at_the_edges(edges, empty):
    result = quality_rules.judged(edges).collect()
    assert len(result) == len(EDGES)
    assert all(r.base_failed and not r.kept for r in result if not r.n_words)
    kept = quality_rules.filtered(edges)
    assert kept.columns == edges.columns and 9 not in {r.doc_id for r in kept.collect()}
    assert quality_rules.judged(empty).count() == 0 and quality_rules.filtered(empty).count() == 0


def removed(rows):
    first: dict[bytes, int] = {}
    coded = [(i, (t or "").encode()) for i, t in rows]
    for i, text in coded:
        for j in range(len(text) - 49 if i is not None else 0):
            first[text[j : j + 50]] = min(i, first.get(text[j : j + 50], i))
    out = []
    for i, text in coded:
        gone = bytearray(len(text))
        for j in range(len(text) - 49 if i is not None else 0):
            if first[text[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        out.append((i, bytes(c for c, g in zip(text, gone, strict=True) if not g)))
    return collections.Counter(out)


@pytest.mark.parametrize("sizes", [(2, 1 << 21), (0, 3000)])
def test_repeated_passages(spark, documents, edges, empty, monkeypatch, sizes):
    """Also with few passages in a pack and every shared minimizer hot."""
    monkeypatch.setattr(repeated_passages, "PACK_BYTES", sizes[1])
    for df in (documents.limit(80), edges):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        result = repeated_passages.without_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
        assert collections.Counter((r.doc_id, bytes(r.kept)) for r in result.collect()) == removed(rows)
    assert repeated_passages.without_repeated_passages(empty).count() == 0


def test_hot_packs_spread_over_all_parts(spark):
    """One pack in each of many partitions."""
    packs = spark.range(2000).selectExpr("shiftleft(id, 32) AS pack")
    for groups in (16, 24, 40):
        parts = {r[0]: r[1] for r in packs.groupBy(repeated_passages._spread(groups).alias("p")).count().collect()}
        assert sorted(parts) == list(range(groups)) and max(parts.values()) < 3 * 2000 / groups


@pytest.mark.parametrize("name", ["op5_url_range_join", "op10_warc"])
def test_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), queries.ORACLES[name]) == []


def test_nested_url_rules(spark):
    rules = [("b.c", "/", "block"), ("b.c", "/x/", "allow"), ("b.c", "/x/y", "block"), ("a.b.c", "/x", "allow"), ("c", "", "block")]
    urls = ["http://a.b.c/x/y", "http://b.c/x/yz?q", "http://B.C/x/z#f", "http://d.b.c/", "http://xb.c", "q", None, "http://c/é", "http://b.c/x/y", "http://b.c/x/y"]
    df = spark.createDataFrame(list(enumerate(urls)), "rule long, url string")
    result, (host, path, rule, verdict) = url_rules.judged(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    for r in result.collect():
        own, way = r[host], r[path]
        fits = [h + p for h, p, _ in rules if (own == h or own.endswith("." + h)) and way.startswith(p)]
        assert r[rule] == (max(fits, key=len) if fits else None), r
    assert result.count() == len(urls)


def test_rule_ensemble(spark, edges):
    result = {r.doc_id: r for r in queries.op6_rule_ensemble(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(result[r.doc_id].predicted, r.quality) for r in labels if result[r.doc_id].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.95 * len(held)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rule_ensemble.scored(edges, none).collect()} == {0.5}


def test_byte_pairs(spark, edges, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    hard = ["'s's 'tis don't'll", "a  b\n\n c \t", "<|endoftext|>x<|endoftext|>", "͸ 日本 ½٣", "'" * 300, "Ᲊa", "é́" * 50]
    df = spark.createDataFrame([(r[0], r[1], "x") for r in EDGES] + [(100 + i, t, "x") for i, t in enumerate(hard)], edges.schema)
    result, ids, text = byte_pairs.round_trip(df, queries.tokenizer_path())
    for r in result.collect():
        want = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r[ids] == b"".join(i.to_bytes(4, "little") for i in want)
        assert r[text] == tokenizer.decode(want, skip_special_tokens=False)
    one, name = byte_pairs.encoded(df, queries.tokenizer_path())
    assert byte_pairs.decoded(one, queries.tokenizer_path(), name)[0].count() == df.count()
    assert byte_pairs.round_trip(empty, queries.tokenizer_path())[0].count() == 0


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda h: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda h: all(int(p) <= 255 for p in h.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda h: 12 <= len(digits(h)) <= 19 and luhn(digits(h))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: 9 <= len(digits(h)) <= 15),
    ]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(patterns) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_personal_data(spark, documents, edges, empty):
    hard = ["a.b@c-d.e_x@y.z", "1.2.3.4.5.6.7.8 001.2.3.999", "4111 1111-1111 1111 x 4111111111111111", "+1 (372) 555-7739-", "é a@b.c 😀 +12345678 9"]
    more = spark.createDataFrame([(200 + i, t, "x") for i, t in enumerate(hard)], edges.schema)
    for df in (documents, edges.unionAll(more)):
        rows = df.select("doc_id", "text").collect()
        want = collections.Counter((r.doc_id, base_spans(r.text or "")) for r in rows)
        told = [(r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.base)) for r in personal_data.found(df).collect()]
        assert collections.Counter(told) == want
    clean = {r.doc_id: r.text for r in personal_data.masked(edges).collect()}
    assert clean[10] == "Mail <EMAIL> or call <PHONE>." and clean[1] == PROSE and clean[3] is None
    assert personal_data.masked(edges).columns == edges.columns
    assert personal_data.found(empty).count() == 0


def test_decontamination(spark, documents, texts, edges, empty, monkeypatch):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    given = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for df, items in ((documents, given), (edges, [(1, "Seven, eight NINE"), (2, PROSE), (2, PROSE), (3, None), (4, ""), (None, "few")])):
        windows: dict[tuple, set] = {}
        for i, t in items:
            w = words(t)
            for j in range(max(1, len(w) - 12) if w else 0):
                windows.setdefault(tuple(w[j : j + 13]), set()).add(i)
        lengths = sorted({len(w) for w in windows})
        want = []
        for r in df.collect():
            w, hit, ids = words(r.text), set(), set()
            for n in lengths:
                for j in range(len(w) - n + 1):
                    if tuple(w[j : j + n]) in windows:
                        hit.update(range(j, j + n))
                        ids |= windows[tuple(w[j : j + n])]
            want.append((r.doc_id, len(w), len(hit), tuple(sorted(str(i) for i in ids if i is not None))))
        bench = spark.createDataFrame(items, "item_id long, text string")
        for size in (decontamination.BLOCK_BYTES, 60):  # one block, and several
            if size == 60 and df is documents:
                continue
            monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
            result, (n, spans, names, _) = decontamination.measured(df, bench)
            told = result.select("doc_id", n, decontamination.n_hit(spans).alias("hit"), names).collect()
            assert collections.Counter((a, b, c, tuple(d)) for a, b, c, d in told) == collections.Counter(want)
        monkeypatch.undo()
    assert decontamination.decontaminated(empty, bench).count() == 0


def test_warc_pushdown_and_edges(spark, tmp_path):
    big = "x" * 200
    rows = [(5, "http://a/", big), (3, "u\r\nv", big), (9, None, big), (4, "http://b/", None), (6, "http://b/", ""), (7, "c", "short"), (8, "c", "short"), (3, "u", big), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = warc.write_pages(pages, f"file://{tmp_path}/w")
    told = collections.Counter((r.id, r.record_type, r.payload_bytes, r.refers_to) for r in warc.read_pages(spark, path).collect())
    want = [("3", "response", 200, None)] * 2 + [(i, "revisit", 200, "3") for i in ("5", "9", None)]
    want += [("4", "response", 0, None), ("6", "response", 0, None), ("7", "response", 5, None), ("8", "response", 5, None)]
    assert told == collections.Counter(want)
    hit = warc.read(spark, path, "record_type", "target_uri", "payload").where("target_uri = 'http://a/'")
    assert [r.record_type for r in hit.collect()] == ["revisit"]
    assert "PushedFilters" in hit._jdf.queryExecution().toString() or hit.count() == 1
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0
    plain = warc.record_bytes({"WARC-Type": "resource", "Content-Type": "text/plain"}, b"abc")
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.warc").write_bytes(plain * 3)
    assert [bytes(r.payload) for r in warc.read(spark, f"file://{tmp_path}/p").collect()] == [b"abc"] * 3


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, FOLDER), "test")
        if name != "byte-pair encoding":
            assert docs.columns == documents.columns
            assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert docs.where("NOT lossless").count() == 0 and docs.count() > 100
