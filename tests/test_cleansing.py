from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavilion import schemas
from pavilion.functions.parsing import blank_to_null, parsed, parsed_key
from pavilion.operators import cleansing
from pavilion.plans import dimensions


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("4", 4), (" 7 ", 7), ("-3", -3), ("+5", 5), ("4.0", 4), ("-3.9", -3), ("6.", 6),
        ("x", None), ("", None), ("1e3", None), ("4.x", None), ("4 5", None), (None, None),
        ("2147483648", None),
    ],
)
def test_whole_numbers(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parsed(F.col("t"), "int")).first()[0] == value


_ODD = [
    "4", " 7 ", "\x014\x7f", "\t-3\r\n", "+5", "+", "- 5", "4.0", " 4.50 ", "\x014.0", ".5", "6.", "x", "NA", "", "4 5", "1e3", "4.x", "0x1",
    "2147483648", "2147483648.0", "99999999999999999999", "\u0664", "4\u00a0", "4\u2028", "2008-4-1", " 2008-04-18 ", "\x012008-04-18",
    "20080418", "2008", "+2008-04-18", "-2008-04-18", "12008-04-18", "208-04-18", "14/04/2008", "unknown", "2008-04-18T10:00", None,
]


@pytest.mark.parametrize(("kind", "point"), [("int", r"\d*"), ("bigint", "0*"), ("date", None)])
def test_text_is_looked_at_before_it_is_converted(spark, kind, point):
    """A conversion that fails raises an error, which costs far more than a pattern; the values are the same."""
    df = spark.createDataFrame([(text,) for text in _ODD], "t string")
    plain, value = F.col("t").try_cast(kind), parsed(F.col("t"), kind)
    if point:
        plain = F.coalesce(plain, F.regexp_extract("t", rf"^\s*([+-]?\d+)\.{point}\s*$", 1).try_cast(kind))
        value = parsed_key(F.col("t"), kind) if point == "0*" else value
    for text, now, then in df.select("t", value.cast("string"), plain.cast("string")).collect():
        assert now == then, repr(text)
    shown = df.select(value.alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    casts = shown.lower().count("cast(")
    assert 0 < casts <= shown.count("RLIKE")


@pytest.mark.parametrize("kind", ["int", "bigint"])
@pytest.mark.parametrize("number", [parsed, parsed_key])
def test_one_digit_takes_no_pattern(spark, kind, number):
    """It is seen by its length before any pattern is tried; no other character passes for a digit."""
    texts = [chr(i) for i in range(0x700)] + ["10", "05", " 5", "5 ", "\U0001d7d7"]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    found = {r.t: r.n for r in df.select("t", number(F.col("t"), kind).alias("n")).collect()}
    assert found == dict.fromkeys(texts) | {str(i): i for i in range(10)} | {"10": 10, "05": 5, " 5": 5, "5 ": 5}
    shown = df.select(number(F.col("t"), kind).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert "length(" in shown and shown.index("length(") < shown.index("RLIKE")


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2008-04-18", datetime.date(2008, 4, 18)),
        ("14/04/2008", None),
        ("", None),
        (None, None),
    ],
)
def test_bad_dates_become_null(spark, raw_matches, text, value):
    dim = dimensions.matches(cleansing.typed_matches(raw_matches({"date": text})))
    assert dim.first()["match_date"] == value


def test_null_words(spark):
    df = spark.createDataFrame([("",), ("NA",), ("Nathan",), (None,)], "t string")
    kept = df.select(blank_to_null(F.col("t"), ("", "NA"))).collect()
    assert [r[0] for r in kept] == [None, None, "Nathan", None]
    assert [r[0] for r in df.select(blank_to_null(F.col("t"), ())).collect()] == ["", "NA", "Nathan", None]


def test_required_keys_drop_rows(spark, raw_deliveries, raw_matches):
    raw = raw_deliveries(
        {}, {"match_id": None}, {"batsman": None}, {"bowler": None}, {"match_id": "x"}, {"ball": None}
    )
    assert cleansing.clean_deliveries(raw).count() == 2
    assert cleansing.clean_matches(raw_matches({}, {"id": None})).count() == 1


def test_keys_are_never_cut(spark, raw_matches):
    """A fraction in a key would merge two matches; such a row has no key."""
    kept = cleansing.clean_matches(raw_matches({"id": "7"}, {"id": "7.9"}, {"id": "A12"}, {"win_by_runs": "4.0"}))
    assert sorted(r["id"] for r in kept.collect()) == [1, 7]


def test_whole_keys_with_zeros_are_kept(spark, raw_matches):
    raw = raw_matches({"id": "335982.0"}, {"id": "335982"}, {"id": "7.9"}, {"id": "A12"}, {"id": None})
    assert [r["id"] for r in cleansing.clean_matches(raw).collect()] == [335982]
    counts = raw.agg(*cleansing.reject_counts(schemas.RAW_MATCHES, schemas.MATCH_KEYS)).first()
    assert counts["id"] == 2
    left = cleansing.refused(raw, schemas.RAW_MATCHES, schemas.MATCH_KEYS).collect()
    assert {r["id"]: r["_reason"] for r in left} == {
        "7.9": "id is no whole number", "A12": "id is no whole number", None: "id is missing",
    }


def test_repeats_are_whole_rows_only(spark, raw_deliveries):
    raw = raw_deliveries({}, {}, {"ball": "2"}, {"ball": "2.0"})
    assert cleansing.clean_deliveries(raw).count() == 2


def test_extra_columns_tell_rows_apart(spark, raw_deliveries):
    raw = raw_deliveries({"super_over": "0"}, {"super_over": "1"}, {"super_over": "1"})
    assert cleansing.clean_deliveries(raw).count() == 2


def test_rejects_are_counted(spark, raw_deliveries):
    raw = raw_deliveries({"batsman_runs": "x"}, {"batsman_runs": None}, {"over": "?", "ball": "?"})
    found = raw.agg(*cleansing.reject_counts(schemas.RAW_DELIVERIES)).first().asDict()
    assert found == {
        "match_id": 0, "inning": 0, "over": 1, "ball": 1,
        "batsman_runs": 1, "extra_runs": 0, "total_runs": 0,
    }


def test_smallest_row_wins_and_null_is_lowest(spark, raw_matches, rows):
    raw = raw_matches({"city": "York"}, {"city": "Leeds"}, {"id": "2"}, {"id": "2", "city": None})
    dim = dimensions.matches(cleansing.typed_matches(raw))
    assert sorted(rows(dim, "match_id", "city")) == [(1, "Leeds"), (2, None)]


_SEASONS = st.one_of(st.none(), st.sampled_from(["2007/08", "2009", "2020/21"]))
_MATCHES = st.lists(
    st.tuples(st.sampled_from("123"), _SEASONS, st.one_of(st.none(), st.sampled_from("xyz"))),
    min_size=1,
    max_size=12,
)


@settings(max_examples=15, deadline=None)
@given(found=_MATCHES)
def test_season_lookup_equals_the_dimension(spark, raw_matches, found):
    raw = raw_matches(*[{"id": i, "season": s, "city": c} for i, s, c in found])
    typed = cleansing.typed_matches(raw)
    short = {r[0]: r[1] for r in dimensions.match_seasons(typed).collect()}
    full = {r["match_id"]: r["season_year"] for r in dimensions.matches(typed).collect()}
    assert short == full
    lowest = {}
    for i, s, c in found:
        key = (s is not None, s or "", c is not None, c or "")
        lowest[int(i)] = min(lowest.get(int(i), key), key)
    assert full == {i: (k[1] if k[0] else None) for i, k in lowest.items()}
