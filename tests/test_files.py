"""Raw files: whole lines, their faults, and records over several lines in split files."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from pavilion import flow, schemas
from pavilion.operators import cleansing
from pavilion.plans import dimensions, sql_tables
from pavilion.sources import files, records

KINDS = {"id": "bigint"}


@pytest.fixture
def split(spark):
    """Split files into ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size: int):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield use
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def told(df):
    return [(r.id, r.winner, r.x, r._line, r._fault) for r in df.collect()]


def test_faulty_lines_are_kept_as_they_came(spark, tmp_path):
    lines = [
        "id,winner,x", "1,A,b", "", "   ", "2,B,c,EXTRA,,", "3", "4,D", '5,"E', '6,7" pipe,z', '8,"F, ""x""",y', '9,"G,h', "NA,,",
        'q,"a,b"', '"r",s,"t', 'u"v,"w",x', ',,"',
    ]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    for multi_line in (False, True):
        faults = {line: fault for *_, line, fault in told(files.read_lines(spark, str(tmp_path), KINDS, multi_line=multi_line)) if fault}
        if not multi_line:
            assert faults == {
                "2,B,c,EXTRA,,": "too many fields", "3": "too few fields", "4,D": "too few fields", '5,"E': "unclosed quote",
                '9,"G,h': "unclosed quote", 'q,"a,b"': "too few fields", '"r",s,"t': "unclosed quote", ',,"': "unclosed quote",
            }
    rows = {line: row for *row, line, _ in told(files.read_lines(spark, str(tmp_path), KINDS))}
    assert len(rows) == len(lines) - 3
    assert rows["2,B,c,EXTRA,,"] == ["2", "B", "c"] and rows["3"] == ["3", None, None] and rows['5,"E'] == ["5", "E", None]
    assert rows['6,7" pipe,z'] == ["6", '7" pipe', "z"] and rows['8,"F, ""x""",y'] == ["8", 'F, "x"', "y"]
    assert rows["NA,,"] == [None, None, None]


def test_a_line_that_holds_the_separator_of_no_text(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,winner,x\n1,a\x01b,c\n2,b,c,\x01\n")
    assert told(files.read_lines(spark, str(tmp_path), KINDS)) == [
        ("1", "a\x01b", "c", "1,a\x01b,c", None), ("2", "b", "c", "2,b,c,\x01", "too many fields"),
    ]


@pytest.mark.parametrize("size", [40, 64, 300, 5000, 1 << 27])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_over_range_borders(spark, tmp_path, split, size, ending):
    rng, expected = random.Random(size), []
    values = ["A", 'B "q" c', "l1\nl2", 'a,\n\n\n"zz"\n,b', "x" * 50 + "\n" + "y" * 200, "", "\n", 'é"\r\n"ü']
    for name in range(3):
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=ending)
            writer.writerow(["id", "winner", "x"])
            for i in range(40):
                row = [str(1000 * name + i), rng.choice(values), rng.choice(values)]
                writer.writerow(row)
                expected.append(tuple(v or None for v in row))
    split(size)
    rows = told(files.read_lines(spark, str(tmp_path), KINDS, multi_line=True))
    assert sorted(map(repr, (r[:3] for r in rows))) == sorted(map(repr, expected)) and {r[4] for r in rows} == {None}


@pytest.mark.parametrize("size", [16, 1 << 27])
def test_a_quote_that_nothing_closes(spark, tmp_path, split, size, monkeypatch):
    text = 'id,winner,x\n1,A,b\n2,B,"open\n' + "".join(f"{i},C,c\n" for i in range(3, 30))
    (tmp_path / "m.csv").write_text(text)
    split(size)
    rows = told(files.read_lines(spark, str(tmp_path), KINDS, multi_line=True))
    assert sorted((r[0], r[4]) for r in rows) == [("1", None), ("2", "unclosed quote")]
    assert {r[3] for r in rows if r[4]} == {text.split("\n", 2)[2].rstrip("\n")}
    # Held in parts, no line is lost and none is taken for a row.
    monkeypatch.setattr(records.records, "__defaults__", (40,))
    rows = told(files.read_lines(spark, str(tmp_path), KINDS, multi_line=True))
    assert [r[:3] for r in rows if not r[4]] == [("1", "A", "b")]
    parts = [r for r in rows if r[4]]
    assert {r[:3] for r in parts} == {(None, None, None)}
    assert sorted("\n".join(r[3] for r in parts).split("\n")) == sorted(text.rstrip("\n").split("\n")[2:])


def test_headers_of_multi_line_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\nid,winner,x\n1,A,b\n")
    (tmp_path / "b.csv").write_text("ID,Winner,x\r\n2,B,c")
    assert sorted(r[0] for r in told(files.read_lines(spark, str(tmp_path), KINDS, multi_line=True))) == ["1", "2"]
    (tmp_path / "c.csv").write_text("winner,id,x\nA,1,b\n")
    with pytest.raises(Exception, match="another header"):
        files.read_csv(spark, str(tmp_path), KINDS, multi_line=True).collect()


def test_files_split_anew_are_not_misread(spark, tmp_path, split):
    (tmp_path / "a.csv").write_text("id,winner,x\n" + '1,"A\nB",c\n' * 30)
    split(64)
    df = files.read_csv(spark, str(tmp_path), KINDS, multi_line=True)
    split(50)
    with pytest.raises(Exception, match="read it again"):
        df.collect()


def test_land_counts_faults_and_keeps_lines(spark, tmp_path, source):
    at = flow.Places(source([{}, {"id": "2.5"}], [{}, {"ball": "2"}, {"batsman": None}]), str(tmp_path / "raw"), str(tmp_path / "out"), "db")
    path = tmp_path / "source" / schemas.DELIVERIES_FILE
    path.write_text(path.read_text() + "1,1,A,B,1,3,Ann,Abe,Bob,0,0,0,,,MORE\n1,1,A,B,1,4,Ann,Abe,Bob\n,1,A\n")
    landed = flow.land(spark, at)
    assert landed["deliveries"]["rows"] == 6 and landed.refused == {"matches": 1, "deliveries": 2}
    assert landed.faulty == {
        "matches": {"id is no whole number": 1},
        "deliveries": {
            "too many fields": 1, "too few fields": 2, "match_id is missing": 1, "batsman is missing": 2, "bowler is missing": 1,
        },
    }
    raw = spark.read.parquet(f"{at.raw}/deliveries")
    kept = {(r._line, r._reason, r.refused) for r in raw.where("_reason IS NOT NULL").collect()}
    assert (",1,A", "too few fields; match_id is missing; batsman is missing; bowler is missing", 1) in kept
    assert ("1,1,A,B,1,3,Ann,Abe,Bob,0,0,0,,,MORE", "too many fields", 0) in kept and len(kept) == 4
    assert raw.where("_reason IS NULL AND _line IS NOT NULL").count() == 0
    assert flow.transform(spark, at)["fact_deliveries"] == 4
    assert flow.land(spark, at, strict=True).refused == {"matches": 1, "deliveries": 4}
    assert flow.transform(spark, at)["fact_deliveries"] == 2


def test_transform_reads_accepted_rows_once(spark, tmp_path, source):
    """Refused rows lie in a folder of their own, which the tables' scan leaves out."""
    at = flow.Places(source([{}], [{}, {"bowler": None}]), str(tmp_path / "raw"), str(tmp_path / "out"), "db")
    flow.land(spark, at)
    accepted, refused = flow.landed(spark, at, "deliveries")
    assert [f.rpartition("/")[0].rpartition("/")[2] for f in accepted.inputFiles()] == ["refused=0", "refused=1"]
    assert accepted.select(F.input_file_name()).distinct().first()[0].count("refused=0") == 1
    assert (accepted.count(), refused.count()) == (1, 1)


def test_both_table_paths_agree_on_dirty_text(spark, raw_matches, raw_deliveries, rows):
    dirty = [{"id": "7.0", "date": "2009-4-8", "win_by_runs": "4.0"}, {"id": "8.5"}, {"id": "x"}, {"id": None}, {"id": " 9 ", "date": "soon", "win_by_runs": "4.9"}]
    matches = raw_matches(*dirty)
    by_frame = dimensions.matches(cleansing.typed_matches(matches))
    assert sorted(rows(sql_tables.matches(matches)), key=repr) == sorted(rows(by_frame), key=repr) and by_frame.count() == 2
    balls = raw_deliveries({"match_id": "7.0", "over": "4.0", "season": "2009"}, {"match_id": "7.5", "season": None}, {"bowler": None, "season": None}, {"batsman_runs": "4.7", "total_runs": "x", "season": None})
    from pavilion.plans import facts

    clean = cleansing.clean_deliveries(balls)
    by_frame = facts.flagged(clean)
    found = sql_tables.deliveries(balls)
    assert found.count() == 2 and sorted(rows(found), key=repr) == sorted(rows(by_frame.select(found.columns)), key=repr)
