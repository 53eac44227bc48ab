"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import glob
import io
import re

import pytest
from pyspark.sql import functions as F

from pavilion import flow, schemas, session
from pavilion.operators import cleansing
from pavilion.operators.lookup import distinct_lookup, hot_keys, lookup
from pavilion.operators.ranking import top_per_group
from pavilion.plans import facts, reports
from pavilion.sinks import tables
from pavilion.sinks.layout import STANDARD, Layout
from pavilion.sources import files
from pavilion.testbed.queries import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture
def conf(spark):
    before = {}

    def use(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield use
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def hot(conf):
    """No broadcast, and thresholds at which test-sized partitions count as hot."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )


def test_reports_read_only_their_columns(spark, tmp_path, fact):
    path = str(tmp_path / "fact")
    tables.write_parquet(fact({}), path)
    stored = spark.read.parquet(path)
    text = plan(reports.top_wicket_takers(stored), "formatted")
    assert "ReadSchema: struct<ball:int,bowler:string,total_runs:int,is_dot_ball:int,is_wicket:int>" in text
    assert "TakeOrderedAndProject" in text
    assert "PushedFilters: [IsNotNull(over), GreaterThanOrEqual(over,1), LessThanOrEqual(over,6)]" in plan(
        reports.powerplay_economy(stored), "formatted"
    )


def test_required_text_columns_are_checked_by_the_scan(spark, tmp_path, raw_deliveries):
    path = str(tmp_path / "raw")
    tables.write_parquet(raw_deliveries({}), path)
    text = plan(cleansing.clean_deliveries(spark.read.parquet(path)), "formatted")
    assert "IsNotNull(batsman), IsNotNull(bowler)" in text


def test_no_query_uses_a_cross_join_or_python(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    from pavilion.testbed import queries

    for name, build in queries._PLANS.items():
        text = plan(build(Tables(spark, FOLDER)))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert word not in text, (name, word)


def test_single_partition_only_for_offsets_and_counts(spark, conf):
    """Only partition sizes and ungrouped counts may meet in one task."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    from pavilion.testbed import queries

    allowed = {"dim_teams", "dim_players", "dim_seasons", "table_counts"}
    found = {
        name
        for name, build in queries._PLANS.items()
        if "SinglePartition" in plan(build(Tables(spark, FOLDER)))
    }
    assert found <= allowed


def test_deduplication_reduces_before_the_shuffle(spark):
    text = plan(Tables(spark, FOLDER).clean_deliveries)
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_group_limit_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    text = plan(top_per_group(df, "g", 2, "id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_group_limits_of_any_size_are_exact_and_spread(spark, conf, rows):
    conf(spark__sql__optimizer__windowGroupLimitThreshold="3")
    df = spark.range(400).select((F.col("id") % 2).alias("g"), (F.col("id") % 37).alias("v"), "id")
    few, many = (top_per_group(df, "g", k, F.desc("v"), "id") for k in (3, 50))
    assert "part" in plan(few) and "part" in plan(many)
    for limited, k in ((few, 3), (many, 50)):
        expected = []
        for g in (0, 1):
            members = sorted((-(i % 37), i) for i in range(400) if i % 2 == g)[:k]
            expected += [(g, -v, i, place) for place, (v, i) in enumerate(members, 1)]
        assert sorted(rows(limited)) == sorted(expected)


def test_hot_match_is_split(spark, hot):
    """Half of all deliveries belong to one match."""
    rows = spark.range(40000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("match_id"),
        F.col("id").alias("ball"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    rows = rows.repartition(16)
    matches = spark.range(40000).select(F.col("id").alias("match_id"), F.lit("2009").alias("season"))
    matches = matches.groupBy("match_id").agg(F.min("season").alias("season"))
    joined = lookup(rows, matches, "match_id", salts=2)
    assert len(joined.collect()) == 40000
    assert "skew=true" in plan(joined)


def test_salts_spread_a_hot_match_without_adaptive_execution(spark, hot, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32")
    rows = spark.range(8000).select(F.lit(1).alias("match_id"), "id")
    matches = spark.createDataFrame([(1, "2009")], "match_id int, season string")
    sizes = lookup(rows, matches, "match_id").groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 8000 * 0.6


@pytest.mark.parametrize("share", [1, 3])
def test_no_task_gets_a_sixteenth_of_a_hot_match(spark, hot, conf, share):
    """All rows, or a third of them, belong to one match; the others have one each."""
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32")
    key = F.when(F.col("id") % share == 0, 1).otherwise(F.col("id")).alias("match_id")
    rows = spark.range(24000).select(key, F.col("id").alias("ball"))
    matches = spark.range(24000).select(F.col("id").alias("match_id"), F.lit("2009").alias("season"))
    joined = lookup(rows, matches, "match_id")
    sizes = joined.where("match_id = 1").groupBy(F.spark_partition_id()).count()
    n = 24000 // share
    assert sizes.agg(F.max("count")).first()[0] <= n / 16 and joined.count() == 24000


def test_only_hot_keys_are_repeated(spark, hot, conf):
    conf(spark__sql__shuffle__partitions="8")
    key = F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 16 == 1, None).otherwise(F.col("id")).alias("k")
    rows = spark.range(16000).select(key, F.col("id").alias("v"))
    found = {r.k: r.salts for r in hot_keys(rows, "k").collect()}
    # 8000 of 15000 rows with a key, in shares of an eighth.
    assert set(found) == {5} and abs(found[5] - 64 * 8 * 8000 / 15000) < 2
    assert [r.salts for r in hot_keys(rows, "k", most=3).collect()] == [3]
    assert hot_keys(rows.where("k IS NULL"), "k").count() == 0
    table = spark.range(16000).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    assert lookup(rows, table, "k").groupBy("x").count().collect() == rows.join(table, "k", "left").groupBy("x").count().collect()


def test_small_tables_are_joined_as_they_are(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="10m")
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    table = spark.range(2).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    text = plan(lookup(rows, table, "k"))
    assert "BroadcastHashJoin" in text and "Generate" not in text and "approx_top_k" not in text


def test_season_lookup_of_the_fact_shuffles_no_flags(spark, hot):
    text = plan(Tables(spark, FOLDER).fact)
    join = text.index("SortMergeJoin")
    assert "is_boundary" not in text[join:]


def test_hot_cluster_value_becomes_several_files(spark, tmp_path, hot):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, "A").otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("team"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    df = df.repartition(8)
    path = str(tmp_path / "hot")
    assert tables.write_parquet(df, path, Layout(cluster=("team",))) == {"rows": 30000}
    holders = spark.read.parquet(path).where("team = 'A'").select(F.input_file_name()).distinct()
    assert holders.count() >= 4


def test_hot_folder_becomes_several_files(spark, tmp_path, hot):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, "2009").otherwise("2010").alias("season"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = str(tmp_path / "hot")
    layout = Layout("season", ("text",))
    assert tables.write_parquet(df.repartition(8), path, layout) == {"rows": 30000}
    assert len(glob.glob(f"{path}/season=2009/*.parquet")) >= 4


def test_files_along_a_curve_are_small_in_both_columns(spark, tmp_path, hot, conf):
    """Filters on either column, or on both, meet few of the files; a hot pair fills several."""
    conf(spark__sql__shuffle__partitions="64")
    teams = [F.concat(F.lit("T"), (F.xxhash64("id", F.lit(i)) % 10 + 10).cast("string")) for i in (1, 2)]
    df = spark.range(60000).select(*[t.alias(n) for t, n in zip(teams, ("a", "b"), strict=True)], F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = str(tmp_path / "curve")
    tables.write_parquet(df.repartition(8), path, Layout(cluster=("a", "b"), curve=True))
    stored = spark.read.parquet(path)
    assert stored.count() == 60000 and stored.columns == ["a", "b", "text"]
    files = stored.groupBy(F.input_file_name()).agg(*[f(c).alias(n + c) for c in "ab" for f, n in ((F.min, "low_"), (F.max, "high_"))]).collect()
    assert len(files) >= 30
    first, second = (sum(f[f"low_{c}"] <= "T3" <= f[f"high_{c}"] for f in files) for c in "ab")
    both = sum(all(f[f"low_{c}"] <= "T3" <= f[f"high_{c}"] for c in "ab") for f in files)
    assert max(first, second) < len(files) / 2 and both < len(files) / 6
    skewed = df.withColumn("a", F.when(F.col("a") < "T15", "T1").otherwise("T2")).withColumn("b", F.lit("T1"))
    path = str(tmp_path / "hot_curve")
    tables.write_parquet(skewed.repartition(8), path, Layout(cluster=("a", "b"), curve=True))
    assert spark.read.parquet(path).where("a = 'T1'").select(F.input_file_name()).distinct().count() >= 4


def test_rows_for_a_curve_are_worked_out_once(spark, tmp_path, monkeypatch):
    """The count, the sample, the bounds and the write read them from files, which then go."""
    seen, arranged = [], tables.arranged
    monkeypatch.setattr(tables, "arranged", lambda df, layout: seen.append(plan(df)) or arranged(df, layout))
    df = spark.range(300).select((F.col("id") % 7).alias("a"), (F.col("id") % 50).alias("b")).dropDuplicates()
    folder = tmp_path / "tables"
    assert tables.write_parquet(df, f"{folder}/c", Layout(cluster=("a", "b"), curve=True)) == {"rows": 300}
    assert "FileScan" in seen[0] and "Exchange" not in seen[0] and "Range" not in seen[0]
    assert [f.name for f in folder.iterdir()] == ["c"]
    assert spark.read.parquet(f"{folder}/c").exceptAll(df).isEmpty()


@pytest.mark.parametrize("values", [[], [None], ["x"], ["x", None, "y"], [str(i) for i in range(500)]])
def test_curves_of_any_values(spark, tmp_path, values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "a string, b int")
    tables.write_parquet(df, str(tmp_path / "c"), Layout(cluster=("a", "b"), curve=True))
    assert sorted(map(repr, spark.read.schema(df.schema).parquet(str(tmp_path / "c")).collect())) == sorted(map(repr, df.collect()))


def test_rows_are_sorted_inside_files(spark, tmp_path, fact):
    built = fact(*[{"batting_team": t, "bowling_team": u, "ball": b} for t in "CAB" for u in "YX" for b in "12"])
    path = str(tmp_path / "fact")
    tables.write_parquet(built, path, STANDARD["fact_deliveries"])
    for file in glob.glob(f"{path}/*.parquet"):
        teams = [tuple(r) for r in spark.read.parquet(file).select("batting_team", "bowling_team").collect()]
        assert teams == sorted(teams)


def test_keyed_tables_come_out_in_order(spark, tmp_path, conf):
    """Written as they are, files hold sorted rows and ranges that do not overlap."""
    from pavilion.operators.keys import with_dense_key

    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    names = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    tables.write_parquet(with_dense_key(names, "name", "key"), str(tmp_path / "names"))
    files = [spark.read.parquet(f).collect() for f in glob.glob(f"{tmp_path}/names/*.parquet")]
    files = sorted(f for f in files if f)
    assert len(files) == 4
    read = [row["key"] for file in files for row in file]
    assert read == list(range(1, 2001))


def test_season_filter_prunes_folders(spark, tmp_path, fact):
    built = fact({}, {"match_id": "2"}, matches=({}, {"id": "2", "season": "2010"}))
    tables.write_parquet(built, f"{tmp_path}/fact_deliveries", Layout("season", ("batting_team",)))
    from pavilion.sources.files import read_parquet

    stored = read_parquet(spark, str(tmp_path), "fact_deliveries")
    chosen = stored.where("season = '2009'")
    assert "PartitionFilters: [isnotnull(season" in plan(chosen, "formatted")
    assert chosen.count() == 1 and dict(stored.dtypes)["season"] == "string"


def test_results_do_not_depend_on_partitions(spark, conf, rows):
    t = Tables(spark, FOLDER)
    results = []
    for width in ("1", "5", "13"):
        conf(spark__sql__shuffle__partitions=width)
        results.append(rows(reports.top_run_scorers(facts.flagged(t.clean_deliveries))))
    assert results[0] == results[1] == results[2]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch(spark, "x").startswith(session.shared_folder(spark))


@pytest.mark.parametrize("kind", ["matches", "deliveries"])
def test_landing_code_is_short_enough_to_be_compiled(spark, source, tmp_path, monkeypatch, kind):
    """The virtual machine interprets methods of 8,000 bytes and more, row by row."""
    seen = {}

    def codes(df, path, column, counts=()):
        seen[path.rsplit("/", 1)[1]] = plan(df.observe("seen", F.count(F.lit(1)).alias("rows"), *counts), "codegen")
        return {name: 0 for name in [*schemas.RAW_MATCHES, "rows", flow.REFUSED, *files.FAULTS, *why]}

    why = [text for name, (_, kinds) in flow.RAW.items() for text in cleansing.refusals(flow.KEYS[name], kinds)]
    monkeypatch.setattr(flow.tables, "write_routed", codes)
    at = flow.Places(source([{}], [{}]), str(tmp_path / "raw"), str(tmp_path / "processed"), "unused")
    flow.land(spark, at)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", seen[kind])]
    assert sizes and max(sizes) < 8000


def test_hot_matches_of_raw_text_are_found_without_dropping_repeats_twice(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(Tables(spark, FOLDER).deliveries_as_text)
    assert "approx_top_k" in text
    dedup = [x for x in text.splitlines() if "Exchange hashpartitioning(match_id" in x and "dismissal_kind" in x and "salt" not in x]
    assert len(dedup) == 1


def _exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text.replace("#", " "))


def test_repeats_and_season_of_the_fact_take_one_shuffle(spark, hot, conf, rows):
    conf(spark__sql__shuffle__partitions="8")
    balls = spark.range(4000).selectExpr("id % 1000 AS match_id", "id % 2000 AS ball", "id % 2000 + 1 AS other")
    matches = spark.range(900).selectExpr("id AS match_id", "concat('S', id) AS season")
    found = distinct_lookup(balls, matches, "match_id", ["match_id", "ball"])
    assert [x.split()[0] for x in _exchanges(plan(found))] == ["match_id", "match_id"]  # the rows, the matches
    expected = balls.dropDuplicates().drop("other").join(matches, "match_id", "left")
    assert found.columns == expected.columns and sorted(rows(found), key=str) == sorted(rows(expected), key=str)


@pytest.mark.parametrize("unknown", [False, True])
def test_a_mass_of_equal_rows_is_dropped_before_the_shuffle(spark, hot, conf, rows, unknown):
    """Half of all rows are one row; more of its match are not, and the match may be unknown."""
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__enabled="false")
    mass = spark.range(8000).selectExpr("-1L AS match_id", "if(id % 20 = 0, id, 0) AS ball")
    balls = mass.unionAll(spark.range(8000).selectExpr("id % 4000 AS match_id", "id % 4000 AS ball")).repartition(8)
    matches = spark.range(-1, 900).selectExpr("id AS match_id", "concat('S', id) AS season")
    matches = matches.where("match_id >= 0") if unknown else matches
    found = distinct_lookup(balls, matches, "match_id", ["match_id", "ball"])
    expected = balls.dropDuplicates().join(matches, "match_id", "left")
    assert sorted(rows(found), key=str) == sorted(rows(expected), key=str) and found.count() == 400 + 4000
    sizes = found.where("match_id = -1").groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 400 / 4


def test_the_transform_moves_deliveries_by_match_once(spark, tmp_path, hot, source, monkeypatch):
    from conftest import DELIVERY, MATCH

    from pavilion.sinks.layout import BY_SEASON

    at = flow.Places(
        source([MATCH | {"id": str(i)} for i in range(200)], [DELIVERY | {"match_id": str(i % 200)} for i in range(400)]),
        str(tmp_path / "raw"), str(tmp_path / "processed"), "flags",
    )
    flow.land(spark, at)
    seen, counted = [], tables._counted
    monkeypatch.setattr(tables, "_counted", lambda df, counts: seen.append(plan(df)) or counted(df, counts))
    flow.transform(spark, at, BY_SEASON)
    (text,) = [x for x in seen if "is_boundary" in x and "dismissal_kind" in x]
    assert len(_exchanges(text)) == 3  # the layout, the deliveries and the matches by match
