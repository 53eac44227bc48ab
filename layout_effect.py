"""What the table layouts save: files, bytes and rows read with and without them.

Writes the match dimension and the delivery fact of ``BENCH_SF_DIR`` plainly, in
the standard layout and by season, runs the same filters on each and prints a
Markdown table. Figures come from the scan metrics in Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

from pyspark.sql import functions as F

from pavilion.session import open_session
from pavilion.sinks.layout import BY_CURVE, BY_SEASON, STANDARD, Layout
from pavilion.sinks.tables import write_parquet
from pavilion.sources.files import read_parquet
from pavilion.testbed.queries import Tables

METRICS = {"number of files read": "files", "size of files read": "bytes", "number of output rows": "rows"}
LAYOUTS = {"plain": {}, "standard": STANDARD, "by season": BY_SEASON, "by curve": BY_CURVE}
FILTERS = {
    "one month of matches": ("dim_matches", "match_date BETWEEN '1995-03-01' AND '1995-03-31'"),
    "matches of one season": ("dim_matches", "season_year = '1995'"),
    "deliveries of one pairing": ("fact_deliveries", "batting_team = 'T3' AND bowling_team = 'T5'"),
    "deliveries to one side": ("fact_deliveries", "bowling_team = 'T5'"),
    "deliveries of one season": ("fact_deliveries", "season = '1995'"),
}


def scans(log: str) -> dict[str, dict[str, int]]:
    """Scan metrics per job description."""
    meaning, label, totals = {}, {}, {}

    def visit(node: dict) -> None:
        if node["nodeName"].startswith("Scan parquet"):
            for metric in node["metrics"]:
                if metric["name"] in METRICS:
                    meaning[metric["accumulatorId"]] = METRICS[metric["name"]]
        for child in node["children"]:
            visit(child)

    def add(execution: int, accumulator: int, value: int) -> None:
        if accumulator in meaning and execution in label:
            per = totals.setdefault(label[execution], {})
            per[meaning[accumulator]] = per.get(meaning[accumulator], 0) + value

    job_of = {}
    with open(log) as lines:
        for event in map(json.loads, lines):
            kind = event["Event"].rsplit(".", 1)[-1]
            if kind == "SparkListenerSQLExecutionStart":
                label[event["executionId"]] = event["description"]
            if "sparkPlanInfo" in event:
                visit(event["sparkPlanInfo"])
            if kind == "SparkListenerJobStart":
                execution = event["Properties"].get("spark.sql.execution.id")
                job_of |= {stage: int(execution) for stage in event["Stage IDs"] if execution}
            if kind == "SparkListenerDriverAccumUpdates":
                for accumulator, value in event["accumUpdates"]:
                    add(event["executionId"], accumulator, value)
            if kind == "SparkListenerStageCompleted":
                info = event["Stage Info"]
                for accumulable in info["Accumulables"]:
                    if accumulable["ID"] in meaning and info["Stage ID"] in job_of:
                        add(job_of[info["Stage ID"]], accumulable["ID"], int(accumulable["Value"]))
    return totals


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = open_session(
        "layout",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="64",
        # Small enough that the tables of a test machine fill several files and
        # row groups, as they do at scale.
        spark__sql__adaptive__advisoryPartitionSizeInBytes="512k",
        spark__sql__files__openCostInBytes="64k",
        spark__hadoop__parquet__block__size=str(256 * 1024),
        spark__hadoop__parquet__page__row__count__limit="2000",
        spark__eventLog__enabled="true",
        spark__eventLog__dir=work,
        spark__eventLog__rolling__enabled="false",
        spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    for name, layouts in LAYOUTS.items():
        for table, df in (("dim_matches", t.matches), ("fact_deliveries", t.fact)):
            layout = layouts.get(table, Layout())
            write_parquet(df, f"{work}/{name}/{table}", layout)
    found = {}
    for name in LAYOUTS:
        for label, (table, condition) in FILTERS.items():
            spark.sparkContext.setJobDescription(f"{label}|{name}")
            chosen = read_parquet(spark, f"{work}/{name}", table).where(condition)
            found[label, name] = chosen.agg(F.count("*"), F.max("match_id")).first()[0]
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    log = next(path for path in glob.glob(f"{work}/*") if os.path.isfile(path))
    read = scans(log)
    print("| Filter | Layout | Rows found | Files read | Bytes of those files | Rows scanned |")
    print("| --- | --- | --- | --- | --- | --- |")
    for label in FILTERS:
        for name in LAYOUTS:
            m = read[f"{label}|{name}"]
            print(
                f"| {label} | {name} | {found[label, name]:,} | {m['files']:,} "
                f"| {m['bytes']:,} | {m['rows']:,} |"
            )


if __name__ == "__main__":
    sys.exit(main())
