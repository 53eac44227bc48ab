"""Command line: ``python -m pavilion <stage> ...`` or through spark-submit."""

from __future__ import annotations

import argparse
import ast
import inspect
import logging

from pavilion import checks, flow
from pavilion.plans.reports import REPORTS, report
from pavilion.session import open_session
from pavilion.sinks.layout import BY_SEASON, STANDARD


def _option(text: str) -> tuple[str, object]:
    name, sign, value = text.partition("=")
    if not sign or not name.isidentifier():
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    try:
        return name, ast.literal_eval(value)
    except (SyntaxError, ValueError):
        return name, value


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pavilion", description=__doc__)
    parser.add_argument("stage", choices=["land", "transform", "load", "create", "validate", "run", "report"])
    parser.add_argument("name", nargs="?", choices=sorted(REPORTS), help="the report to show")
    parser.add_argument("--source", default="data/source", help="folder of the raw CSV files")
    parser.add_argument("--raw", default="data/raw", help="raw zone")
    parser.add_argument("--processed", default="data/processed", help="processed zone")
    parser.add_argument("--database", default="cricket")
    parser.add_argument("--tables", help="folder of the database, if it has to be created")
    parser.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", type=_option,
        help="an option of the report, such as min_balls=120, overs=(1,6) or k=20",
    )
    parser.add_argument("--by-season", action="store_true", help="season folders instead of days")
    parser.add_argument("--multi-line", action="store_true", help="quoted values may hold line breaks")
    parser.add_argument("--strict", action="store_true", help="refuse faulty lines instead of reading what can be read")
    parser.add_argument("--copy", action="store_true", help="load copies into the database")
    arguments = parser.parse_args()
    if arguments.stage == "report" and not arguments.name:
        parser.error("report needs a name")
    known = list(inspect.signature(REPORTS[arguments.name].build).parameters) if arguments.name else []
    wrong = [name for name, _ in arguments.option if name not in known]
    if wrong:
        parser.error(f"{arguments.name} has no option {', '.join(wrong)}")
    return arguments


def main() -> None:
    asked = _arguments()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    places = flow.Places(asked.source, asked.raw, asked.processed, asked.database, asked.tables)
    layouts = BY_SEASON if asked.by_season else STANDARD
    spark = open_session()
    if asked.stage == "land":
        landed = flow.land(spark, places, multi_line=asked.multi_line, strict=asked.strict)
        print(landed, {"refused": landed.refused, "faulty": landed.faulty})
    elif asked.stage == "transform":
        print(flow.transform(spark, places, layouts))
    elif asked.stage == "load":
        # Without a copy the tables keep the layout that they were written with.
        print(flow.load(spark, places, layouts if asked.copy else None, asked.copy))
    elif asked.stage == "create":
        flow.create(spark, places)
    elif asked.stage == "run":
        print(flow.run(spark, places, layouts, asked.copy, asked.multi_line, asked.strict))
    else:
        if not spark.catalog.databaseExists(places.database):
            # A catalogue that lives in the session starts out empty each time.
            flow.load(spark, places)
        if asked.stage == "validate":
            print(checks.validate(spark, places.database))
        else:
            report(spark, places.database, asked.name, **dict(asked.option)).show(truncate=False)


if __name__ == "__main__":
    main()
