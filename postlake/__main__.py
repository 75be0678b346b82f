"""Command line: ``python -m postlake <step> --source <name|all> --date YYYY-MM-DD``."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from postlake.plans import daily
from postlake.session import get_session
from postlake.sinks.serving import publish_all
from postlake.sinks.tables import create_namespaces
from postlake.sources.registry import select_sources


def _arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postlake")
    parser.add_argument("step", choices=("init", "bronze", "silver", "gold", "publish", "day"))
    parser.add_argument("--source", default="all")
    parser.add_argument("--date", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--landing", default="landing")
    parser.add_argument("--quarantine", default="bronze/_quarantine")
    parser.add_argument("--root", help="location of the namespaces (init)")
    parser.add_argument("--catalog")
    parser.add_argument("--row-level", action="store_true", help="the catalog has native MERGE")
    parser.add_argument("--buckets", type=int)
    parser.add_argument("--title-index", action="store_true", help="keep an index of titles for searches")
    parser.add_argument("--schema-dir")
    parser.add_argument("--compat", action="store_true")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-properties", help="JSON file with user, password, driver")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    sources = select_sources(args.source)
    lake = daily.Lake(
        landing=args.landing,
        quarantine=args.quarantine,
        catalog=args.catalog,
        row_level=args.row_level,
        buckets=args.buckets,
        schema_dir=args.schema_dir,
        compat=args.compat,
        title_index=args.title_index,
    )
    spark = get_session(f"postlake-{args.step}")
    if args.step == "init":
        create_namespaces(spark, args.root, args.catalog)
    elif args.step == "bronze":
        for source in sources:
            print(json.dumps(daily.run_bronze(spark, lake, source, args.date)))
    elif args.step == "silver":
        for source in sources:
            print(json.dumps(daily.run_silver(spark, lake, source, args.date)))
    elif args.step == "gold":
        daily.run_gold(spark, lake, args.date)
    elif args.step == "publish":
        with open(args.jdbc_properties, encoding="utf-8") as file:
            properties = json.load(file)
        publish_all(spark, args.jdbc_url, properties, namespace=lake.table("gold", "").rstrip("."))
    else:
        for metrics in daily.run_day(spark, lake, args.date, sources):
            print(json.dumps(metrics))


if __name__ == "__main__":
    main()
