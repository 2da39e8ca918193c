"""Command line: ``spark-submit`` or ``python -m triploom <report> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from triploom.operators import with_trip_id
from triploom.plans.pipeline import ALL_STAGES, PipelineParams, run_pipeline
from triploom.plans.reports import chain_report, profile_report
from triploom.sources import read_locations, read_trips


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="triploom")
    reports = parser.add_subparsers(dest="report", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        report = reports.add_parser(name, help=text)
        report.add_argument("--trips", required=True, help="path of the trips table")
        report.add_argument("--format", default="csv", choices=["csv", "parquet"])
        report.add_argument("--infer-schema", action="store_true")
        report.add_argument("--rows", type=int, default=10, help="rows to show")
        return report

    profile = add("profile", "summaries, NULL rows, totals and top locations")
    profile.add_argument("--locations", required=True)

    pipeline = add("outliers", "remove outliers and rank pairs by amount")
    pipeline.add_argument("--base-dir", required=True, help="folder for stage outputs")
    pipeline.add_argument("--stages", nargs="+", default=ALL_STAGES, choices=ALL_STAGES)
    pipeline.add_argument("--features", default="speed")
    pipeline.add_argument("--contamination", type=float, default=0.001)
    pipeline.add_argument("--id-col", help="unique trip id; row numbers if left out")
    pipeline.add_argument("--num-trees", type=int, default=100)
    pipeline.add_argument("--seed", type=int, default=1)
    pipeline.add_argument("--max-samples", type=int, default=256)
    pipeline.add_argument("--key", default="columns", choices=["columns", "struct"])
    pipeline.add_argument("--depth", type=int, default=1)

    chains = add("chains", "longest chains of trips one driver could have made")
    chains.add_argument("--id-col", help="unique trip id; row numbers if left out")
    chains.add_argument("--max-idle", type=float, default=300, help="seconds")
    chains.add_argument(
        "--weights", nargs="+", default=["distance"], choices=["distance", "count"]
    )

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"triploom {args.report}").getOrCreate()
    if args.report == "outliers":
        params = PipelineParams(
            trips_path=args.trips,
            base_dir=args.base_dir,
            trips_format=args.format,
            infer_schema=args.infer_schema,
            id_col=args.id_col,
            num_trees=args.num_trees,
            seed=args.seed,
            features=args.features,
            contamination=args.contamination,
            max_samples=args.max_samples,
            key=args.key,
            depth=args.depth,
        )
        tables = run_pipeline(spark, params, args.stages)
    else:
        trips = read_trips(spark, args.trips, args.format, args.infer_schema)
        if args.report == "profile":
            tables = profile_report(trips, read_locations(spark, args.locations))
        else:
            trips = with_trip_id(trips, args.id_col)
            tables = chain_report(trips, args.max_idle, args.weights)
    for name, table in tables.items():
        print(f"\n{name}")
        table.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
