"""Run one job of the chain.

    python -m colloquy.plans.cli filter   --input RAW      --output FILTERED
    python -m colloquy.plans.cli features --input FILTERED --output FEATURES
    python -m colloquy.plans.cli time     --input FEATURES --output REPORT_DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colloquy.plans import reports, tables
from colloquy.session import build_session
from colloquy.sources.sinks import write_notes, write_summary_csv
from colloquy.sources.tables import month_paths, read_files, read_table
from colloquy.staging import scope

TABLES: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {
    "filter": tables.build_filtered,
    "features": tables.build_features,
    "text-base": tables.build_text_base,
    "model-base": tables.build_model_base,
}
REPORTS: dict[str, Callable[[DataFrame], reports.Frames]] = {
    "filter-checks": reports.filter_report,
    "feature-checks": reports.feature_report,
    "explore": reports.explore_report,
    "subsets": reports.subset_report,
    "time": reports.time_report,
    "communities": reports.community_report,
    "text": reports.text_report,
    "text-base-checks": reports.text_base_report,
    "nlp": reports.nlp_report,
    "model-base-checks": reports.model_base_report,
    "models": reports.model_report,
}


# Frames that grow with the number of communities, not with the report.
GROWING = ("subreddits", "subreddit_counts", "subreddit_pair_counts")


def write_report(frames: reports.Frames, out: str) -> None:
    """One CSV per frame; (metric, value) frames become ``name: value`` notes.
    Each frame's own sort keys order its file."""
    for name, frame in frames.items():
        path = f"{out.rstrip('/')}/{name}"
        if frame.columns == ["metric", "value"]:
            write_notes(frame, path)
        else:
            write_summary_csv(frame, path, one_file=name not in GROWING)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=[*TABLES, *REPORTS, "list", "trips"])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--master")
    parser.add_argument("--object-store", action="store_true", help="use S3A with instance credentials")
    parser.add_argument("--year", type=int, help="year of the list and trips jobs")
    parser.add_argument("--months", type=int, nargs="+", help="months of the list (first one) and trips jobs")
    parser.add_argument("--min-count", type=int, default=500, help="threshold of distinctive terms")
    parser.add_argument("--features", help="feature table, for the notes of the text-base-checks and model-base-checks jobs")
    parser.add_argument("--text-base", help="cleaned-text table, which spares the text job the cleaning")
    parser.add_argument("--features-from", choices=("all", "train"), default="all", help="rows behind the features of the model-base job")
    args = parser.parse_args(argv)
    spark = build_session(f"colloquy-{args.job}", args.master, object_store=args.object_store)
    with scope(spark):
        run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job in TABLES:
        options = {"features_from": args.features_from} if args.job == "model-base" else {}
        TABLES[args.job](spark, args.input, args.output, **options)
    elif args.job == "list":
        month = (args.months or [1])[0]
        write_report({"subreddits": tables.list_communities(spark, args.input, args.year or 2024, month)}, args.output)
    elif args.job == "trips":
        year = args.year or 2021
        paths = month_paths(args.input, year, args.months or range(1, 13))
        write_report(reports.trip_report(read_files(spark, *paths), year), args.output)
    else:
        report = REPORTS[args.job]
        options = {"min_count": args.min_count} if args.job == "nlp" else {}
        if args.features and args.job in ("text-base-checks", "model-base-checks"):
            options["features"] = read_table(spark, args.features)
        if args.text_base and args.job == "text":
            options["text_base"] = read_table(spark, args.text_base)
        write_report(report(read_table(spark, args.input), **options), args.output)


if __name__ == "__main__":
    main()
