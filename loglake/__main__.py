"""Command line of the jobs, for spark-submit or ``python -m loglake``.

Exits with 1 when a batch fails the gate, a schema change breaks, or a data test
is an error, so that whatever runs the steps stops there.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from loglake.contract import (
    MAX_LATENCY_MS,
    NULL_RATE_THRESHOLD,
    MissingColumnsError,
    QualityGateError,
    SchemaEvolutionError,
)
from loglake.operators.datatests import run_data_tests
from loglake.operators.schema_diff import field_history, json_fields
from loglake.plans import jobs, panels
from loglake.session import build_session
from loglake.sources.raw import read_lines
from loglake.streaming.lake import stream_to_silver

PANELS = {
    "kpis": ("fct_requests_daily", panels.latest_day_kpis),
    "traffic": ("fct_requests_daily", panels.panel_traffic),
    "errors": ("fct_requests_daily", panels.panel_error_rate),
    "latency": ("fct_requests_daily", panels.panel_latency),
    "endpoints": ("dim_endpoints", panels.top_endpoints),
}


def _time(text: str) -> datetime:
    value = datetime.fromisoformat(text)
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loglake", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str, *paths: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=text)
        for path in paths:
            sub.add_argument(f"--{path}-path", required=True)
        return sub

    step("ingest", "append new raw files to bronze", "raw", "bronze")
    silver = step("silver", "clean, gate and upsert into silver", "bronze", "silver", "quarantine")

    def limits(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--null-rate-threshold", type=float, default=NULL_RATE_THRESHOLD)
        sub.add_argument("--max-latency-ms", type=int, default=MAX_LATENCY_MS)

    limits(silver)
    silver.add_argument(
        "--arrived",
        nargs=2,
        type=_time,
        metavar=("FROM", "UNTIL"),
        help="process this window of arrival times again, not what is new",
    )
    silver.add_argument(
        "--event-times-fixed",
        action="store_true",
        help="an event never comes again with another time: search its own day only",
    )
    marts = step("marts", "bring the marts up to date", "silver", "marts")
    marts.add_argument("--full", action="store_true", help="read all days again")
    tests = step("test", "run the data tests", "silver", "marts")
    tests.add_argument("--as-of", type=_time, help="clock of the freshness test; now by default")
    tests.add_argument("--require-rows", action="store_true", help="an empty table is stale")
    panel = step("panel", "show a dashboard panel", "marts")
    panel.add_argument("name", choices=PANELS)
    run = step("run", "all steps in order", "raw", "lake")
    run.add_argument("--as-of", type=_time)
    limits(run)
    step("last-run", "show the last run in which all steps succeeded", "lake")
    limits(step("stream", "ingest and merge by micro-batches what is not yet done", "raw", "lake", "checkpoint"))
    step("drift", "show which file brought which field and type", "raw")
    return parser.parse_args(argv)


def _limits(args: argparse.Namespace) -> dict:
    return {"null_rate_threshold": args.null_rate_threshold, "max_latency_ms": args.max_latency_ms}


def _passed(results: DataFrame) -> bool:
    rows = results.orderBy("model", "column_name", "test").collect()  # one per test
    for r in rows:
        print(f"{r.status:5} {r.model}.{r.column_name} {r.test}: {r.failures} failing")
    return all(r.status != "error" for r in rows)


def _print_rows(rows: DataFrame) -> None:
    """All rows as tab-separated text under their names, a partition at a time."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*("" if value is None else value for value in row), sep="\t")


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session(f"loglake {args.step}")
    now = datetime.now(timezone.utc)
    try:
        if args.step == "ingest":
            jobs.ingest_raw(spark, args.raw_path, args.bronze_path)
        elif args.step == "silver":
            jobs.bronze_to_silver(
                spark,
                args.bronze_path,
                args.silver_path,
                args.quarantine_path,
                args.null_rate_threshold,
                args.max_latency_ms,
                args.arrived and tuple(args.arrived),
                args.event_times_fixed,
            )
        elif args.step == "marts":
            jobs.build_marts(spark, args.silver_path, args.marts_path, args.full)
        elif args.step == "test":
            models = jobs.read_models(spark, args.silver_path, args.marts_path)
            results = run_data_tests(models, args.as_of or now, require_rows=args.require_rows)
            return 0 if _passed(results) else 1
        elif args.step == "panel":
            mart, select = PANELS[args.name]
            _print_rows(select(jobs.read_mart(spark, args.marts_path, mart)))
        elif args.step == "run":
            results = jobs.run_all(spark, args.raw_path, args.lake_path, args.as_of or now, now.isoformat(), **_limits(args))
            return 0 if _passed(results) else 1
        elif args.step == "last-run":
            print(jobs.last_run(spark, f"{args.lake_path}/run_log"))
        elif args.step == "stream":
            stream = stream_to_silver(spark, args.raw_path, args.lake_path, args.checkpoint_path, limits=_limits(args))
            stream.awaitTermination()
        elif args.step == "drift":
            history = field_history(json_fields(read_lines(spark, args.raw_path)))
            _print_rows(history.orderBy("first_file", "field"))
    except (MissingColumnsError, QualityGateError, SchemaEvolutionError) as error:
        logging.error("%s stopped: %s", args.step, error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
