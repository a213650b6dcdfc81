"""Jobs for spark-submit: python -m faremill <job> --root <folder> [options]."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from faremill.config import Thresholds
from faremill.lake import Lake
from faremill.operators import windows
from faremill.operators.filters import Filters
from faremill.operators.windows import Window
from faremill.plans import adhoc, bi, cube, pipeline
from faremill.plans.ledger import Ledger
from faremill.session import build_spark
from faremill.sources import areas
from faremill.sources.extract import extract


BI_QUERIES = {
    "summary": bi.summary, "trips-daily": bi.trips_daily, "trips-by-hour": bi.trips_by_hour,
    "trips-by-company": bi.trips_by_company, "payment-mix": bi.payment_mix,
    "top-routes": bi.top_routes, "pickup-areas": bi.pickup_areas, "heatmap": bi.heatmap,
}
NAMED = ("top-routes", "pickup-areas")  # queries that name areas


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="faremill")
    jobs = parser.add_subparsers(dest="job", required=True)
    about = {
        "extract": "land the window's source pages as raw CSV",
        "bronze": "type the window's raw months",
        "silver": "clean, dedupe and enrich the window's months",
        "backfill": "extract (with --source), bronze and silver for every completed month",
        "delta": "backfill of the newest completed month",
        "lookback": "backfill of the last two completed months",
        "gold": "rebuild all marts",
        "maintenance": "compact tables and expire old mart versions",
        "post": "gold, then maintenance",
        "freshness": "check and record when each asset was last rebuilt",
        "alarms": "show what made runs fail",
        "failures": "show failed attempts with their last success and streak",
        "bi": "show a BI query under the given filters",
        "sql": "run ';'-separated statements and show the results",
    }
    for name, text in about.items():
        job = jobs.add_parser(name, help=text)
        job.add_argument("--root", required=True, help="folder of the lake")
        if name in ("extract", "bronze", "silver", "backfill", "delta", "lookback"):
            job.add_argument("--start", required=True, help="first month, e.g. 2023-10")
            job.add_argument("--end", help="end month, exclusive")
        if name in ("extract", "backfill", "delta", "lookback"):
            job.add_argument("--source", required=name == "extract",
                             help="dataset URL or folder of pages")
        if name == "backfill":
            job.add_argument("--by-month", action="store_true", help="gate each month on its own")
            job.add_argument("--missing", action="store_true",
                             help="only months that the ledger does not show as loaded")
        if name == "lookback":
            job.add_argument("--changed", action="store_true",
                             help="only months whose source rows changed (needs --source)")
        if name in ("gold", "post", "sql", "bi"):
            job.add_argument("--areas", required=name in ("gold", "post"),
                             help="area dimension CSV")
        if name == "bi":
            job.add_argument("query", choices=sorted(BI_QUERIES))
            job.add_argument("--start", help="first day")
            job.add_argument("--end", help="last day")
            job.add_argument("--cube", action="store_true", help="answer from the cube")
            job.add_argument("--company")
            job.add_argument("--payment-type")
            job.add_argument("--pickup-area", type=int)
            job.add_argument("--day-type", choices=("weekday", "weekend"))
        if name in ("gold", "post"):
            job.add_argument("--changed", help="only this month's silver changed")
            job.add_argument("--cube", action="store_true", help="refresh the BI cube as well")
            job.add_argument("--check-first", action="store_true",
                             help="publish marts only after their checks")
        if name == "sql":
            job.add_argument("--file", action="store_true", help="STATEMENTS is a file path")
            job.add_argument("statements")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = build_spark(f"faremill_{args.job}")
    lake, limits, book = Lake(spark, args.root).create(), Thresholds.from_env(), None
    if args.job in ("extract", "bronze", "silver", "gold"):
        book = Ledger(lake)
    if args.job == "extract":
        window = Window.of(args.start, args.end)
        pipeline.land(lake, extract(spark, args.source, window), window, book, limits)
    elif args.job == "bronze":
        pipeline.load_bronze(lake, Window.of(args.start, args.end), book, limits)
    elif args.job == "silver":
        pipeline.load_silver(lake, Window.of(args.start, args.end), book, limits)
    elif args.job in ("backfill", "delta", "lookback"):
        planned = windows.backfill(args.start, args.end, datetime.now(timezone.utc))
        if args.job != "backfill":
            planned = {"delta": windows.delta, "lookback": windows.lookback}[args.job](planned)
        if planned:
            span = Window(planned[0].start, planned[-1].end)
            source = extract(spark, args.source, span) if args.source else None
            if getattr(args, "missing", False):
                pipeline.unloaded(lake, planned).orderBy("first_month").show(adhoc.SHOWN_ROWS, False)
                pipeline.backfill_missing(lake, planned, source, limits, args.by_month)
            elif getattr(args, "changed", False):
                if source is None:
                    raise SystemExit("--changed needs --source")
                pipeline.reload_changed(lake, planned, source, limits)
            else:
                pipeline.backfill(lake, planned, source, limits, getattr(args, "by_month", False))
    elif args.job in ("gold", "post"):
        changed = Window.of(args.changed) if args.changed else None
        dimension = areas.load(spark, args.areas)
        if args.job == "gold":
            pipeline.rebuild_gold(lake, dimension, book, limits, changed, args.check_first, args.cube)
        else:
            pipeline.post(lake, dimension, limits, changed, args.check_first, cubed=args.cube
                          ).show(truncate=False)
    elif args.job == "maintenance":
        pipeline.maintenance(lake, Ledger(lake)).show(truncate=False)
    elif args.job == "freshness":
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        pipeline.freshness(lake, Ledger(lake), now, limits).show(truncate=False)
    elif args.job == "alarms":
        pipeline.alarms(Ledger(lake)).show(adhoc.SHOWN_ROWS, truncate=False)
    elif args.job == "failures":
        pipeline.failures(Ledger(lake)).orderBy("at").show(adhoc.SHOWN_ROWS, truncate=False)
    elif args.job == "bi":
        if args.query in NAMED and not args.areas:
            raise SystemExit(f"{args.query} needs --areas")
        filters = Filters(start=args.start, end=args.end, company=args.company,
                          payment_type=args.payment_type, pickup_area=args.pickup_area,
                          day_type=args.day_type)
        dimension = [areas.load(spark, args.areas)] if args.query in NAMED else []
        trips = cube.Cube(lake) if args.cube else lake.table("silver")
        BI_QUERIES[args.query](trips, *dimension, filters).show(
            adhoc.SHOWN_ROWS, truncate=False)
    else:
        if args.areas:
            lake.register_areas(areas.load(spark, args.areas))
        text = args.statements
        if args.file:
            with open(text, encoding="utf-8") as script:
                text = script.read()
        adhoc.show_script(spark, text)


if __name__ == "__main__":
    main()
