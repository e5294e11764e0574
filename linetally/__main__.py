"""Command line, one subcommand per job. Run with ``spark-submit`` or ``python -m linetally``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import functions as F

from linetally.env import Env, build_session, written
from linetally.plans import catalog, convert
from linetally.plans import pipeline as P
from linetally.plans.recon import overall_state, status_report
from linetally.plans.staging import refresh_from_ledgers, refresh_stg_orders
from linetally.sources import csv_orders as CSV
from linetally.sources import raw_orders as RAW
from linetally.sources import reference as REF
from linetally.streaming.replay import replay


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="linetally")
    parser.add_argument("--env", default="dev")
    parser.add_argument("--base", required=True, help="folder that holds the layers")
    parser.add_argument("--salt", default="", help="masking salt of this environment; reader views need one")
    parser.add_argument("--output", help="folder for the job's result, in full, as CSV with a header")
    parser.add_argument("--preview", type=int, default=0, metavar="N", help="also print the first N rows of the result")
    jobs = parser.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land", help="source CSV to daily newline-delimited JSON")
    land.add_argument("--input", required=True)
    land.add_argument("--plain-lines", action="store_true", help="no quoted line breaks: the file can be split")
    land.add_argument("--most-undated", type=float, default=0.5, help="share of rows without a usable date that stops the job")
    land.add_argument("--stream-days", type=int, default=0, help="hold back the last N days for replay")

    month = jobs.add_parser("convert", help="convert one month")
    month.add_argument("--year", type=int, required=True)
    month.add_argument("--month", type=int, required=True)
    fill = jobs.add_parser("backfill", help="convert a range of months")
    fill.add_argument("start")
    fill.add_argument("end")
    for p in (month, fill):
        p.add_argument("--warn-on-mismatch", action="store_true", help="an imbalance does not fail the run")

    load = jobs.add_parser("load", help="staged files to RAW")
    load.add_argument("periods", nargs="*", help="periods to replace; without any, files not loaded yet are added")
    stage = jobs.add_parser("stage", help="refresh staging")
    stage.add_argument("periods", nargs="*", help="periods to reprocess; without any, those with newer loads")
    ref = jobs.add_parser("reference", help="saved reference pages to RAW")
    ref.add_argument("--pages", required=True)
    jobs.add_parser("seed", help="write the shipped country mapping")
    run = jobs.add_parser("run", help="everything for some periods")
    run.add_argument("periods", nargs="+")
    jobs.add_parser("replay", help="take in streamed files that have arrived")
    jobs.add_parser("report", help="reconciliation per period")
    query = jobs.add_parser("sql", help="a query over the tables of the environment")
    query.add_argument("text")
    return parser


def _give(result, args: argparse.Namespace) -> None:
    """The whole result to ``--output``, and a preview if one is asked for."""
    if args.output:
        result.write.mode("overwrite").option("header", "true").csv(args.output)
    if args.preview:
        result.show(args.preview, False)


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session("linetally")
    env = Env(args.env, args.base, args.salt)
    stream = env.path("landing", "stream")

    if args.job == "land":
        rows = CSV.scan_csv_rows(spark, args.input, not args.plain_lines)
        dated, undated = CSV.split_undated(CSV.prepare(CSV.well_formed(rows)))
        malformed = CSV.malformed_rows(rows)
        # what an earlier run set aside of this file goes, that of other files stays
        source = f"source={quote(args.input, safe='')}"
        undated.drop("event_date").write.mode("overwrite").json(f"{env.quarantine_csv}/undated/{source}")
        malformed.write.mode("overwrite").json(f"{env.quarantine_csv}/malformed/{source}")
        profile = CSV.profile(dated)
        left_out, broken, kept = undated.count(), malformed.count(), profile.first()["row_count"]
        if left_out:
            print(f"{left_out} lines have no usable date and cannot be filed under a day; see {env.quarantine_csv}")
        if broken:
            print(f"{broken} rows do not have the header's fields; see {env.quarantine_csv}")
        CSV.require_dated(kept, left_out, args.most_undated)
        _give(profile, args)
        batch, held = CSV.hold_back(dated, args.stream_days) if args.stream_days else (dated, None)
        CSV.write_daily(batch, env.landing)
        if held is not None:
            CSV.write_daily(held, stream)
    elif args.job in ("convert", "backfill"):
        periods = (
            [f"{args.year:04d}-{args.month:02d}"] if args.job == "convert" else convert.period_range(args.start, args.end)
        )
        recon = convert.convert_months(
            spark,
            env.landing,
            env.staged,
            env.audit,
            periods,
            fail_on_mismatch=not args.warn_on_mismatch,
            quarantine=env.quarantine,
        )
        _give(recon.select("period", "source_lines", "rows_written_back", "status").orderBy("period"), args)
        for row in recon.groupBy("status").count().orderBy("status").collect():  # one row per status
            print(f"{row['count']} periods {row['status']}")
    elif args.job == "load":
        if args.periods:
            RAW.load_periods(spark, env.staged, env.raw_orders, args.periods)
        else:
            print(f"{RAW.load_new_files(spark, env.staged, env.raw_orders)} files loaded")
    elif args.job == "stage":
        if args.periods:
            raw = RAW.read_all_raw(spark, env.raw_orders, env.raw_orders_stream)
            rebuilt = refresh_stg_orders(spark, raw, env.stg_orders, args.periods)
        else:
            rebuilt = refresh_from_ledgers(spark, env.raw_orders, env.raw_orders_stream, env.stg_orders)
        print("rebuilt:", rebuilt)
    elif args.job == "reference":
        pages = written(REF.read_pages(spark, args.pages), "pages")
        REF.require_complete(pages)
        landed, now = env.path("landing", "worldbank"), F.current_timestamp()
        audit = REF.land_reference(REF.flatten_countries(pages, now), REF.flatten_indicators(pages, now), landed)
        # one record per pull and dataset; earlier pulls stay
        audit.withColumn("pulled_at", F.current_timestamp()).write.mode("append").json(env.path("staged", "_audit/reference"))
        REF.require_balanced(audit)
        REF.load_countries(spark, landed, env.raw_countries)
        REF.load_indicators(spark, landed, env.raw_indicators)
    elif args.job == "seed":
        REF.write_default_mapping(spark, env.country_mapping)
    elif args.job == "run":
        report = P.run(spark, env, args.periods, raise_on_failure=False)
        if report.table() is not None:
            _give(report.table(), args)
        print(report.state, report.failed_step or "")
        return 0 if report.state == "SUCCESS" else 1
    elif args.job == "replay":
        replay(
            spark,
            stream,
            env.raw_orders,
            env.raw_orders_stream,
            env.stg_orders,
            env.path("ops", "replay_checkpoint"),
            env.quarantine_stream,
            env.stream_audit,
        )
    elif args.job == "report":
        recon = P.reconciliation(spark, env)
        _give(status_report(recon), args)
        print(overall_state(recon))
    elif args.job == "sql":
        catalog.register(spark, env)
        if not (args.output or args.preview):
            raise SystemExit("sql needs --output DIR for the whole result, or --preview N")
        _give(spark.sql(args.text), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
