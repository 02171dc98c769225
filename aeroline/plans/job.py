"""End-to-end run from the landing zone to the star schema, for spark-submit.

    spark-submit run_job.py --root s3a://bucket/air --mode incremental --run-id 2026-03-10T05
    spark-submit run_job.py --root s3a://bucket/air --mode backfill --start 2026-01-01 --end 2026-01-14
    spark-submit run_job.py --root s3a://bucket/air --mode history --until 2019-09-01T00:00 --windows 4
    spark-submit --packages <kafka connector> run_job.py --root s3a://bucket/air --servers host:9092 --topic readings
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.fixed_values import BACKFILL_TARGET
from aeroline.operators.backfill import next_window
from aeroline.operators.columns import lower_case
from aeroline.operators.incremental import MODES
from aeroline.plans.files import Layout, bronze_to_silver, raw_to_bronze, silver_to_gold
from aeroline.plans.report import RunReport, add_landed, drain, landed_metrics
from aeroline.plans.warehouse import (
    FACT_RULES, Warehouse, close_dates, late_before, open_dates, register_tables, update_gold, update_silver, validate,
)
from aeroline.session import clear_work, get_or_create_session, staged
from aeroline.sources.landing import readable
from aeroline.sources.messages import from_messages, kafka_stream
from aeroline.sources.progress import read_progress, write_progress
from aeroline.sources.tables import partition_values, read_partitions
from aeroline.streaming.landing import broken_to_quarantine, landing_to_bronze, messages_to_landing, track_progress


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Landing zone to star schema")
    parser.add_argument("--root", required=True, help="folder of all layers")
    parser.add_argument("--dataset", default="readings")
    parser.add_argument("--layers", choices=["canonical", "files"], default="canonical")
    parser.add_argument("--mode", choices=[*MODES, "history"], default="incremental")
    parser.add_argument("--start", help="first date of a backfill, inclusive")
    parser.add_argument("--end", help="last date of a backfill, inclusive")
    parser.add_argument("--lookback", default="1 hour", help="how far behind the newest stored hour rows are still taken")
    parser.add_argument("--target", choices=["prod", "dev"], default="prod")
    parser.add_argument("--facts", choices=FACT_RULES, default="rebuild",
                        help="rebuild the facts of the dates a run has changed, so corrections reach them, or only insert new ones")
    parser.add_argument("--catalogue", nargs="?", const="", metavar="PREFIX",
                        help="enter the tables into the catalogue, in databases named by layer and target with this in front")
    parser.add_argument("--run-id", help="name of this run in its report; what an interrupted run has left is finished by the next one, whatever its name")
    parser.add_argument("--servers", help="brokers to take new messages from first; needs the Kafka connector")
    parser.add_argument("--topic", help="topic of the messages")
    parser.add_argument("--until", default=BACKFILL_TARGET, help="how far back --mode history goes")
    parser.add_argument("--today", help="the day before which history begins; by default the current one")
    parser.add_argument("--windows", type=int, help="windows a run of --mode history loads at most")
    parser.add_argument("--archive", action="store_true", help="move landing files away once they are in bronze")
    parsed = parser.parse_args(arguments)
    if parsed.mode == "backfill" and not (parsed.start and parsed.end):
        parser.error("a backfill needs --start and --end")
    if parsed.mode != "backfill" and (parsed.start or parsed.end):
        parser.error("--start and --end belong to --mode backfill")
    given = [name for name in ("until", "today", "windows") if getattr(parsed, name) != parser.get_default(name)]
    if given and parsed.mode != "history":
        parser.error(f"only for --mode history: {', '.join(given)}")
    parsed.today = f"{parsed.today or date.today().isoformat()} 00:00:00"
    if bool(parsed.servers) != bool(parsed.topic):
        parser.error("--servers and --topic belong together")
    if parsed.layers == "files":
        others = ("mode", "start", "end", "lookback", "target", "facts", "catalogue", "run_id", "archive", "servers")
        given = [name for name in others if getattr(parsed, name) != parser.get_default(name)]
        if given:
            parser.error(f"--layers files takes every new delivery; not applicable: {', '.join(given)}")
    return parsed


def ingest(messages: DataFrame, options: argparse.Namespace) -> None:
    """Drain new messages into the landing zone, and those that give no record into the quarantine.

    A backfill also moves the progress of the historical load, from which ``next_window`` plans the next one.
    """
    layout, state = Layout(options.root, options.dataset), f"{options.root}/state/{options.dataset}"
    messages_to_landing(messages, layout.landing, f"{state}_ingest").awaitTermination()
    broken_to_quarantine(messages, layout.broken, f"{state}_broken").awaitTermination()
    if options.mode == "backfill":
        track_progress(from_messages(messages), layout.progress, f"{state}_history").awaitTermination()


def run_canonical(spark: SparkSession, options: argparse.Namespace, messages: DataFrame | None = None) -> int:
    """Messages, if there are any, to landing; bronze as a drained stream; then silver and gold increments and their
    checks. Returns the violations. ``messages``: a stream of key and value in place of the broker's.

    What the run has done is shown and appended to its reports: rows of each stage, broken and late lines, types that
    differ from the schema, and checks that fail.
    """
    if messages is None and options.servers:
        messages = kafka_stream(spark, options.servers, options.topic)
    if messages is not None:
        ingest(messages, options)
    layout, warehouse = Layout(options.root, options.dataset), Warehouse(options.root, options.target)
    report = RunReport(spark, options.run_id or "")
    warehouse.recover(spark)
    late = late_before(spark, warehouse, options.lookback) if options.mode == "incremental" else None
    _land(spark, layout, options, report, late)
    if options.mode == "history":
        return run_history(spark, options, layout, warehouse, report)

    bronze = read_partitions(spark, layout.bronze, options.start, options.end)
    first = options.start and f"{options.start} 00:00:00"
    last = options.end and f"{options.end} 23:59:59"
    failures = _load(spark, lower_case(readable(bronze)), warehouse, options, options.mode, first, last, report)
    if options.catalogue is not None:
        register_tables(spark, warehouse, options.catalogue)
    report.write(layout.reports)
    report.frame().show(100, truncate=False)
    return failures


def _land(spark: SparkSession, layout: Layout, options: argparse.Namespace, report: RunReport, late: str | None) -> None:
    """Landing files to bronze; what the lines are is counted on the way."""
    archive = layout.archive if options.archive else None
    checkpoint = f"{options.root}/state/{options.dataset}_bronze"
    add_landed(report, drain(spark, lambda: landing_to_bronze(
        spark, layout.landing, layout.bronze, checkpoint, archive=archive, metrics=landed_metrics(late))))


def _load(
    spark: SparkSession, raw: DataFrame, warehouse: Warehouse, options: argparse.Namespace, mode: str, first: str | None, last: str | None,
    report: RunReport,
) -> int:
    """Silver, gold and the checks of the dates that were touched. Returns the violations."""
    update_silver(raw, warehouse, None, mode, options.lookback, first, last, report=report)
    dates = open_dates(spark, warehouse)
    done = dates.agg(F.count("*"), F.min("date").cast("string"), F.max("date").cast("string")).first()
    print(f"run {options.run_id or ''}: {done[0]} dates from {done[1]} to {done[2]}")
    if not done[0]:
        print("no valid reading to load")
        return 0
    update_gold(spark, warehouse, dates=dates, facts=options.facts, report=report)
    checks = staged(validate(spark, warehouse, dates), "validation")
    close_dates(spark, warehouse)
    failed = checks.filter("violations > 0")
    for row in failed.collect():
        report.add("checks", row["check_name"], row["violations"])
    return failed.count()


def run_history(spark: SparkSession, options: argparse.Namespace, layout: Layout, warehouse: Warehouse, report: RunReport) -> int:
    """Load history backwards, window by window, until the target date; returns the violations.

    The oldest hour loaded is kept as progress. Each round plans the next window from it, loads that window from bronze, and
    only then moves it to the window's begin: an interrupted run repeats its last window, which changes nothing. Windows
    without readings move it as well. ``--windows`` ends a run earlier, and the next one goes on from there.
    """
    state, failures, rounds = f"{options.root}/state/{options.dataset}_history_progress", 0, 0
    days = partition_values(spark, layout.bronze, "date")
    while not options.windows or rounds < options.windows:
        window = next_window(read_progress(spark, state), options.today, options.until).first()
        if window["is_done"]:
            break
        first, last = (window[name].replace("T", " ") + ":00" for name in ("window_start", "window_end"))
        if any(first[:10] <= day <= last[:10] for day in days):
            bronze = read_partitions(spark, layout.bronze, first[:10], last[:10])
            window_report = RunReport(spark, options.run_id or "")
            # The window ends with a full hour, whose readings lie after its beginning.
            failures += _load(spark, lower_case(readable(bronze)), warehouse, options, "backfill", first, last[:14] + "59:59.999999", window_report)
            for (stage, metric), value in window_report.values().items():
                report.add(f"{window['window_start']} {stage}", metric, value)
        write_progress(spark.createDataFrame([(first,)], "at STRING").selectExpr(
            "CAST(at AS TIMESTAMP_NTZ) AS oldest_loaded", "current_timestamp() AS ingested_at"), state)
        rounds += 1
    report.add("history", "windows", rounds)
    if options.catalogue is not None:
        register_tables(spark, warehouse, options.catalogue)
    report.write(layout.reports)
    return failures


def run_files(spark: SparkSession, options: argparse.Namespace) -> int:
    layout = Layout(options.root, options.dataset)
    raw_to_bronze(spark, layout)
    bronze_to_silver(spark, layout)
    silver_to_gold(spark, layout)
    return 0


def main(arguments: list[str] | None = None) -> int:
    options = parse_arguments(arguments)
    spark = get_or_create_session()
    try:
        return (run_files if options.layers == "files" else run_canonical)(spark, options)
    finally:
        clear_work(spark)
