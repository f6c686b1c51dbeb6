"""Command line: ``python -m marketloom <command> …``, or the same by spark-submit on a cluster.

Exit status: 0 for success, 1 for a failed run, load or check, 2 for wrong arguments and unknown tables.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark import SparkConf
from pyspark.sql import SparkSession

from marketloom.plans.daily import refresh_graph, run_daily
from marketloom.plans.graph import export_graph, load_ontology, top_customers
from marketloom.plans.ops import RunLog, silver_overview
from marketloom.session import local_session
from marketloom.sources.bronze import check_tables, load_bronze, profile_files, profile_issues
from marketloom.warehouse import Warehouse


def session() -> SparkSession:
    """The session of spark-submit if there is one, else a local one."""
    if SparkSession.getActiveSession() or SparkConf().contains("spark.master"):
        return SparkSession.builder.appName("marketloom").getOrCreate()
    return local_session("*")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("marketloom", description="Retail warehouse on Spark.")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *folders: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=text)
        for f in folders:
            added.add_argument(f)
        return added

    run = command("daily", "load, validate, build marts and check, as one run", "warehouse", "raw")
    run.add_argument("--threads", type=int, default=8)
    run.add_argument("--on-load-error", choices=("stop", "skip"), default="stop")
    run.add_argument("--sort-sales", action="store_true", help="store unified sales in the order of customers")
    load = command("load", "load raw files", "warehouse", "raw")
    load.add_argument("tables", nargs="*")
    profile = command("profile", "compare raw files with their declared columns", "raw")
    profile.add_argument("tables", nargs="*")
    graph = command("graph", "build or refresh the graph from stored tables", "warehouse")
    graph.add_argument("--rebuild", action="store_true")
    export = command("export", "write the graph as JSON lines", "warehouse", "target")
    export.add_argument("--mode", choices=("sample", "full"), default="sample")
    export.add_argument("--top-customers", type=int, default=200)
    top = command("top-customers", "customers by purchases", "warehouse")
    top.add_argument("--n", type=int, default=10)
    command("overview", "rows and rejected rows per validated table", "warehouse")
    return out


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        tables = check_tables(args.tables) if args.command in ("load", "profile") else []
    except ValueError as exc:
        print(exc, file=sys.stderr)
        return 2
    spark = session()
    wh = Warehouse(spark, args.warehouse) if "warehouse" in args else None
    if args.command == "daily":
        out = run_daily(wh, args.raw, args.threads, args.on_load_error, args.sort_sales)
        print(f"run {out.run_id}: {out.status}, {out.passed} passed, {out.failed} failed{': ' + out.message if out.message else ''}")
        return out.exit_code
    if args.command == "load":
        return _load(wh, args.raw, tables)
    if args.command == "profile":
        found = profile_files(spark, args.raw, tables)
        found.orderBy("table_name").show(len(tables), truncate=False)
        return int(profile_issues(found).first()["issues"] > 0)
    if args.command == "graph":
        for (kind, name), n in sorted(refresh_graph(wh, upsert=not args.rebuild).items()):
            print(f"{kind} {name}: {n}")
    elif args.command == "export":
        counts = export_graph(wh.read("graph", "node"), wh.read("graph", "edge"), load_ontology(), args.target, args.mode, args.top_customers)
        counts.orderBy("kind", "name").show(100, truncate=False)
    elif args.command == "top-customers":
        top_customers(wh.read("graph", "node"), wh.read("graph", "edge"), args.n).show(args.n, truncate=False)
    else:
        silver_overview(wh).show(100, truncate=False)
    return 0


def _load(wh: Warehouse, raw: str, tables: list[str]) -> int:
    log = RunLog(wh)
    log.start()
    stats = load_bronze(wh, raw, tables)
    bad = [s for s in stats if s.status == "failed"]
    for s in stats:
        print(f"{s.table_name}: {s.status}, {s.rows_loaded} rows, {s.bytes_loaded} bytes, {s.duration_s:.1f} s{': ' + s.error_message if s.error_message else ''}")
    log.stats(stats)
    log.end("failed" if bad else "success", len(stats) - len(bad), sum(s.rows_loaded for s in stats), bad[0].error_message if bad else None)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
