"""Run log (append-only tables) and the reports built on it."""

from __future__ import annotations

from datetime import datetime, timezone
from itertools import count
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.exprs import at_least_zero, duration_s
from marketloom.operators.joins import with_scalar
from marketloom.operators.rank import top_n
from marketloom.sources.sinks import last_per_key, latest_events
from marketloom.warehouse import ANOMALIES, Warehouse

# --- fixed values: columns of the log tables ---------------------------------------------------------
RUNS = (
    "run_id bigint, seq bigint, started_at timestamp, ended_at timestamp, status string, "
    "tables_loaded int, rows_loaded bigint, error_message string"
)
GRAPH_RUNS = (
    "run_id bigint, seq bigint, started_at timestamp, ended_at timestamp, status string, "
    "nodes_loaded bigint, edges_loaded bigint, error_message string"
)
STATS = (
    "run_id bigint, table_name string, started_at timestamp, ended_at timestamp, "
    "rows_loaded bigint, bytes_loaded bigint, duration_s double, status string, "
    "error_message string"
)
RESULTS = (
    "run_id bigint, recorded_at timestamp, test_name string, status string, failures bigint, "
    "message string"
)
TIMINGS = (
    "run_id bigint, seq bigint, node_id string, node_type string, status string, "
    "execution_time_s double, rows_affected bigint"
)
# --- end of fixed values -----------------------------------------------------------------------------


class RunLog:
    """Writes one run's events. Nothing is updated in place: a run is started by one event and
    ended by another, and ``runs`` shows the last state. Runs are numbered by the warehouse and events
    by the run, so order doesn't depend on clocks; an append that is repeated adds nothing."""

    def __init__(self, wh: Warehouse, kind: str = "ingest"):
        self.wh, self.table = wh, {"ingest": "ingest_runs", "graph": "graph_runs"}[kind]
        self.schema = RUNS if kind == "ingest" else GRAPH_RUNS
        self.run_id = wh.next_number("runs")
        self._seq, self._batches = count(1), count(1)
        self._stats, self._results, self._timings = [], [], []
        self._lock = Lock()  # tables of a run are built by several threads

    def _add(self, name: str, rows: list[tuple], schema: str) -> None:
        if rows:
            self.wh.append(self.wh.spark.createDataFrame(rows, schema).coalesce(1), "ops", name, f"run-{self.run_id}-{next(self._batches)}")

    def start(self) -> int:
        now = datetime.now(timezone.utc)
        self._add(self.table, [(self.run_id, next(self._seq), now, None, "running", None, None, None)],
                  self.schema)
        return self.run_id

    def stats(self, rows) -> None:
        """Per-table load statistics (``LoadStats``)."""
        self._stats += [
            (self.run_id, s.table_name, s.started_at, s.ended_at, s.rows_loaded, s.bytes_loaded,
             s.duration_s, s.status, s.error_message) for s in rows]

    def result(self, test: str, status: str, failures: int | None = None, message: str | None = None) -> None:
        with self._lock:
            self._results.append(
                (self.run_id, datetime.now(timezone.utc), test, status, failures, message))

    def node(self, node: str, kind: str, status: str, seconds: float, rows: int | None = None) -> None:
        with self._lock:
            self._timings.append((self.run_id, next(self._seq), node, kind, status, float(seconds), rows))

    def flush(self) -> None:
        """Write what was collected: one small file per log table and run."""
        self._add("ingest_table_stats", self._stats, STATS)
        self._add("test_results", self._results, RESULTS)
        self._add("node_timings", self._timings, TIMINGS)
        self._stats, self._results, self._timings = [], [], []

    def end(self, status: str, first: int, second: int, error: str | None = None) -> None:
        """Close the run. The two counts are (tables, rows) or, for the graph, (nodes, edges)."""
        self.flush()
        now = datetime.now(timezone.utc)
        self._add(self.table, [(self.run_id, next(self._seq), None, now, status, first, second, error)],
                  self.schema)


def load_stats_frame(spark: SparkSession, run_id: int, stats) -> DataFrame:
    """A load's statistics as rows of the log table: one per table, so at most a few dozen."""
    return spark.createDataFrame([
        (run_id, s.table_name, s.started_at, s.ended_at, s.rows_loaded, s.bytes_loaded, s.duration_s, s.status,
         s.error_message) for s in stats], STATS)


def runs(wh: Warehouse, kind: str = "ingest") -> DataFrame:
    """Last state of every run."""
    return latest_events(wh.read("ops", "ingest_runs" if kind == "ingest" else "graph_runs"), "run_id", "seq")


def node_timings(wh: Warehouse) -> DataFrame:
    """Last write per (run, node)."""
    return last_per_key(wh.read("ops", "node_timings"), ["run_id", "node_id"], "seq").drop("seq")


def ops_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "ingest_runs": runs(wh), "ingest_table_stats": wh.read("ops", "ingest_table_stats"),
        "test_results": wh.read("ops", "test_results"), "node_timings": node_timings(wh),
    }


# -- reports ------------------------------------------------------------------------------------------
def recent_runs(runs: DataFrame, n: int = 10, now: Column | None = None) -> DataFrame:
    """Newest runs with their duration; an open run counts up to now."""
    timed = runs.withColumn("duration_s", duration_s(F.col("started_at"), F.col("ended_at"), now))
    return top_n(timed, [F.col("run_id").desc()], n)


def latest_run(runs: DataFrame, now: Column | None = None) -> DataFrame:
    return recent_runs(runs, 1, now)


def table_stats(stats: DataFrame, runs: DataFrame) -> DataFrame:
    """Load statistics of the latest run, largest first."""
    return _of_latest(stats, runs).orderBy(F.col("bytes_loaded").desc(), "table_name")


def latest_checks(results: DataFrame, runs: DataFrame) -> DataFrame:
    return _of_latest(results, runs).orderBy(F.col("status").desc(), "test_name")


def slowest_nodes(timings: DataFrame, runs: DataFrame, n: int = 10) -> DataFrame:
    """Slowest nodes of the latest run."""
    return top_n(_of_latest(timings, runs),
                 [F.col("execution_time_s").desc_nulls_first(), F.col("node_id").asc()], n)


def _of_latest(df: DataFrame, runs: DataFrame) -> DataFrame:
    return df.filter(F.col("run_id") == runs.agg(F.max("run_id")).scalar())


# --- fixed values: which statuses count, on the dashboard and in a run ------------------------------
_PASSED = {"dashboard": ["pass"], "run": ["pass", "success"]}
_FAILED = {"dashboard": ["fail", "error"], "run": ["fail", "error", "runtime error"]}
# --- end of fixed values ----------------------------------------------------------------------------


def tally(results: DataFrame, rule: str = "dashboard", by: tuple[str, ...] = ()) -> DataFrame:
    """Passed, failed and other results. The dashboard and the run count differently."""
    ok, bad = F.col("status").isin(_PASSED[rule]), F.col("status").isin(_FAILED[rule])
    return results.groupBy(*by).agg(
        F.count_if(ok).alias("passed"), F.count_if(bad).alias("failed"),
        F.count_if(~ok & ~bad | F.col("status").isNull()).alias("other"),
    )


def run_history(runs: DataFrame, timings: DataFrame, stats: DataFrame, n: int = 8) -> DataFrame:
    """Wall, node and load seconds of the newest successful runs."""
    newest = top_n(runs.filter(F.col("status") == "success"), [F.col("run_id").desc()], n).select(
        "run_id", duration_s(F.col("started_at"), F.col("ended_at"), F.lit(None)).alias("wall_s"))
    ids = newest.select("run_id")

    def seconds(df: DataFrame, column: str, alias: str) -> DataFrame:
        return df.join(ids, "run_id", "left_semi").groupBy("run_id").agg(F.sum(column).alias(alias))

    joined = newest.join(seconds(timings, "execution_time_s", "node_s"), "run_id", "left").join(
        seconds(stats, "duration_s", "load_s"), "run_id", "left")
    return joined.select(
        "run_id", "wall_s", F.coalesce("node_s", F.lit(0.0)).alias("node_s"),
        F.coalesce("load_s", F.lit(0.0)).alias("load_s"))


# -- layer overviews ------------------------------------------------------------------------------------
def layer_stats(wh: Warehouse, layer: str) -> DataFrame:
    """Exact rows and stored bytes per table; the bytes of a Silver table include its rejected rows,
    whose own table ``<table>__anomalies`` shows 0. One row per table, so the result is small by
    construction."""
    return stats_of(wh.spark, [
        (name, wh.read(layer, name), 0 if name.endswith(ANOMALIES) else wh.size_bytes(wh.snapshot_path(layer, name)))
        for name in wh.tables(layer)])


def stats_of(spark: SparkSession, parts: list[tuple[str, DataFrame, int]]) -> DataFrame:
    """(table_name, rows, bytes) of named frames."""
    out = spark.createDataFrame([], "table_name string, rows bigint, bytes bigint")
    for name, df, size in parts:
        out = out.unionByName(df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.lit(size).cast("bigint").alias("bytes")))
    return out


def pair_anomalies(stats: DataFrame) -> DataFrame:
    """Tables next to the row count of their ``__anomalies`` table (0 without one)."""
    mark = ANOMALIES
    is_side = F.col("table_name").endswith(mark)
    sides = stats.filter(is_side).select(
        F.regexp_replace("table_name", f"{mark}$", "").alias("table_name"),
        at_least_zero(F.col("rows")).alias("anomaly_rows"))
    return stats.filter(~is_side).join(sides, "table_name", "left").select(
        "table_name", at_least_zero(F.col("rows")).alias("rows"), "bytes",
        F.coalesce("anomaly_rows", F.lit(0)).alias("anomaly_rows"))


def layer_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"),
                     F.sum("bytes").alias("bytes"))


def silver_overview(wh: Warehouse) -> DataFrame:
    return pair_anomalies(layer_stats(wh, "silver")).orderBy("table_name")


def gold_overview(wh: Warehouse) -> DataFrame:
    return layer_stats(wh, "gold").orderBy("table_name")


def gold_kpis(customer_360: DataFrame, product: DataFrame, comparison: DataFrame) -> DataFrame:
    """One row: Champions, customers at risk, best item, lifetime net sales."""
    segment = F.col("segment")
    people = customer_360.agg(F.count_if(segment == "Champions").alias("champions"),
                              F.count_if(segment == "At risk high-value").alias("at_risk"))
    best = product.agg(F.max("total_net_sales").alias("top_item_sales"))
    life = comparison.agg(F.sum("total_net_sales").alias("lifetime_net_sales"))
    return with_scalar(with_scalar(people, best), life)
