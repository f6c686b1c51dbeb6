"""The daily run: load, Silver, unified facts, marts and checks under one run id."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import groupby
from threading import Lock
from types import MappingProxyType

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from marketloom.operators.quality import (
    Check, answered, gold_suite, graph_suite, observed, ops_suite, range_suite, run_checks, table_suite, verdict,
)
from marketloom.operators.silver import read_clean, store_silver
from marketloom.operators.unify import CHANNELS, SALES_ORDER, by_channel, unify_returns, unify_sales
from marketloom.plans import marts
from marketloom.plans.graph import Tables, build_graph, load_ontology
from marketloom.plans.ops import RunLog, ops_tables
from marketloom.sources.bronze import LoadStats, failed_load, file_path, load_table, tables_loaded
from marketloom.specs import TABLES, silver_tables
from marketloom.warehouse import Warehouse, Written


def silver_frame(wh: Warehouse, name: str) -> DataFrame:
    """Silver table by its Silver name: validated tables, rejected rows and unified facts alike."""
    return wh.read("silver", name)


def layer_frame(wh: Warehouse, layer: str, name: str) -> DataFrame:
    return wh.read(layer, name)


def write_sales(wh: Warehouse, sort_by: Sequence[str] = ()) -> Written:
    facts = [read_clean(wh, f"{ch}_sales") for ch in CHANNELS]
    sales = unify_sales(*facts)
    if sort_by:
        return wh.write(sales, "silver", "int_sales_unified", partition_by=["channel"], sort_by=sort_by)
    return wh.write_parts(by_channel(sales), "silver", "int_sales_unified", "channel")


def write_returns(wh: Warehouse) -> Written:
    facts = [read_clean(wh, f"{ch}_returns") for ch in CHANNELS]
    return wh.write_parts(by_channel(unify_returns(*facts)), "silver", "int_returns_unified", "channel")


def gold_frame(wh: Warehouse, name: str) -> DataFrame:
    """A mart over the stored Silver tables."""
    def s(table: str) -> DataFrame:
        return silver_frame(wh, table)

    sales, returns = "int_sales_unified", "int_returns_unified"
    if name == "mart_sales_performance":
        return marts.mart_sales_performance(s(sales), s(returns), s("dim_date_dim"))
    if name == "mart_channel_comparison":
        return marts.mart_channel_comparison(s(sales), s("dim_date_dim"))
    if name == "mart_customer_360":
        return marts.mart_customer_360(
            s("dim_customer"), s("dim_customer_demographics"), s("dim_household_demographics"),
            s("dim_income_band"), s(sales), s(returns))
    if name == "mart_product_analytics":
        return marts.mart_product_analytics(s("dim_item"), s(sales), s(returns))
    raise ValueError(f"unknown mart {name!r}")


@dataclass(frozen=True)
class Node:
    """A step of the run: how its table is made, what it needs, what is checked before and after.

    ``make`` gets the aggregates that answer checks and returns what was written and counted.
    """

    name: str
    layer: str
    make: Callable[[Mapping[str, Column]], Written]
    needs: tuple[str, ...] = ()
    before: tuple[Check, ...] = ()
    after: tuple[Check, ...] = ()
    weight: int = 0  # heavier nodes begin first


def load_name(table: str) -> str:
    return f"load {table}"


def nodes_of_run(
    wh: Warehouse, load: Callable[[str], Written], sizes: Mapping[str, int] | None = None, sort_sales: Sequence[str] = ()
) -> list[Node]:
    """Loads, Silver, unified facts and marts with what each needs. The Silver table of a raw table
    needs that table's load only, so that no table waits for all others."""
    sizes = sizes or {}

    def silver(t: str):
        return lambda metrics: store_silver(wh, wh.read("bronze", t), TABLES[t], metrics=metrics)

    def mart(m: str):
        return lambda metrics: wh.write(gold_frame(wh, m), "gold", m, metrics=metrics)

    nodes = [Node(load_name(t), "bronze", lambda _, t=t: load(t), after=tuple(table_suite("bronze", t)), weight=sizes.get(t, 0)) for t in TABLES]
    nodes += [
        Node(TABLES[t].silver_name, "silver", silver(t), (load_name(t),), after=(*table_suite("silver", t), *range_suite(t)),
             weight=sizes.get(t, 0))
        for t in silver_tables()
    ]
    facts = {k: tuple(f"fact_{ch}_{k}" for ch in CHANNELS) for k in ("sales", "returns")}
    nodes += [
        Node("int_sales_unified", "silver", lambda _: write_sales(wh, sort_sales), facts["sales"]),
        Node("int_returns_unified", "silver", lambda _: write_returns(wh), facts["returns"]),
    ]
    both = ("int_sales_unified", "int_returns_unified")
    needs = {
        "mart_sales_performance": (*both, "dim_date_dim"),
        "mart_channel_comparison": ("int_sales_unified", "dim_date_dim"),
        "mart_customer_360": (*both, "dim_customer", "dim_customer_demographics",
                              "dim_household_demographics", "dim_income_band"),
        "mart_product_analytics": (*both, "dim_item"),
    }
    return nodes + [Node(m, "gold", mart(m), n, after=tuple(c for c in gold_suite() if c.table == m)) for m, n in needs.items()]


def run_nodes(spark: SparkSession, nodes: Sequence[Node], work: Callable[[Node], None], threads: int) -> None:
    """Calls ``work`` for every node as soon as those it needs have ended, ``threads`` next to each
    other and each in a pool of its own, so that a FAIR session shares its cores among them."""
    by_name = {n.name: n for n in nodes}
    missing = {x for n in nodes for x in n.needs} - set(by_name)
    if missing:
        raise ValueError(f"needed but not there: {', '.join(sorted(missing))}")
    waiting = {n.name: set(n.needs) for n in nodes}
    running: dict = {}

    def in_pool(node: Node) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", node.name)
        work(node)

    # The queue of the threads is kept short, so that the heaviest of all ready nodes comes next.
    ready = [by_name[n] for n, needs in waiting.items() if not needs]
    with ThreadPoolExecutor(threads) as pool:
        while ready or running:
            ready.sort(key=lambda n: n.weight)
            while ready and len(running) < threads:
                node = ready.pop()
                del waiting[node.name]
                running[pool.submit(inheritable_thread_target(spark)(in_pool), node)] = node.name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in ended:
                name = running.pop(future)
                future.result()
                for user, needs in waiting.items():
                    if name in needs:
                        needs.discard(name)
                        ready += [by_name[user]] if not needs else []
    if waiting:
        raise ValueError(f"nodes need each other: {', '.join(sorted(waiting))}")


@dataclass
class Outcome:
    run_id: int
    status: str
    passed: int = 0
    failed: int = 0
    message: str | None = None
    blocked: set[str] = field(default_factory=set)

    @property
    def exit_code(self) -> int:
        return 0 if self.status == "success" else 1


def run_daily(wh: Warehouse, raw_folder: str, threads: int = 8, on_load_error: str = "stop", sort_sales: bool = False) -> Outcome:
    """Full refresh. Each table is loaded, validated and checked on its own, and what needs it follows.

    A failed table or check skips what depends on it and fails the run. A failed load ends the run:
    what has begun is ended, nothing else begins (with ``on_load_error="skip"`` only what depends on
    it is skipped). Rejected rows do not fail it, unless a key was out of range. Whatever goes wrong,
    the run is closed in the log with all that was recorded. ``sort_sales`` stores unified sales in the
    order of customers: for warehouses whose sales are read by customer more often than they are written.
    """
    if on_load_error not in ("stop", "skip"):
        raise ValueError(f"unknown answer {on_load_error!r} to a failed load; known: stop, skip")
    log = RunLog(wh)
    run = _Run(wh, log, Outcome(log.start(), "failed"), raw_folder, on_load_error == "stop")
    out = run.out
    try:
        sizes = {t: wh.size_bytes(file_path(raw_folder, t)) for t in TABLES}
        run_nodes(wh.spark, nodes_of_run(wh, run.load, sizes, SALES_ORDER if sort_sales else ()), run.node, threads)
        run.stats.sort(key=lambda s: list(TABLES).index(s.table_name))
        broken = [s for s in run.stats if s.status == "failed"]
        log.stats(run.stats)
        if broken:
            out.message = f"load failed at {broken[0].table_name}: {broken[0].error_message}"
            return out
        log.flush()  # the log's own tables are checked as they stand now
        run.checks(tuple(ops_suite()))
        out.status = "success" if out.failed == 0 else "failed"
        out.message = None if out.failed == 0 else f"{out.failed} node(s) or check(s) failed"
        return out
    except Exception as exc:
        out.status, out.message = "failed", f"{type(exc).__name__}: {exc}"
        return out
    finally:
        log.end(out.status, tables_loaded(run.stats, in_daily_run=True), sum(s.rows_loaded for s in run.stats), out.message)


class _Run:
    """Builds and checks the tables of one run; several threads share it."""

    def __init__(self, wh: Warehouse, log: RunLog, out: Outcome, raw_folder: str, stop: bool):
        self.wh, self.log, self.out, self.raw_folder, self.stop = wh, log, out, raw_folder, stop
        self.stats: list[LoadStats] = []
        self._lock = Lock()

    def load(self, table: str) -> Written:
        started = datetime.now(timezone.utc)
        try:
            done = load_table(self.wh, self.raw_folder, table)
        except Exception as exc:
            with self._lock:
                self.stats.append(failed_load(table, started, exc))
            raise
        with self._lock:
            self.stats.append(done)
        nulls = [c.name for c in table_suite("bronze", table) if c.kind == "not_null"]
        return Written("", done.rows_loaded, {n: done.null_keys for n in nulls})

    def node(self, node: Node) -> None:
        is_load = node.layer == "bronze"  # loads have their own statistics
        with self._lock:
            blocking = sorted(self.out.blocked & set(node.needs))
            if self.stop and not blocking:
                blocking = [load_name(s.table_name) for s in self.stats if s.status == "failed"][:1]
        if blocking:
            self._block(node)
            if not is_load:
                self._record(node.name, "model", "skipped", 0.0, message=f"blocked by {', '.join(blocking)}")
            return
        clock = time.perf_counter()
        try:
            done = node.make(observed(node.after))
        except Exception as exc:  # recorded; dependants are skipped
            self._block(node)
            if not is_load:
                self._record(node.name, "model", "error", time.perf_counter() - clock, message=str(exc))
            return
        seconds = time.perf_counter() - clock
        if not is_load:
            self._record(node.name, "model", "success", seconds, rows=done.rows - done.metrics.get("rejected", 0))
        if not self.checks(node.after, done.metrics, seconds):
            self._block(node)

    def checks(self, checks: tuple[Check, ...], metrics: Mapping[str, object] = MappingProxyType({}), written_s: float = 0.0) -> bool:
        """Records checks that were answered by the write, and runs the others table by table; the
        seconds of a check are those of the pass that answers it. A check that raises is an error, and
        counts as failed."""
        good, known = True, answered(checks, metrics)
        for name, failures in known.items():
            status, message = verdict(failures)
            self._record(name, "test", status, written_s, failures, message)
            good &= status == "pass"
        left = [c for c in checks if c.name not in known]
        for (_, table), group in groupby(left, lambda c: (c.layer, c.table)):
            group, clock = list(group), time.perf_counter()
            try:
                rows = run_checks(lambda x, t: self._frame(x, t), group).collect()  # one per check
                found = [(r["test_name"], r["status"], r["failures"], r["message"]) for r in rows]
            except Exception as exc:
                found = [(c.name, "error", None, f"{type(exc).__name__}: {exc}") for c in group]
            seconds = time.perf_counter() - clock
            for name, status, failures, message in found:
                self._record(name, "test", status, seconds, failures, message)
                good &= status == "pass"
        return good

    def _frame(self, layer: str, table: str) -> DataFrame:
        return ops_tables(self.wh)[table] if layer == "ops" else layer_frame(self.wh, layer, table)

    def _block(self, node: Node) -> None:
        with self._lock:
            self.out.blocked.add(node.name)

    def _record(self, name, kind, status, seconds, failures=None, message=None, rows=None) -> None:
        self.log.result(name, status, failures, message)
        self.log.node(name, kind, status, seconds, rows)
        with self._lock:
            self.out.passed += status in ("pass", "success")
            self.out.failed += status in ("fail", "error", "runtime error")


def refresh_graph(wh: Warehouse, upsert: bool = True, tables: Tables | None = None) -> dict:
    """Build the graph from stored Silver (or other ``tables`` by Silver name), check its keys and log the build. A graph that fails a
    check is stored, and the run is logged as failed and raises."""
    log = RunLog(wh, "graph")
    log.start()
    try:
        counts = build_graph(wh, load_ontology(), tables or (lambda t: silver_frame(wh, t)), upsert=upsert)
        bad = [r for r in run_checks(lambda layer, t: wh.read(layer, t), graph_suite()).collect() if r["status"] != "pass"]
        if bad:
            raise ValueError("; ".join(f"{r['test_name']}: {r['message']}" for r in bad))
    except Exception as exc:
        log.end("failed", 0, 0, f"{type(exc).__name__}: {exc}")
        raise
    nodes, edges = (sum(n for (k, _), n in counts.items() if k == kind) for kind in ("node", "edge"))
    log.end("success", nodes, edges)
    return counts
