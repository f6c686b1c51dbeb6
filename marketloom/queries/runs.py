"""Data tests and run reports. Orders stand in for runs, order lines for the work of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import quality as Q
from marketloom.plans import ops as O
from marketloom.queries import query
from marketloom.queries.marts import stored_mart
from marketloom.queries.oracle import big, oracle
from marketloom.specs import TABLES, silver_tables

_KEYED = [t for t, s in TABLES.items() if s.pk]


def _key_sql(layer: str, table: str, source: str) -> str:
    key, name = TABLES[table].pk, table if layer == "bronze" else TABLES[table].silver_name
    return (f"SELECT 'not_null_{layer}_{name}_{key}' AS test_name, count(*) AS failures FROM {source} WHERE {key} IS NULL "
            f"UNION ALL SELECT 'unique_{layer}_{name}_{key}', count(*) FROM (SELECT {key} FROM {source} "
            f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)")


def _checked(rows: str, *parts: str) -> str:
    return oracle(f"SELECT test_name, {big('failures', 'failures')}, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status "
                  f"FROM ({rows})", *parts)


@query(_checked(" UNION ALL ".join(_key_sql("bronze", t, f"raw_{t}") for t in _KEYED), *[f"raw_{t}" for t in _KEYED]))
def bronze_checks(bed):
    suite = [c for t in _KEYED for c in Q.table_suite("bronze", t)]
    return Q.run_checks(lambda _, t: bed.raw(t), suite).drop("message")


@query(_checked(" UNION ALL ".join(_key_sql("silver", t, TABLES[t].silver_name) for t in _KEYED),
                *[TABLES[t].silver_name for t in _KEYED]))
def silver_checks(bed):
    raw = {s.silver_name: t for t, s in TABLES.items()}
    suite = [c for t in _KEYED for c in Q.table_suite("silver", t)]
    return Q.run_checks(lambda _, t: bed.silver(raw[t]), suite).drop("message")


def _verdicts(counts: dict[str, str]) -> str:
    """Checks with their failures by SQL."""
    rows = " UNION ALL ".join(f"SELECT '{n}' AS test_name, CAST(({c}) AS BIGINT) AS failures" for n, c in counts.items())
    return f"SELECT test_name, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status, failures FROM ({rows})"


_FACTS = [t for t, s in TABLES.items() if s.kind == "fact"]
_REFERENCES = {c.name: f"SELECT count(*) FROM {c.table} WHERE {c.columns[0]} NOT IN (SELECT {c.parent[2]} FROM {c.parent[1]})"
               for t in _FACTS for c in Q.reference_suite(t)}
_READ = sorted({x for t in _FACTS for c in Q.reference_suite(t) for x in (c.table, c.parent[1])})


@query(oracle(_verdicts(_REFERENCES), *_READ, once=tuple(_READ)))
def fact_references(bed):
    """All keys of all fact tables, looked up in their dimensions."""
    raw = {s.silver_name: t for t, s in TABLES.items()}
    suite = [c for t in _FACTS for c in Q.reference_suite(t)]
    return Q.run_checks(lambda _, t: bed.silver(raw[t]), suite).drop("message")


_PRODUCTS = "SELECT count(*) FROM product_analytics WHERE i_category = "
_CUSTOMERS = "SELECT count(*) FROM customer_360 WHERE segment = "
_SPOILED = dict(zip([c.name for c in Q.gold_suite()], (
    "SELECT count(*) FROM sales_performance WHERE channel = 'store'",
    "SELECT count(DISTINCT channel) FROM sales_performance WHERE channel = 'web'",
    _PRODUCTS + "'Music'", _PRODUCTS + "'Books'", _CUSTOMERS + "'Active'", _CUSTOMERS + "'New'",
    _CUSTOMERS + "'Hibernating'", "SELECT count(DISTINCT segment) FROM customer_360 WHERE segment = 'Loyal'",
), strict=True))


@query(oracle(_verdicts(_SPOILED), "sales_performance", "product_analytics", "customer_360"))
def gold_checks(bed):
    """All checks of the marts, on marts with some rows repeated and spoiled."""
    perf, product, customer = (stored_mart(bed, f"mart_{m}") for m in ("sales_performance", "product_analytics", "customer_360"))
    null = F.lit(None)
    key, segment = F.col("c_customer_sk"), F.col("segment")
    frames = {
        "mart_sales_performance": perf.union(perf.filter("channel = 'web'").withColumn("channel", F.lit("phone"))).union(
            perf.filter("channel = 'store'").withColumn("channel", null.cast("string"))),
        "mart_product_analytics": product.union(product.filter("i_category = 'Books'")).union(
            product.filter("i_category = 'Music'").withColumn("i_item_sk", null.cast("int"))),
        "mart_customer_360": customer.union(customer.filter(segment == "New")).union(
            customer.filter(segment == "Active").withColumn("c_customer_sk", null.cast("int"))).union(
            customer.filter(segment == "Hibernating").withColumns({"c_customer_sk": -key - 1, "segment": null.cast("string")})).union(
            customer.filter(segment == "Loyal").withColumns({"c_customer_sk": -key - 1, "segment": F.lit("Other")})),
    }
    return Q.run_checks(lambda _, t: frames[t], Q.gold_suite()).drop("message")


@query(oracle("""
    SELECT 'unique' AS test, CAST(count(*) AS BIGINT) AS failures FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'accepted_values', count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A')
    UNION ALL SELECT 'foreign_key', count(*) FROM sales WHERE item_sk NOT IN (SELECT i_item_sk FROM dim_item)
    UNION ALL SELECT 'not_null', count(*) FROM sales WHERE customer_sk IS NULL""", "sales", "dim_item"))
def failing_checks(bed):
    """Tests that fail on this data, with their failure counts."""
    li, sales = bed.source("lineitem"), bed.sales()
    found = {
        "unique": Q.unique(li, ["l_orderkey", "l_linenumber"]),
        "accepted_values": Q.accepted_values(li, "l_returnflag", ["A"]),
        "foreign_key": Q.foreign_key(sales, "item_sk", bed.silver("item"), "i_item_sk"),
        "not_null": Q.not_null(sales, "customer_sk").drop("column"),
    }
    rows = [df.select(F.lit(n).alias("test"), F.col("failures").cast("bigint").alias("failures")) for n, df in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


# -- run reports over orders and lines ---------------------------------------------------------------------
_STATUS = "CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'running' END"
_NODE = "concat('n', cast(l_partkey as string), '_', cast(l_suppkey as string), '_', cast(l_linenumber as string), '_', cast(l_extendedprice as decimal(12,2)))"
_RESULT = ("CASE WHEN l_returnflag = 'N' THEN 'pass' WHEN l_returnflag = 'R' THEN 'fail' "
           "WHEN l_linestatus = 'O' THEN 'success' WHEN l_linenumber < 4 THEN 'error' "
           "WHEN l_linenumber = 4 THEN 'runtime error' ELSE 'skipped' END")


def runs_of(bed):
    o = bed.source("orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    return o.select(
        F.col("o_orderkey").alias("run_id"), start.alias("started_at"),
        F.when(F.col("o_orderstatus") != "P", start + F.expr("INTERVAL 90 MINUTES")).alias("ended_at"),
        F.expr(_STATUS).alias("status"))


def work_of(bed):
    return bed.source("lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.expr(_NODE).alias("node_id"), F.expr(_RESULT).alias("status"),
        F.col("l_quantity").alias("execution_time_s"))


def stats_of(bed):
    return bed.source("lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.expr(_NODE).alias("table_name"),
        F.col("l_quantity").cast("bigint").alias("rows_loaded"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("bigint").alias("bytes_loaded"),
        F.col("l_linenumber").cast("double").alias("duration_s"))


_NOW = "TIMESTAMP '2002-01-01'"
_RUNS = f"""SELECT o_orderkey AS run_id, {_STATUS} AS status,
    CAST(epoch_ms(COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 90 MINUTE END, {_NOW}))
         - epoch_ms(o_orderdate) AS DOUBLE) / 1000 AS duration_s FROM orders ORDER BY run_id DESC LIMIT """
_DUCK_NODE = _NODE.replace("string", "varchar")
_LAST = "l_orderkey = (SELECT max(o_orderkey) FROM orders)"


def _now():
    return F.lit("2002-01-01").cast("timestamp_ntz")


@query(_RUNS + "1")
def latest_run(bed):
    return O.latest_run(runs_of(bed), _now()).select("run_id", "status", "duration_s")


@query(_RUNS + "10")
def recent_runs(bed):
    return O.recent_runs(runs_of(bed), 10, _now()).select("run_id", "status", "duration_s")


@query(f"SELECT l_orderkey AS run_id, {_DUCK_NODE} AS node_id, {_RESULT} AS status, l_quantity AS execution_time_s "
       f"FROM lineitem WHERE {_LAST} ORDER BY execution_time_s DESC, node_id LIMIT 10")
def slowest_nodes(bed):
    return O.slowest_nodes(work_of(bed), runs_of(bed))


@query(f"SELECT l_orderkey AS run_id, {_DUCK_NODE} AS table_name, CAST(l_quantity AS BIGINT) AS rows_loaded, "
       f"CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS bytes_loaded, "
       f"CAST(l_linenumber AS DOUBLE) AS duration_s FROM lineitem WHERE {_LAST}")
def table_stats(bed):
    return O.table_stats(stats_of(bed), runs_of(bed))


@query(f"SELECT l_orderkey AS run_id, {_DUCK_NODE} AS test_name, {_RESULT} AS status FROM lineitem WHERE {_LAST}")
def latest_checks(bed):
    results = work_of(bed).drop("execution_time_s").withColumnRenamed("node_id", "test_name")
    return O.latest_checks(results, runs_of(bed))


def _tally_sql(passed: str, failed: str) -> str:
    return (f"SELECT run_id, count(*) FILTER (WHERE status IN ({passed})) AS passed, "
            f"count(*) FILTER (WHERE status IN ({failed})) AS failed, "
            f"count(*) FILTER (WHERE status NOT IN ({passed}, {failed})) AS other "
            f"FROM (SELECT l_orderkey AS run_id, {_RESULT} AS status FROM lineitem) GROUP BY run_id")


@query(_tally_sql("'pass'", "'fail', 'error'"))
def tally_dashboard(bed):
    return O.tally(work_of(bed), "dashboard", ("run_id",))


@query(_tally_sql("'pass', 'success'", "'fail', 'error', 'runtime error'"))
def tally_run(bed):
    return O.tally(work_of(bed), "run", ("run_id",))


@query(f"""SELECT o_orderkey AS run_id, 5400.0::DOUBLE AS wall_s,
       coalesce((SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey), 0)::DOUBLE AS node_s,
       coalesce((SELECT sum(l_linenumber) FROM lineitem WHERE l_orderkey = o_orderkey), 0)::DOUBLE AS load_s
       FROM orders WHERE o_orderstatus = 'O' ORDER BY run_id DESC LIMIT 8""")
def run_history(bed):
    return O.run_history(runs_of(bed), work_of(bed), stats_of(bed))


@query("""SELECT l_orderkey AS run_id, l_linenumber AS node, max(CAST(l_quantity AS BIGINT)) AS rows FROM lineitem
          GROUP BY ALL""")
def node_last_write(bed):
    """Last write per (run, node); the write order is the row count, so the result is its maximum."""
    from marketloom.sources.sinks import last_per_key

    writes = bed.source("lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("node"),
        F.col("l_quantity").cast("bigint").alias("rows"), F.col("l_quantity").alias("seq"))
    return last_per_key(writes, ["run_id", "node"], "seq").drop("seq")


@query("""SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus = 'P' THEN 'running' ELSE 'done' END AS status,
                 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(14,2)) END AS total FROM orders""")
def run_state(bed):
    """State of each run from its start and end events."""
    from marketloom.sources.sinks import latest_events

    o = bed.source("orders")
    total = F.col("o_totalprice").cast("decimal(14,2)")
    begun = o.select(F.col("o_orderkey").alias("run_id"), F.lit(1).alias("seq"), F.lit("running").alias("status"),
                     F.lit(None).cast("decimal(14,2)").alias("total"))
    ended = o.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("run_id"), F.lit(2).alias("seq"), F.lit("done").alias("status"), total.alias("total"))
    return latest_events(begun.unionByName(ended), "run_id", "seq")


_SIDES = silver_tables()
_PARTS = [x for t in _SIDES for x in (f"raw_{t}", TABLES[t].silver_name)]


def _overview_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{TABLES[t].silver_name}' AS table_name, (SELECT count(*) FROM {TABLES[t].silver_name}) AS rows, "
        f"(SELECT count(*) FROM raw_{t}) - (SELECT count(*) FROM {TABLES[t].silver_name}) AS anomaly_rows, "
        "true AS has_bytes" for t in _SIDES)


def _overview(bed):
    bed.silver_layer()
    return O.silver_overview(bed.wh).filter(F.col("table_name").isin([TABLES[t].silver_name for t in _SIDES]))


@query(oracle(_overview_sql(), *_PARTS))
def silver_overview(bed):
    """Stored Silver tables next to their rejected rows."""
    return _overview(bed).withColumn("has_bytes", F.col("bytes") > 0).drop("bytes")


@query(oracle(f"SELECT {big('count(*)', 'tables')}, {big('sum(rows)', 'rows')}, true AS has_bytes FROM ({_overview_sql()})", *_PARTS))
def layer_totals(bed):
    return O.layer_totals(_overview(bed)).withColumn("has_bytes", F.col("bytes") > 0).drop("bytes")


# -- a daily run and a graph build, by their logs -----------------------------------------------------------
_UNIQUE = "unique_bronze_item_i_item_sk"
_MADE = {
    **{TABLES[t].silver_name: TABLES[t].silver_name for t in silver_tables() if t != "item"},
    "int_sales_unified": "sales", "int_returns_unified": "returns", "mart_sales_performance": "sales_performance",
    "mart_channel_comparison": "channel_comparison", "mart_customer_360": "customer_360",
}


def _nodes_sql() -> str:
    rows = [f"SELECT '{n}' AS node_id, 'success' AS status, {big('count(*)', 'rows')}, CAST(NULL AS VARCHAR) AS message FROM {p}" for n, p in _MADE.items()]
    rows.append("SELECT 'dim_item', 'skipped', CAST(NULL AS BIGINT), 'blocked by load item'")
    rows.append("SELECT 'mart_product_analytics', 'skipped', CAST(NULL AS BIGINT), 'blocked by dim_item'")
    rows.append(f"SELECT '{_UNIQUE}', 'fail', CAST(NULL AS BIGINT), 'failures: ' || count(*) FROM (SELECT i_item_sk FROM raw_item "
                "WHERE i_item_sk IS NOT NULL GROUP BY i_item_sk)")
    return " UNION ALL ".join(rows)


@query(oracle(_nodes_sql(), *_MADE.values(), "raw_item"))
def daily_nodes(bed):
    """Node log of a daily run over raw files in which every item stands twice: tables with their rows,
    the check that fails, and what is skipped because of it."""
    from marketloom.plans.daily import run_daily
    from marketloom.queries.sources import raw_files, raw_table
    from marketloom.session import new_folder
    from marketloom.sources.bronze import write_raw
    from marketloom.warehouse import Warehouse

    folder = raw_files(bed, [t for t in TABLES if t != "item"])
    items = raw_table(bed, "item")
    write_raw(items.unionByName(items), folder, "item")
    wh = Warehouse(bed.spark, new_folder(bed.spark, "daily"))
    run_daily(wh, folder)
    timings = O.node_timings(wh).filter("node_type = 'model' OR status <> 'pass'")
    return timings.join(wh.read("ops", "test_results"), F.col("node_id") == F.col("test_name")).select(
        "node_id", timings["status"], F.col("rows_affected").alias("rows"), "message")


@query(oracle(f"SELECT 'success' AS status, (SELECT {big('count(*)', 'n')} FROM node) AS nodes_loaded, "
              f"(SELECT {big('count(*)', 'n')} FROM edge) AS edges_loaded, 2 AS seq", "node", "edge"))
def graph_build_log(bed):
    """Log of a graph build from stored Silver: one run, ended by its second event."""
    from marketloom.plans.daily import refresh_graph
    from marketloom.queries.graph import tables_of
    from marketloom.session import new_folder
    from marketloom.warehouse import Warehouse

    bed.silver_layer()
    wh = Warehouse(bed.spark, new_folder(bed.spark, "graph"))
    refresh_graph(wh, tables=tables_of(bed))
    events = wh.read("ops", "graph_runs")
    last = events.groupBy("run_id").agg(F.max("seq").cast("int").alias("seq"))
    runs = O.recent_runs(O.runs(wh, "graph"), 1)
    return runs.join(last, "run_id").select("status", "nodes_loaded", "edges_loaded", "seq")
