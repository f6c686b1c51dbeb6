"""The daily run end to end over raw files made from the smallest data set, and its reports."""

import pytest

from marketloom.operators import quality as Q
from marketloom.plans import ops as O
from marketloom.plans.daily import refresh_graph, run_daily, silver_frame
from marketloom.sources.bronze import file_path, write_raw
from marketloom.specs import TABLES, silver_tables
from marketloom.testbed import Bed
from marketloom.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    bed = Bed.of(spark, SF)
    for t in silver_tables():
        write_raw(bed.raw(t), folder, t)
    version = spark.createDataFrame([("2", "2020-01-01", "10:00", "x")], "dv_version string, dv_create_date string, "
                                    "dv_create_time string, dv_cmdline_args string")
    write_raw(version, folder, "dbgen_version")
    return folder


@pytest.fixture(scope="module")
def run(spark, raw, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    return wh, run_daily(wh, raw)


def test_success(run):
    wh, out = run
    assert (out.status, out.exit_code, out.failed) == ("success", 0, 0)  # rejected rows do not fail a run
    assert out.passed == 30 + 76 + 24 + 6  # tables, checks, key ranges, checks of the log
    row = O.runs(wh).first()
    assert (row.status, row.tables_loaded, row.run_id) == ("success", 25, out.run_id) and row.ended_at >= row.started_at
    assert len(Q.default_suite()) == 76


def test_layers_agree(run):
    wh, _ = run
    for t in ("item", "store_sales"):
        raw_rows = wh.read("bronze", t).count()
        over = O.silver_overview(wh).filter(f"table_name = '{TABLES[t].silver_name}'").first()
        assert over.rows + over.anomaly_rows == raw_rows and over.anomaly_rows > 0 and over.bytes > 0
    sales = silver_frame(wh, "int_sales_unified")
    assert sales.count() == sum(silver_frame(wh, f"fact_{c}_sales").count() for c in ("store", "catalog", "web"))
    perf, comp = wh.read("gold", "mart_sales_performance"), wh.read("gold", "mart_channel_comparison")
    assert perf.selectExpr("sum(net_sales)").first()[0] == comp.selectExpr("sum(total_net_sales)").first()[0]
    assert wh.read("gold", "mart_customer_360").count() == silver_frame(wh, "dim_customer").count()
    assert wh.read("gold", "mart_product_analytics").count() == silver_frame(wh, "dim_item").count()


def test_reports(run):
    wh, out = run
    runs, results = O.runs(wh), wh.read("ops", "test_results")
    assert O.latest_run(runs).first().run_id == out.run_id
    assert O.table_stats(wh.read("ops", "ingest_table_stats"), runs).count() == 25
    assert tuple(O.tally(results).first()) == (106, 0, 30)
    assert tuple(O.tally(results, "run").first()) == (136, 0, 0)
    timings = O.node_timings(wh)
    made = {r.node_id: r.rows_affected for r in timings.filter("node_type = 'model'").collect()}
    assert made["dim_item"] == wh.read("silver", "dim_item").count() and made["mart_customer_360"] > 0
    assert timings.filter("execution_time_s > 0").count() == timings.count()
    assert O.slowest_nodes(O.node_timings(wh), runs).count() == 10
    hist = O.run_history(runs, O.node_timings(wh), wh.read("ops", "ingest_table_stats")).first()
    assert hist.wall_s > 0 and hist.node_s > 0 and hist.load_s > 0
    assert O.gold_overview(wh).count() == 4
    assert Q.run_checks(lambda _, t: O.ops_tables(wh)[t], Q.ops_suite()).filter("status <> 'pass'").count() == 0


def test_graph_refresh(run):
    wh, _ = run
    first = refresh_graph(wh)
    assert refresh_graph(wh) == first
    assert [r.status for r in O.runs(wh, "graph").collect()] == ["success", "success"]
    assert first["node", "Item"] == silver_frame(wh, "dim_item").count()
    assert (wh.read("graph", "ontology_class").count(), wh.read("graph", "ontology_relationship").count()) == (15, 7)


def test_failed_load_ends_the_run(spark, wh, tmp_path):
    (tmp_path / "call_center.dat").write_text("1|2\n")
    out = run_daily(wh, str(tmp_path))
    assert (out.status, out.exit_code) == ("failed", 1) and "load failed at call_center" in out.message
    row = O.runs(wh).first()
    assert (row.status, row.tables_loaded) == ("failed", 0)
    assert O.recent_runs(O.runs(wh)).first().duration_s >= 0


def test_failed_check_skips_dependants(spark, raw, tmp_path, wh):
    # A second copy of one item key: the Bronze test fails, Silver and the item mart are skipped.
    folder = tmp_path / "raw"
    folder.mkdir()
    for t in TABLES:
        source = file_path(raw, t)
        (folder / f"{t}.dat").symlink_to(source)
    (folder / "item.dat").unlink()
    items = spark.read.text(file_path(raw, "item"))
    items.unionByName(items.limit(1)).write.text(str(folder / "item.dat"))
    out = run_daily(wh, str(folder))
    assert (out.status, out.failed) == ("failed", 1)
    assert out.blocked == {"load item", "dim_item", "mart_product_analytics"}
    skipped = wh.read("ops", "test_results").filter("status = 'skipped'").collect()
    assert {(r.test_name, r.message) for r in skipped} == {("dim_item", "blocked by load item"), ("mart_product_analytics", "blocked by dim_item")}
    assert wh.exists("gold", "mart_customer_360") and not wh.exists("gold", "mart_product_analytics")
    failed = wh.read("ops", "test_results").filter("status = 'fail'").first()
    assert (failed.test_name, failed.failures) == ("unique_bronze_item_i_item_sk", 1)


def test_a_check_that_raises_fails_the_run_and_all_is_logged(raw, wh, monkeypatch):
    from marketloom.plans import daily

    def checks(frames, suite):
        if suite[0].table == "store":
            raise RuntimeError("no answer " + "x" * 5000 + " because")
        return Q.run_checks(frames, suite)

    monkeypatch.setattr(daily, "run_checks", checks)
    out = run_daily(wh, raw)
    assert (out.status, out.failed, out.blocked) == ("failed", 1, {"load store", "dim_store"})
    assert O.runs(wh).first().status == "failed" and wh.read("ops", "ingest_table_stats").count() == 25
    errors = wh.read("ops", "test_results").filter("status = 'error'").collect()
    assert {r.test_name for r in errors} == {"unique_bronze_store_s_store_sk"}  # the write has counted the null keys
    assert all(r.message.endswith("because") for r in errors)  # whole, not cut
    assert wh.read("ops", "node_timings").filter("status = 'skipped'").count() == 1


def test_a_run_that_breaks_is_closed(raw, wh, monkeypatch):
    from marketloom.plans import daily

    monkeypatch.setattr(daily, "ops_suite", lambda: 1 / 0)
    out = run_daily(wh, raw)
    assert out.status == "failed" and "ZeroDivisionError" in out.message
    row = O.runs(wh).first()
    assert (row.status, row.tables_loaded) == ("failed", 25) and wh.read("ops", "ingest_table_stats").count() == 25


def test_keys_that_do_not_fit_fail_the_run(spark, raw, tmp_path, wh):
    folder = tmp_path / "raw"
    folder.mkdir()
    for t in TABLES:
        (folder / f"{t}.dat").symlink_to(file_path(raw, t))
    (folder / "reason.dat").unlink()
    (folder / "reason.dat").write_text("1|A|a\n3000000000|B|b\nx|C|c\n")
    out = run_daily(wh, str(folder))
    failed = wh.read("ops", "test_results").filter("status = 'fail'").collect()
    assert out.status == "failed" and [(r.test_name, r.failures) for r in failed] == [
        ("key_range_silver_dim_reason__anomalies", 1)]


def test_nodes_run_as_soon_as_they_can(spark):
    """No barrier: a chain isn't held up by a slow node it doesn't need; needs come first; errors end it."""
    import threading
    import time

    from marketloom.plans.daily import Node, run_nodes

    order, lock, slow = [], threading.Lock(), threading.Event()

    def work(node):
        if node.name == "slow":
            assert slow.wait(30)
        with lock:
            order.append((node.name, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        if node.name == "c":
            slow.set()

    def node(name, *needs, weight=0):
        return Node(name, "silver", lambda _: None, needs, weight=weight)

    run_nodes(spark, [node("slow"), node("c", "b"), node("b", "a"), node("a"), node("last", "slow", "c")], work, 2)
    assert [n for n, _ in order] == ["a", "b", "c", "slow", "last"] and all(n == p for n, p in order)
    begun = []
    run_nodes(spark, [node("light"), node("heavy", weight=9), node("middle", weight=5)], lambda n: begun.append(n.name), 1)
    assert begun == ["heavy", "middle", "light"]
    with pytest.raises(ValueError, match="not there"):
        run_nodes(spark, [node("a", "nope")], work, 2)
    with pytest.raises(ValueError, match="each other"):
        run_nodes(spark, [node("a", "b"), node("b", "a")], work, 2)
    with pytest.raises(ZeroDivisionError):
        run_nodes(spark, [node("a"), node("b", "a")], lambda n: 1 / 0, 2)
    assert time.time() > 0


def test_a_failed_load_may_skip_its_dependants_only(raw, tmp_path, wh):
    folder = tmp_path / "raw"
    folder.mkdir()
    for t in TABLES:
        (folder / f"{t}.dat").symlink_to(file_path(raw, t))
    (folder / "item.dat").unlink()
    out = run_daily(wh, str(folder), on_load_error="skip")
    assert out.status == "failed" and "load failed at item" in out.message
    assert out.blocked == {"load item", "dim_item", "mart_product_analytics"}
    assert wh.exists("gold", "mart_customer_360") and wh.read("ops", "ingest_table_stats").count() == 25


def test_nothing_is_read_again_for_counts(spark, raw, tmp_path):
    """Rows, null keys and rejected rows come from the writes: one Spark job per write, none besides."""
    from marketloom.operators.silver import store_silver
    from marketloom.sources.bronze import load_table

    wh = Warehouse(spark, str(tmp_path / "w"))
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def jobs(work):
        sc.setJobGroup(work.__name__ + str(tmp_path), "counted")
        try:
            out = work()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(work.__name__ + str(tmp_path)))

    def load():
        return load_table(wh, raw, "store_sales")

    stats, n = jobs(load)
    assert n == 1 and stats.rows_loaded == wh.read("bronze", "store_sales").count() and stats.null_keys is None

    def silver():
        checks = Q.range_suite("store_sales")
        return store_silver(wh, wh.read("bronze", "store_sales"), TABLES["store_sales"], metrics=Q.observed(checks))

    done, n = jobs(silver)
    rejected = wh.read("silver", "fact_store_sales__anomalies")
    assert n <= 2 and done.rows == stats.rows_loaded and done.metrics["rejected"] == rejected.count() > 0  # reading the schema may be a job
    assert done.metrics["key_range_silver_fact_store_sales__anomalies"] == 0


def test_observed_checks_agree_with_run_checks(spark, wh):
    rows = [(1, "New"), (None, "New"), (2, "Other"), (3, None), (4, "Odd"), (5, "Odd")]
    df = spark.createDataFrame(rows, "c_customer_sk int, segment string")
    suite = [c for c in Q.gold_suite() if c.table == "mart_customer_360"]
    done = wh.write(df, "gold", "mart_customer_360", metrics=Q.observed(suite))
    known = Q.answered(suite, done.metrics)
    full = {r.test_name: (r.status, r.failures, r.message) for r in Q.run_checks(lambda layer, t: wh.read(layer, t), suite).collect()}
    assert len(known) == 2 and {n: (v[0], f, v[1]) for n, f in known.items() for v in [Q.verdict(f)]}.items() <= full.items()
    assert full["accepted_values_gold_mart_customer_360_segment"][1] == 2  # values, so the three rows counted in the write don't answer it
    good = wh.write(df.filter("segment = 'New'"), "gold", "mart_customer_360", metrics=Q.observed(suite))
    assert Q.answered(suite, good.metrics)["accepted_values_gold_mart_customer_360_segment"] == 0


def test_sales_in_order_of_customers(spark, raw, run, tmp_path):
    """A run that sorts its sales has the same marts."""
    wh, _ = run
    other = Warehouse(spark, str(tmp_path))
    assert run_daily(other, raw, sort_sales=True).exit_code == 0
    for layer, table in (("silver", "int_sales_unified"), ("gold", "mart_customer_360"), ("gold", "mart_product_analytics")):
        ours, theirs = other.read(layer, table), wh.read(layer, table)
        ours = ours.select(theirs.columns)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty(), table
