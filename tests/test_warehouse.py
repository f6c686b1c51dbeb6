"""Snapshots: readers and writers next to each other, failures, and Silver's two halves."""

import pytest

from marketloom.specs import TABLES
from marketloom.warehouse import Warehouse


def numbers(spark, n):
    return spark.range(n)


def test_the_newest_write_is_read_whatever_the_clock_says(spark, wh, monkeypatch):
    import time

    wh.write(numbers(spark, 1), "gold", "t")
    monkeypatch.setattr(time, "time", lambda: 1.0)
    for n in (2, 3, 4):
        wh.write(numbers(spark, n), "gold", "t")
        assert wh.read("gold", "t").count() == n


def test_two_writers_lose_no_folder(spark, wh):
    """A slow writer next to two fast ones keeps its files and becomes current when it ends."""
    wh.write(numbers(spark, 1), "gold", "t")
    base = wh.path("gold", "t")
    numbers(spark, 9).write.parquet(f"{base}/v-slow")
    for n in (2, 3, 4):
        wh.write(numbers(spark, n), "gold", "t")
    assert spark.read.parquet(f"{base}/v-slow").count() == 9
    wh._switch(base, "v-slow")
    assert wh.read("gold", "t").count() == 9
    wh.write(numbers(spark, 5), "gold", "t")
    assert wh.read("gold", "t").count() == 5 and spark.read.parquet(f"{base}/v-slow").count() == 9


def test_a_reader_of_the_last_snapshot_keeps_its_files(spark, wh):
    wh.write(numbers(spark, 1), "gold", "t")
    before = wh.read("gold", "t")
    wh.write(numbers(spark, 2), "gold", "t")
    assert before.count() == 1
    folders = wh.files.names(wh.path("gold", "t"))
    wh.write(numbers(spark, 3), "gold", "t")
    assert len([f for f in folders if f.startswith("v-")]) == 2


def test_a_failed_write_between_good_ones(spark, wh):
    wh.write(numbers(spark, 1), "gold", "t")
    with pytest.raises(Exception, match="broken"):
        wh.write(spark.range(10).selectExpr("raise_error('broken') AS x"), "gold", "t")
    assert wh.read("gold", "t").count() == 1
    wh.write(numbers(spark, 2), "gold", "t")
    assert wh.read("gold", "t").count() == 2
    base = wh.path("gold", "t")
    assert sum(n.startswith("v-") for n in wh.files.names(base)) == 2
    assert not any(n.startswith(".new") for n in wh.files.names(f"{base}/_commits"))


def test_missing_tables(wh):
    for name in ("t", "dim_item", "dim_item__anomalies"):
        with pytest.raises(FileNotFoundError):
            wh.read("silver", name)
    with pytest.raises(ValueError):
        wh.read("copper", "t")


def test_silver_names(spark, tmp_path):
    from marketloom.operators.silver import store_silver, stored_summary

    wh = Warehouse(spark, str(tmp_path / "w"))
    raw = spark.createDataFrame([("1", "A", "one"), ("x", "B", "two"), ("3", "C", " ")], TABLES["reason"].columns)
    raw = raw.toDF(*TABLES["reason"].columns)
    store_silver(wh, raw, TABLES["reason"])
    assert wh.tables("silver") == ["dim_reason", "dim_reason__anomalies"]
    assert sorted(map(tuple, wh.read("silver", "dim_reason").collect())) == [(1, "A", "one"), (3, "C", None)]
    bad = wh.read("silver", "dim_reason__anomalies").collect()
    assert [(r["r_reason_sk"], r["r_reason_desc"], r["anomaly_reasons"]) for r in bad] == [("x", "two", ["r_reason_sk:not_integer"])]
    assert set(wh.register_views("silver")) == {"silver_dim_reason", "silver_dim_reason__anomalies"}
    assert spark.sql("SELECT count(*) FROM silver_dim_reason").first()[0] == 2
    row = stored_summary(wh, ["reason"]).first()
    assert (row["total_rows"], row["rejected_rows"], row["reason"]) == (3, 1, "r_reason_sk:not_integer")


def test_writers_that_race_are_all_listed(spark, tmp_path):
    """Eight writers commit at the same time: every commit has a number of its own, none is lost."""
    from concurrent.futures import ThreadPoolExecutor

    wh = Warehouse(spark, str(tmp_path / "w"), keep=100)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda n: Warehouse(spark, wh.root, keep=100).write(numbers(spark, n), "gold", "t"), range(1, 9)))
    commit = wh._newest(wh.path("gold", "t"))
    assert commit.number == 8 and len({f for f, _ in commit.folders}) == 8
    with ThreadPoolExecutor(8) as pool:
        drawn = list(pool.map(lambda _: wh.next_number("runs"), range(40)))
    assert sorted(drawn) == list(range(1, 41))


def test_a_writer_between_read_and_commit_of_another_loses_nothing(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "w"))
    wh.write(numbers(spark, 1), "gold", "t")
    other, newest, busy = Warehouse(spark, wh.root), wh._newest, []

    def slow(base):
        found = newest(base)
        if not busy:
            busy.append(1)
            other.write(numbers(spark, 2), "gold", "t")
        return found

    monkeypatch.setattr(wh, "_newest", slow)
    wh.write(numbers(spark, 3), "gold", "t")
    rows = [spark.read.parquet(f"{wh.path('gold', 't')}/{f}").count() for f, _ in other._newest(wh.path("gold", "t")).folders]
    assert rows == [3, 2]


def test_an_append_that_is_repeated_adds_nothing(spark, wh):
    from concurrent.futures import ThreadPoolExecutor

    assert wh.append(numbers(spark, 5), "ops", "log", "a") and not wh.append(numbers(spark, 5), "ops", "log", "a")
    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(lambda _: wh.append(numbers(spark, 7), "ops", "log", "b"), range(4)))
    assert sum(added) == 1 and wh.read("ops", "log").count() == 12
    assert sum(n.startswith("b-") for n in wh.files.names(wh.path("ops", "log"))) == 2


def test_many_batches_are_merged_and_still_known(spark, wh, monkeypatch):
    from marketloom import warehouse

    monkeypatch.setattr(warehouse, "MERGE_BATCHES", 3)
    for i in range(10):
        before = wh.read("ops", "log") if i else None
        assert wh.append(numbers(spark, 1), "ops", "log", f"n{i}")
        assert before is None or before.count() == i  # a reader of the last commit keeps its files
    assert wh.read("ops", "log").count() == 10 and len(wh.folders("ops", "log")) <= 4
    assert not any(wh.append(numbers(spark, 1), "ops", "log", f"n{i}") for i in range(10))


def test_counts_come_from_the_write(spark, wh):
    from pyspark.sql import functions as F

    done = wh.write(spark.range(100).withColumn("k", F.expr("if(id % 10 = 0, null, id)")), "gold", "t", metrics={"nulls": F.count_if(F.col("k").isNull())})
    assert (done.rows, done.metrics) == (100, {"nulls": 10})
    assert wh.write(spark.range(0), "gold", "t", metrics={"n": F.count_if(F.col("id") > 0)}).rows == 0


def _sales(spark):
    """Sales of 400 customers in no order; customer 7 holds a third of the rows, some rows have none."""
    from pyspark.sql import functions as F

    n = F.col("id")
    customer = F.when(n % 3 == 0, 7).when(n % 31 == 1, None).otherwise(F.pmod(F.xxhash64(n), F.lit(400)))
    return spark.range(0, 20000, 1, 8).select(
        customer.cast("int").alias("customer_sk"), (n % 50).cast("int").alias("item_sk"), n.alias("order_number"),
        F.when(n % 2 == 0, "web").otherwise("store").alias("channel"))


def _files(wh, name):
    """(rows, values of row groups' smallest and largest customer) per file of a table."""
    import glob

    import pyarrow.parquet as pq

    for path in glob.glob(f"{wh.snapshot_path('silver', name).removeprefix('file:')}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("customer_sk")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            yield path, meta.row_group(g).num_rows, s.min, s.max


@pytest.fixture()
def uncoalesced(spark):
    """Small ranges stay in tasks of their own, as large ones do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_sorted_tables(spark, wh, uncoalesced):
    from pyspark.sql import functions as F

    order = ["customer_sk", "item_sk", "order_number"]
    sales = _sales(spark)
    plain = wh.write(sales, "silver", "plain", ["channel"])
    ordered = wh.write(sales, "silver", "ordered", ["channel"], {"none": F.count_if(F.col("customer_sk").isNull())}, order)
    assert ordered.rows == plain.rows == 20000
    assert ordered.metrics["none"] == sales.filter("customer_sk IS NULL").count() > 0
    read = {n: wh.read("silver", n).select(sales.columns) for n in ("plain", "ordered")}
    assert read["ordered"].exceptAll(sales).isEmpty() and sales.exceptAll(read["ordered"]).isEmpty()

    # Rows of a file are in order.
    by_file = read["ordered"].select(*order, "channel", F.input_file_name().alias("f")).toPandas()
    for _, rows in by_file.groupby("f"):
        keys = list(rows[order].fillna(-1).itertuples(index=False, name=None))
        assert keys == sorted(keys)
    # Customers of a range are in few row groups, and the hot one is dealt to several files of its own.
    touched = {n: sum(1 for _, _, low, high in _files(wh, n) if low is not None and low <= 300 <= high) for n in read}
    assert touched["ordered"] <= 4 < 16 == touched["plain"]
    hot = read["ordered"].filter("customer_sk = 7").select(F.input_file_name()).distinct().count()
    assert hot >= 4 and max(n for _, n, _, _ in _files(wh, "ordered")) < 20000 / 3
    # An aggregate by customer shuffles about a row per customer.
    partial = {n: df.groupBy("customer_sk").count()._jdf for n, df in read.items()}
    sent = {n: _shuffled(j) for n, j in partial.items()}
    assert sent["ordered"] < sent["plain"] / 2


def _shuffled(frame) -> int:
    """Rows that the only exchange of a query writes."""
    frame.collect()
    plan = frame.queryExecution().executedPlan()
    stage = plan.finalPhysicalPlan().collectLeaves().apply(0)
    return stage.plan().metrics().apply("shuffleRecordsWritten").value()


def test_sorted_empty_tables(spark, wh):
    assert wh.write(_sales(spark).filter("false"), "silver", "none", ["channel"], sort_by=["customer_sk"]).rows == 0
