"""What bounds a task and what is written, seen from plans and folders."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom import testbed
from marketloom.operators import aggregates as A
from marketloom.operators.unify import CHANNELS
from marketloom.sources import bronze as B

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def bed(spark, tmp_path):
    made = testbed.Bed(spark, SF)
    made.wh = type(made.wh)(spark, str(tmp_path / "bed"))
    return made


def test_tasks_of_the_join_of_lines_follow_the_rows(bed, monkeypatch):
    monkeypatch.setattr(testbed, "LINES_PER_TASK", 50)
    lines = bed.source("lineitem").count()
    plan = bed._order_lines()._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey#" in plan and f"], {-(-lines // 50)}" in plan


def test_facts_are_not_copied_as_text(bed):
    bed.silver("store_sales")
    assert bed.wh.files.names(f"{bed.wh.root}/bronze") == ["order_lines"]


def test_unified_facts_lie_in_folders_of_channels(bed):
    sales = bed.sales()
    folder = bed.wh.snapshot_path("silver", "int_sales_unified")
    assert [n for n in bed.wh.files.names(folder) if "=" in n] == sorted(f"channel={c}" for c in CHANNELS)
    clean = sum(bed.silver(f"{c}_sales").count() for c in CHANNELS)
    assert sales.count() == clean and {r[0] for r in sales.select("channel").distinct().collect()} == set(CHANNELS)


def test_parts_are_written_without_a_sort_and_all_or_none(spark, wh):
    rows = spark.range(10).withColumn("kind", F.lit("a"))
    done = wh.write_parts({"a": rows, "b": rows.withColumn("kind", F.lit("b")).filter("id < 3")}, "gold", "t", "kind")
    assert done.rows == 13 and wh.read("gold", "t").groupBy("kind").count().orderBy("kind").collect() == [("a", 10), ("b", 3)]
    broken = rows.withColumn("id", F.expr("raise_error('broken')").cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        wh.write_parts({"a": rows, "b": broken}, "gold", "t", "kind")
    assert wh.read("gold", "t").count() == 13
    assert len([n for n in wh.files.names(wh.path("gold", "t")) if n.startswith("v-")]) == 1


SALES = ("channel string, sold_date_sk int, customer_sk int, item_sk int, order_number int, quantity int, ext_sales_price decimal(7,2), "
         "ext_discount_amt decimal(7,2), ext_tax decimal(7,2), net_paid decimal(7,2), net_profit decimal(7,2)")


@pytest.fixture(scope="module")
def sales(spark):
    one = D("1.25")
    rows = [("store" if i % 3 else "web", i % 4 or None, i % 5 or None, i % 7, i % 11 or None, i % 6, one, one, None if i % 13 == 0 else one, one, one)
            for i in range(400)]
    return spark.createDataFrame(rows, SALES).cache()


AGGREGATES = {
    "daily": lambda s: A.daily_sales(s),
    "monthly": lambda s: A.monthly_sales(s, s.sparkSession.range(1, 4).selectExpr(
        "CAST(id AS INT) AS d_date_sk", "2001 AS d_year", "CAST(id DIV 2 AS INT) AS d_moy")),
    "orders": lambda s: A.daily_orders(s),
    "pairs": lambda s: A.pair_aggregate(s, "customer_sk", "item_sk", {
        "orders": "count(distinct channel, order_number)", "quantity": "sum(quantity)", "net_paid": "sum(net_paid)"}),
}


@pytest.mark.parametrize("name", AGGREGATES)
def test_aggregates_are_dealt_by_their_groups_with_the_same_result(sales, monkeypatch, name):
    make = AGGREGATES[name]
    plain = make(sales)
    monkeypatch.setattr(A, "GROUPS_PER_TASK", 3)
    dealt = make(sales)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan(plain) and "RepartitionByExpression" in plan(dealt)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.count() > 0


def test_order_counts_of_lists_bitmaps_and_both(spark):
    def day(n, channel, numbers):
        return [(channel, n, int(o)) for o in numbers for _ in range(2)]
    rows = [*day(1, "web", range(300)), *day(2, "web", range(290, 310)), *day(2, "store", [1, 2, 40000]), *day(3, "store", [2, 3, 7]),
            *day(4, "store", range(0, 70000, 200))]
    state = A.daily_orders(spark.createDataFrame(rows, "channel string, sold_date_sk int, order_number int"))
    assert {r.bitmap is None for r in state.collect()} == {True, False}
    by_day = {(r.sold_date_sk, r.channel): r.order_count for r in A.count_orders(state, "sold_date_sk", "channel").collect()}
    assert by_day == {(1, "web"): 300, (2, "web"): 20, (2, "store"): 3, (3, "store"): 3, (4, "store"): 350}
    some = state.withColumn("half", F.when(F.col("sold_date_sk") < 3, 1))  # the other half is NULL
    exact = {None: len({2, 3, 7} | set(range(0, 70000, 200))), 1: 310 + 3}
    assert {r.half: r.order_count for r in A.count_orders(some, "half").collect()} == exact
    assert A.count_orders(state.unionByName(state), "channel").orderBy("channel").collect()[1].order_count == 310


def test_short_lists_are_not_blown_up_to_bitmaps(spark):
    rows = [("web", d, o * 32768) for d in range(20) for o in range(20)]
    state = A.daily_orders(spark.createDataFrame(rows, "channel string, sold_date_sk int, order_number int"))
    plan = A.count_orders(state, "sold_date_sk", "channel")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(positions" in plan and "LeftAnti" in plan


def test_compressed_raw_files_hold_the_same_lines_in_bounded_files(spark, tmp_path):
    rows = spark.range(25).select(F.col("id").cast("string").alias("r_reason_sk"), F.lit("x").alias("r_reason_id"), F.lit(None).cast("string").alias("r_reason_desc"))
    B.write_raw(rows.coalesce(1), str(tmp_path), "reason", "gzip", 10)
    files = list((tmp_path / "reason.dat").glob("*.gz")) or list(tmp_path.glob("*/*.gz"))
    assert len(files) == 3
    assert sorted(map(tuple, B.read_bronze(spark, str(tmp_path), "reason").collect())) == sorted(map(tuple, rows.collect()))
