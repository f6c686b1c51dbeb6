from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketloom.operators import aggregates as A
from marketloom.plans import marts as M

SALES = ("channel string, sold_date_sk int, item_sk int, customer_sk int, order_number int, quantity int, "
         "ext_sales_price decimal(7,2), ext_discount_amt decimal(7,2), ext_tax decimal(7,2), net_paid decimal(7,2), "
         "net_profit decimal(7,2)")
RETURNS = ("channel string, returned_date_sk int, item_sk int, customer_sk int, reason_sk int, order_number int, "
           "return_quantity int, return_amt decimal(7,2), net_loss decimal(7,2)")


def sale(channel="store", day=10, item=1, customer=1, order=1, q=2, price="10.00"):
    p = D(price)
    return (channel, day, item, customer, order, q, p, D(0), D(0), p, D(1))


def ret(channel="store", day=10, item=1, customer=1, order=1, q=1, amt="5.00"):
    return (channel, day, item, customer, 1, order, q, D(amt), D("0.50"))


@pytest.fixture()
def make(spark):
    def both(sales, returns=()):
        return spark.createDataFrame(list(sales), SALES), spark.createDataFrame(list(returns), RETURNS)
    return both


@pytest.fixture()
def dates(spark):
    return spark.createDataFrame(
        [(n, date(2001, 1 if n < 20 else 2, n % 20 + 1), 2001, 1 if n < 20 else 2, n % 7) for n in range(40)],
        "d_date_sk int, d_date date, d_year int, d_moy int, d_dow int")


def test_sales_performance(make, dates):
    sales, returns = make(
        [sale(order=1), sale(order=1), sale(order=2), sale(order=None), sale(day=None), sale("web", day=11, price="0.00"),
         sale(day=99)],
        [ret(), ret(day=12), ret("web", day=11), ret(day=None)])
    rows = {(r.sale_date, r.channel): r for r in M.mart_sales_performance(sales, returns, dates).collect()}
    assert set(rows) == {(date(2001, 1, 11), "store"), (date(2001, 1, 12), "web")}  # day 99 has no date row
    store, web = rows[(date(2001, 1, 11), "store")], rows[(date(2001, 1, 12), "web")]
    assert (store.line_item_count, store.order_count, store.gross_sales) == (4, 2, D("40.00"))
    assert (store.return_amt, store.return_rate) == (D("5.00"), D("0.1250"))
    assert (web.return_amt, web.return_rate) == (D("5.00"), None)  # gross sales not positive


def test_channel_comparison(make, dates):
    sales, _ = make([sale(order=1), sale(order=1, day=11), sale("catalog", order=1), sale(day=25)])
    rows = {r.d_moy: r for r in M.mart_channel_comparison(sales, dates).collect()}
    assert (rows[1].store_orders, rows[1].catalog_orders, rows[1].web_orders, rows[1].total_orders) == (1, 1, None, 2)
    assert rows[1].web_net_sales is None and rows[1].total_net_sales == D("30.00")
    assert (rows[2].store_orders, rows[2].catalog_orders) == (1, None)


def test_monthly_rollup(make, dates):
    sales, returns = make([sale(order=1), sale(order=1, day=11)])
    row = A.monthly_rollup(M.mart_sales_performance(sales, returns, dates)).first()
    assert (row.order_count, row.net_sales) == (2, D("20.00"))  # daily counts add up


def customers(spark, n):
    c = spark.createDataFrame(
        [(i, f"C{i}", "f", "l", "e", 1970, "Y", i, 1) for i in range(n)],
        "c_customer_sk int, c_customer_id string, c_first_name string, c_last_name string, c_email_address string, "
        "c_birth_year int, c_preferred_cust_flag string, c_current_cdemo_sk int, c_current_hdemo_sk int")
    cd = spark.createDataFrame([(1, "F", "M", "College")],
                               "cd_demo_sk int, cd_gender string, cd_marital_status string, cd_education_status string")
    hd = spark.createDataFrame([(1, 4)], "hd_demo_sk int, hd_income_band_sk int")
    ib = spark.createDataFrame([(4, 10, 20)], "ib_income_band_sk int, ib_lower_bound int, ib_upper_bound int")
    return c, cd, hd, ib


def test_customer_360(spark, make):
    sales, returns = make(
        [sale(customer=1, order=1), sale("web", customer=1, order=1, day=12), sale(customer=None, day=30),
         sale(customer=3, day=None)],
        [ret(customer=1), ret(customer=2), ret(customer=3)])
    rows = {r.c_customer_sk: r for r in M.mart_customer_360(*customers(spark, 4), sales, returns).collect()}
    assert len(rows) == 4
    one = rows[1]
    assert (one.order_count, one.recency_days, one.ltv_net_paid) == (2, 19, D("20.00"))  # day 31 against 12
    assert (one.returned_amt, one.return_rate, one.cd_gender, one.income_upper) == (D("5.00"), D("0.2500"), "F", 20)
    assert (one.r_quintile, one.rfm_score, one.segment) == (1, 111, "Hibernating")
    for sk in (0, 2, 3):  # never bought, returns only, undated sale only
        r = rows[sk]
        assert (r.segment, r.gross_sales, r.returned_amt, r.quantity_purchased) == ("No purchase", 0, 0, 0)
        assert (r.order_count, r.recency_days, r.rfm_score, r.return_rate) == (None, None, None, None)


def test_quintiles_with_null_money(spark, make):
    sales, returns = make([sale(customer=c, price=str(c + 1)) for c in range(1, 6)])
    sales = sales.withColumn("net_paid", F.when(F.col("customer_sk") != 1, F.col("net_paid")))
    rows = {r.customer_sk: r.m_quintile for r in M.score_customers(sales, returns).collect()}
    assert rows == {2: 1, 3: 2, 4: 3, 5: 4, 1: 5}  # NULL sorts last when ascending


def test_product_analytics(spark, make):
    items = spark.createDataFrame(
        [(i, f"I{i}", "p", "b", "c", "g", "m", D("1.00")) for i in (1, 2, 3)],
        "i_item_sk int, i_item_id string, i_product_name string, i_brand string, i_class string, i_category string, "
        "i_manufact string, i_current_price decimal(7,2)")
    sales, returns = make([sale(item=1, q=3), sale("web", item=2, price="90.00"), sale(item=None)], [ret(item=1), ret(item=3)])
    rows = {r.i_item_sk: r for r in M.mart_product_analytics(items, sales, returns).collect()}
    assert [(rows[i].sales_rank, rows[i].sales_percentile) for i in (1, 2, 3)] == [(2, 2), (1, 1), (None, None)]
    assert (rows[1].return_rate, rows[1].store_quantity, rows[1].web_quantity) == (D("0.3333"), 3, 0)
    assert (rows[3].returned_amt, rows[3].return_rate, rows[3].total_quantity) == (D("5.00"), None, 0)


def test_orders_of_a_period_add_up(spark):
    """Lists and bitmaps, order numbers over several buckets, negative ones and none."""
    from pyspark.sql import functions as F

    from marketloom.operators import aggregates as A

    sales = spark.range(20_000).select(
        F.when(F.col("id") % 11 > 0, (F.col("id") % 7).cast("int")).alias("sold_date_sk"), F.element_at(F.array(F.lit("web"), F.lit("store")), (F.col("id") % 2 + 1).cast("int")).alias("channel"),
        F.when(F.col("id") % 13 > 0, F.when(F.col("id") % 3 == 0, F.col("id") % 5000).otherwise(F.col("id") * 97 - 40_000)).cast("int").alias("order_number"))
    state = A.daily_orders(sales)
    assert state.filter("bitmap IS NOT NULL").count() > 0 and state.filter("size(positions) > 0").count() > 0
    assert state.agg(F.max(F.size("positions"))).first()[0] <= A.SPARSE
    dated = where = sales.filter("sold_date_sk IS NOT NULL AND order_number IS NOT NULL")
    for by in (["sold_date_sk", "channel"], ["channel"]):
        want = dated.groupBy(*by).agg(F.countDistinct("order_number").alias("order_count"))
        got = A.count_orders(state, *by)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*by, "order_count").collect()))
    assert A.count_orders(state).first()[0] == where.select("channel", "order_number").distinct().count()
