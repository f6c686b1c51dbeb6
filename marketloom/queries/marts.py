"""Marts and the aggregates, joins and rankings they consist of."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions import exprs as X
from marketloom.operators import aggregates as A
from marketloom.operators import joins as J
from marketloom.operators import rank as R
from marketloom.operators.unify import SALES_ORDER
from marketloom.plans import marts as M
from marketloom.plans.ops import gold_kpis as kpis
from marketloom.queries import query
from marketloom.queries.oracle import amount, big, oracle, part, ratio

_MONEY = {"gross_sales", "discount_amt", "tax_amt", "net_sales", "net_profit", "return_amt", "return_net_loss",
          "ltv_net_paid", "profit_total", "returned_amt"}


def _plain(df):
    """Sums at the width of the mart boundary."""
    return df.select([
        F.col(c).cast("decimal(18,2)").alias(c) if c in _MONEY or c.endswith(("_sales", "_profit")) else F.col(c)
        for c in df.columns])


def stored_mart(bed, name: str):
    """A mart written once to the Gold layer, for queries that read marts."""
    return bed.stored("gold", name, lambda: MARTS[name](bed))


@query(part("sales_performance"))
def mart_sales_performance(bed):
    return M.mart_sales_performance(bed.sales(), bed.returns(), bed.silver("date_dim"))


@query(part("channel_comparison"))
def mart_channel_comparison(bed):
    return M.mart_channel_comparison(bed.sales(), bed.silver("date_dim"))


@query(part("customer_360"))
def mart_customer_360(bed):
    return M.mart_customer_360(
        bed.silver("customer"), bed.silver("customer_demographics"), bed.silver("household_demographics"),
        bed.silver("income_band"), bed.sales(), bed.returns())


@query(part("product_analytics"))
def mart_product_analytics(bed):
    return M.mart_product_analytics(bed.silver("item"), bed.sales(), bed.returns())


MARTS = {f.__name__: f for f in (
    mart_sales_performance, mart_channel_comparison, mart_customer_360, mart_product_analytics)}


@query(part("daily_sales"))
def daily_sales(bed):
    return _plain(A.daily_sales(bed.sales()))


@query(part("daily_returns"))
def daily_returns(bed):
    return _plain(A.daily_returns(bed.returns()))


@query(part("monthly_sales"))
def monthly_sales(bed):
    return _plain(A.monthly_sales(bed.sales(), bed.silver("date_dim")))


@query(part("customer_sales"))
def customer_sales(bed):
    return _plain(A.customer_sales(bed.sales()))


@query(part("customer_sales"), name="customer_sales_sorted")
def _customer_sales_sorted(bed):
    """The same from sales that are stored in the order of customers."""
    stored = bed.stored("silver", "sales_by_customer", bed.sales, sort_by=SALES_ORDER)
    return _plain(A.customer_sales(stored))


@query(part("customer_returns"))
def customer_returns(bed):
    return _plain(A.customer_returns(bed.returns()))


@query(part("item_sales"))
def item_sales(bed):
    return _plain(A.item_sales(bed.sales()))


@query(part("item_returns"))
def item_returns(bed):
    return _plain(A.item_returns(bed.returns()))


@query(oracle("SELECT max(sold_date_sk) + 1 AS today_sk FROM sales", "sales"))
def reference_day(bed):
    return A.reference_day(bed.sales())


@query(part("scored"))
def score_customers(bed):
    return _plain(M.score_customers(bed.sales(), bed.returns()))


@query(oracle("SELECT sale_year, sale_month, channel, " + ", ".join(
    big(f"sum({c})", c) for c in ("line_item_count", "order_count", "quantity_sold", "return_order_count", "return_quantity")
) + ", " + ", ".join(amount(f"sum({c})", c) for c in (
    "gross_sales", "discount_amt", "tax_amt", "net_sales", "net_profit", "return_amt", "return_net_loss"))
    + " FROM sales_performance GROUP BY sale_year, sale_month, channel", "sales_performance"))
def monthly_rollup(bed):
    return _plain(A.monthly_rollup(stored_mart(bed, "mart_sales_performance")))


@query(oracle("""
    SELECT (SELECT count(*) FROM customer_360 WHERE segment = 'Champions') AS champions,
           (SELECT count(*) FROM customer_360 WHERE segment = 'At risk high-value') AS at_risk,
           (SELECT max(total_net_sales) FROM product_analytics) AS top_item_sales,
           (SELECT CAST(sum(total_net_sales) AS DECIMAL(18,2)) FROM channel_comparison) AS lifetime_net_sales
    """, "customer_360", "product_analytics", "channel_comparison"))
def gold_kpis(bed):
    return _plain(kpis(*[stored_mart(bed, f"mart_{n}") for n in (
        "customer_360", "product_analytics", "channel_comparison")]))


@query(oracle("""
    SELECT CAST(sale_date AS VARCHAR) AS sale_date, channel, order_count, CAST(net_sales AS DOUBLE) AS net_sales,
           CAST(return_rate AS DOUBLE) AS return_rate FROM sales_performance""", "sales_performance"))
def export_safe(bed):
    return X.export_safe(
        mart_sales_performance(bed).select("sale_date", "channel", "order_count", "net_sales", "return_rate"))


@query(f"""SELECT l_orderkey, {ratio('tax', 'net')} AS rate FROM (
           SELECT l_orderkey, sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))) AS tax,
                  sum(CAST(l_quantity - 25 AS DECIMAL(18,2))) AS net FROM lineitem GROUP BY l_orderkey)""")
def safe_ratio(bed):
    """Ratio per order; the denominator is zero or negative for many orders."""
    wide = "decimal(18,2)"
    li = bed.source("lineitem").groupBy("l_orderkey").agg(
        F.sum((F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).cast(wide)).alias("tax"),
        F.sum((F.col("l_quantity") - 25).cast(wide)).alias("net"))
    return li.select("l_orderkey", X.safe_ratio(F.col("tax"), F.col("net")).alias("rate"))


@query(oracle("SELECT order_number, channel, item_sk, d_year, d_moy FROM sales JOIN dim_date_dim "
              "ON d_date_sk = sold_date_sk", "sales", "dim_date_dim"))
def join_dates(bed):
    sold = bed.sales().select("order_number", "channel", "item_sk", "sold_date_sk")
    return J.join_dates(sold, bed.silver("date_dim"), "sold_date_sk", ["d_year", "d_moy"]).drop("sold_date_sk")


@query(oracle("""
    SELECT c_customer_sk, cd_gender, cd_marital_status, cd_education_status, ib_lower_bound AS income_lower,
           ib_upper_bound AS income_upper
    FROM dim_customer LEFT JOIN dim_customer_demographics ON cd_demo_sk = c_current_cdemo_sk
    LEFT JOIN dim_household_demographics ON hd_demo_sk = c_current_hdemo_sk
    LEFT JOIN dim_income_band ON ib_income_band_sk = hd_income_band_sk""",
    "dim_customer", "dim_customer_demographics", "dim_household_demographics", "dim_income_band"))
def enrich_customer(bed):
    return J.enrich_customer(
        bed.silver("customer"), bed.silver("customer_demographics"), bed.silver("household_demographics"),
        bed.silver("income_band")).select(
        "c_customer_sk", "cd_gender", "cd_marital_status", "cd_education_status", "income_lower", "income_upper")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row_number() OVER (
          ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS row_number
          FROM lineitem""")
def global_row_number(bed):
    """Row numbers over every line, by ship date."""
    li = bed.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    order = [F.col(c).asc_nulls_last() for c in
             ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return R.global_row_number(li, order).drop("l_shipdate", "l_extendedprice")


@query("""SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderpriority, o_orderkey) AS INTEGER) AS ntile FROM orders""")
def global_ntile(bed):
    """Tiles over a key with five values: each value is held by a fifth of the rows."""
    o = bed.source("orders").select("o_orderkey", "o_orderpriority")
    return R.global_ntile(o, 7, [F.col("o_orderpriority").asc_nulls_last(), F.col("o_orderkey").asc()]).drop(
        "o_orderpriority")


@query(oracle("""
    SELECT customer_sk, item_sk, n FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_sk ORDER BY n DESC, item_sk) AS rn FROM (
        SELECT customer_sk, item_sk, CAST(sum(quantity) AS BIGINT) AS n FROM sales
        WHERE customer_sk IS NOT NULL AND item_sk IS NOT NULL GROUP BY ALL)) WHERE rn <= 4""", "sales"))
def top_n_per(bed):
    pairs = A.pair_aggregate(bed.sales(), "customer_sk", "item_sk", {"n": "sum(quantity)"})
    best = R.top_n_per(pairs, ["from_sk"], [F.col("n").desc(), F.col("to_sk").asc()], 4)
    return best.select(F.col("from_sk").alias("customer_sk"), F.col("to_sk").alias("item_sk"), "n")


@query(oracle("SELECT item_sk, total_net_sales FROM item_sales ORDER BY total_net_sales DESC NULLS LAST, item_sk LIMIT 25",
              "item_sales"))
def top_n(bed):
    items = A.item_sales(bed.sales()).select("item_sk", F.col("total_net_sales").cast("decimal(18,2)").alias("total_net_sales"))
    return R.top_n(items, [F.col("total_net_sales").desc_nulls_last(), F.col("item_sk").asc()], 25)


@query(oracle("SELECT i_item_sk, i_product_name FROM dim_item ORDER BY i_product_name NULLS LAST, i_item_sk LIMIT 200",
              "dim_item"))
def bounded(bed):
    """An ordered listing under the interactive result cap."""
    listed = bed.silver("item").select("i_item_sk", "i_product_name").orderBy(
        F.col("i_product_name").asc_nulls_last(), "i_item_sk")
    return R.bounded(listed)


# -- distinct orders that add up ---------------------------------------------------------------------------
def daily_orders_of(bed):
    return bed.stored("gold", "agg_daily_orders", lambda: A.daily_orders(bed.sales()))


def _dated_orders(bed):
    days = bed.silver("date_dim").select(
        F.col("d_date_sk").alias("sold_date_sk"), F.col("d_year").alias("sale_year"), F.col("d_moy").alias("sale_month"),
        F.col("d_qoy").alias("sale_quarter"))
    return daily_orders_of(bed).join(days, "sold_date_sk")


@query(oracle(f"SELECT sold_date_sk, channel, {big('count(DISTINCT order_number)', 'order_count')} FROM sales "
              "WHERE sold_date_sk IS NOT NULL GROUP BY sold_date_sk, channel", "sales"))
def daily_order_state(bed):
    """The stored state, counted day by day."""
    return A.count_orders(daily_orders_of(bed), "sold_date_sk", "channel")


@query(oracle(f"SELECT d_year AS sale_year, d_qoy AS sale_quarter, {big('count(DISTINCT (channel, order_number))', 'order_count')} FROM sales "
              "JOIN dim_date_dim ON d_date_sk = sold_date_sk WHERE order_number IS NOT NULL GROUP BY ALL", "sales", "dim_date_dim"))
def quarterly_orders(bed):
    """Another period, over all channels, from the same state."""
    return A.count_orders(_dated_orders(bed), "sale_year", "sale_quarter")


@query(oracle(f"SELECT sale_year, sale_month, p.channel, {big('any_value(m.order_count)', 'order_count')}, {big('sum(quantity_sold)', 'quantity_sold')}, "
              f"{amount('sum(p.net_sales)', 'net_sales')} FROM sales_performance p JOIN monthly_sales m "
              "ON m.d_year = sale_year AND m.d_moy = sale_month AND m.channel = p.channel GROUP BY ALL", "sales_performance", "monthly_sales"))
def monthly_rollup_distinct(bed):
    """The monthly view with the order counts of the channel comparison, the facts not read again."""
    out = A.monthly_rollup(stored_mart(bed, "mart_sales_performance"), _dated_orders(bed))
    return _plain(out.select("sale_year", "sale_month", "channel", "order_count", "quantity_sold", "net_sales"))
