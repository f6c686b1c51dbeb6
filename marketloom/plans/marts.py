"""The four marts over Silver tables and the unified facts. Ranks run jobs while the plan is built:
the ranked aggregates are checkpointed; all else is lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.exprs import (
    recency_days, rfm_score, rfm_segment, safe_ratio, zero_if_null,
)
from marketloom.operators import aggregates as agg
from marketloom.operators.joins import enrich_customer, join_dates, left_join, with_scalar
from marketloom.operators.rank import global_rank, stacked_tiles
from marketloom.session import checkpointed

AMOUNT = T.DecimalType(18, 2)  # money at the mart boundary


def _money(*names: str, zero: bool = False) -> list[Column]:
    return [
        (zero_if_null(F.col(n)) if zero else F.col(n)).cast(AMOUNT).alias(n) for n in names
    ]


def _count(*names: str, zero: bool = False) -> list[Column]:
    return [
        (zero_if_null(F.col(n)) if zero else F.col(n)).cast("bigint").alias(n) for n in names
    ]


def mart_sales_performance(sales: DataFrame, returns: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales and returns per (date, channel) with sales.

    Returns are matched on their own date, and dropped on days without sales in the channel.
    """
    returned = agg.daily_returns(returns).withColumnRenamed("returned_date_sk", "sold_date_sk")
    both = left_join(agg.daily_sales(sales), returned, ["sold_date_sk", "channel"])
    dated = join_dates(both, dates, "sold_date_sk", ["d_date", "d_year", "d_moy", "d_dow"])
    return dated.select(
        F.col("d_date").alias("sale_date"),
        F.col("d_year").alias("sale_year"),
        F.col("d_moy").alias("sale_month"),
        F.col("d_dow").alias("sale_dow"),
        "channel",
        *_count("line_item_count", "order_count", "quantity_sold"),
        *_money("gross_sales", "discount_amt", "tax_amt", "net_sales", "net_profit"),
        *_count("return_order_count", "return_quantity", zero=True),
        *_money("return_amt", "return_net_loss", zero=True),
        safe_ratio(zero_if_null(F.col("return_amt")), F.col("gross_sales")).alias("return_rate"),
    )


def mart_channel_comparison(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per (year, month) with store, catalog, web and total measures."""
    wide = agg.pivot_channels(agg.monthly_sales(sales, dates))
    measures = [c for c in wide.columns if c not in ("d_year", "d_moy")]
    return wide.select(
        "d_year", "d_moy",
        *[
            F.col(c).cast("bigint" if c.endswith(("_orders", "_quantity")) else AMOUNT).alias(c)
            for c in measures
        ],
    )


def score_customers(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Buyers with recency, money and the three quintiles."""
    buyers = left_join(agg.customer_sales(sales), agg.customer_returns(returns), "customer_sk")
    scored = with_scalar(buyers, agg.reference_day(sales)).withColumn(
        "recency_days", recency_days(F.col("today_sk"), F.col("last_sale_date_sk"))
    ).drop("today_sk")
    # Falling order puts NULLs first and rising order last, as in PostgreSQL.
    return stacked_tiles(scored, "customer_sk", {
        "r_quintile": (F.col("recency_days"), True), "f_quintile": (F.col("order_count"), False),
        "m_quintile": (F.col("ltv_net_paid"), False)}, 5)


def mart_customer_360(
    customers: DataFrame, demographics: DataFrame, households: DataFrame, bands: DataFrame,
    sales: DataFrame, returns: DataFrame,
) -> DataFrame:
    """One row per customer: lifetime value, RFM scores and segment.

    Non-buyers keep NULL scores and dates and get 0 for money and quantity. A customer with
    returns but no dated sale counts as a non-buyer, with 0 returned.
    """
    scored = score_customers(sales, returns)
    people = enrich_customer(customers, demographics, households, bands)
    joined = people.join(scored, F.col("c_customer_sk") == F.col("customer_sk"), "left")
    r, f, m = (F.col(f"{x}_quintile") for x in "rfm")
    return joined.select(
        "c_customer_sk", "c_customer_id", "c_first_name", "c_last_name", "c_email_address",
        "c_birth_year", "c_preferred_cust_flag", "cd_gender", "cd_marital_status",
        "cd_education_status", "income_lower", "income_upper", "first_sale_date_sk",
        "last_sale_date_sk", "recency_days",
        *_count("order_count"),
        *_count("quantity_purchased", zero=True),
        *_money("gross_sales", "ltv_net_paid", "profit_total", zero=True),
        *_count("returned_quantity", zero=True),
        *_money("returned_amt", zero=True),
        safe_ratio(zero_if_null(F.col("returned_amt")), F.col("gross_sales")).alias("return_rate"),
        r, f, m,
        rfm_score(r, f, m).alias("rfm_score"),
        rfm_segment(r, f, m, F.col("customer_sk").isNotNull()).alias("segment"),
    )


def mart_product_analytics(items: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per item: totals, channels, returns, sales rank and percentile.

    Returns show even for unsold items; rank and rate of an unsold item are NULL.
    """
    sold = checkpointed(agg.item_sales(sales))
    ranks = global_rank(
        sold.select("item_sk", "total_net_sales"),
        [F.col("total_net_sales").desc_nulls_last(), F.col("item_sk").asc()],
        row_number="sales_rank",
        tiles={"sales_percentile": 100},
    ).drop("total_net_sales")
    ranked = sold.join(ranks, "item_sk").withColumnRenamed("item_sk", "i_item_sk")
    returned = agg.item_returns(returns).withColumnRenamed("item_sk", "i_item_sk")
    joined = left_join(left_join(items, ranked, "i_item_sk"), returned, "i_item_sk")
    return joined.select(
        "i_item_sk", "i_item_id", "i_product_name", "i_brand", "i_class", "i_category",
        "i_manufact", "i_current_price",
        *_count("total_quantity", zero=True),
        *_money("total_gross_sales", "total_net_sales", "total_net_profit", zero=True),
        *_count("store_quantity", "catalog_quantity", "web_quantity", zero=True),
        *_money("store_gross_sales", "catalog_gross_sales", "web_gross_sales", zero=True),
        *_count("returned_quantity", zero=True),
        *_money("returned_amt", zero=True),
        safe_ratio(zero_if_null(F.col("returned_quantity")), F.col("total_quantity")).alias(
            "return_rate"),
        *_count("sales_rank"),
        "sales_percentile",
    )
