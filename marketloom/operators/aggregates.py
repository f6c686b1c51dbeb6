"""Pre-aggregations of the unified facts; every mart aggregates first and joins afterwards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.exprs import where_not_null
from marketloom.operators.rank import top_n_per
from marketloom.operators.unify import CHANNELS

_MONTH_MEASURES = {
    "orders": "order_count", "quantity": "quantity", "gross_sales": "gross_sales",
    "net_sales": "net_sales", "net_profit": "net_profit",
}


GROUPS_PER_TASK = 500_000
HOT_ORIGINS = 1024  # at most, that are spread over tasks


def tasks_for(df: DataFrame, *groups: str) -> int:
    """Tasks among which an aggregate by these columns is dealt so that none has to spill; the number of
    groups is estimated in a pass over the columns."""
    n = df.agg(F.approx_count_distinct(F.xxhash64(*groups))).first()[0]
    return n // GROUPS_PER_TASK + 1


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows dealt to tasks by keys, if there are to be more tasks than the session's shuffle partitions.
    What is grouped by these keys or more, distinct counts among them, is then not shuffled again."""
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def daily_sales(sales: DataFrame) -> DataFrame:
    """Per (date, channel). The distinct count is split on the order number before the groups
    are formed, so a hot day does not land on one task."""
    sold = where_not_null(sales, "sold_date_sk").select(
        "sold_date_sk", "channel", "order_number", "quantity", "ext_sales_price", "ext_discount_amt", "ext_tax", "net_paid", "net_profit")
    keys = ("sold_date_sk", "channel", "order_number")
    return dealt(sold, tasks_for(sold, *keys), *keys).groupBy("sold_date_sk", "channel").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.countDistinct("order_number").alias("order_count"),
        F.sum("quantity").alias("quantity_sold"),
        F.sum("ext_sales_price").alias("gross_sales"),
        F.sum("ext_discount_amt").alias("discount_amt"),
        F.sum("ext_tax").alias("tax_amt"),
        F.sum("net_paid").alias("net_sales"),
        F.sum("net_profit").alias("net_profit"),
    )


def daily_returns(returns: DataFrame) -> DataFrame:
    return where_not_null(returns, "returned_date_sk").groupBy("returned_date_sk", "channel").agg(
        F.countDistinct("order_number").alias("return_order_count"),
        F.sum("return_quantity").alias("return_quantity"),
        F.sum("return_amt").alias("return_amt"),
        F.sum("net_loss").alias("return_net_loss"),
    )


def monthly_sales(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Per (year, month, channel).

    The date dimension is a few thousand rows, so its lookup stays on the map side and the lines
    are combined to (month, channel, order) before the groups are formed.
    """
    days = dates.select(F.col("d_date_sk").alias("sold_date_sk"), "d_year", "d_moy")
    sold = where_not_null(sales, "sold_date_sk")
    dated = sold.join(days, "sold_date_sk").select(
        "d_year", "d_moy", "channel", "order_number", "quantity", "ext_sales_price", "net_paid", "net_profit")
    tasks = tasks_for(sold, "sold_date_sk", "channel", "order_number")
    return dealt(dated, tasks, "d_year", "d_moy", "channel", "order_number").groupBy("d_year", "d_moy", "channel").agg(
        F.countDistinct("order_number").alias("order_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("ext_sales_price").alias("gross_sales"),
        F.sum("net_paid").alias("net_sales"),
        F.sum("net_profit").alias("net_profit"),
    )


def pivot_channels(monthly: DataFrame) -> DataFrame:
    """Channels side by side, and their totals; a channel without sales stays NULL."""
    picked = [
        F.max(F.when(F.col("channel") == ch, F.col(source))).alias(f"{ch}_{target}")
        for ch in CHANNELS
        for target, source in _MONTH_MEASURES.items()
    ]
    totals = [F.sum(s).alias(f"total_{t}") for t, s in _MONTH_MEASURES.items()]
    return monthly.groupBy("d_year", "d_moy").agg(*picked, *totals)


def item_sales(sales: DataFrame) -> DataFrame:
    """Per item: totals and per-channel measures in one aggregation."""
    measures = {
        "quantity": "quantity", "gross_sales": "ext_sales_price", "net_sales": "net_paid",
        "net_profit": "net_profit",
    }
    totals = [F.sum(c).alias(f"total_{t}") for t, c in measures.items()]
    by_channel = [
        F.sum(F.when(F.col("channel") == ch, F.col(measures[m]))).alias(f"{ch}_{m}")
        for m in ("quantity", "gross_sales")
        for ch in CHANNELS
    ]
    return where_not_null(sales, "item_sk").groupBy("item_sk").agg(*totals, *by_channel)


def item_returns(returns: DataFrame) -> DataFrame:
    return where_not_null(returns, "item_sk").groupBy("item_sk").agg(
        F.sum("return_quantity").alias("returned_quantity"),
        F.sum("return_amt").alias("returned_amt"),
    )


def customer_sales(sales: DataFrame) -> DataFrame:
    """Per customer. An order number counts once per channel; NULL order numbers do not count."""
    return where_not_null(sales, "customer_sk", "sold_date_sk").groupBy("customer_sk").agg(
        F.min("sold_date_sk").alias("first_sale_date_sk"),
        F.max("sold_date_sk").alias("last_sale_date_sk"),
        F.countDistinct("channel", "order_number").alias("order_count"),
        F.sum("quantity").alias("quantity_purchased"),
        F.sum("ext_sales_price").alias("gross_sales"),
        F.sum("net_paid").alias("ltv_net_paid"),
        F.sum("net_profit").alias("profit_total"),
    )


def customer_returns(returns: DataFrame) -> DataFrame:
    return where_not_null(returns, "customer_sk").groupBy("customer_sk").agg(
        F.sum("return_quantity").alias("returned_quantity"),
        F.sum("return_amt").alias("returned_amt"),
    )


def reference_day(sales: DataFrame) -> DataFrame:
    """One row: the day after the last sale, over all sales (also those without a customer)."""
    return sales.agg((F.max("sold_date_sk") + 1).alias("today_sk"))


def pair_aggregate(
    df: DataFrame, from_column: str, to_column: str, aggregates: Mapping[str, str]
) -> DataFrame:
    """Named aggregate expressions per (from, to) pair with both keys present.

    Keys take the type of node keys here, so that a later cut per origin and the lookup of the
    origin share one partitioning. Pairs are dealt by both keys, so a hot origin is spread over all tasks.
    """
    keys = ["from_sk", "to_sk"]
    found = _pairs(df, from_column, to_column)
    return dealt(found, tasks_for(found, *keys), *keys).groupBy(*keys).agg(*_named(aggregates))


def top_pairs(
    df: DataFrame, from_column: str, to_column: str, aggregates: Mapping[str, str], order: Sequence[Column], n: int | None
) -> DataFrame:
    """``pair_aggregate`` cut to the first n pairs per origin, by one shuffle: rows are dealt by their origin to as
    many tasks as the pairs need, and what is grouped and ranked there is not shuffled again.

    An origin with more rows than a task takes is left to ``pair_aggregate``, which spreads its pairs, and the
    cut then sends n of them per task. Which origins those are is estimated, and is a matter of balance only.
    """
    if n is None:
        return pair_aggregate(df, from_column, to_column, aggregates)
    found = _pairs(df, from_column, to_column)
    n_pairs, often = found.agg(
        F.approx_count_distinct(F.xxhash64("from_sk", "to_sk")),
        F.expr(f"approx_top_k(from_sk, {HOT_ORIGINS}, {16 * HOT_ORIGINS})")).first()
    hot = [x["item"] for x in often or [] if x["count"] > GROUPS_PER_TASK]
    tasks = max(n_pairs // GROUPS_PER_TASK + 1, df.sparkSession.sparkContext.defaultParallelism)
    cold = found.filter(~F.col("from_sk").isin(hot)) if hot else found
    pairs = cold.repartition(tasks, "from_sk").groupBy("from_sk", "to_sk").agg(*_named(aggregates))
    best = top_n_per(pairs, ["from_sk"], order, n)
    if not hot:
        return best
    spread = pair_aggregate(df.filter(F.col(from_column).cast("bigint").isin(hot)), from_column, to_column, aggregates)
    return best.unionByName(top_n_per(spread, ["from_sk"], order, n))


def _pairs(df: DataFrame, from_column: str, to_column: str) -> DataFrame:
    keys = {n: F.col(c).cast("bigint") for c, n in ((from_column, "from_sk"), (to_column, "to_sk"))}
    return where_not_null(df, from_column, to_column).withColumns(keys)


def _named(aggregates: Mapping[str, str]) -> list[Column]:
    return [F.expr(e).alias(n) for n, e in aggregates.items()]


SPARSE = 256  # positions of a bucket that are kept as a list; more are a bitmap


def daily_orders(sales: DataFrame) -> DataFrame:
    """The distinct orders of each (date, channel), in a form that adds up: per bucket of 32,768 order
    numbers the positions that occur, as a list while they are few, else as a bitmap.

    Orders are made distinct before groups form, and a group is one bucket, so it has a bound and a hot
    day is spread over tasks. Stored, it answers distinct counts of any period
    (``count_orders``) without reading the facts again. NULL order numbers do not count.
    """
    number = F.col("order_number").cast("bigint")
    keys = ["sold_date_sk", "channel", "bucket"]
    sold = where_not_null(sales, "sold_date_sk", "order_number").select(
        "sold_date_sk", "channel", F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("position"))
    seen = dealt(sold, tasks_for(sold, *keys, "position"), *keys).distinct()
    lists = seen.groupBy(*keys).agg(F.collect_list(F.col("position").cast("int")).alias("positions"))
    few = F.size("positions") <= SPARSE
    dense = lists.filter(~few).select(*keys, F.explode("positions").alias("position")).groupBy(*keys).agg(
        F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("bitmap"))
    return lists.filter(few).select(*keys, F.array_sort("positions").alias("positions"), F.lit(None).cast("binary").alias("bitmap")).unionByName(
        dense.select(*keys, F.lit(None).cast("array<int>").alias("positions"), "bitmap"))


def count_orders(state: DataFrame, *by: str) -> DataFrame:
    """Distinct orders per group of stored ``daily_orders`` rows (with the columns ``by`` added), as
    ``order_count``. An order number counts once per channel."""
    keys = list(dict.fromkeys([*by, "channel", "bucket"]))
    # Lists stay lists: a bitmap is 4 KB, however few its positions. Only groups that hold a bitmap too are merged as bitmaps.
    lists = state.filter("positions IS NOT NULL").select(*keys, "positions").groupBy(*keys).agg(
        F.array_distinct(F.flatten(F.collect_list("positions"))).alias("positions"))
    bitmaps = state.filter("bitmap IS NOT NULL").select(*keys, "bitmap").groupBy(*keys).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    held = bitmaps.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    counted = lists.join(held, same, "left_anti").select(*keys, F.size("positions").cast("bigint").alias("n"))
    listed = lists.join(held, same, "left_semi").select(*keys, F.explode("positions").alias("position")).groupBy(*keys).agg(
        F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("bitmap"))
    merged = listed.unionByName(bitmaps).groupBy(*keys).agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return counted.unionByName(merged).groupBy(*by).agg(F.sum("n").alias("order_count"))


def monthly_rollup(mart: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Monthly view of the daily mart. Order counts add up days: an order shipped on two days
    counts twice. With ``orders`` (``daily_orders`` with sale_year and sale_month) an order counts
    once a month, as in the channel comparison."""
    sums = (
        "line_item_count order_count quantity_sold gross_sales discount_amt tax_amt net_sales "
        "net_profit return_order_count return_quantity return_amt return_net_loss"
    ).split()
    keys = ["sale_year", "sale_month", "channel"]
    out = mart.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    if orders is None:
        return out
    return out.drop("order_count").join(count_orders(orders, *keys), keys, "left").select(*keys, *sums)
