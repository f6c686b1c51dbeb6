"""One channel-independent shape for store, catalog and web facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.exprs import project_map

CHANNELS = ("store", "catalog", "web")

# --- fixed values: unified columns and where each channel keeps them ---------------------------
_SAME_NAME = (
    "quantity wholesale_cost list_price sales_price ext_discount_amt ext_sales_price "
    "ext_wholesale_cost ext_list_price ext_tax coupon_amt net_paid net_paid_inc_tax net_profit"
).split()


def _sales_map(prefix: str, party: str, location: str, order: str) -> dict[str, str]:
    own = {
        "sold_date_sk": "sold_date_sk", "sold_time_sk": "sold_time_sk", "item_sk": "item_sk",
        "customer_sk": f"{party}customer_sk", "cdemo_sk": f"{party}cdemo_sk",
        "hdemo_sk": f"{party}hdemo_sk", "addr_sk": f"{party}addr_sk",
        "location_sk": location, "promo_sk": "promo_sk", "order_number": order,
        **{c: c for c in _SAME_NAME},
    }
    return {target: f"{prefix}_{source}" for target, source in own.items()}


def _returns_map(prefix: str, time: str, party: str, order: str, amount: str) -> dict[str, str]:
    own = {
        "returned_date_sk": "returned_date_sk", "returned_time_sk": time, "item_sk": "item_sk",
        "customer_sk": f"{party}customer_sk", "reason_sk": "reason_sk", "order_number": order,
        "return_quantity": "return_quantity", "return_amt": amount, "return_tax": "return_tax",
        "net_loss": "net_loss",
    }
    return {target: f"{prefix}_{source}" for target, source in own.items()}


# The buyer is the billed customer; the returner is the refunded customer.
SALES_MAPS = {
    "store": _sales_map("ss", "", "store_sk", "ticket_number"),
    "catalog": _sales_map("cs", "bill_", "call_center_sk", "order_number"),
    "web": _sales_map("ws", "bill_", "web_site_sk", "order_number"),
}
RETURNS_MAPS = {
    "store": _returns_map("sr", "return_time_sk", "", "ticket_number", "return_amt"),
    "catalog": _returns_map("cr", "returned_time_sk", "refunded_", "order_number", "return_amount"),
    "web": _returns_map("wr", "returned_time_sk", "refunded_", "order_number", "return_amt"),
}
# --- end of fixed values ----------------------------------------------------------------------
#: Order of sales for readers of customers; the later columns split a hot customer.
SALES_ORDER = ("customer_sk", "item_sk", "order_number")


def unify(facts: dict[str, DataFrame], maps: dict[str, dict[str, str]]) -> DataFrame:
    """UNION ALL of one projection per channel, tagged with the channel."""
    parts = [project_map(facts[ch], maps[ch], channel=ch) for ch in maps]
    return reduce(DataFrame.unionByName, parts)


def unify_sales(store: DataFrame, catalog: DataFrame, web: DataFrame) -> DataFrame:
    return unify({"store": store, "catalog": catalog, "web": web}, SALES_MAPS)


def unify_returns(store: DataFrame, catalog: DataFrame, web: DataFrame) -> DataFrame:
    return unify({"store": store, "catalog": catalog, "web": web}, RETURNS_MAPS)


def by_channel(unified: DataFrame) -> dict[str, DataFrame]:
    """Unified facts channel by channel: the tag is constant, so each reads that channel's table only."""
    return {ch: unified.filter(F.col("channel") == ch) for ch in CHANNELS}
