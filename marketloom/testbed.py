"""Retail-shaped raw tables derived from a TPC-H-like star schema.

Every raw table of the catalog is one SELECT over the given Parquet tables. The text is in the
dialect that Spark SQL and DuckDB share, so an oracle can start from the same raw rows. No row of
a source table is dropped to save work; a few values are spoiled on purpose so that the Silver
validation has something to reject:

* quantity ``x<n>``             where discount is 0.10 on line 7
* list price ``<n>.4``          where tax is 0.08 on line 6
* net profit ``9999999.00``     where discount is 0.00 on line 5 (right form, out of range)
* item dates ``1999/01/02`` and ``1999-13-45`` for sizes 50 and 49, blank text for size 48
* one odd value or a few in each dimension, so that every table has rejected rows

Order priority decides the channel. Single-unit sales are anonymous, sales of 50 units are
undated, and 2 % of customers and items appear in returns only.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators.silver import read_clean, silver_split, store_silver
from marketloom.operators.unify import CHANNELS, by_channel, unify_returns, unify_sales
from marketloom.session import scratch_root
from marketloom.specs import TABLES, silver_tables, spec_of
from marketloom.warehouse import Warehouse

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")

# Order lines with their channel, customer and money, computed once for all channel facts.
BASE_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, o_custkey,
       CAST(l_quantity AS INT) AS qty,
       CAST(l_discount AS DECIMAL(4,2)) AS disc_rate,
       CAST(l_tax AS DECIMAL(4,2)) AS tax_rate,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.1 AS DECIMAL(12,2)) AS price,
       CAST(CAST(l_shipdate AS DATE) - DATE '1900-01-01' AS INT) + 2415021 AS ship_sk,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'web'
            WHEN o_orderpriority = '5-LOW' THEN 'catalog' ELSE 'store' END AS channel
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

_LINES = """
(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, o_custkey, qty, disc_rate,
        tax_rate, price, ship_sk, channel, disc,
        CAST(price - disc AS DECIMAL(12,2)) AS net,
        CAST((price - disc) * tax_rate AS DECIMAL(12,2)) AS tax,
        CAST(price * 0.93 AS DECIMAL(12,2)) AS cost
 FROM (SELECT b.*, CAST(price * disc_rate AS DECIMAL(12,2)) AS disc
       FROM {base} b WHERE channel = '%s') p) q
"""

_SOLD = {
    "sold_date_sk": "CASE WHEN qty = 50 THEN NULL ELSE ship_sk END",
    "sold_time_sk": "l_linenumber * 3600",
    "item_sk": "CASE WHEN l_partkey % 50 = 49 THEN NULL ELSE l_partkey END",
    "customer_sk": "CASE WHEN qty = 1 OR o_custkey % 50 = 49 THEN NULL ELSE o_custkey END",
    "promo_sk": "l_linenumber",
    "order": "l_orderkey",
    "quantity": "CASE WHEN disc_rate = 0.10 AND l_linenumber = 7 "
                "THEN CONCAT('x', CAST(qty AS STRING)) ELSE CAST(qty AS STRING) END",
    "wholesale_cost": "cost",
    "list_price": "CASE WHEN tax_rate = 0.08 AND l_linenumber = 6 "
                  "THEN CONCAT(CAST(price AS STRING), '.4') ELSE CAST(price AS STRING) END",
    "sales_price": "net",
    "ext_discount_amt": "disc",
    "ext_sales_price": "price",
    "ext_wholesale_cost": "cost",
    "ext_list_price": "price",
    "ext_tax": "tax",
    "coupon_amt": "CAST(0 AS DECIMAL(7,2))",
    "net_paid": "net",
    "net_paid_inc_tax": "net + tax",
    "net_profit": "CASE WHEN disc_rate = 0.00 AND l_linenumber = 5 "
                  "THEN '9999999.00' ELSE CAST(CAST(net - cost AS DECIMAL(12,2)) AS STRING) END",
}
_SHIPPED = {
    "ship_date_sk": "ship_sk + 2",
    "ship_mode_sk": "l_linenumber",
    "warehouse_sk": "l_suppkey",
    "ext_ship_cost": "CAST(price * 0.05 AS DECIMAL(12,2))",
    "net_paid_inc_ship": "net + CAST(price * 0.05 AS DECIMAL(12,2))",
    "net_paid_inc_ship_tax": "net + tax + CAST(price * 0.05 AS DECIMAL(12,2))",
}
_RETURNED = {
    "returned_date_sk": "CASE WHEN qty = 50 THEN NULL ELSE ship_sk + l_linenumber END",
    "item_sk": "l_partkey",
    "customer_sk": "CASE WHEN qty = 1 THEN NULL ELSE o_custkey END",
    "reason_sk": "l_linenumber",
    "order": "l_orderkey",
    "return_quantity": _SOLD["quantity"],
    "return_amt": "net",
    "return_tax": "tax",
    "return_amt_inc_tax": "net + tax",
    "fee": "CAST(0.5 AS DECIMAL(7,2))",
    "return_ship_cost": "CAST(price * 0.02 AS DECIMAL(12,2))",
    "refunded_cash": "net",
    "reversed_charge": "CAST(0 AS DECIMAL(7,2))",
    "credit": "CAST(0 AS DECIMAL(7,2))",
    "net_loss": "CAST(net * 0.1 AS DECIMAL(12,2))",
}


def _fact(prefix: str, values: dict[str, str], renamed: dict[str, str]) -> dict[str, str]:
    named = {renamed.get(k, k): v for k, v in values.items()}
    return {f"{prefix}_{k}": v for k, v in named.items()}


def _lines(channel: str, where: str = "") -> str:
    return f"{_LINES % channel} {where}"


_R = "WHERE l_returnflag = 'R'"
_STATE = "CASE WHEN s_nationkey < 8 THEN 'CA' WHEN s_nationkey < 16 THEN 'TX' ELSE 'NY' END"
_PLACE = {  # postal address of a location derived from its supplier
    "street_number": "s_suppkey + 100", "street_name": "'Main'", "city": "CONCAT('City ', CAST(s_nationkey AS STRING))",
    "state": _STATE, "zip": "10000 + s_nationkey", "country": "'United States'", "gmt_offset": "'-5.00'",
}
_SEGMENT_NO = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 "
               "WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END")


def _place(prefix: str, extra: dict[str, str]) -> dict[str, str]:
    return {**extra, **{f"{prefix}_{k}": v for k, v in _PLACE.items()}}


# table -> (FROM clause, column -> expression); columns left out are empty.
RAW: dict[str, tuple[str, dict[str, str]]] = {
    "store_sales": (_lines("store"), _fact("ss", {**_SOLD, "store_sk": "l_suppkey"}, {"order": "ticket_number"})),
    "catalog_sales": (_lines("catalog"), _fact(
        "cs", {**_SOLD, **_SHIPPED, "call_center_sk": "l_suppkey"},
        {"order": "order_number", "customer_sk": "bill_customer_sk"})),
    "web_sales": (_lines("web"), _fact(
        "ws", {**_SOLD, **_SHIPPED, "web_site_sk": "l_suppkey"},
        {"order": "order_number", "customer_sk": "bill_customer_sk"})),
    "store_returns": (_lines("store", _R), _fact(
        "sr", {**_RETURNED, "store_sk": "l_suppkey"}, {"order": "ticket_number", "credit": "store_credit"})),
    "catalog_returns": (_lines("catalog", _R), _fact(
        "cr", {**_RETURNED, "warehouse_sk": "l_suppkey"},
        {"order": "order_number", "customer_sk": "refunded_customer_sk", "return_amt": "return_amount",
         "credit": "store_credit"})),
    "web_returns": (_lines("web", _R), _fact(
        "wr", _RETURNED, {"order": "order_number", "customer_sk": "refunded_customer_sk",
                          "credit": "account_credit"})),
    "customer": ("{customer}", {
        "c_customer_sk": "c_custkey", "c_customer_id": "c_name",
        "c_current_cdemo_sk": "c_nationkey + 1", "c_current_hdemo_sk": _SEGMENT_NO,
        "c_current_addr_sk": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END",
        "c_first_name": "CASE WHEN c_nationkey = 3 THEN '  ' ELSE CONCAT(' ', c_mktsegment) END",
        "c_last_name": "c_name", "c_preferred_cust_flag": "CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END",
        "c_birth_day": "c_nationkey + 1",
        "c_birth_year": "CASE WHEN c_nationkey = 24 AND c_acctbal < 0 THEN '19x4' "
                        "ELSE CAST(1950 + c_nationkey AS STRING) END",
        "c_birth_country": "CONCAT('NATION_', CAST(c_nationkey AS STRING))",
        "c_email_address": "CONCAT(LOWER(c_mktsegment), CAST(c_custkey AS STRING), '@example.com')"}),
    "customer_address": (
        "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey", {
            "ca_address_sk": "CASE WHEN c_acctbal < 9000 THEN c_custkey ELSE c_custkey + 500000000 END", "ca_address_id": "CONCAT('A', CAST(c_custkey AS STRING))",
            "ca_street_number": "c_custkey", "ca_street_name": "'Oak'", "ca_city": "n_name",
            "ca_state": "r_name", "ca_zip": "20000 + c_nationkey", "ca_country": "'United States'",
            "ca_gmt_offset": "CASE WHEN c_nationkey = 7 THEN '-5,00' ELSE '-5.00' END"}),
    "customer_demographics": (
        "(SELECT c_nationkey, COUNT(*) AS n FROM {customer} GROUP BY c_nationkey) d", {
            "cd_demo_sk": "c_nationkey + 1",
            "cd_gender": "CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END",
            "cd_marital_status": "CASE WHEN c_nationkey < 6 THEN 'S' WHEN c_nationkey < 18 THEN 'M' END",
            "cd_education_status": "'College'", "cd_purchase_estimate": "n",
            "cd_credit_rating": "'Good'", "cd_dep_count": "CASE WHEN c_nationkey = 13 THEN 'few' ELSE CAST(c_nationkey AS STRING) END"}),
    "household_demographics": (
        "(SELECT c_mktsegment, COUNT(*) AS n, COUNT(DISTINCT c_nationkey) AS k FROM {customer} "
        "GROUP BY c_mktsegment) d", {
            "hd_demo_sk": _SEGMENT_NO, "hd_income_band_sk": _SEGMENT_NO,
            "hd_buy_potential": "c_mktsegment",
            "hd_dep_count": "CASE WHEN c_mktsegment = 'FURNITURE' THEN '?' ELSE CAST(k AS STRING) END", "hd_vehicle_count": "n"}),
    "income_band": (
        "(SELECT c_mktsegment, MIN(FLOOR(c_acctbal)) AS lo, MAX(FLOOR(c_acctbal)) AS hi FROM {customer} "
        "GROUP BY c_mktsegment) d", {
            "ib_income_band_sk": f"{_SEGMENT_NO} + CASE WHEN c_mktsegment = 'MACHINERY' THEN 100 ELSE 0 END", "ib_lower_bound": "CASE WHEN c_mktsegment = 'BUILDING' THEN '1e3' ELSE CAST(CAST(lo AS INT) AS STRING) END",
            "ib_upper_bound": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(hi AS INT) END"}),
    "item": ("{part}", {
        "i_item_sk": "p_partkey", "i_item_id": "CONCAT('I', CAST(p_partkey AS STRING))",
        "i_rec_start_date": "CASE WHEN p_size = 50 THEN '1999/01/02' WHEN p_size = 49 THEN '1999-13-45' "
                            "ELSE '1997-10-27' END",
        "i_item_desc": "CASE WHEN p_size = 48 THEN '   ' ELSE CONCAT(p_type, ' ', p_name) END",
        "i_current_price": "CAST(p_retailprice AS DECIMAL(12,2))",
        "i_wholesale_cost": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.7 AS DECIMAL(12,2))",
        "i_brand_id": "p_size", "i_brand": "CONCAT(' ', p_brand, ' ')", "i_class_id": "p_size",
        "i_class": "p_type", "i_category_id": "p_size",
        "i_category": "CASE WHEN p_size < 17 THEN 'Books' WHEN p_size < 34 THEN 'Music' ELSE 'Home' END",
        "i_manufact": "p_brand", "i_size": "p_size", "i_manager_id": "p_size",
        "i_product_name": "CASE WHEN p_size = 1 THEN NULL ELSE p_name END"}),
    "store": ("{supplier}", _place("s", {
        "s_store_sk": "s_suppkey", "s_store_id": "CONCAT('S', CAST(s_suppkey AS STRING))",
        "s_rec_start_date": "'1997-03-13'", "s_store_name": "s_name", "s_number_employees": "200 + s_nationkey",
        "s_floor_space": "CASE WHEN s_nationkey = 11 THEN '+9000' ELSE '9000' END",
        "s_manager": "CONCAT('M ', s_name)", "s_market_id": "s_nationkey", "s_tax_precentage": "'0.03'"})),
    "call_center": ("{supplier}", _place("cc", {
        "cc_call_center_sk": "s_suppkey", "cc_call_center_id": "CONCAT('CC', CAST(s_suppkey AS STRING))",
        "cc_rec_start_date": "'1998-01-01'", "cc_name": "s_name", "cc_employees": "10 + s_nationkey",
        "cc_sq_ft": "1000", "cc_manager": "CONCAT('M ', s_name)", "cc_mkt_id": "s_nationkey",
        "cc_division": "1", "cc_company": "CASE WHEN s_nationkey = 2 THEN '1.0' ELSE '1' END",
        "cc_tax_percentage": "CASE WHEN s_nationkey = 15 THEN '.03' ELSE '0.03' END"})),
    "warehouse": ("{supplier}", _place("w", {
        "w_warehouse_sk": "s_suppkey", "w_warehouse_id": "CONCAT('W', CAST(s_suppkey AS STRING))",
        "w_warehouse_name": "s_name", "w_warehouse_sq_ft": "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_nationkey IN (4, 14) THEN '5e4' ELSE '50000' END"})),
    "web_site": ("{supplier}", _place("web", {
        "web_site_sk": "s_suppkey", "web_site_id": "CONCAT('WS', CAST(s_suppkey AS STRING))",
        "web_rec_start_date": "CASE WHEN s_nationkey = 5 THEN '1997-8-16' ELSE '1997-08-16' END",
        "web_name": "s_name", "web_manager": "CONCAT('M ', s_name)", "web_mkt_id": "s_nationkey",
        "web_company_id": "1", "web_tax_percentage": "'0.05'"})),
    "catalog_page": ("{part}", {
        "cp_catalog_page_sk": "p_partkey", "cp_catalog_page_id": "CONCAT('P', CAST(p_partkey AS STRING))",
        "cp_department": "p_type", "cp_catalog_number": "p_size",
        "cp_catalog_page_number": "CASE WHEN p_size = 13 THEN ' 13 ' ELSE CAST(p_size AS STRING) END",
        "cp_description": "p_name", "cp_type": "'monthly'"}),
    "promotion": ("(SELECT l_linenumber, COUNT(*) AS n, MIN(l_partkey) AS k FROM {lineitem} GROUP BY l_linenumber) d", {
        "p_promo_sk": "l_linenumber", "p_promo_id": "CONCAT('PR', CAST(l_linenumber AS STRING))",
        "p_item_sk": "k", "p_cost": "CASE WHEN l_linenumber = 5 THEN '1,000.00' ELSE '1000.00' END", "p_response_target": "n",
        "p_promo_name": "CASE WHEN l_linenumber = 3 THEN '' ELSE 'promo' END", "p_discount_active": "'N'"}),
    "reason": ("(SELECT l_linenumber, COUNT(*) AS n FROM {lineitem} GROUP BY l_linenumber) d", {
        "r_reason_sk": "CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS STRING) ELSE '7.0' END", "r_reason_id": "CONCAT('R', CAST(l_linenumber AS STRING))",
        "r_reason_desc": "CONCAT('reason ', CAST(n AS STRING))"}),
    "ship_mode": ("(SELECT l_linenumber, l_linestatus, COUNT(*) AS n FROM {lineitem} "
                  "GROUP BY l_linenumber, l_linestatus) d", {
        "sm_ship_mode_sk": "CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN '107.' ELSE "
                           "CAST(l_linenumber + CASE WHEN l_linestatus = 'O' THEN 0 ELSE 100 END AS STRING) END",
        "sm_ship_mode_id": "CONCAT('SM', l_linestatus, CAST(l_linenumber AS STRING))",
        "sm_type": "CASE WHEN l_linestatus = 'O' THEN 'EXPRESS' ELSE 'REGULAR' END", "sm_code": "'AIR'",
        "sm_carrier": "CASE WHEN l_linenumber = 2 THEN NULL ELSE 'CARRIER' END", "sm_contract": "n"}),
    "date_dim": ("(SELECT day, CAST(day - DATE '1900-01-01' AS INT) AS dn FROM "
                 "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM {lineitem}) x) d", {
        "d_date_sk": "dn + 2415021", "d_date_id": "CONCAT('D', CAST(dn AS STRING))", "d_date": "day",
        "d_month_seq": "EXTRACT(YEAR FROM day) * 12 + EXTRACT(MONTH FROM day) - 22801",
        "d_year": "EXTRACT(YEAR FROM day)", "d_dow": "(dn + 1) % 7", "d_moy": "EXTRACT(MONTH FROM day)",
        "d_dom": "CASE WHEN dn % 997 = 5 THEN 'first' ELSE CAST(EXTRACT(DAY FROM day) AS STRING) END", "d_qoy": "EXTRACT(QUARTER FROM day)",
        "d_fy_year": "EXTRACT(YEAR FROM day)", "d_weekend": "CASE WHEN (dn + 1) % 7 IN (0, 6) THEN 'Y' ELSE 'N' END"}),
    "time_dim": ("(SELECT h, mi, s, COUNT(*) AS n FROM (SELECT EXTRACT(HOUR FROM ts) AS h, "
                 "EXTRACT(MINUTE FROM ts) AS mi, CAST(FLOOR(EXTRACT(SECOND FROM ts)) AS INT) AS s "
                 "FROM {events}) x GROUP BY h, mi, s) d", {
        "t_time_sk": "h * 3600 + mi * 60 + s", "t_time_id": "CONCAT('T', CAST(h * 3600 + mi * 60 + s AS STRING))",
        "t_time": "h * 3600 + mi * 60 + s", "t_hour": "h", "t_minute": "mi",
        "t_second": "CASE WHEN s = 59 AND mi = 59 THEN '5 9' ELSE CAST(s AS STRING) END",
        "t_am_pm": "CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END"}),
    "web_page": ("{pages}", {
        "wp_web_page_sk": "page_id", "wp_web_page_id": "CASE WHEN LENGTH(html) < 1500 THEN NULL ELSE "
                                                       "CONCAT('WP', CAST(page_id AS STRING)) END",
        "wp_rec_start_date": "'1997-09-03'", "wp_url": "url", "wp_type": "'html'",
        "wp_char_count": "LENGTH(html)", "wp_link_count": "CASE WHEN page_id % 50 = 7 THEN 'many' ELSE '6' END"}),
    "inventory": ("(SELECT l_partkey, l_suppkey, SUM(CAST(l_quantity AS INT)) AS n, MAX(l_shipdate) AS last "
                  "FROM {lineitem} GROUP BY l_partkey, l_suppkey) d", {
        "inv_date_sk": "CAST(CAST(last AS DATE) - DATE '1900-01-01' AS INT) + 2415021",
        "inv_item_sk": "l_partkey", "inv_warehouse_sk": "l_suppkey",
        "inv_quantity_on_hand": "CASE WHEN n = 50 THEN '50 ' ELSE CAST(n AS STRING) END"}),
}


def raw_sql(table: str) -> str:
    """SELECT of one raw table; ``{source}`` and ``{base}`` are left to be filled in."""
    source, values = RAW[table]
    unknown = set(values) - set(spec_of(table).columns)
    if unknown:
        raise ValueError(f"{table}: no such columns {sorted(unknown)}")
    columns = [f"CAST({values.get(c, 'NULL')} AS STRING) AS {c}" for c in spec_of(table).columns]
    return f"SELECT {', '.join(columns)} FROM {source}"


#: Lines of a task that joins lines and orders: it sorts them twice, about 100 MB each time.
LINES_PER_TASK = 500_000


class Bed:
    """Raw, Silver and graph tables over one folder of source tables.

    Tables that several queries read are written once per application to the shared scratch
    folder, as the layers of a warehouse are.
    """

    _made: dict[tuple[str, str], "Bed"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        tag = "".join(c if c.isalnum() else "_" for c in self.folder)
        self.wh = Warehouse(spark, f"{scratch_root(spark)}/bed-{tag}")
        self._ready: set[str] = set()
        self._locks: dict[str, Lock] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Bed":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._made:
            cls._made[key] = cls(spark, folder)
        return cls._made[key]

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, **frames: str) -> DataFrame:
        paths = {n: f"parquet.`{self.folder}/{n}.parquet`" for n in SOURCES}
        return self.spark.sql(text.format(**{**paths, **frames}))

    def stored(self, layer: str, name: str, make, **how) -> DataFrame:
        """Read a table of the scratch warehouse, writing it first if this session has not."""
        self._once(f"{layer}.{name}", lambda: self.wh.write(make(), layer, name, **how))
        return self.wh.read(layer, name)

    def stored_parts(self, layer: str, name: str, column: str, make) -> DataFrame:
        """The same for a table that comes as a frame per value of a column."""
        self._once(f"{layer}.{name}", lambda: self.wh.write_parts(make(), layer, name, column))
        return self.wh.read(layer, name)

    def _once(self, name: str, work) -> None:
        with self._locks.setdefault(name, Lock()):
            if name not in self._ready:
                work()
                self._ready.add(name)

    def _order_lines(self) -> DataFrame:
        # A given table may be one row group: its lines are dealt to all cores before they are joined. The
        # number of tasks follows the rows (counted from the footers), so that none has to spill.
        lines = self.source("lineitem")
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-lines.count() // LINES_PER_TASK))
        lines = lines.repartition(tasks, "l_orderkey")
        return self.spark.sql(BASE_SQL, lineitem=lines, orders=self.source("orders"))

    # -- layers --------------------------------------------------------------------------------
    def raw(self, table: str) -> DataFrame:
        sql = raw_sql(table)
        if "{base}" not in sql:
            return self._sql(sql)
        # One join of lines and orders, partitioned by channel: each fact reads its own part, and its text
        # is made of it on the way; a copy of all facts as text would be most of what is written.
        self.stored("bronze", "order_lines", self._order_lines, partition_by=["channel"])
        return self._sql(sql, base=f"parquet.`{self.wh.snapshot_path('bronze', 'order_lines')}`")

    def silver(self, table: str) -> DataFrame:
        """Clean rows, written once together with the rejected ones."""
        spec = spec_of(table)
        self._once(f"silver.{spec.silver_name}", lambda: store_silver(self.wh, self.raw(table), spec))
        return read_clean(self.wh, table)

    def clean(self, table: str) -> DataFrame:
        """Clean rows, computed from the raw table without storing them."""
        return silver_split(self.raw(table), TABLES[table])[0]

    def silver_layer(self, tables: list[str] | None = None, threads: int = 4) -> None:
        """Write Silver tables; independent tables share the cluster."""
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(self.silver, tables or silver_tables()))

    def _channels(self, kind: str) -> list[DataFrame]:
        """Clean facts of all channels from stored Silver; each fact is flagged once."""
        names = [f"{ch}_{kind}" for ch in CHANNELS]
        self.silver_layer(names)
        return [self.silver(n) for n in names]

    def sales(self) -> DataFrame:
        return self.stored_parts(
            "silver", "int_sales_unified", "channel", lambda: by_channel(unify_sales(*self._channels("sales"))))

    def returns(self) -> DataFrame:
        return self.stored_parts(
            "silver", "int_returns_unified", "channel", lambda: by_channel(unify_returns(*self._channels("returns"))))

    def unified(self, kind: str) -> DataFrame:
        """Unified sales or returns for a reader of few columns: the stored table if there is one, else made of
        stored Silver as they are read, which writes no second copy of all facts."""
        if f"silver.int_{kind}_unified" in self._ready:
            return getattr(self, kind)()
        return {"sales": unify_sales, "returns": unify_returns}[kind](*self._channels(kind))
