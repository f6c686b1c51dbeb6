"""Silver tables, their rejected rows, and the expressions behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions import exprs as X
from marketloom.operators.silver import silver_split, stored_summary
from marketloom.queries import query
from marketloom.queries.oracle import anomalies_sql, big, oracle, part, reasons_sql
from marketloom.specs import TABLES, silver_tables


def _register(table: str) -> None:
    spec = TABLES[table]

    @query(part(spec.silver_name), name=f"silver_{table}")
    def clean(bed):
        return silver_split(bed.raw(table), spec)[0]

    @query(oracle(anomalies_sql(table, f"raw_{table}"), f"raw_{table}"), name=f"anomalies_{table}")
    def anomalies(bed):
        bad = silver_split(bed.raw(table), spec)[1]
        return bad.withColumn("anomaly_reasons", F.array_join("anomaly_reasons", ","))


for _table in silver_tables():
    _register(_table)


@query(oracle(
    "SELECT l_orderkey, l_linenumber, NULLIF(TRIM('  ' || l_returnflag || ' '), '') AS padded, "
    "NULLIF(TRIM(CASE WHEN l_linestatus = 'F' THEN '   ' ELSE l_linestatus END), '') AS blank "
    "FROM lineitem"))
def clean_text(bed):
    li = bed.source("lineitem")
    blank = F.when(F.col("l_linestatus") == "F", "   ").otherwise(F.col("l_linestatus"))
    return li.select(
        "l_orderkey", "l_linenumber",
        X.clean_text(F.concat(F.lit("  "), "l_returnflag", F.lit(" "))).alias("padded"),
        X.clean_text(blank).alias("blank"))


@query(oracle("""
    SELECT ss_ticket_number, ss_promo_sk,
           CASE WHEN regexp_full_match(ss_quantity, '-?[0-9]+') THEN TRY_CAST(ss_quantity AS INTEGER) END AS quantity,
           CASE WHEN regexp_full_match(ss_list_price, '-?[0-9]+(\\.[0-9]+)?')
                THEN TRY_CAST(ss_list_price AS DECIMAL(7,2)) END AS list_price,
           CASE WHEN regexp_full_match(ss_net_profit, '-?[0-9]+(\\.[0-9]+)?')
                THEN TRY_CAST(ss_net_profit AS DECIMAL(7,2)) END AS net_profit
    FROM raw_store_sales""", "raw_store_sales"))
def guarded_casts(bed):
    return bed.raw("store_sales").select(
        "ss_ticket_number", "ss_promo_sk",
        X.safe_int(F.col("ss_quantity")).alias("quantity"),
        X.safe_decimal(F.col("ss_list_price")).alias("list_price"),
        X.safe_decimal(F.col("ss_net_profit")).alias("net_profit"))


@query(oracle("""
    SELECT i_item_sk, CASE WHEN regexp_full_match(i_rec_start_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                           THEN TRY_CAST(i_rec_start_date AS DATE) END AS start_date
    FROM raw_item""", "raw_item"))
def guarded_dates(bed):
    return bed.raw("item").select(
        "i_item_sk", X.safe_date(F.col("i_rec_start_date")).alias("start_date"))


@query(oracle(f"""
    SELECT *, {reasons_sql('web_sales')} AS reasons, {reasons_sql('web_sales')} = '' AS is_clean
    FROM raw_web_sales""", "raw_web_sales"))
def violation_flags(bed):
    flagged = X.with_flags(bed.raw("web_sales"), TABLES["web_sales"].types)
    reasons = F.col("anomaly_reasons")
    return flagged.select(
        *TABLES["web_sales"].columns, F.array_join(reasons, ",").alias("reasons"),
        X.is_clean(reasons).alias("is_clean"))


_ALL = silver_tables()
_RAWS = [f"raw_{t}" for t in _ALL]
_FLAGGED = " UNION ALL ".join(
    f"SELECT '{TABLES[t].silver_name}' AS table_name, {reasons_sql(t)} AS reasons FROM raw_{t}" for t in _ALL)


@query(oracle(f"""
    SELECT t.*, r.reason, {big('coalesce(r.reason_rows, 0)', 'reason_rows')}
    FROM (SELECT table_name, {big('count(*)', 'total_rows')},
                 {big("count(*) FILTER (WHERE reasons <> '')", 'rejected_rows')}
          FROM flagged GROUP BY table_name) t
    LEFT JOIN (SELECT table_name, reason, count(*) AS reason_rows
               FROM (SELECT table_name, unnest(string_split(reasons, ',')) AS reason
                     FROM flagged WHERE reasons <> '') GROUP BY ALL) r USING (table_name)
    """.replace("FROM flagged", f"FROM ({_FLAGGED})"), *_RAWS), name="anomaly_summary")
def _summary(bed):
    """Reasons as they are stored with all Silver tables."""
    bed.silver_layer()
    return stored_summary(bed.wh)


def _key(table: str) -> str:
    return TABLES[table].pk or TABLES[table].columns[0]


@query(oracle(" UNION ALL ".join(
    f"SELECT '{TABLES[t].silver_name}' AS name, count(*) AS n, count({_key(t)}) AS n_keys FROM {TABLES[t].silver_name} "
    f"UNION ALL SELECT '{TABLES[t].silver_name}__anomalies', count(*), count({_key(t)}) "
    f"FROM ({anomalies_sql(t, f'raw_{t}')})" for t in _ALL), *_RAWS, *[TABLES[t].silver_name for t in _ALL]))
def silver_views(bed):
    """Rows and keys of all clean tables and of all tables of rejected rows, through SQL views."""
    bed.silver_layer()
    views = set(bed.wh.register_views("silver"))
    names = {f"{TABLES[t].silver_name}{x}": _key(t) for t in _ALL for x in ("", "__anomalies")}
    assert {f"silver_{n}" for n in names} <= views
    return bed.spark.sql(" UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS n, count({k}) AS n_keys FROM silver_{n}" for n, k in names.items()))


@query(part("sales"))
def unify_sales(bed):
    return bed.sales()


@query(part("returns"))
def unify_returns(bed):
    return bed.returns()


@query("SELECT o_orderkey, CAST(epoch_ms(COALESCE(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 90 MINUTE END, "
       "TIMESTAMP '2002-01-01') ) - epoch_ms(o_orderdate) AS DOUBLE) / 1000 AS duration_s FROM orders")
def duration_s(bed):
    o = bed.source("orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    end = F.when(F.col("o_orderstatus") != "P", start + F.expr("INTERVAL 90 MINUTES"))
    return o.select("o_orderkey", X.duration_s(start, end, F.lit("2002-01-01").cast("timestamp_ntz")).alias("duration_s"))


@query("SELECT s_suppkey, greatest(CAST(s_acctbal AS DECIMAL(12,2)), 0) AS balance FROM supplier")
def at_least_zero(bed):
    return bed.source("supplier").select(
        "s_suppkey", X.at_least_zero(F.col("s_acctbal").cast("decimal(12,2)")).alias("balance"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(k, '^[a-zA-Z]') THEN k ELSE 'C_' || k END AS safe
          FROM (SELECT p_partkey, regexp_replace(CASE WHEN p_size > 25 THEN p_brand ELSE '#' || p_size || ' ' || p_name END,
                                                 '[^a-zA-Z0-9_]', '', 'g') AS k FROM part)""")
def safe_label(bed):
    name = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(
        F.concat(F.lit("#"), F.col("p_size").cast("string"), F.lit(" "), F.col("p_name")))
    return bed.source("part").select("p_partkey", X.safe_label(name).alias("safe"))


@query("""SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(12,2)) END AS balance,
                 CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS segment,
                 c_acctbal >= 0 AS stripped_has_balance, true AS kept_has_balance FROM customer""")
def json_properties(bed):
    """Members written to JSON, with and without NULLs, and read back as text and number."""
    c = bed.source("customer")
    members = {
        "name": F.col("c_name"),
        "balance": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)")),
        "segment": F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")),
    }
    packed = c.select("c_custkey", X.props_json(members).alias("p"),
                      X.props_json(members, keep_nulls=True).alias("k"))
    return packed.select(
        "c_custkey", X.prop("p", "name").alias("c_name"), X.prop("p", "balance", "decimal(12,2)").alias("balance"),
        X.prop("k", "segment").alias("segment"),
        F.col("p").contains('"balance"').alias("stripped_has_balance"),
        F.col("k").contains('"balance"').alias("kept_has_balance"))


@query(oracle("SELECT order_number, channel, quantity FROM sales WHERE customer_sk IN "
              "(SELECT c_customer_sk FROM dim_customer WHERE c_birth_year >= 1970)", "sales", "dim_customer"))
def is_in_set(bed):
    born = bed.silver("customer").filter(F.col("c_birth_year") >= 1970).select("c_customer_sk")
    return X.is_in_set(bed.sales(), born, "customer_sk").select("order_number", "channel", "quantity")


@query(oracle("SELECT order_number, channel, item_sk FROM sales WHERE channel IN ('store', 'web') "
              "AND customer_sk IS NOT NULL AND sold_date_sk IS NOT NULL", "sales"))
def where_not_null(bed):
    found = X.is_in_set(bed.sales(), ["store", "web"], "channel")
    return X.where_not_null(found, "customer_sk", "sold_date_sk").select("order_number", "channel", "item_sk")


