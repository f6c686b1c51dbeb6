"""Raw file scans, loads and sinks, on files and tables derived from the given ones."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from marketloom.queries import query
from marketloom.plans.ops import load_stats_frame
from marketloom.queries.oracle import PARTS, big, oracle
from marketloom.session import new_folder
from marketloom.sources import bronze as B
from marketloom.sources import sinks as S
from marketloom.sources import upsert as U
from marketloom.specs import TABLES
from marketloom.warehouse import Warehouse

LINES_PER_FILE = 1_000_000  # of a compressed raw file, which is one task's work
_FILES = tuple(TABLES)
_READ = tuple(t for t in _FILES if t != "ship_mode")  # one file is missing on purpose


# The version table has no rows of its own in the test bed: one is made of a region.
PARTS["raw_dbgen_version"] = ((), "SELECT r_name AS dv_version, '2020-01-01' AS dv_create_date, '10:00:00' AS dv_create_time, "
                              "r_name AS dv_cmdline_args FROM region WHERE r_regionkey = 0")


def raw_table(bed, table: str):
    if table != "dbgen_version":
        return bed.raw(table)
    return bed.source("region").filter("r_regionkey = 0").select(
        F.col("r_name").alias("dv_version"), F.lit("2020-01-01").alias("dv_create_date"),
        F.lit("10:00:00").alias("dv_create_time"), F.col("r_name").alias("dv_cmdline_args"))


def raw_files(bed, tables) -> str:
    """Raw tables written as delimited text, in a folder of their own. The text of the facts is most of what
    a load writes, so it is compressed."""
    folder = new_folder(bed.spark, "raw")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: B.write_raw(raw_table(bed, t), folder, t, "gzip", LINES_PER_FILE), tables))
    return folder


def _scan(table: str) -> None:
    columns = ", ".join(f"NULLIF({c}, '') AS {c}" for c in TABLES[table].columns)

    @query(oracle(f"SELECT {columns} FROM raw_{table}", f"raw_{table}"), name=f"bronze_scan_{table}")
    def scan(bed):
        return B.read_bronze(bed.spark, raw_files(bed, [table]), table)


for _t in _FILES:
    _scan(_t)


def _declared() -> str:
    rows = ", ".join(f"('{t}', '{s.file}', {len(s.columns)})" for t, s in TABLES.items())
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM raw_{t}" for t in _READ)
    return f"""
    SELECT d.table_name, d.file, CAST(d.cols AS INTEGER) AS decl_cols, {big('coalesce(n, 0)', 'rows')},
           CAST(CASE WHEN n IS NULL THEN 0 WHEN table_name = 'item' THEN 1 ELSE d.cols END AS INTEGER) AS min_cols,
           CAST(CASE WHEN n IS NULL THEN 0 WHEN table_name = 'item' THEN 2 ELSE d.cols END AS INTEGER) AS max_cols,
           CASE WHEN n IS NULL THEN 'MISSING' WHEN table_name = 'item' THEN 'MISMATCH' ELSE 'OK' END AS status
    FROM (VALUES {rows}) d(table_name, file, cols) LEFT JOIN ({counts}) c USING (table_name)"""


@query(oracle(_declared(), *[f"raw_{t}" for t in _READ]))
def profile_files(bed):
    """All files but one, of which one has lines of one and two fields."""
    folder = raw_files(bed, [t for t in _READ if t != "item"])
    line = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.concat_ws("|", "p_type", "p_brand"))
    bed.source("part").select(line.alias("value")).write.text(B.file_path(folder, "item"))
    return B.profile_files(bed.spark, folder).drop("size_bytes")


@query(oracle("SELECT count(*) AS failed, 0 AS loaded, true AS names_line FROM "
              "(SELECT 1 FROM raw_reason LIMIT 1)", "raw_reason"))
def blank_line_aborts(bed):
    """A blank line between good ones fails the load and leaves no table."""
    folder, wh = new_folder(bed.spark, "raw"), Warehouse(bed.spark, new_folder(bed.spark, "load"))
    good = raw_table(bed, "reason").select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in TABLES["reason"].columns]).alias("value"))
    good.union(good.limit(1).select(F.lit("").alias("value"))).union(good).coalesce(1).write.text(B.file_path(folder, "reason"))
    stats = load_stats_frame(bed.spark, 1, B.load_bronze(wh, folder, ["reason"]))
    return stats.agg(
        F.count_if(F.col("status") == "failed").alias("failed"), F.sum("rows_loaded").cast("int").alias("loaded"),
        F.bool_and(F.col("error_message").contains("expected 3 fields, found 1")).alias("names_line"))


@query("""SELECT 'good' AS half, CAST(p_partkey AS VARCHAR) AS line, 3 AS fields FROM part WHERE p_size % 10 > 0
          UNION ALL SELECT 'bad', CASE WHEN p_size % 20 = 0 THEN '' ELSE p_partkey || '|' || p_brand END,
          CASE WHEN p_size % 20 = 0 THEN 1 ELSE 2 END FROM part WHERE p_size % 10 = 0""")
def quarantined_lines(bed):
    """Both halves of a file with short and blank lines: rows loaded, and lines set aside."""
    folder, wh = new_folder(bed.spark, "raw"), Warehouse(bed.spark, new_folder(bed.spark, "load"))
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    line = F.when(size % 20 == 0, "").when(size % 10 == 0, F.concat_ws("|", key, "p_brand")).otherwise(F.concat_ws("|", key, "p_brand", "p_type"))
    bed.source("part").select(line.alias("value")).write.text(B.file_path(folder, "reason"))
    B.load_table(wh, folder, "reason", mode="quarantine", max_bad_share=0.5)
    return wh.read("bronze", "reason").select(F.lit("good").alias("half"), F.col("r_reason_sk").alias("line"), F.lit(3).alias("fields")).unionByName(
        wh.read("bronze", "reason__bad_lines").select(F.lit("bad").alias("half"), "line", "fields"))


@query(oracle(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {big('count(*)', 'rows_loaded')}, 'success' AS status FROM raw_{t}" for t in _FILES),
    *[f"raw_{t}" for t in _FILES]))
def load_bronze(bed):
    wh = Warehouse(bed.spark, new_folder(bed.spark, "load"))
    stats = B.load_bronze(wh, raw_files(bed, _FILES), list(_FILES), on_error="raise", threads=8)
    return load_stats_frame(bed.spark, 1, stats).select("table_name", "rows_loaded", "status")


@query("""SELECT k, v FROM (SELECT p_partkey AS k, p_brand AS v FROM part WHERE p_size >= 20
          UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size < 20)""")
def merge_by_key(bed):
    p = bed.source("part")
    old = p.filter("p_size <= 40").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("v"))
    new = p.filter("p_size >= 20").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("v"))
    return S.merge_by_key(old, new, ["k"])


@query("""SELECT k, v FROM (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_size <= 40
          UNION ALL SELECT p_partkey, p_brand FROM part WHERE p_size > 40)""")
def insert_missing(bed):
    p = bed.source("part")
    old = p.filter("p_size <= 40").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("v"))
    new = p.filter("p_size >= 20").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("v"))
    return S.insert_missing(old, new, ["k"])


@query("""SELECT user_id, event_id, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def last_write_per_key(bed):
    e = bed.source("events").select("user_id", "event_id", "event_type", F.col("event_id").alias("seq"))
    return S.last_per_key(e, ["user_id"], "seq").drop("seq")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus")
def append_log(bed):
    """Rows appended in three writes, read back together."""
    wh = Warehouse(bed.spark, new_folder(bed.spark, "log"))
    o = bed.source("orders").select("o_orderkey", "o_orderstatus")
    is_f, is_o = (F.coalesce(F.col("o_orderstatus") == x, F.lit(False)) for x in ("F", "O"))
    for part_of in (is_f, is_o, ~is_f & ~is_o):
        wh.append(o.filter(part_of), "ops", "order_log")
    return wh.read("ops", "order_log").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM supplier")
def replace_table(bed):
    """A table replaced by a result computed from itself."""
    wh = Warehouse(bed.spark, new_folder(bed.spark, "replace"))
    wh.write(bed.source("supplier").withColumn("s_acctbal", F.lit(0.0)), "silver", "supplier")
    wh.write(wh.read("silver", "supplier").drop("s_acctbal").join(
        bed.source("supplier").select("s_suppkey", "s_acctbal"), "s_suppkey"), "silver", "supplier")
    return wh.read("silver", "supplier")


@query(oracle("SELECT channel, count(*) AS n, CAST(sum(net_paid) AS DECIMAL(18,2)) AS net_sales FROM sales GROUP BY channel",
              "sales"))
def layer_views(bed):
    """A stored layer read through its SQL views."""
    bed.sales()
    views = bed.wh.register_views("silver")
    name = next(v for v in views if v.endswith("int_sales_unified"))
    return bed.spark.sql(
        f"SELECT channel, count(*) AS n, CAST(sum(net_paid) AS DECIMAL(18,2)) AS net_sales FROM {name} GROUP BY channel")


@query("""SELECT * FROM (SELECT 1 AS step, count(*) AS changed, 16 AS touched FROM part
          UNION ALL SELECT 2, 0, 0 UNION ALL SELECT 3, 1, 1
          UNION ALL SELECT 4, count(*), 16 FROM part WHERE p_size > 25) WHERE (SELECT count(*) FROM part) > 0""")
def upsert_buckets(bed):
    """Rows that an upsert found changed and buckets it wrote: a new table, the same rows again, one row
    changed, the rows of large parts changed."""
    p = bed.source("part").select("p_partkey", "p_name", "p_size")
    one = p.agg(F.min("p_partkey")).scalar()
    wh = Warehouse(bed.spark, new_folder(bed.spark, "upsert"))
    new_name = lambda which: p.withColumn("p_name", F.when(which, "renamed").otherwise(F.col("p_name")))
    steps = [p, p, new_name(F.col("p_partkey") == one), p.filter("p_size > 25").withColumn("p_name", F.lit("large"))]
    done = [U.upsert(wh, rows, "silver", "part", ["p_partkey"]) for rows in steps]
    return bed.spark.createDataFrame([(i + 1, d.changed, len(d.touched)) for i, d in enumerate(done)], "step int, changed long, touched int")


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN 'renamed'
          ELSE p_name END AS p_name, p_size FROM part WHERE p_size > 10 OR p_partkey = (SELECT min(p_partkey) FROM part)""")
def upsert_rows(bed):
    """A stored table after three upserts: rows that were left out of the later ones stay."""
    p = bed.source("part").select("p_partkey", "p_name", "p_size")
    first = F.col("p_partkey") == p.agg(F.min("p_partkey")).scalar()
    wh = Warehouse(bed.spark, new_folder(bed.spark, "upsert"))
    for rows in (p.filter("p_size > 10"), p.filter(first).withColumn("p_name", F.when(F.col("p_size") > 25, "large").otherwise("renamed")),
                 p.filter("p_size > 25").withColumn("p_name", F.lit("large"))):
        U.upsert(wh, rows, "silver", "part", ["p_partkey"])
    return wh.read("silver", "part")
