"""What the time of a daily run rests on: short code per row, no large dictionaries, cheap gzip. F1 of round 4."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketloom.functions import exprs as X
from marketloom.sources import bronze as B
from marketloom.specs import TABLES

COMPILED = 8000  # bytes of a method that the JVM still compiles


def _largest_method(df) -> int:
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


@pytest.mark.parametrize("table", ["web_sales", "catalog_sales", "store_sales"])
def test_lines_of_wide_tables_are_parsed_by_compiled_code(spark, tmp_path, table):
    names = TABLES[table].columns
    rows = spark.range(3).select(*[
        F.when((F.col("id") + i) % 3 > 0, F.concat(F.col("id").cast("string"), F.lit(f'"\\{i}'))).alias(c) for i, c in enumerate(names)])
    B.write_raw(rows, str(tmp_path), table)
    read = B.read_bronze(spark, str(tmp_path), table)
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")  # the default: longer methods are kept, and interpreted
    try:
        assert _largest_method(read) < COMPILED
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def test_columns_of_many_values_have_no_dictionary(spark, wh):
    rows = spark.range(200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(30_000)).cast("int").alias("many"), (F.col("id") % 90).cast("int").alias("few"),
        F.lpad(F.pmod(F.xxhash64("id"), F.lit(9_000)).cast("string"), 20, "x").alias("text")).coalesce(1)
    wh.write(rows, "gold", "encoded")
    part, = (f for f in wh.files.names(wh.snapshot_path("gold", "encoded")) if f.endswith(".parquet"))
    group = pq.ParquetFile(f"{wh.snapshot_path('gold', 'encoded')}/{part}").metadata.row_group(0)
    pages = {group.column(i).path_in_schema: {s for s in group.column(i).encodings if s != "RLE"} for i in range(3)}
    assert "RLE_DICTIONARY" in pages["few"]
    assert "DELTA_BINARY_PACKED" in pages["many"] and "DELTA_BYTE_ARRAY" in pages["text"]
    assert wh.read("gold", "encoded").exceptAll(rows).count() == 0


def test_raw_files_take_a_low_level_of_gzip(spark, wh, tmp_path):
    rows = spark.range(50_000).select(
        (F.xxhash64("id") % 1_000_000).cast("string").alias("r_reason_sk"), F.concat(F.lit("R"), F.col("id") % 977).alias("r_reason_id"),
        F.lit("reason").alias("r_reason_desc")).coalesce(1)
    B.write_raw(rows, str(tmp_path), "reason", "gzip")
    rows.select(F.concat_ws("|", *rows.columns)).write.text(str(tmp_path / "usual"), compression="gzip")
    fast, usual = wh.size_bytes(B.file_path(str(tmp_path), "reason")), wh.size_bytes(str(tmp_path / "usual"))
    assert usual < fast < 1.25 * usual
    assert B.read_bronze(spark, str(tmp_path), "reason").exceptAll(rows).count() == 0


ODD = [None, "", " ", "0", "-0", "007", "-7", "+7", "--7", "-", "7-", "1 ", ";", "1;2", "1;", ";1", "-;", "1\n", "\n", "1.", ".1", "1.5", "1.55", "1.555", "1.5.5",
       "999999999", "1234567890", "9999999999", "12345", "123456", "12345.67", "123456.7", "1e3", "x", "١", "1999-01-02", "1999-13-45", "1,0"]


def test_plain_rows_are_told_as_value_by_value(spark):
    """Reasons are those of each column alone, whatever the other columns hold and whichever separator is in a value."""
    types = {n: TABLES["web_sales"].types[n] for n in ("ws_item_sk", "ws_order_number", "ws_quantity", "ws_net_paid", "ws_ext_tax")}
    values = spark.createDataFrame([(v,) for v in ODD], "v string")
    rows = None
    for at in types:  # each odd value in each column, beside plain and missing ones
        for other in ("5", None, ""):
            part = values.select(*[(F.col("v") if c == at else F.lit(other)).alias(c) for c in types])
            rows = part if rows is None else rows.unionByName(part)
    pairs = values.crossJoin(values.withColumnRenamed("v", "u")).select(
        *[F.col("v" if i % 2 else "u").alias(c) for i, c in enumerate(types)])
    rows = rows.unionByName(pairs)
    alone = F.array_compact(F.array(*[X.violation(c, t) for c, t in types.items()]))
    found = rows.select(*types, X.anomaly_reasons(types).alias("found"), alone.alias("alone"))
    assert found.filter(~F.col("found").eqNullSafe(F.col("alone"))).count() == 0
    assert found.filter("size(found) > 0").count() > 500 and found.filter("size(found) = 0").count() > 50
    assert "forall" not in found._jdf.queryExecution().analyzed().toString().lower()  # a lambda is interpreted value by value
