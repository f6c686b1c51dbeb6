from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions import exprs as X
from marketloom.operators.silver import anomaly_summary, read_anomalies, read_clean, silver_split, store_silver
from marketloom.specs import TABLES, TableSpec, bronze_schema

ITEM = TABLES["item"]


def items(spark, *rows):
    base = dict.fromkeys(ITEM.columns)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], bronze_schema("item"))


def reasons(spark, **row):
    bad = silver_split(items(spark, row), ITEM)[1].collect()
    return bad[0]["anomaly_reasons"] if bad else []


@pytest.mark.parametrize("value", ["12.0", " 12 ", "+5", "x", "12\n", "", "-", "1e3"])
def test_bad_integers(spark, value):
    assert reasons(spark, i_item_sk=value) == ["i_item_sk:not_integer"]


@pytest.mark.parametrize("value", [".5", "5.", "1e3", "12.3.4", "+1", "12.5\n"])
def test_bad_decimals(spark, value):
    assert reasons(spark, i_current_price=value) == ["i_current_price:not_numeric"]


@pytest.mark.parametrize("value", ["1999/01/02", "1999-1-2", "1999-01-02 ", "x"])
def test_bad_dates(spark, value):
    assert reasons(spark, i_rec_start_date=value) == ["i_rec_start_date:not_date"]


@pytest.mark.parametrize("column,value", [
    ("i_rec_start_date", "1999-13-45"), ("i_item_sk", "99999999999"), ("i_current_price", "123456.78"),
    ("i_current_price", "99999.995")])
def test_right_form_out_of_range(spark, column, value):
    assert reasons(spark, **{column: value}) == [f"{column}:out_of_range"]
    with pytest.raises(Exception, match="does not fit"):
        silver_split(items(spark, {column: value}), ITEM, strict=True)[0].collect()


def test_reasons_in_column_order(spark):
    assert reasons(spark, i_manager_id="z", i_item_sk="y") == ["i_item_sk:not_integer", "i_manager_id:not_integer"]


def test_clean_values(spark):
    row = silver_split(items(spark, dict(
        i_item_sk="-7", i_rec_start_date="2001-02-03", i_current_price="12.5", i_wholesale_cost="1.005",
        i_brand=" a ", i_class="   ", i_size="\tx", i_brand_id="2147483647", i_class_id="0000000000012")), ITEM)[0].first()
    assert (row.i_item_sk, row.i_rec_start_date, row.i_current_price) == (-7, date(2001, 2, 3), Decimal("12.50"))
    assert (row.i_wholesale_cost, row.i_brand, row.i_class, row.i_size) == (Decimal("1.01"), "a", None, "\tx")
    assert (row.i_brand_id, row.i_class_id, row.i_rec_end_date) == (2147483647, 12, None)


def test_halves_partition_the_raw_table(spark, wh):
    raw = items(spark, *[dict(i_item_sk=str(n) if n % 3 else f"x{n}", i_brand=f" b{n} ") for n in range(50)])
    clean, bad = silver_split(raw, ITEM)
    assert (clean.count(), bad.count()) == (33, 17)
    store_silver(wh, raw, ITEM)
    assert read_clean(wh, "item").exceptAll(clean).count() == 0 and read_clean(wh, "item").count() == 33
    assert read_anomalies(wh, "item").exceptAll(bad).count() == 0 and read_anomalies(wh, "item").count() == 17
    assert read_anomalies(wh, "item").filter("i_brand like ' b%'").count() == 17  # raw text kept


def test_table_without_typed_columns(spark):
    spec = TableSpec("dbgen_version", ("dv_version",), (), None, "meta")
    clean, bad = silver_split(spark.createDataFrame([(" 1 ",)], "dv_version string"), spec)
    assert (clean.first()[0], bad.count(), dict(bad.dtypes)["anomaly_reasons"]) == ("1", 0, "array<string>")


def test_summary(spark):
    flagged = X.with_flags(items(spark, dict(i_item_sk="1"), dict(i_item_sk="x", i_class_id="y"), dict(i_item_sk="z")), ITEM.types)
    rows = {r.reason: (r.total_rows, r.rejected_rows, r.reason_rows) for r in anomaly_summary({"item": flagged}).collect()}
    assert rows == {"i_item_sk:not_integer": (3, 2, 2), "i_class_id:not_integer": (3, 2, 1)}


def test_ratio_label_json(spark):
    df = spark.range(1).select(
        X.safe_ratio(F.lit(Decimal("1.00")), F.lit(Decimal("3.00"))).alias("third"),
        X.safe_ratio(F.lit(Decimal("1.00")), F.lit(Decimal("0.00"))).alias("none"),
        X.safe_ratio(F.lit(Decimal("1.00")), F.lit(Decimal("-2.00"))).alias("neg"),
        X.safe_ratio(F.lit(Decimal("1.00")), F.lit(Decimal("20000.00"))).alias("half"),
        X.safe_label(F.lit("a-b c_1")).alias("l1"), X.safe_label(F.lit("1x")).alias("l2"), X.safe_label(F.lit("")).alias("l3"),
        X.props_json({"a": F.lit(1), "b": F.lit(None).cast("int")}).alias("j1"),
        X.props_json({"a": F.lit(1), "b": F.lit(None).cast("int")}, keep_nulls=True).alias("j2"),
        X.props_json({}).alias("j3")).first()
    assert (df.third, df.none, df.neg, df.half) == (Decimal("0.3333"), None, None, Decimal("0.0001"))
    assert (df.l1, df.l2, df.l3) == ("abc_1", "C_1x", "C_")
    assert (df.j1, df.j2, df.j3) == ('{"a":1}', '{"a":1,"b":null}', "{}")


def test_export_safe(spark):
    df = spark.sql("SELECT 1.50BD AS d, DATE '2001-02-03' AS t, TIMESTAMP '2001-02-03 04:05:06' AS s, 'x' AS x")
    assert tuple(X.export_safe(df).first()) == (1.5, "2001-02-03", "2001-02-03T04:05:06", "x")


@pytest.mark.parametrize("r,f,m,segment", [
    (5, 5, 5, "Champions"), (4, 3, 1, "Loyal"), (1, 1, 4, "At risk high-value"), (2, 1, 1, "Hibernating"),
    (3, 1, 1, "New"), (3, 2, 1, "Active"), (None, None, None, "No purchase")])
def test_segments(spark, r, f, m, segment):
    q = [F.lit(x).cast("int") for x in (r, f, m)]
    assert spark.range(1).select(X.rfm_segment(*q, F.lit(r is not None))).first()[0] == segment
