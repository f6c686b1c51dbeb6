"""Bronze tables, whose numbers are text, take less than tables written with the common options."""

from pyspark.sql import functions as F

from marketloom.sources import bronze as B


def test_numbers_as_text_are_stored_in_larger_pages(spark, wh, tmp_path):
    rows = spark.range(60_000).select(
        (F.xxhash64("id") % 1_000_000).cast("string").alias("r_reason_sk"), F.concat(F.lit("R"), F.col("id") % 977).alias("r_reason_id"),
        F.concat_ws(".", F.abs(F.xxhash64("id")) % 9973, F.col("id") % 100).alias("r_reason_desc")).coalesce(1)
    B.write_raw(rows, str(tmp_path), "reason")
    assert B.load_table(wh, str(tmp_path), "reason").rows_loaded == 60_000
    wh.write(B.read_bronze(spark, str(tmp_path), "reason").coalesce(1), "gold", "plain")
    assert wh.read("bronze", "reason").exceptAll(rows).count() == 0
    size = lambda layer, name: wh.size_bytes(wh.snapshot_path(layer, name))
    print(size("bronze", "reason"), size("gold", "plain"))
    assert size("bronze", "reason") < size("gold", "plain")
