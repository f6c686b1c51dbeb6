import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators.rank import global_rank, top_n_per


@pytest.mark.parametrize("n,k", [(0, 5), (1, 5), (3, 5), (5, 5), (1003, 5), (1003, 100), (2000, 7)])
def test_same_as_plain_window(spark, n, k):
    rng = random.Random(n + k)
    # A third of the rows share one value; some are NULL.
    rows = [(i, rng.choice([7, 7, rng.randrange(50), rng.randrange(50), None])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(6)
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    w = Window.orderBy(*order)
    want = df.select("id", F.row_number().over(w).alias("rn"), F.ntile(k).over(w).alias("t"))
    got = global_rank(df, order, row_number="rn", tiles={"t": k}).select("id", "rn", "t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_single_task_sort(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 3)
    plan = global_rank(df, [F.col("v").asc(), F.col("id").asc()], row_number="rn")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # Only the row counts per task meet in one place.
    assert "v#" not in "".join(line for line in text.splitlines() if "SinglePartition" in line)
    assert plan.agg(F.max("rn")).first()[0] == 1000


def test_top_n_per(spark):
    df = spark.createDataFrame([(c, i, 10 - i) for c in "ab" for i in range(7)], "c string, i int, s int")
    order = [F.col("s").desc_nulls_last(), F.col("i").asc()]
    assert top_n_per(df, ["c"], order, 5).groupBy("c").count().collect()[0]["count"] == 5
    assert top_n_per(df, ["c"], order, None).count() == 14
    plan = top_n_per(df, ["c"], order, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stacked_tiles_are_ntiles_by_one_sort(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from marketloom.operators.rank import stacked_tiles

    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1, 1, 1, 2, 3, 50]), rng.choice([None, 0.5, -2.25, 7.75]), f"row {i}") for i in range(1003)]
    df = spark.createDataFrame(rows, "k int, a int, b double, name string").withColumn("b", F.col("b").cast("decimal(10,2)"))
    df.createOrReplaceTempView("stacked")
    want = spark.sql("SELECT *, ntile(5) OVER (ORDER BY a DESC NULLS FIRST, k) AS ta, ntile(5) OVER (ORDER BY b NULLS LAST, k) AS tb FROM stacked")
    got = stacked_tiles(df, "k", {"ta": (F.col("a"), True), "tb": (F.col("b"), False)}, 5)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert stacked_tiles(df.limit(0), "k", {"ta": (F.col("a"), True)}, 5).count() == 0
