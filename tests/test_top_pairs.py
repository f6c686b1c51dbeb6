"""The first pairs per origin, dealt by origins, with hot origins spread; facts that the graph reads without a copy."""

import re

import pytest
from pyspark.sql import functions as F

from marketloom.operators import aggregates as A
from marketloom.operators.rank import top_n_per
from marketloom.plans import graph as G
from marketloom.queries.graph import tables_of
from marketloom.testbed import Bed

MADE = {"orders": "count(distinct channel, order_number)", "quantity": "sum(quantity)"}


def order():
    return [F.col("orders").desc_nulls_last(), F.col("to_sk").asc()]


@pytest.fixture(scope="module")
def sales(spark):
    # Origin 1 holds most rows; both keys, the order and the quantity are sometimes missing, and rows repeat.
    rows = [("web" if i % 3 else "store", 1 if i % 4 else i % 37 or None, i % 23 or None, i % 11 or None, i % 6 or None)
            for i in range(1200)]
    return spark.createDataFrame(rows + rows[:50], "channel string, a int, b int, order_number int, quantity int").cache()


def _exchanges(df) -> list[str]:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.mark.parametrize("per_task", [500_000, 300, 1])
def test_top_pairs_are_those_of_the_aggregate_and_the_cut(sales, monkeypatch, per_task):
    monkeypatch.setattr(A, "GROUPS_PER_TASK", per_task)
    want = top_n_per(A.pair_aggregate(sales, "a", "b", MADE), ["from_sk"], order(), 3)
    got = A.top_pairs(sales, "a", "b", MADE, order(), 3)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 50
    every = A.top_pairs(sales, "a", "b", MADE, order(), None)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, A.pair_aggregate(sales, "a", "b", MADE).collect()))


def test_rows_are_shuffled_once_by_their_origin(sales):
    dealt = _exchanges(A.top_pairs(sales, "a", "b", MADE, order(), 3))
    assert len(dealt) == 1 and dealt[0].startswith("from_sk#") and "to_sk" not in dealt[0]


def test_a_hot_origin_is_spread_by_its_pairs(sales, monkeypatch):
    monkeypatch.setattr(A, "GROUPS_PER_TASK", 300)
    dealt = _exchanges(A.top_pairs(sales, "a", "b", MADE, order(), 3))
    assert any("from_sk" in d and "to_sk" in d for d in dealt)


def test_no_rows(sales):
    assert A.top_pairs(sales.limit(0), "a", "b", MADE, order(), 3).count() == 0
    assert A.top_pairs(sales.filter("a IS NULL"), "a", "b", MADE, order(), 3).count() == 0


def test_the_graph_reads_facts_without_a_second_copy(spark, tmp_path):
    bed = Bed(spark, "/root/testdata/sf0.001")
    bed.wh = type(bed.wh)(spark, str(tmp_path / "bed"))
    read = {n: tables_of(bed)(n) for n in ("int_sales_unified", "int_returns_unified")}
    assert not any(bed.wh.exists("silver", n) for n in read)
    stored = {"int_sales_unified": bed.sales(), "int_returns_unified": bed.returns()}
    for name, df in read.items():
        columns = sorted(df.columns)
        assert sorted(stored[name].columns) == columns
        a, b = (sorted(map(str, x.select(*columns).collect())) for x in (df, stored[name]))
        assert a == b and a
        again = tables_of(bed)(name)  # stored by now
        assert any(name in f for f in again.inputFiles())


def test_aggregate_edges_of_the_ontology_are_cut(sales):
    onto = G.load_ontology()
    rel = onto["relationships"]["PURCHASED"]
    nodes = sales.sparkSession.range(1, 40).select(
        F.explode(F.array(*[F.struct(G.node_id(onto, c, F.col("id")).alias("node_id"), F.lit(c).alias("class_name")) for c in ("Customer", "Item")])).alias("n")
    ).select("n.*")
    source = sales.withColumnsRenamed({"a": rel["from_column"], "b": rel["to_column"]}).withColumn("net_paid", F.lit(1).cast("decimal(7,2)"))
    edges = G.aggregate_edges(onto, "PURCHASED", source, nodes)
    assert edges.groupBy("from_node_id").count().agg(F.max("count")).first()[0] == rel["top_n"]
