import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators.keysets import key_set, members, missing, non_members
from marketloom.operators.quality import Check, foreign_key, reference_suite, run_checks
from marketloom.specs import TABLES


def frame(spark, values, kind="bigint"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, n int")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


CASES = {
    "dense": list(range(1000)),
    "scattered": [random.Random(1).randrange(-(1 << 62), 1 << 62) for _ in range(500)],
    "edges": [-(1 << 63), (1 << 63) - 1, -1, 0, 63, 64, -64, -65],
    "repeated": [5, 5, 5, None, None, 7],
    "empty": [],
}


@pytest.mark.parametrize("limit", [128 << 20, 0])
@pytest.mark.parametrize("case", CASES)
def test_members_and_the_rest_are_exact(spark, case, limit):
    keys = CASES[case]
    near = {k + d for k in keys if k is not None for d in (-64, -1, 0, 1, 64) if -(1 << 63) <= k + d < 1 << 63}
    probes = [None, None, 3, *sorted(near)]
    held = key_set(frame(spark, keys), "k", limit)
    rows = frame(spark, probes)
    inside = sorted(r.n for r in members(rows, "k", held).collect())
    outside = sorted(r.n for r in non_members(rows, "k", held).collect())
    want = {k for k in keys if k is not None}
    assert inside == [i for i, p in enumerate(probes) if p in want]
    assert outside == [i for i, p in enumerate(probes) if p not in want]


def test_close_keys_share_words(spark):
    assert key_set(spark.range(64 * 100), "id").n_words == 100
    assert key_set(spark.range(0, 64 * 100, 64), "id").n_words == 100
    assert key_set(frame(spark, [1, 2, 70, 1], "int"), "k").n_words == 2


def test_size_decides_what_is_sent(spark):
    rows = frame(spark, range(10))
    small, large = key_set(spark.range(1000), "id"), key_set(spark.range(1000), "id", 0)
    assert small.is_small and not large.is_small
    assert key_set(spark.range(0), "id", 0).is_small  # nothing to send
    hinted = members(rows, "k", small)
    assert "strategy=broadcast" in plan_of(hinted)[0] and "BroadcastHashJoin" in plan_of(hinted)[1]
    assert "strategy=broadcast" not in plan_of(members(rows, "k", large))[0]


def test_columns_of_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        key_set(spark.createDataFrame([("a",)], "k string"), "k")
    with pytest.raises(TypeError):
        members(spark.createDataFrame([("1",)], "k string"), "k", key_set(spark.range(3), "id"))


def test_one_set_restricts_two_columns_of_its_own_rows(spark):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("twice"))
    held = key_set(rows, "id")
    both = members(members(rows, "id", held), "twice", held)
    assert sorted(r.id for r in both.collect()) == list(range(50))


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_foreign_key_in_every_form(spark, kind):
    hot = [7] * 1000 + [3] * 10 + [None] * 5 + [8]
    child = frame(spark, [v if v is None or kind != "string" else str(v) for v in hot], kind)
    parent = spark.createDataFrame([(str(v) if kind == "string" else v,) for v in (3, 8, 8)], f"p {kind}")
    assert foreign_key(child, "k", parent, "p").collect()[0].failures == 1000
    if kind != "string":
        assert foreign_key(child, "k", parent, "p", key_set(parent, "p", 0)).collect()[0].failures == 1000
        assert "Exchange hashpartitioning" not in foreign_key(child, "k", parent, "p")._jdf.queryExecution().toString()
    nothing = parent.filter("false")
    assert foreign_key(child, "k", nothing, "p").collect()[0].failures == 1011
    assert foreign_key(child.filter("false"), "k", parent, "p").collect()[0].failures == 0


def test_all_columns_are_counted_in_one_pass(spark):
    rows = spark.createDataFrame([(1, 5, 1), (None, 6, 2), (9, None, 3), (9, 200, 4)], "a int, b bigint, w int")
    few, many = key_set(spark.range(5), "id"), key_set(spark.range(100), "id")
    none = key_set(spark.range(0), "id")
    found = missing(rows, [("a few", "a", few), ("b many", "b", many), ("a many", "a", many), ("w none", "w", none)])
    assert {r.name: r.failures for r in found.collect()} == {"a few": 2, "b many": 1, "a many": 0, "w none": 4}
    assert {r.failures for r in missing(rows.filter("false"), [("a", "a", few)]).collect()} == {0}
    assert str(found._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 5  # the rows once, four sets
    with pytest.raises(ValueError):
        missing(rows, [("a", "a", key_set(spark.range(5), "id", 0))])


def test_references_of_facts(spark):
    names = {c.columns[0]: c.parent[1:] for t in TABLES for c in reference_suite(t)}
    assert names["cs_ship_hdemo_sk"] == ("dim_household_demographics", "hd_demo_sk")
    assert names["sr_returned_date_sk"] == (TABLES["date_dim"].silver_name, "d_date_sk")
    assert set(names) == {c for s in TABLES.values() if s.kind == "fact" for c in s.columns if c.endswith("_sk")}
    frames = {"f": spark.createDataFrame([(1, "x"), (4, "y"), (None, None)], "k int, s string"), "p": spark.createDataFrame(
        [(1, "x"), (2, "z")], "id bigint, name string")}
    suite = [Check("foreign_key", "t", "f", ("k",), parent=("t", "p", "id")),
             Check("foreign_key", "t", "f", ("s",), parent=("t", "p", "name"))]
    found = {r.test_name: (r.status, r.failures) for r in run_checks(lambda _, t: frames[t], suite).collect()}
    assert found == {"foreign_key_t_f_k": ("fail", 1), "foreign_key_t_f_s": ("fail", 1)}
