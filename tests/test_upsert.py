"""Upsert by buckets: what is written, null keys, partitions, racing writers."""

from marketloom.sources import sinks as S
from marketloom.sources.upsert import Upserted, upsert
from marketloom.warehouse import Warehouse

SCHEMA = "k long, kind string, v string, w int"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def stored(wh):
    return sorted(map(tuple, wh.read("silver", "t").select("k", "kind", "v", "w").collect()), key=str)


def test_only_touched_buckets_are_written(spark, wh):
    values = [(i, "ab"[i % 2], f"v{i}", None) for i in range(500)]
    first = upsert(wh, rows(spark, values), "silver", "t", ["k"], ["kind"])
    assert first.changed == 500 and len(first.touched) == 32
    before = set(wh.folders("silver", "t"))
    assert upsert(wh, rows(spark, values), "silver", "t", ["k"], ["kind"]) == Upserted(0, ())
    assert set(wh.folders("silver", "t")) == before
    one = upsert(wh, rows(spark, [(7, "b", "new", None), (9, "b", "v9", None)]), "silver", "t", ["k"], ["kind"])
    assert one.changed == 1 and len(one.touched) == 1 and one.touched[0].startswith("kind=b/_bucket=16-")
    after = set(wh.folders("silver", "t"))
    assert len(after - before) == 1 and len(before - after) == 1
    assert stored(wh) == sorted([v if v[0] != 7 else (7, "b", "new", None) for v in values], key=str)


def test_null_keys_and_null_values(spark, wh):
    upsert(wh, rows(spark, [(None, "a", "x", 1), (1, "a", None, 2)]), "silver", "t", ["k"], buckets=4)
    assert upsert(wh, rows(spark, [(None, "a", "x", 1), (1, "a", None, 2)]), "silver", "t", ["k"]).changed == 0
    assert upsert(wh, rows(spark, [(None, "a", "y", 1), (1, None, "a", 2)]), "silver", "t", ["k"]).changed == 2
    assert stored(wh) == [(1, None, "a", 2), (None, "a", "y", 1)]


def test_odd_partition_values(spark, wh):
    values = [(1, "a=b/c", "x", 1), (2, None, "y", 2), (3, "50%", "z", 3), (4, "two words", "u", 4)]
    upsert(wh, rows(spark, values), "silver", "t", ["k"], ["kind"], buckets=2)
    done = upsert(wh, rows(spark, [(k, p, v + "!", w) for k, p, v, w in values]), "silver", "t", ["k"], ["kind"])
    assert done.changed == 4 and stored(wh) == sorted([(k, p, v + "!", w) for k, p, v, w in values], key=str)


def test_rows_that_are_only_added(spark, wh):
    from pyspark.sql import functions as F

    upsert(wh, rows(spark, [(1, "a", "old", 1), (2, "b", "old", 1)]), "silver", "t", ["k"])
    new = rows(spark, [(1, "a", "new", 1), (2, "b", "new", 1), (3, "a", "new", 1)])
    assert upsert(wh, new, "silver", "t", ["k"], only_added=F.col("kind") == "a").changed == 2
    assert [r[2] for r in stored(wh)] == ["old", "new", "new"]


def test_two_writers_of_one_bucket(spark, wh, monkeypatch):
    """The slower one sees that its bucket has changed, and starts again."""
    upsert(wh, rows(spark, [(1, "a", "x", 1), (2, "a", "x", 1)]), "silver", "t", ["k"], buckets=1)
    other, commit, busy = Warehouse(spark, wh.root), wh.commit, []

    def slow(base, change):
        if not busy:
            busy.append(1)
            upsert(other, rows(spark, [(2, "a", "other", 1)]), "silver", "t", ["k"])
        return commit(base, change)

    monkeypatch.setattr(wh, "commit", slow)
    upsert(wh, rows(spark, [(1, "a", "mine", 1)]), "silver", "t", ["k"])
    assert stored(wh) == [(1, "a", "mine", 1), (2, "a", "other", 1)]


def test_a_reader_of_the_old_table_keeps_its_files(spark, wh):
    upsert(wh, rows(spark, [(1, "a", "x", 1)]), "silver", "t", ["k"], buckets=1)
    before = wh.read("silver", "t")
    upsert(wh, rows(spark, [(1, "a", "y", 1)]), "silver", "t", ["k"])
    assert before.first()["v"] == "x"
    upsert(wh, rows(spark, [(1, "a", "z", 1)]), "silver", "t", ["k"])
    assert len([n for n in wh.files.names(wh.path("silver", "t")) if n.startswith("_version=")]) <= 3


def test_whole_table_results_with_null_keys(spark):
    old, new = rows(spark, [(None, "a", "x", 1), (1, "a", "x", 1)]), rows(spark, [(None, "b", "y", 2), (2, "b", "y", 2)])
    merged = sorted((tuple(r) for r in S.merge_by_key(old, new, ["k"]).collect()), key=str)
    assert merged == [(1, "a", "x", 1), (2, "b", "y", 2), (None, "b", "y", 2)]
    added = sorted((tuple(r) for r in S.insert_missing(old, new, ["k"]).collect()), key=str)
    assert added == [(1, "a", "x", 1), (2, "b", "y", 2), (None, "a", "x", 1)]
