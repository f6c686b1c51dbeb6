"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.store import stored


#: A hot key is dealt to so many places; one with fewer rows to as many as it has rows.
SALTS = 1024


def split_join(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """``rows.join(table, key)`` for a table of one row per key, where a key may hold most rows.

    Rows are dealt by the key and a hash of the column ``by``; the table's row is repeated for the
    hashes that occur with its key, ``SALTS`` at most. Nulls in ``key`` are dropped, as a join does.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    places = salted.select(key, "_salt").distinct().join(table, key)
    return salted.join(places, [key, "_salt"]).drop("_salt")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return split_join(both.filter("b > a"), low, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = split_join(down, low, "a", "b").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return low.select("a", F.col("m").alias("b")).union(moved)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and those have none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Every round links nodes to smaller ones and is written to the shared folder, until the edges
    are stars around the roots; the edges of a node with many are split over tasks. Self loops and repeated edges are allowed, nulls are not.
    """
    now = stored(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_stars(now):
        now = stored(_small(stored(_large(now), "edges")).distinct(), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
