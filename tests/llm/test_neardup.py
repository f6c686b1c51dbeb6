import numpy as np
import pyarrow as pa
from helpers import MIDDLE, SENTENCE, components, edge_docs, empty_docs, shingles, similar_pairs, table
from pyspark.sql import functions as F

from marketloom.llm import neardup
from marketloom.llm import components as stars
from marketloom.llm.components import components as spark_components
from marketloom.llm.components import split_join


def expected(rows):
    sets = [shingles(r["text"]) for r in rows]
    label = components(len(rows), similar_pairs(sets))
    least = {}
    for r, c in zip(rows, label, strict=True):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    return sorted(
        (str(r["doc_id"]), len(s), str(least.get(c) if s else r["doc_id"]))
        for r, s, c in zip(rows, sets, label, strict=True))


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)


def test_all_documents_against_brute_force(spark):
    docs = table(spark, MIDDLE, "documents")
    assert found(neardup.near_duplicates(docs)) == expected(docs.collect())


def test_edges(spark):
    docs = edge_docs(spark)
    assert found(neardup.near_duplicates(docs)) == expected(docs.collect())
    assert neardup.near_duplicates(empty_docs(spark)).collect() == []


def near_copies(spark, n, words=120):
    """One group of near copies, chains of them, and texts that share a passage."""
    import random

    r = random.Random(5)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        w[r.randrange(words)] = f"new{i}"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(words)]
    for i in range(40):
        chain = [*chain[3:], f"d{i}", f"e{i}", f"f{i}"]
        rows.append((n + i, " ".join(chain)))
    for i in range(200):
        rows.append((n + 100 + i, " ".join([*base[:40], *(f"g{i}-{k}" for k in range(80))])))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_large_groups_are_cut_into_blocks_and_lose_nothing(spark):
    docs = near_copies(spark, 400)
    assert found(neardup.near_duplicates(docs, block_shingles=3000)) == expected(docs.collect())


def test_large_tree_nodes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_NODE", 16)
    docs = near_copies(spark, 150)
    assert found(neardup.near_duplicates(docs)) == expected(docs.collect())


def test_threshold_is_exact(spark):
    """7 of 9 shingles shared is a link, 6 of 9 isn't; 3 of 4 is one."""
    w = [f"a{i}" for i in range(12)]  # 8 shingles
    rows = [(1, " ".join(w)), (2, " ".join([*w[:11], "z"])), (3, " ".join([*w[:10], "y", "z"])), (4, SENTENCE.upper()), (5, SENTENCE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(neardup.near_duplicates(docs)) == expected(docs.collect())


def test_components(spark):
    edges = spark.range(1, 500).select((F.col("id") - 1).alias("a"), F.col("id").alias("b")).filter("b % 100 <> 0")
    got = {r["node"]: r["root"] for r in spark_components(edges).collect()}
    assert got == {i: i // 100 * 100 for i in range(500)}
    assert spark_components(edges.filter("a < 0")).collect() == []


def test_hot_nodes(spark, monkeypatch):
    """A node of most edges, in both directions, and a chain behind it."""
    hub = spark.range(1, 4000).selectExpr("CASE WHEN id % 2 = 0 THEN id ELSE 2000 END a", "CASE WHEN id % 2 = 0 THEN 2000 ELSE id END b")
    edges = hub.union(spark.range(5000, 5050).selectExpr("id a", "id + 1 b")).union(hub.limit(10))
    for salts in (stars.SALTS, 3):
        monkeypatch.setattr(stars, "SALTS", salts)
        got = {r["node"]: r["root"] for r in spark_components(edges).collect()}
        assert got == {i: 1 for i in range(1, 4000)} | {i: 5000 for i in range(5000, 5051)}


def test_split_join_is_a_join(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 90 END k", "id v")
    rows = rows.union(rows.limit(5)).union(spark.sql("SELECT 7L, CAST(NULL AS BIGINT)"))
    table = spark.range(60).selectExpr("id k", "id * 2 x")
    want = sorted(map(str, rows.join(table, "k").select("k", "v", "x").collect()))
    assert sorted(map(str, split_join(rows, table, "k", "v").select("k", "v", "x").collect())) == want
    # Every place holds a part of the hot key only.
    spread = rows.filter("k = 7").selectExpr(f"pmod(xxhash64(v), {stars.SALTS}) s").groupBy("s").count()
    assert spread.agg({"count": "max"}).first()[0] < 20


def missed_by_trees(levels, pairs=10_000):
    """Share of pairs that agree in 48 of 64 tokens and meet at no tree node of a level, if all nodes are large."""
    rng = np.random.default_rng(7)
    left = rng.integers(0, 1 << 32, (pairs, neardup.TOKENS), dtype=np.uint32)
    right = left.copy()
    for row, other in zip(right, rng.random(left.shape).argsort(1)[:, :neardup.TOKENS // 4], strict=True):
        row[other] ^= np.uint32(0x5A5A5A5A)
    share, out = neardup.PERCENT / 100 * neardup.TOKENS, []
    paths = None  # of the nodes that both sets of a pair reach: (pair, path)
    for level in range(levels):
        first, met = level == 0, []
        own = np.arange(pairs) if first else paths[0]
        for tokens in (left, right):
            columns = [pa.array(own), pa.array([tokens[i].tobytes() for i in own], pa.binary())]
            names = ["node", "tokens"]
            if not first:
                columns, names = [*columns, pa.array(paths[1])], [*names, "path"]
            step = neardup._branch((neardup.FIRST_CHILDREN if first else neardup.CHILDREN) / share, first)
            rows = pa.Table.from_batches(step([pa.RecordBatch.from_arrays(columns, names)]))
            met.append(set(zip(rows["node"].to_pylist(), rows["path"].to_pylist(), strict=True)))
        both = sorted(met[0] & met[1])
        paths = tuple(np.array(x, np.int64) for x in zip(*both, strict=True))
        out.append(1 - len(set(paths[0].tolist())) / pairs)
    return out


def test_recall_of_large_nodes():
    """The worst case: borderline pairs, all common nodes large down to the last level."""
    assert missed_by_trees(neardup.DEPTH)[-1] < 3e-4
