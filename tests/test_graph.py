import json

import pytest
from pyspark.sql import functions as F

from marketloom.operators.quality import graph_suite, run_checks
from marketloom.plans import graph as G
from marketloom.specs import TABLES, silver_schema

ONTO = G.load_ontology()
BASE = {c: (c << 40) + (1 << 31) for c in range(1, 16)}  # node id of key 0


def table(spark, name, *rows):
    schema = silver_schema(name)
    base = dict.fromkeys(schema.fieldNames())
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


@pytest.fixture(scope="module")
def silver(spark):
    frames = {s.silver_name: table(spark, t) for t, s in TABLES.items() if s.kind == "dim"}
    frames["dim_customer"] = table(
        spark, "customer",
        dict(c_customer_sk=1, c_customer_id="A", c_first_name="Ann", c_current_addr_sk=10, c_current_hdemo_sk=20),
        dict(c_customer_sk=2, c_customer_id="B", c_current_addr_sk=99, c_current_hdemo_sk=20),  # no such address
        dict(c_customer_sk=3, c_customer_id="C"), dict(c_customer_id="no key"))
    frames["dim_customer_address"] = table(spark, "customer_address", dict(ca_address_sk=10, ca_city="X"))
    frames["dim_household_demographics"] = table(
        spark, "household_demographics", dict(hd_demo_sk=20, hd_income_band_sk=5, hd_buy_potential="hi"))
    frames["dim_income_band"] = table(
        spark, "income_band", dict(ib_income_band_sk=5, ib_lower_bound=1), dict(ib_income_band_sk=6, ib_lower_bound=1, ib_upper_bound=2))
    frames["dim_item"] = table(spark, "item", *[dict(i_item_sk=i, i_item_id=f"I{i}", i_product_name="p" if i < 3 else None)
                                                for i in range(8)])
    sales = [("store", 1, i, o) for i in range(7) for o in range(i)] + [("web", 1, 6, 1), ("store", 2, 1, 50), ("store", 3, 1, 51),
             ("store", 2, 2, 52), ("store", None, 1, 53), ("store", 1, 77, 54)]
    frames["int_sales_unified"] = spark.createDataFrame(sales, "channel string, customer_sk int, item_sk int, order_number int") \
        .withColumn("quantity", F.lit(1)).withColumn("net_paid", F.lit("2.50").cast("decimal(7,2)"))
    frames["fact_store_sales"] = table(spark, "store_sales")
    frames["int_returns_unified"] = spark.createDataFrame([], "customer_sk int, reason_sk int, return_amt decimal(7,2)")
    return frames


@pytest.fixture(scope="module")
def graph(spark, silver):
    nodes = G.build_nodes(ONTO, silver.__getitem__).cache()
    return nodes, G.build_edges(ONTO, silver.__getitem__, nodes).cache()


def test_nodes(graph):
    rows = {(r.class_name, r.source_sk): r for r in graph[0].collect()}
    assert len(rows) == 3 + 1 + 1 + 2 + 8  # the customer without a key is no node
    assert rows["Customer", 1].label == "Ann " and rows["Customer", 1].natural_id == "A"
    assert json.loads(rows["Customer", 1].properties) == {"first_name": "Ann"}  # NULLs dropped
    assert rows["IncomeBand", 5].label is None and rows["IncomeBand", 6].label == "1-2"
    assert rows["HouseholdDemographics", 20].label == "buy:hi" and rows["Item", 5].label == "I5"
    assert rows["Item", 5].node_id == BASE[6] + 5


def test_fk_edges_need_both_ends(graph):
    e = graph[1].filter("relationship_name = 'LIVES_AT'").collect()
    assert [(r.from_node_id, r.to_node_id, r.properties) for r in e] == [(BASE[1] + 1, BASE[2] + 10, "{}")]


def test_top_five_by_order_count(graph):
    e = graph[1].filter(f"relationship_name = 'PURCHASED' and from_node_id = {BASE[1] + 1}")
    found = {r.to_node_id - BASE[6]: json.loads(r.properties) for r in e.collect()}
    assert set(found) == {2, 3, 4, 5, 6}
    assert found[6] == {"order_count": 7, "quantity": 7, "net_paid": 17.5}  # order 1 counts in store and web


def test_counts_and_checks(spark, graph):
    counts = {(r.kind, r.name): r.n for r in G.graph_counts(*graph).collect()}
    assert counts["edge", "IN_HOUSEHOLD"] == 2 and counts["edge", "IN_INCOME_BAND"] == 1
    classes, rels = G.ontology_tables(spark, ONTO)
    assert (classes.count(), rels.count()) == (15, 7)
    frames = {"node": graph[0], "edge": graph[1], "ontology_class": classes, "ontology_relationship": rels}
    assert run_checks(lambda _, t: frames[t], graph_suite()).filter("status <> 'pass'").count() == 0
    assert G.class_summary(graph[0], ONTO).filter("class_name = 'Store'").first().n == 0


def test_questions(graph):
    top = G.top_customers(*graph, n=2).collect()
    assert {(r.customer_name, float(r.total_net_paid)) for r in top} == {("Ann ", 52.5), (" ", 5.0)}
    assert [(r.product_name, r.pairs) for r in G.co_purchase(*graph).collect()] == [("p", 2)]
    assert len(G.match_edges(*graph, "PURCHASED", 3).collect()) == 3
    chain = G.customer_chain(graph[1]).collect()
    assert [(r.customer & 255, r.income_band & 255) for r in chain] == [(1, 5)]
    assert [r.source_sk for r in G.nodes_where(graph[0], "Item", {"product_name": "p"}).orderBy("source_sk").collect()] == [0, 1, 2]


def test_sample_two_hops(graph):
    ids = {r.node_id for r in G.sample_nodes(graph[1], ONTO, top=1).collect()}
    assert ids == {BASE[1] + 1, BASE[2] + 10, BASE[4] + 20, BASE[5] + 5} | {BASE[6] + i for i in range(2, 7)}
    nodes, edges = G.restrict(*graph, G.sample_nodes(graph[1], ONTO, top=1))
    assert (nodes.count(), edges.count()) == (9, 8)


def test_refresh_keeps_vanished_nodes(spark, silver, graph):
    changed = dict(silver)
    changed["dim_customer"] = table(spark, "customer", dict(c_customer_sk=1, c_customer_id="A", c_first_name="Eve"))
    nodes, edges = G.merge_graph(graph, (n := G.build_nodes(ONTO, changed.__getitem__),
                                         G.build_edges(ONTO, changed.__getitem__, n)), ONTO)
    labels = {r.node_id: r.label for r in nodes.filter("class_name = 'Customer'").collect()}
    assert labels == {BASE[1] + 1: "Eve ", BASE[1] + 2: " ", BASE[1] + 3: " "}
    assert edges.count() == graph[1].count()


def test_build_and_export(spark, wh, silver, tmp_path):
    counts = G.build_graph(wh, ONTO, silver.__getitem__)
    assert counts["node", "Item"] == 8
    assert G.build_graph(wh, ONTO, silver.__getitem__, upsert=True) == counts
    nodes, edges = wh.read("graph", "node"), wh.read("graph", "edge")
    done = G.export_graph(nodes, edges, ONTO, str(tmp_path / "x"), mode="full", node_batch=3)
    assert {(r.kind, r.name): r.n for r in done.collect()}["nodes", "Item"] == 8
    assert len(list((tmp_path / "x/nodes/Item").glob("part-*"))) >= 3  # at most 3 nodes per file
    with pytest.raises(ValueError, match="unknown mode"):
        G.export_graph(nodes, edges, ONTO, "x", mode="half")


def test_unknown_kind(graph):
    bad = {"classes": ONTO["classes"], "relationships": {"R": {"kind": "odd", "from": "Item", "to": "Item"}}}
    with pytest.raises(ValueError, match="unknown relationship kind"):
        G.build_edges(bad, {}.get, graph[0])
