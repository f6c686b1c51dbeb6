"""Knowledge graph: nodes, edges, refresh, sample, export and the fixed questions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.functions.exprs import prop
from marketloom.operators import aggregates as A
from marketloom.operators.quality import graph_suite, run_checks
from marketloom.plans import graph as G
from marketloom.queries import query
from marketloom.queries.oracle import PARTS, amount, big, oracle, part
from marketloom.session import new_folder
from marketloom.specs import TABLES
from marketloom.warehouse import Warehouse

ONTO = G.load_ontology()
_FACTS = {"int_sales_unified": "sales", "int_returns_unified": "returns"}


def tables_of(bed):
    """Silver tables by name for the graph build; channel facts and dimensions are stored."""
    raw = {s.silver_name: t for t, s in TABLES.items()}

    def table(name: str):
        if name in _FACTS:
            return bed.unified(_FACTS[name])
        return bed.silver(raw[name])

    return table


def _nodes(bed):
    bed.silver_layer([c["source_table"] for c in ONTO["classes"].values()])
    return G.build_nodes(ONTO, tables_of(bed))


def nodes_of(bed):
    def parts():
        nodes = _nodes(bed)
        return {n: nodes.filter(F.col("class_name") == n) for n in ONTO["classes"]}

    return bed.stored_parts("graph", "node", "class_name", parts)


def edges_of(bed):
    nodes = nodes_of(bed)

    def parts():
        edges = G.build_edges(ONTO, tables_of(bed), nodes)
        return {n: edges.filter(F.col("relationship_name") == n) for n in ONTO["relationships"]}

    return bed.stored_parts("graph", "edge", "relationship_name", parts)


# -- oracle parts -------------------------------------------------------------------------------------
# Label expressions of the classes.
_LABELS = {
    "Customer": "COALESCE(c_first_name, '') || ' ' || COALESCE(c_last_name, '')",
    "Address": "COALESCE(ca_city, '') || ', ' || COALESCE(ca_state, '')",
    "Demographics": "COALESCE(cd_gender, '?') || '/' || COALESCE(cd_marital_status, '?') || '/' || COALESCE(cd_education_status, '?')",
    "HouseholdDemographics": "'buy:' || COALESCE(hd_buy_potential, '?')",
    "IncomeBand": "CAST(ib_lower_bound AS VARCHAR) || '-' || CAST(ib_upper_bound AS VARCHAR)",
    "Item": "COALESCE(i_product_name, i_item_desc, i_item_id)",
    "Store": "COALESCE(s_store_name, s_store_id)",
    "CallCenter": "COALESCE(cc_name, cc_call_center_id)",
    "Warehouse": "COALESCE(w_warehouse_name, w_warehouse_id)",
    "WebSite": "COALESCE(web_name, web_site_id)",
    "WebPage": "'page:' || COALESCE(wp_web_page_id, CAST(wp_web_page_sk AS VARCHAR))",
    "CatalogPage": "COALESCE(cp_department, cp_catalog_page_id)",
    "Promotion": "COALESCE(p_promo_name, p_promo_id)",
    "ShipMode": "COALESCE(sm_type, '') || '/' || COALESCE(sm_carrier, '')",
    "Reason": "COALESCE(r_reason_desc, r_reason_id)",
}
_DIMS = {n: TABLES[c["source_table"]].silver_name for n, c in ONTO["classes"].items()}


def _id(class_name: str, sk: str) -> str:
    return f"CAST({ONTO['classes'][class_name]['id']} AS BIGINT) * 1099511627776 + 2147483648 + {sk}"


PARTS["node"] = (tuple(_DIMS.values()), " UNION ALL ".join(
    f"SELECT {_id(n, c['surrogate_key'])} AS node_id, '{n}' AS class_name, CAST({c['surrogate_key']} AS BIGINT) AS source_sk, "
    f"{c.get('natural_key', 'CAST(NULL AS VARCHAR)')} AS natural_id, {_LABELS[n]} AS label "
    f"FROM {_DIMS[n]} WHERE {c['surrogate_key']} IS NOT NULL" for n, c in ONTO["classes"].items()))


def _fk_sql(name: str) -> str:
    r = ONTO["relationships"][name]
    key = ONTO["classes"][r["from"]]["surrogate_key"]
    return (f"SELECT DISTINCT f.node_id AS from_node_id, t.node_id AS to_node_id, '{name}' AS relationship_name "
            f"FROM {_DIMS[r['from']]} s JOIN node f ON f.class_name = '{r['from']}' AND f.source_sk = s.{key} "
            f"JOIN node t ON t.class_name = '{r['to']}' AND t.source_sk = s.{r['column']}")


def _agg_sql(name: str, source: str, frm: str, to: str, first: str, rest: str, cut: bool = True) -> str:
    r = ONTO["relationships"][name]
    where = f"WHERE rn <= {r['top_n']}" if cut else ""
    return (f"SELECT f.node_id AS from_node_id, t.node_id AS to_node_id, '{name}' AS relationship_name, m1, m2, m3 "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY m1 DESC NULLS LAST, b) AS rn FROM "
            f"(SELECT {frm} AS a, {to} AS b, {first} AS m1, {rest} FROM {source} "
            f"WHERE {frm} IS NOT NULL AND {to} IS NOT NULL GROUP BY 1, 2)) e "
            f"JOIN node f ON f.class_name = '{r['from']}' AND f.source_sk = e.a "
            f"JOIN node t ON t.class_name = '{r['to']}' AND t.source_sk = e.b {where}")


_PURCHASED = ("sales", "customer_sk", "item_sk", "CAST(count(DISTINCT channel || '|' || order_number) AS BIGINT)",
              f"{big('sum(quantity)', 'm2')}, {amount('sum(net_paid)', 'm3')}")
_AGGREGATES = {
    "PURCHASED": _PURCHASED,
    "SHOPPED_AT": ("fact_store_sales", "ss_customer_sk", "ss_store_sk", "CAST(count(DISTINCT ss_ticket_number) AS BIGINT)",
                   f"CAST(NULL AS BIGINT) AS m2, {amount('sum(ss_net_paid)', 'm3')}"),
    "RETURNED": ("returns", "customer_sk", "reason_sk", "CAST(count(*) AS BIGINT)",
                 f"CAST(NULL AS BIGINT) AS m2, {amount('sum(return_amt)', 'm3')}"),
}
_MEASURES = {  # relationship -> (m1, m2, m3) property names
    "PURCHASED": ("order_count", "quantity", "net_paid"), "SHOPPED_AT": ("order_count", None, "net_paid"),
    "RETURNED": ("return_count", None, "return_amt"),
}
for _n, _r in ONTO["relationships"].items():
    if _r["kind"] == "fk":
        PARTS[_n] = (("node", _DIMS[_r["from"]]), _fk_sql(_n))
    else:
        PARTS[_n] = (("node", _AGGREGATES[_n][0]), _agg_sql(_n, *_AGGREGATES[_n]))
PARTS["edge"] = (tuple(ONTO["relationships"]), " UNION ALL ".join(
    f"SELECT from_node_id, to_node_id, relationship_name, "
    f"{'m1, m2, m3' if r['kind'] == 'aggregate' else 'CAST(NULL AS BIGINT) AS m1, CAST(NULL AS BIGINT) AS m2, CAST(NULL AS DECIMAL(18,2)) AS m3'} "
    f"FROM {n}" for n, r in ONTO["relationships"].items()))
PARTS["top_customers"] = (("PURCHASED",), """
    SELECT from_node_id AS node_id FROM PURCHASED GROUP BY from_node_id
    ORDER BY sum(m3) DESC NULLS LAST, from_node_id LIMIT 200""")
PARTS["sample"] = (("top_customers", "edge"), """
    SELECT node_id FROM top_customers
    UNION SELECT to_node_id FROM edge WHERE from_node_id IN (SELECT node_id FROM top_customers)
    UNION SELECT to_node_id FROM edge WHERE from_node_id IN (
        SELECT to_node_id FROM edge WHERE from_node_id IN (SELECT node_id FROM top_customers))""")


# -- nodes ----------------------------------------------------------------------------------------------
@query(part("node"))
def graph_nodes(bed):
    return nodes_of(bed).select("node_id", "class_name", "source_sk", "natural_id", "label")


@query(oracle("""
    SELECT i_item_sk AS source_sk, i_product_name AS product_name, i_item_desc AS description, i_category AS category,
           CAST(i_current_price AS DECIMAL(9,2)) AS current_price, i_size AS size FROM dim_item""", "dim_item"))
def item_properties(bed):
    """Node properties read back from JSON, as text and as a number."""
    return G.class_nodes(ONTO, "Item", bed.silver("item")).select(
        "source_sk", *[prop("properties", p).alias(p) for p in ("product_name", "description", "category")],
        prop("properties", "current_price", "decimal(9,2)").alias("current_price"),
        prop("properties", "size").alias("size"))


@query(oracle("SELECT DISTINCT class_name, class_name AS export_label FROM node", "node"))
def export_labels(bed):
    return G.labels_of(nodes_of(bed))


# -- edges ------------------------------------------------------------------------------------------------
def _register_edges(name: str) -> None:
    measures = _MEASURES.get(name)

    @query(part(name), name=f"edges_{name.lower()}")
    def edges(bed):
        found = G.relationship_edges(ONTO, name, tables_of(bed), nodes_of(bed))
        if not measures:
            return found.drop("properties")
        kinds = ("bigint", "bigint", "decimal(18,2)")
        return found.select(
            "from_node_id", "to_node_id", "relationship_name",
            *[(prop("properties", m, k) if m else F.lit(None).cast(k)).alias(f"m{i}")
              for i, (m, k) in enumerate(zip(measures, kinds), 1)])


for _n in ONTO["relationships"]:
    _register_edges(_n)


@query(oracle(_agg_sql("PURCHASED", *_PURCHASED, cut=False).replace(", m1, m2, m3", "", 1), "node", "sales"))
def edges_unbounded(bed):
    """Aggregate edges without a cut per customer."""
    onto = {"classes": ONTO["classes"], "relationships": {
        "PURCHASED": {**ONTO["relationships"]["PURCHASED"], "top_n": None}}}
    return G.aggregate_edges(onto, "PURCHASED", bed.sales(), nodes_of(bed)).drop("properties")


@query(oracle(f"""SELECT customer_sk AS from_sk, reason_sk AS to_sk, {big('count(*)', 'n')}, {amount('sum(return_amt)', 'amt')}
    FROM returns WHERE customer_sk IS NOT NULL AND reason_sk IS NOT NULL GROUP BY ALL""", "returns"))
def pair_aggregate(bed):
    return A.pair_aggregate(bed.returns(), "customer_sk", "reason_sk", {
        "n": "count(1)", "amt": "cast(sum(return_amt) as decimal(18,2))"})


@query(oracle("""
    SELECT relationship_name, f.class_name AS from_class, f.source_sk AS from_sk, f.label AS from_label,
           t.class_name AS to_class, t.source_sk AS to_sk, t.label AS to_label
    FROM edge JOIN node f ON f.node_id = from_node_id JOIN node t ON t.node_id = to_node_id""", "edge", "node"))
def edge_view(bed):
    return G.edge_view(nodes_of(bed), edges_of(bed)).select(
        "relationship_name", "from_class", "from_sk", "from_label", "to_class", "to_sk", "to_label")


@query(oracle("""
    SELECT relationship_name, f.class_name AS from_class, f.source_sk AS from_sk, t.class_name AS to_class,
           t.source_sk AS to_sk
    FROM edge JOIN node f ON f.node_id = from_node_id JOIN node t ON t.node_id = to_node_id""", "edge", "node"))
def edge_keys(bed):
    return G.edge_keys(ONTO, edges_of(bed)).drop("properties")


# -- refresh ------------------------------------------------------------------------------------------------
@query(oracle("SELECT node_id, CASE WHEN source_sk % 2 = 0 THEN label ELSE 'old ' || label END AS label FROM node "
              "WHERE source_sk % 3 > 0 OR source_sk % 2 = 0", "node"))
def merge_nodes(bed):
    """Upsert over all classes: refreshed nodes get their label back, other old ones stay."""
    nodes = nodes_of(bed)
    old = nodes.filter("source_sk % 3 > 0").withColumn("label", F.concat(F.lit("old "), "label"))
    return G.merge_nodes(old, nodes.filter("source_sk % 2 = 0")).select("node_id", "label")


_FKS = ", ".join(f"'{n}'" for n, r in ONTO["relationships"].items() if r["kind"] == "fk")


@query(oracle(f"""
    SELECT from_node_id, to_node_id, relationship_name,
           CASE WHEN relationship_name IN ({_FKS}) THEN from_node_id % 3 > 0 ELSE from_node_id % 2 > 0 END AS is_stale
    FROM edge WHERE from_node_id % 3 > 0 OR from_node_id % 2 = 0""", "edge"))
def merge_edges(bed):
    """Refresh over all relationships, where stored properties are stale: foreign-key edges are
    only added, aggregate edges replaced."""
    edges = edges_of(bed)
    stale = edges.filter("from_node_id % 3 > 0").withColumn("properties", F.lit("stale"))
    return G.merge_edges(stale, edges.filter("from_node_id % 2 = 0"), ONTO).select(
        "from_node_id", "to_node_id", "relationship_name", (F.col("properties") == "stale").alias("is_stale"))


@query(oracle("SELECT class_name, description <> '' AS described, surrogate_key, kind, from_class, to_class FROM (VALUES "
              + ", ".join(f"('{n}', 'x', '{c['surrogate_key']}', NULL, NULL, NULL)" for n, c in ONTO["classes"].items()) + ", "
              + ", ".join(f"('{n}', 'x', NULL, '{r['kind']}', '{r['from']}', '{r['to']}')" for n, r in ONTO["relationships"].items())
              + ") t(class_name, description, surrogate_key, kind, from_class, to_class) WHERE EXISTS (SELECT 1 FROM node)", "node"))
def ontology_tables(bed):
    """Class and relationship tables as a graph build stores them."""
    wh = Warehouse(bed.spark, new_folder(bed.spark, "graph"))
    bed.silver_layer()
    G.build_graph(wh, ONTO, tables_of(bed))
    none = F.lit(None).cast("string")
    described = (F.col("description") != "").alias("described")
    return wh.read("graph", "ontology_class").select(
        "class_name", described, "surrogate_key", none.alias("kind"), none.alias("from_class"), none.alias("to_class")
    ).union(wh.read("graph", "ontology_relationship").select(
        "name", described, none.alias("surrogate_key"), "kind", "from_class", "to_class"))


@query(oracle("SELECT -CAST(c_customer_sk AS BIGINT) AS from_sk, -CAST(c_current_addr_sk AS BIGINT) AS to_sk, "
              "'Customer' AS from_class, 'Address' AS to_class FROM dim_customer "
              "JOIN dim_customer_address ON ca_address_sk = c_current_addr_sk", "dim_customer", "dim_customer_address"))
def edges_of_negative_keys(bed):
    """Edges between nodes whose keys are below zero, each source row twice."""
    customer, address = bed.silver("customer"), bed.silver("customer_address")
    below = lambda df, *keys: df.withColumns({k: -F.col(k) for k in keys})
    source = below(customer, "c_customer_sk", "c_current_addr_sk")
    nodes = G.class_nodes(ONTO, "Customer", source).unionByName(
        G.class_nodes(ONTO, "Address", below(address, "ca_address_sk")))
    edges = G.fk_edges(ONTO, "LIVES_AT", source.union(source), nodes)
    return G.edge_keys(ONTO, edges).select("from_sk", "to_sk", "from_class", "to_class")


# -- sample and export ----------------------------------------------------------------------------------------
@query(part("sample"))
def sample_nodes(bed):
    return G.sample_nodes(edges_of(bed), ONTO)


@query(oracle("""
    SELECT relationship_name, from_node_id, to_node_id FROM edge
    SEMI JOIN sample a ON a.node_id = from_node_id SEMI JOIN sample b ON b.node_id = to_node_id""",
    "edge", "sample", once=("sales", "returns", "node", "edge", "sample")))
def sample_edges(bed):
    edges = edges_of(bed)
    return G.restrict(nodes_of(bed), edges, G.sample_nodes(edges, ONTO))[1].drop("properties")


@query(oracle("SELECT DISTINCT to_node_id AS node_id FROM edge WHERE from_node_id IN "
              "(SELECT node_id FROM node WHERE class_name = 'HouseholdDemographics')", "edge", "node"))
def hop_out(bed):
    seed = nodes_of(bed).filter("class_name = 'HouseholdDemographics'")
    return G.hop_out(seed, edges_of(bed))


_EXPORTED = """
    SELECT 'nodes' AS kind, class_name AS name, count(*) AS n FROM node WHERE {n} GROUP BY class_name
    UNION ALL SELECT 'edges', relationship_name, count(*) FROM edge WHERE {e} GROUP BY relationship_name"""


@query(oracle(_EXPORTED.format(n="true", e="true"), "node", "edge"))
def export_full(bed):
    return G.export_graph(nodes_of(bed), edges_of(bed), ONTO, new_folder(bed.spark, "export"), mode="full")


@query(oracle(_EXPORTED.format(
    n="node_id IN (SELECT node_id FROM sample)",
    e="from_node_id IN (SELECT node_id FROM sample) AND to_node_id IN (SELECT node_id FROM sample)"), "node", "edge", "sample",
    once=("sales", "returns", "node", "edge", "sample")))
def export_sample(bed):
    return G.export_graph(nodes_of(bed), edges_of(bed), ONTO, new_folder(bed.spark, "export"), mode="sample")


@query(oracle("SELECT *, true AS bounded, true AS ordered FROM (" + _EXPORTED.format(n="true", e="true") + ")", "node", "edge"))
def export_manifest(bed):
    """Files of a full export by its manifest: their rows, none above the bound, ranges of keys that don't overlap."""
    path = new_folder(bed.spark, "export")
    G.export_graph(nodes_of(bed), edges_of(bed), ONTO, path, mode="full")
    files = G.read_manifest(bed.spark, path)
    before = F.max("last").over(Window.partitionBy("kind", "name").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    bound = F.when(F.col("kind") == "nodes", G.NODE_BATCH).otherwise(G.EDGE_BATCH)
    return files.withColumn("apart", F.coalesce(before <= F.col("first"), F.lit(True))).groupBy("kind", "name").agg(
        F.sum("rows").alias("n"), F.bool_and(F.col("rows") <= bound).alias("bounded"), F.bool_and("apart").alias("ordered"))


@query(oracle("""
    SELECT 'Store' AS node_class, CAST(s_store_sk AS BIGINT) AS source_sk, COALESCE(s_store_name, s_store_id) AS label,
           s_store_id AS natural_id, s_store_name AS store_name, s_city AS city, s_state AS state, s_zip AS zip,
           s_manager AS manager, CAST(s_number_employees AS BIGINT) AS number_employees,
           CAST(s_floor_space AS BIGINT) AS floor_space FROM dim_store""", "dim_store"))
def flatten_nodes(bed):
    return G.flatten_nodes(ONTO, nodes_of(bed), "Store")


@query(oracle("""
    SELECT 'Customer' AS from_class, f.source_sk AS from_sk, 'Item' AS to_class, t.source_sk AS to_sk,
           CAST(m1 AS DOUBLE) AS order_count, CAST(m2 AS DOUBLE) AS quantity, CAST(m3 AS DOUBLE) AS net_paid
    FROM PURCHASED JOIN node f ON f.node_id = from_node_id JOIN node t ON t.node_id = to_node_id""", "PURCHASED", "node"))
def flatten_edges(bed):
    return G.flatten_edges(ONTO, edges_of(bed), "PURCHASED")


# -- questions -----------------------------------------------------------------------------------------------
@query(oracle("""
    SELECT node_id, label AS customer_name, CAST(sum(m3) AS DECIMAL(18,2)) AS total_net_paid
    FROM PURCHASED JOIN node ON node_id = from_node_id GROUP BY node_id, label
    ORDER BY 3 DESC NULLS LAST, 1 LIMIT 5""", "PURCHASED", "node"))
def top_customers(bed):
    return G.top_customers(nodes_of(bed), edges_of(bed)).withColumn(
        "total_net_paid", F.col("total_net_paid").cast("decimal(18,2)"))


@query(oracle("SELECT CAST(s_store_sk AS BIGINT) AS source_sk, COALESCE(s_store_name, s_store_id) AS label "
              "FROM dim_store WHERE s_state = 'CA'", "dim_store"))
def stores_in_state(bed):
    return G.nodes_where(nodes_of(bed), "Store", {"state": "CA"}).select("source_sk", "label")


@query(oracle("""
    SELECT f.label AS from_label, t.label AS to_label, e.from_node_id, e.to_node_id FROM (
        SELECT * FROM PURCHASED ORDER BY from_node_id, to_node_id LIMIT 50) e
    JOIN node f ON f.node_id = e.from_node_id JOIN node t ON t.node_id = e.to_node_id""", "PURCHASED", "node"))
def match_edges(bed):
    return G.match_edges(nodes_of(bed), edges_of(bed), "PURCHASED").select(
        "from_label", "to_label", "from_node_id", "to_node_id")


@query(oracle("""
    SELECT i_product_name AS product_name, count(*) AS pairs
    FROM PURCHASED a JOIN PURCHASED b ON a.to_node_id = b.to_node_id AND a.from_node_id < b.from_node_id
    JOIN node n ON n.node_id = a.to_node_id JOIN dim_item ON i_item_sk = n.source_sk
    GROUP BY i_product_name ORDER BY pairs DESC, product_name NULLS LAST LIMIT 10""", "PURCHASED", "node", "dim_item"))
def co_purchase(bed):
    return G.co_purchase(nodes_of(bed), edges_of(bed))


@query(oracle("""
    SELECT a.from_node_id AS customer, a.to_node_id AS address, h.to_node_id AS household, b.to_node_id AS income_band
    FROM LIVES_AT a JOIN IN_HOUSEHOLD h ON h.from_node_id = a.from_node_id
    JOIN IN_INCOME_BAND b ON b.from_node_id = h.to_node_id ORDER BY 1, 2, 3, 4 LIMIT 20""",
    "LIVES_AT", "IN_HOUSEHOLD", "IN_INCOME_BAND"))
def customer_chain(bed):
    return G.customer_chain(edges_of(bed))


@query(oracle("""
    SELECT 'node' AS kind, class_name AS name, count(*) AS n FROM node GROUP BY class_name
    UNION ALL SELECT 'edge', relationship_name, count(*) FROM edge GROUP BY relationship_name""", "node", "edge"))
def graph_counts(bed):
    return G.graph_counts(nodes_of(bed), edges_of(bed))


@query(oracle("SELECT c.name AS class_name, c.source_table, CAST(count(n.node_id) AS BIGINT) AS n FROM (VALUES "
              + ", ".join(f"('{n}', '{t}')" for n, t in _DIMS.items())
              + ") c(name, source_table) LEFT JOIN node n ON n.class_name = c.name GROUP BY ALL", "node"))
def class_summary(bed):
    return G.class_summary(nodes_of(bed), ONTO).drop("description")


@query(oracle("SELECT r.*, CAST(count(e.from_node_id) AS BIGINT) AS n FROM (VALUES "
              + ", ".join(f"('{n}', '{r['from']}', '{r['to']}', '{r['kind']}')" for n, r in ONTO["relationships"].items())
              + ") r(name, from_class, to_class, kind) LEFT JOIN edge e ON e.relationship_name = r.name GROUP BY ALL", "edge"))
def relationship_summary(bed):
    return G.relationship_summary(edges_of(bed), ONTO).drop("description")


# -- whole classes and relationships, flattened ---------------------------------------------------------------
def _register_flat(name: str) -> None:
    spec = ONTO["classes"][name]
    types = TABLES[spec["source_table"]].types
    plain = {"int": "BIGINT", "decimal(7,2)": "DOUBLE"}
    columns = {"node_class": f"'{name}'", "source_sk": f"CAST({spec['surrogate_key']} AS BIGINT)", "label": _LABELS[name],
               "natural_id": spec.get("natural_key", "CAST(NULL AS VARCHAR)")}
    columns |= {p: f"CAST({c} AS {plain.get(types[c].simpleString(), 'VARCHAR')})" for p, c in spec["properties"].items()}

    @query(oracle(f"SELECT {', '.join(f'{c} AS {n}' for n, c in columns.items())} FROM {_DIMS[name]} "
                  f"WHERE {spec['surrogate_key']} IS NOT NULL", _DIMS[name]), name=f"flatten_nodes_{name.lower()}")
    def flat(bed):
        return G.flatten_nodes(ONTO, nodes_of(bed), name)


def _register_flat_edges(name: str) -> None:
    measures = [(f"m{i}", m) for i, m in enumerate(_MEASURES.get(name, ()), 1) if m]
    more = "".join(f", CAST({c} AS DOUBLE) AS {m}" for c, m in measures)

    @query(oracle(f"SELECT f.class_name AS from_class, f.source_sk AS from_sk, t.class_name AS to_class, t.source_sk AS to_sk{more} "
                  f"FROM {name} JOIN node f ON f.node_id = from_node_id JOIN node t ON t.node_id = to_node_id", name, "node"),
           name=f"flatten_edges_{name.lower()}")
    def flat(bed):
        return G.flatten_edges(ONTO, edges_of(bed), name)


for _n in ONTO["classes"]:
    _register_flat(_n)
for _n in ONTO["relationships"]:
    _register_flat_edges(_n)


# -- integrity ------------------------------------------------------------------------------------------------
def _count(table: str, where: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


_FAILURES = dict(zip([c.name for c in graph_suite()], (
    _count("node", "class_name = 'Store'"), _count("LIVES_AT", "true"), _count("node", "class_name = 'Item'"),
    _count("RETURNED", "true"), _count("SHOPPED_AT", "true"), _count("SHOPPED_AT", "true"),
    "SELECT count(DISTINCT 1) FROM PURCHASED",
), strict=True))


@query(oracle("SELECT test_name, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status, failures FROM ("
              + " UNION ALL ".join(f"SELECT '{n}' AS test_name, CAST(({c}) AS BIGINT) AS failures" for n, c in _FAILURES.items())
              + ")", "node", "LIVES_AT", "RETURNED", "SHOPPED_AT", "PURCHASED"))
def graph_checks(bed):
    """All checks of the graph, on a graph with some nodes and edges repeated and spoiled."""
    classes, rels = G.ontology_tables(bed.spark, ONTO)
    nodes, edges = nodes_of(bed).select(*G.NODE_COLUMNS), edges_of(bed).select(*G.EDGE_COLUMNS)
    rel = lambda n: edges.filter(F.col("relationship_name") == n)
    frames = {
        "node": nodes.union(nodes.filter("class_name = 'Store'")).union(
            nodes.filter("class_name = 'Item'").withColumn("class_name", F.lit("Thing"))),
        "edge": edges.union(rel("LIVES_AT")).union(
            rel("RETURNED").withColumn("from_node_id", -F.col("from_node_id"))).union(
            rel("SHOPPED_AT").withColumns({"to_node_id": -F.col("to_node_id"), "relationship_name": F.lit("VISITED")})),
        "ontology_class": classes,
        "ontology_relationship": rels.withColumn("kind", F.when(F.col("name") == "PURCHASED", "sum").otherwise(F.col("kind"))),
    }
    return run_checks(lambda _, t: frames[t], graph_suite()).drop("message")
