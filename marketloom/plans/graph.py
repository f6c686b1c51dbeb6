"""Knowledge graph: nodes and edges derived from Silver by an ontology, and queries over them."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.exprs import prop, props_json, safe_label, where_not_null
from marketloom.operators.aggregates import top_pairs
from marketloom.operators.keysets import KeySet, key_set, members
from marketloom.operators.rank import top_n
from marketloom.session import checkpointed
from marketloom.sources.sinks import insert_missing, merge_by_key
from marketloom.sources.upsert import replace_keyed
from marketloom.sources.upsert import upsert as upsert_rows
from marketloom.specs import TABLES
from marketloom.warehouse import Warehouse

SK_BITS = 40  # node id: class id above, source key below
SK_SHIFT = 1 << 31  # added to the key, so that negative keys keep to their class
NODE_COLUMNS = ("node_id", "class_name", "source_sk", "natural_id", "label", "properties")
EDGE_COLUMNS = ("from_node_id", "to_node_id", "relationship_name", "properties")
# --- fixed values: lines of an exported file ---
NODE_BATCH, EDGE_BATCH = 2000, 5000
# --- end of fixed values ---
Ontology = Mapping[str, Mapping[str, dict]]
Tables = Callable[[str], DataFrame]  # Silver table name -> frame


def load_ontology(path: str | Path | None = None) -> Ontology:
    return json.loads(Path(path or Path(__file__).parents[1] / "ontology.json").read_text("utf-8"))


def ontology_tables(spark: SparkSession, onto: Ontology) -> tuple[DataFrame, DataFrame]:
    """Class and relationship metadata as tables, keyed by class_name and name."""
    classes = spark.createDataFrame(
        [(n, c["description"], TABLES[c["source_table"]].silver_name, c["surrogate_key"], c.get("natural_key"),
          c.get("label_expr"), json.dumps(c.get("properties", {}))) for n, c in onto["classes"].items()],
        "class_name string, description string, source_table string, surrogate_key string, "
        "natural_key string, label_expr string, properties string",
    )
    relationships = spark.createDataFrame(
        [(n, r["description"], r["from"], r["to"], r["kind"], json.dumps(r))
         for n, r in onto["relationships"].items()],
        "name string, description string, from_class string, to_class string, kind string, "
        "definition string",
    )
    return classes, relationships


# -- identity -------------------------------------------------------------------------------------
def node_id(onto: Ontology, class_name: str, sk: Column) -> Column:
    """Stable id: the same source row has the same id in every build."""
    return F.lit(onto["classes"][class_name]["id"] << SK_BITS).cast("bigint") + sk.cast("bigint") + F.lit(SK_SHIFT).cast("bigint")


def class_id_of(node: Column) -> Column:
    return F.shiftright(node, SK_BITS).cast("int")


def sk_of(node: Column) -> Column:
    return node.bitwiseAND(F.lit((1 << SK_BITS) - 1)) - F.lit(SK_SHIFT).cast("bigint")


def class_name_of(onto: Ontology, node: Column) -> Column:
    """Class of a node id, decoded without a lookup."""
    pairs = [x for n, c in onto["classes"].items() for x in (F.lit(c["id"]), F.lit(n))]
    return F.create_map(*pairs)[class_id_of(node)]


# -- build ------------------------------------------------------------------------------------------
def label_expr(spec: Mapping) -> Column:
    return F.expr(spec["label_expr"]) if spec.get("label_expr") else F.col(spec["surrogate_key"]).cast("string")


def class_nodes(onto: Ontology, class_name: str, source: DataFrame) -> DataFrame:
    spec = onto["classes"][class_name]
    key = spec["surrogate_key"]
    natural = F.col(spec["natural_key"]).cast("string") if spec.get("natural_key") else F.lit(None).cast("string")
    return where_not_null(source, key).select(
        node_id(onto, class_name, F.col(key)).alias("node_id"),
        F.lit(class_name).alias("class_name"),
        F.col(key).cast("bigint").alias("source_sk"),
        natural.alias("natural_id"),
        label_expr(spec).alias("label"),
        props_json(spec.get("properties", {})).alias("properties"),
    )


def build_nodes(onto: Ontology, tables: Tables) -> DataFrame:
    """One node per row of every class's source table."""
    parts = [
        class_nodes(onto, n, tables(TABLES[c["source_table"]].silver_name)) for n, c in onto["classes"].items()
    ]
    return reduce(DataFrame.unionByName, parts)


class NodeSets:
    """Ids of the nodes of each class as key sets; each is made when it is first asked for."""

    def __init__(self, nodes: DataFrame):
        self.nodes, self._sets = nodes, {}

    def of(self, class_name: str) -> KeySet:
        if class_name not in self._sets:
            self._sets[class_name] = key_set(self.nodes.filter(F.col("class_name") == class_name), "node_id")
        return self._sets[class_name]


def _sets_of(nodes: DataFrame | NodeSets) -> NodeSets:
    return nodes if isinstance(nodes, NodeSets) else NodeSets(nodes)


def resolve_ends(onto: Ontology, df: DataFrame, nodes: NodeSets, from_class: str, to_class: str) -> DataFrame:
    """Replace (from_sk, to_sk) by node ids; rows whose ends are not both nodes are dropped. Ids are
    computed, and the sets of existing ones go to the rows."""
    for side, class_name in (("from", from_class), ("to", to_class)):
        df = df.withColumn(f"{side}_node_id", node_id(onto, class_name, F.col(f"{side}_sk"))).drop(f"{side}_sk")
        df = members(df, f"{side}_node_id", nodes.of(class_name))
    return df


def fk_edges(onto: Ontology, name: str, source: DataFrame, nodes: DataFrame | NodeSets) -> DataFrame:
    """One edge per pair of origin and target, however often the pair stands in the source. The
    origin is a row of the node's own table and becomes its node id without a lookup; only the
    target is looked up."""
    rel, sets = onto["relationships"][name], _sets_of(nodes)
    key = onto["classes"][rel["from"]]["surrogate_key"]
    pairs = where_not_null(source, key, rel["column"]).select(
        node_id(onto, rel["from"], F.col(key)).alias("from_node_id"),
        node_id(onto, rel["to"], F.col(rel["column"])).alias("to_node_id"),
    )
    return members(pairs, "to_node_id", sets.of(rel["to"])).distinct().select(
        "from_node_id", "to_node_id", F.lit(name).alias("relationship_name"),
        F.lit("{}").alias("properties"),
    )


def aggregate_edges(onto: Ontology, name: str, source: DataFrame, nodes: DataFrame | NodeSets) -> DataFrame:
    """Top pairs per origin by the first aggregate (ties by target key), with the aggregates as
    properties. Without ``top_n`` all pairs become edges."""
    rel = onto["relationships"][name]
    first = next(iter(rel["aggregates"]))
    order = [F.col(first).desc_nulls_last(), F.col("to_sk").asc()]
    best = top_pairs(source, rel["from_column"], rel["to_column"], rel["aggregates"], order, rel.get("top_n"))
    return resolve_ends(onto, best, _sets_of(nodes), rel["from"], rel["to"]).select(
        "from_node_id", "to_node_id", F.lit(name).alias("relationship_name"),
        props_json({a: a for a in rel["aggregates"]}, keep_nulls=True).alias("properties"),
    )


def relationship_edges(onto: Ontology, name: str, tables: Tables, nodes: DataFrame | NodeSets) -> DataFrame:
    rel = onto["relationships"][name]
    if rel["kind"] == "fk":
        table = onto["classes"][rel["from"]]["source_table"]
        return fk_edges(onto, name, tables(TABLES[table].silver_name), nodes)
    if rel["kind"] == "aggregate":
        return aggregate_edges(onto, name, tables(rel["source"]), nodes)
    raise ValueError(f"unknown relationship kind {rel['kind']!r} of {name}")


def build_edges(onto: Ontology, tables: Tables, nodes: DataFrame) -> DataFrame:
    sets = NodeSets(nodes)
    parts = [relationship_edges(onto, n, tables, sets) for n in onto["relationships"]]
    return reduce(DataFrame.unionByName, parts)


def build_graph(wh: Warehouse, onto: Ontology, tables: Tables, upsert: bool = False, buckets: int = 4) -> dict:
    """Write graph.node and graph.edge; returns rows per class and relationship.

    ``upsert`` keeps nodes and edges that have vanished from Silver, as a refresh in place does, and
    writes only the buckets that hold a change. Foreign-key edges are only added. ``buckets`` of a new
    graph are per class and relationship; a large one needs more (a bucket is read by a task).
    """
    put = upsert_rows if upsert else replace_keyed
    put(wh, build_nodes(onto, tables).select(*NODE_COLUMNS), "graph", "node", ["node_id"], ["class_name"], buckets)
    edges = build_edges(onto, tables, wh.read("graph", "node")).select(*EDGE_COLUMNS)
    fks = [n for n, r in onto["relationships"].items() if r["kind"] == "fk"]
    added = {"only_added": F.col("relationship_name").isin(fks)} if upsert else {}
    put(wh, edges, "graph", "edge", ["from_node_id", "to_node_id"], ["relationship_name"], buckets, **added)
    for table, frame in zip(("ontology_class", "ontology_relationship"), ontology_tables(wh.spark, onto), strict=True):
        wh.write(frame.coalesce(1), "graph", table)
    counts = graph_counts(wh.read("graph", "node"), wh.read("graph", "edge")).collect()
    return {(r["kind"], r["name"]): r["n"] for r in counts}  # a row per class and relationship


def merge_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed nodes are updated, new ones added, vanished ones stay; ids do not change."""
    return merge_by_key(old.select(*NODE_COLUMNS), new.select(*NODE_COLUMNS), ["node_id"])


def merge_edges(old: DataFrame, new: DataFrame, onto: Ontology) -> DataFrame:
    """Aggregate edges take new properties; foreign-key edges are only added."""
    keys = ["from_node_id", "to_node_id", "relationship_name"]
    fks = [n for n, r in onto["relationships"].items() if r["kind"] == "fk"]
    is_fk = F.col("relationship_name").isin(fks)
    old, new = old.select(*EDGE_COLUMNS), new.select(*EDGE_COLUMNS)
    added = insert_missing(old.filter(is_fk), new.filter(is_fk), keys)
    return added.unionByName(merge_by_key(old.filter(~is_fk), new.filter(~is_fk), keys))


def merge_graph(
    old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame], onto: Ontology
) -> tuple[DataFrame, DataFrame]:
    return merge_nodes(old[0], new[0]), merge_edges(old[1], new[1], onto)


# -- queries ------------------------------------------------------------------------------------------
def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows per class and per relationship."""
    per_class = nodes.groupBy(F.col("class_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    per_rel = edges.groupBy(F.col("relationship_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return per_class.select(F.lit("node").alias("kind"), "name", "n").unionByName(
        per_rel.select(F.lit("edge").alias("kind"), "name", "n")
    )


def class_summary(nodes: DataFrame, onto: Ontology) -> DataFrame:
    """Every class with its description, source and node count (0 if it has none)."""
    classes, _ = ontology_tables(nodes.sparkSession, onto)
    n = nodes.groupBy("class_name").agg(F.count(F.lit(1)).alias("n"))
    return classes.select("class_name", "description", "source_table").join(n, "class_name", "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)))


def relationship_summary(edges: DataFrame, onto: Ontology) -> DataFrame:
    _, rels = ontology_tables(edges.sparkSession, onto)
    n = edges.groupBy(F.col("relationship_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return rels.select("name", "description", "from_class", "to_class", "kind").join(n, "name", "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)))


def _of(edges: DataFrame, rel: str) -> DataFrame:
    return edges.filter(F.col("relationship_name") == rel)


def sum_prop(edges: DataFrame, rel: str, name: str, alias: str) -> DataFrame:
    """Sum of a numeric edge property per origin node."""
    value = prop("properties", name, "decimal(18,2)")
    return _of(edges, rel).groupBy(F.col("from_node_id").alias("node_id")).agg(F.sum(value).alias(alias))


def top_customers(nodes: DataFrame, edges: DataFrame, n: int = 5) -> DataFrame:
    """Customers with the highest purchases. Totals are cut to n before the name lookup."""
    totals = sum_prop(edges, "PURCHASED", "net_paid", "total_net_paid")
    best = top_n(totals, [F.col("total_net_paid").desc_nulls_last(), F.col("node_id").asc()], n)
    names = nodes.filter(F.col("class_name") == "Customer").select("node_id", "label")
    return names.join(best, "node_id").select(
        "node_id", F.col("label").alias("customer_name"), "total_net_paid"
    )


def hop_out(seed: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes reached by one outbound edge."""
    return members(edges, "from_node_id", key_set(seed, "node_id")).select(F.col("to_node_id").alias("node_id")).distinct()


def sample_nodes(edges: DataFrame, onto: Ontology, top: int = 200) -> DataFrame:
    """Ids of the top customers by purchases and of all nodes one and two hops out."""
    totals = sum_prop(edges, "PURCHASED", "net_paid", "total").filter(
        class_id_of(F.col("node_id")) == onto["classes"]["Customer"]["id"]
    )
    # Each set is computed once: the hops and what restricts nodes and edges read it again.
    seed = checkpointed(top_n(totals, [F.col("total").desc_nulls_last(), F.col("node_id").asc()], top).select("node_id"))
    one = checkpointed(hop_out(seed, edges))
    return checkpointed(seed.union(one).union(hop_out(one, edges)).distinct())


def restrict(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes in the id set, and edges with both ends in it."""
    inside = key_set(ids, "node_id")
    kept = members(members(edges, "from_node_id", inside), "to_node_id", inside)
    return members(nodes, "node_id", inside), kept.select(*EDGE_COLUMNS)


def edge_view(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with class, key and label of both ends."""
    def end(side: str) -> DataFrame:
        return nodes.select(*[
            F.col(c).alias(f"{side}_{t}") for c, t in
            (("node_id", "node_id"), ("class_name", "class"), ("source_sk", "sk"), ("label", "label"))
        ])

    return edges.join(end("from"), "from_node_id").join(end("to"), "to_node_id")


def edge_keys(onto: Ontology, edges: DataFrame) -> DataFrame:
    """Edges by class and source key of their ends, decoded from the ids without a join."""
    ends = [
        c
        for side in ("from", "to")
        for c in (
            class_name_of(onto, F.col(f"{side}_node_id")).alias(f"{side}_class"),
            sk_of(F.col(f"{side}_node_id")).alias(f"{side}_sk"),
        )
    ]
    return edges.select(*ends, "relationship_name", "properties")


def nodes_where(nodes: DataFrame, class_name: str, wanted: Mapping[str, str]) -> DataFrame:
    """Nodes of a class with the given property values."""
    found = nodes.filter(F.col("class_name") == class_name)
    for name, value in wanted.items():
        found = found.filter(prop("properties", name) == value)
    return found


def match_edges(nodes: DataFrame, edges: DataFrame, rel: str, limit: int = 50) -> DataFrame:
    """The first edges of a relationship with both labels; cut before the lookups."""
    first = top_n(_of(edges, rel), [F.col("from_node_id").asc(), F.col("to_node_id").asc()], limit)
    return edge_view(nodes, first)


def co_purchase(nodes: DataFrame, edges: DataFrame, limit: int = 10) -> DataFrame:
    """Products by the number of customer pairs that share them.

    An item with m buyers has m(m-1)/2 ordered pairs, so counting buyers is enough and no pair
    is ever formed.
    """
    buyers = _of(edges, "PURCHASED").groupBy(F.col("to_node_id").alias("node_id")).agg(
        F.count(F.lit(1)).alias("m"))
    pairs = F.expr("m * (m - 1) div 2")
    items = nodes.filter(F.col("class_name") == "Item").select(
        "node_id", prop("properties", "product_name").alias("product_name"))
    counted = (
        buyers.filter("m > 1").join(items, "node_id").groupBy("product_name")
        .agg(F.sum(pairs).alias("pairs"))
    )
    return top_n(counted, [F.col("pairs").desc(), F.col("product_name").asc_nulls_last()], limit)


def customer_chain(edges: DataFrame, limit: int = 20) -> DataFrame:
    """First paths customer -> address and customer -> household -> income band, by node id.

    One join per customer and one lookup of the household; the cut keeps a heap per task.
    """
    def hop(rel: str, start: str, end: str) -> DataFrame:
        return _of(edges, rel).select(
            F.col("from_node_id").alias(start), F.col("to_node_id").alias(end))

    paths = (
        hop("LIVES_AT", "customer", "address")
        .join(hop("IN_HOUSEHOLD", "customer", "household"), "customer")
        .join(hop("IN_INCOME_BAND", "household", "income_band"), "household")
    )
    order = [F.col(c).asc() for c in ("customer", "address", "household", "income_band")]
    return top_n(paths.select("customer", "address", "household", "income_band"), order, limit)


# -- export -------------------------------------------------------------------------------------------
def _plain(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegerType):
        return "bigint"
    return "double" if isinstance(dtype, T.DecimalType) else "string"


def flatten_nodes(onto: Ontology, nodes: DataFrame, class_name: str) -> DataFrame:
    """Nodes of a class with one column per property; a property named like a base column wins."""
    spec = onto["classes"][class_name]
    types = TABLES[spec["source_table"]].types
    fields = {p: _plain(types[c]) for p, c in spec.get("properties", {}).items()}
    parsed = nodes.filter(F.col("class_name") == class_name).withColumn(
        "_p", F.from_json("properties", ", ".join(f"`{p}` {t}" for p, t in fields.items()))
    )
    base = {"node_class": F.col("class_name"), "source_sk": F.col("source_sk"),
            "label": F.col("label"), "natural_id": F.col("natural_id")}
    columns = base | {p: F.col(f"_p.`{p}`") for p in fields}
    return parsed.select(*[c.alias(n) for n, c in columns.items()])


def flatten_edges(onto: Ontology, edges: DataFrame, name: str) -> DataFrame:
    """Edges of a relationship by endpoint keys, with numeric property columns."""
    fields = list(onto["relationships"][name].get("aggregates", {}))
    keys = ["from_class", "from_sk", "to_class", "to_sk"]
    return edge_keys(onto, _of(edges, name)).select(
        *keys, *[prop("properties", f, "double").alias(f) for f in fields]
    )


def export_label(name: str) -> str:
    """Folder name of a class or relationship; same rule as ``safe_label`` on columns."""
    kept = "".join(ch for ch in name if ch.isalnum() or ch == "_")
    return kept if kept[:1].isalpha() else f"C_{kept}"


def export_graph(
    nodes: DataFrame, edges: DataFrame, onto: Ontology, path: str, mode: str = "sample",
    top: int = 200, node_batch: int = NODE_BATCH, edge_batch: int = EDGE_BATCH, threads: int = 8,
) -> DataFrame:
    """Write JSON lines per class and relationship, in ranges of keys; no file has more lines than its
    batch (0: no bound). A manifest beside them has the rows, keys and checksum of every file.

    ``mode`` is "sample" (top customers and two hops out) or "full". Returns the counts read
    back from the files.
    """
    if mode not in ("sample", "full"):
        raise ValueError(f"unknown mode {mode!r}; known: sample, full")
    if mode == "sample":
        # The sample is small and read once per class and relationship: compute it once.
        nodes, edges = map(checkpointed, restrict(nodes, edges, sample_nodes(edges, onto, top)))
    jobs = [(f"nodes/{export_label(n)}", flatten_nodes(onto, nodes, n), ["source_sk"], node_batch) for n in onto["classes"]]
    jobs += [(f"edges/{export_label(n)}", flatten_edges(onto, edges, n), ["from_sk", "to_sk"], edge_batch)
             for n in onto["relationships"]]

    def write(job) -> None:
        folder, df, keys, batch = job
        df.orderBy(*keys).write.mode("error").option("maxRecordsPerFile", batch).json(f"{path}/{folder}")

    spark = nodes.sparkSession
    with ThreadPoolExecutor(threads) as pool:  # independent folders share the cluster
        list(pool.map(inheritable_thread_target(spark)(write), jobs))
    _write_manifest(spark, path)
    return export_counts(spark, path)


def _write_manifest(spark: SparkSession, path: str) -> None:
    """Rows, first and last key, and the sum of the lines' CRC-32 per file, from one scan of the files."""
    lines = spark.read.text([f"{path}/nodes/*", f"{path}/edges/*"]).select("value", F.col("_metadata.file_path").alias("file"))
    key = F.coalesce(F.get_json_object("value", "$.source_sk"), F.get_json_object("value", "$.from_sk")).cast("bigint")
    files = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"),
        F.sum(F.crc32(F.col("value").cast("binary"))).alias("checksum"))
    files.select(
        F.regexp_extract("file", r"/(nodes|edges)/[^/]+/[^/]+$", 1).alias("kind"), F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1).alias("name"),
        F.regexp_extract("file", r"[^/]+$", 0).alias("file"), "rows", "first", "last", "checksum").write.mode("error").parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """kind, name, file, rows, first, last, checksum: a row per exported file."""
    return spark.read.parquet(f"{path}/manifest")


def damaged_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of the manifest that are missing or hold other lines than when they were written."""
    lines = spark.read.text([f"{path}/nodes/*", f"{path}/edges/*"]).select("value", F.regexp_extract(F.col("_metadata.file_path"), r"[^/]+$", 0).alias("file"))
    now = lines.groupBy("file").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.crc32(F.col("value").cast("binary"))).alias("_sum"))
    same = (F.col("rows") == F.col("_rows")) & (F.col("checksum") == F.col("_sum"))
    return read_manifest(spark, path).join(now, "file", "left").filter(~F.coalesce(same, F.lit(False))).select("kind", "name", "file")


def export_counts(spark: SparkSession, path: str) -> DataFrame:
    """Objects in an export, per kind and folder."""
    return read_manifest(spark, path).groupBy("kind", "name").agg(F.sum("rows").alias("n"))


def labels_of(nodes: DataFrame) -> DataFrame:
    """Distinct export labels of the classes present."""
    return nodes.select("class_name").distinct().withColumn("export_label", safe_label(F.col("class_name")))
