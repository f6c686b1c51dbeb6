"""Data tests as rows: not_null, unique, accepted_values and foreign_key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.keysets import KeySet, is_integer, key_set, missing, non_members
from marketloom.operators.unify import CHANNELS
from marketloom.specs import SILVER_NAMES, TABLES

# --- fixed values -------------------------------------------------------------------------------
SEGMENTS = ("Champions", "Loyal", "At risk high-value", "Hibernating", "New", "Active", "No purchase")
RUN_STATUS = ("running", "success", "failed")
LOAD_STATUS = ("success", "failed")
EDGE_KINDS = ("fk", "aggregate")
KEY_ROLES = {  # how key columns of facts end, and the dimension they name
    "date": "date_dim", "time": "time_dim", "item": "item", "customer": "customer", "cdemo": "customer_demographics",
    "hdemo": "household_demographics", "addr": "customer_address", "store": "store", "promo": "promotion", "reason": "reason",
    "warehouse": "warehouse", "ship_mode": "ship_mode", "call_center": "call_center", "catalog_page": "catalog_page",
    "web_page": "web_page", "web_site": "web_site",
}
# --- end of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique, accepted_values, foreign_key or key_range
    layer: str
    table: str
    columns: tuple[str, ...]
    values: tuple = ()
    parent: tuple[str, str, str] | None = None  # layer, table, key

    @property
    def name(self) -> str:
        if self.kind == "key_range":
            return f"{self.kind}_{self.layer}_{self.table}"
        return f"{self.kind}_{self.layer}_{self.table}_{'_'.join(self.columns)}"


Frames = Callable[[str, str], DataFrame]  # (layer, table) -> frame


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """(column, failures) with the NULL rows of each column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of key values that occur more than once; NULL keys are skipped."""
    return (
        df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").agg(F.count(F.lit(1)).alias("failures"))
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """One row: number of distinct values outside the list; NULL is skipped."""
    bad = df.filter(~F.col(column).isin(list(values))).select(column).distinct()
    return bad.agg(F.count(F.lit(1)).alias("failures"))


def foreign_key(df: DataFrame, column: str, parent: DataFrame, key: str, known: KeySet | None = None) -> DataFrame:
    """One row: rows whose non-NULL value is not a key of the parent.

    Integer keys of the parent are a bitmap (``known`` if it is there already) that is sent to the
    rows. Where it is too large for that, and for other types, values are counted before the
    lookup, so a value held by many rows is one row of the join.
    """
    rows = df.dropna(subset=[column])
    if known is None and is_integer(df, column) and is_integer(parent, key):
        known = key_set(parent, key)
    if known is not None and known.is_small:
        return non_members(rows.select(column), column, known).agg(F.count(F.lit(1)).alias("failures"))
    held = rows.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = held.join(parent.select(F.col(key).alias("_v")), "_v", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


def key_failures(df: DataFrame, column: str) -> DataFrame:
    """(kind, failures) of not_null and unique of one column, from one count per value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    null = F.col(column).isNull()
    found = counted.agg(
        F.coalesce(F.sum(F.when(null, F.col("_n"))), F.lit(0)).alias("not_null"),
        F.count_if(~null & (F.col("_n") > 1)).alias("unique"))
    return found.unpivot([], ["not_null", "unique"], "kind", "failures")


def key_range(rejected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rejected rows with a key that has the right form and doesn't fit its type."""
    return rejected.agg(F.count_if(_out_of_range(columns)).alias("failures"))


def _out_of_range(columns: Sequence[str]) -> Column:
    return F.arrays_overlap("anomaly_reasons", F.array(*[F.lit(f"{c}:out_of_range") for c in columns]))


# -- checks that are answered by the write of a table -----------------------------------------------
def observed(checks: Sequence[Check]) -> dict[str, Column]:
    """Aggregates over the rows of a table that answer its checks while it is written, by the names
    of the checks. ``unique`` and ``foreign_key`` need a shuffle and aren't among them.

    Rows of a Silver table are clean or rejected (``is_anomaly``); checks of the table hold for the
    clean ones, checks of ``…__anomalies`` for the rejected.
    """
    out = {}
    for c in checks:
        here = F.lit(True)
        if c.layer == "silver" and c.table in SILVER_NAMES:
            here = ~F.col("is_anomaly")
        if c.kind == "not_null":
            out[c.name] = F.count_if(here & F.col(c.columns[0]).isNull())
        elif c.kind == "accepted_values":
            out[c.name] = F.count_if(here & F.coalesce(~F.col(c.columns[0]).isin(list(c.values)), F.lit(False)))
        elif c.kind == "key_range":
            out[c.name] = F.count_if(F.col("is_anomaly") & _out_of_range(c.columns))
    return out


def answered(checks: Sequence[Check], metrics: Mapping[str, object]) -> dict[str, int]:
    """Failures of the checks that ``metrics`` answer. Rows with unaccepted values are counted in a
    write, values in a check: so only their absence answers it."""
    kinds = {c.name: c.kind for c in checks}
    return {n: int(v) for n, v in metrics.items() if n in kinds and (kinds[n] != "accepted_values" or not v)}


def verdict(failures: int) -> tuple[str, str | None]:
    """Status and message of a check, as in ``run_checks``."""
    return ("fail", f"failures: {failures}") if failures > 0 else ("pass", None)


def run_checks(frames: Frames, suite: Sequence[Check]) -> DataFrame:
    """One row per check: test_name, status, failures, message.

    The not_null and unique checks of one column share a pass, and so do other not_null checks of a
    table. So do its foreign_key checks, if the keys they look up are sets small enough to be
    sent to the rows.
    """
    parts: list[DataFrame] = []
    parents: dict[tuple[str, str, str], KeySet] = {}
    by_table: dict[tuple[str, str], list[Check]] = {}
    for check in suite:
        by_table.setdefault((check.layer, check.table), []).append(check)
    for (layer, table), checks in by_table.items():
        df = frames(layer, table)
        keys = {c.columns for c in checks if c.kind == "unique" and len(c.columns) == 1}
        keys &= {c.columns for c in checks if c.kind == "not_null"}
        for columns in sorted(keys):
            both = {c.kind: c for c in checks if c.columns == columns and c.kind in ("not_null", "unique")}
            names = F.create_map(*[F.lit(x) for kind, c in both.items() for x in (kind, c.name)])
            parts.append(key_failures(df, columns[0]).select(names[F.col("kind")].alias("test_name"), "failures"))
        checks = [c for c in checks if c.columns not in keys or c.kind not in ("not_null", "unique")]
        nulls = [c for c in checks if c.kind == "not_null"]
        if nulls:
            names = F.create_map(*[F.lit(x) for c in nulls for x in (c.columns[0], c.name)])
            parts.append(
                not_null(df, *[c.columns[0] for c in nulls])
                .select(names[F.col("column")].alias("test_name"), "failures"))
        small = []
        for c in checks:
            if c.kind == "unique":
                one = unique(df, c.columns)
            elif c.kind == "accepted_values":
                one = accepted_values(df, c.columns[0], c.values)
            elif c.kind == "foreign_key":
                parent, key = frames(*c.parent[:2]), c.parent[2]
                if c.parent not in parents and is_integer(df, c.columns[0]) and is_integer(parent, key):
                    parents[c.parent] = key_set(parent, key)
                if is_integer(df, c.columns[0]) and c.parent in parents and parents[c.parent].is_small:
                    small.append((c.name, c.columns[0], parents[c.parent]))
                    continue
                one = foreign_key(df, c.columns[0], parent, key, parents.get(c.parent))
            elif c.kind == "key_range":
                one = key_range(df, c.columns)
            elif c.kind == "not_null":
                continue
            else:
                raise ValueError(f"unknown check {c.kind!r}")
            parts.append(one.select(F.lit(c.name).alias("test_name"), "failures"))
        if small:
            parts.append(missing(df, small).withColumnRenamed("name", "test_name"))
    rows = reduce(DataFrame.unionByName, parts)
    failed = F.col("failures") > 0
    return rows.select(
        "test_name",
        F.when(failed, "fail").otherwise("pass").alias("status"),
        F.col("failures").cast("bigint").alias("failures"),
        F.when(failed, F.concat(F.lit("failures: "), F.col("failures").cast("string"))).alias("message"),
    )


def key_checks(layer: str, table: str, key: str) -> list[Check]:
    return [Check("not_null", layer, table, (key,)), Check("unique", layer, table, (key,))]


def table_suite(layer: str, table: str) -> list[Check]:
    """Checks of one Bronze or Silver table, by its raw name."""
    spec = TABLES[table]
    name = table if layer == "bronze" else spec.silver_name
    return key_checks(layer, name, spec.pk) if spec.pk else []


def range_suite(table: str) -> list[Check]:
    """Keys and order numbers of a Silver table must fit their integer type: rows rejected for
    that would silently leave every mart."""
    spec = TABLES[table]
    keys = tuple(c for c in spec.columns if c.endswith(("_sk", "_order_number", "_ticket_number")))
    return [Check("key_range", "silver", f"{spec.silver_name}__anomalies", keys)]


def gold_suite() -> list[Check]:
    return [
        Check("not_null", "gold", "mart_sales_performance", ("channel",)),
        Check("accepted_values", "gold", "mart_sales_performance", ("channel",), CHANNELS),
        *key_checks("gold", "mart_product_analytics", "i_item_sk"),
        *key_checks("gold", "mart_customer_360", "c_customer_sk"),
        Check("not_null", "gold", "mart_customer_360", ("segment",)),
        Check("accepted_values", "gold", "mart_customer_360", ("segment",), SEGMENTS),
    ]


def reference_suite(table: str) -> list[Check]:
    """Every key of a Silver fact table is a key of the dimension that its name ends with."""
    found = []
    for column in TABLES[table].columns:
        dims = [d for role, d in KEY_ROLES.items() if column.endswith(f"_{role}_sk")]
        if TABLES[table].kind == "fact" and dims:
            spec = TABLES[dims[0]]
            found.append(Check("foreign_key", "silver", TABLES[table].silver_name, (column,),
                               parent=("silver", spec.silver_name, spec.pk)))
    return found


def default_suite() -> list[Check]:
    """Keys of all dimensions in Bronze and Silver, and the Gold checks: 76 in all."""
    keyed = [c for layer in ("bronze", "silver") for t in TABLES for c in table_suite(layer, t)]
    return keyed + gold_suite()


def graph_suite() -> list[Check]:
    return [
        Check("unique", "graph", "node", ("class_name", "source_sk")),
        Check("unique", "graph", "edge", ("from_node_id", "to_node_id", "relationship_name")),
        Check("foreign_key", "graph", "node", ("class_name",),
              parent=("graph", "ontology_class", "class_name")),
        Check("foreign_key", "graph", "edge", ("from_node_id",), parent=("graph", "node", "node_id")),
        Check("foreign_key", "graph", "edge", ("to_node_id",), parent=("graph", "node", "node_id")),
        Check("foreign_key", "graph", "edge", ("relationship_name",),
              parent=("graph", "ontology_relationship", "name")),
        Check("accepted_values", "graph", "ontology_relationship", ("kind",), EDGE_KINDS),
    ]


def ops_suite() -> list[Check]:
    return [
        Check("accepted_values", "ops", "ingest_runs", ("status",), RUN_STATUS),
        Check("accepted_values", "ops", "ingest_table_stats", ("status",), LOAD_STATUS),
        Check("unique", "ops", "ingest_table_stats", ("run_id", "table_name")),
        Check("foreign_key", "ops", "ingest_table_stats", ("run_id",), parent=("ops", "ingest_runs", "run_id")),
        Check("foreign_key", "ops", "test_results", ("run_id",), parent=("ops", "ingest_runs", "run_id")),
        Check("foreign_key", "ops", "node_timings", ("run_id",), parent=("ops", "ingest_runs", "run_id")),
    ]
