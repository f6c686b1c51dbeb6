"""Silver: one validated, typed table and one table of rejected rows per raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions.exprs import clean_text, is_anomaly, is_clean, with_flags
from marketloom.specs import TABLES, TableSpec, silver_tables
from marketloom.warehouse import ANOMALIES, Warehouse, Written


def _typed(spec: TableSpec, wrap=lambda c: c) -> list:
    # Only for rows without reasons: their form is checked already, so the cast needs no guard
    # and the pattern is matched once per value.
    def value(name, dtype):
        c = F.col(name)
        return clean_text(c) if isinstance(dtype, T.StringType) else c.try_cast(dtype)

    return [wrap(value(c, t)).alias(c) for c, t in spec.types.items()]


def silver_split(
    df: DataFrame, spec: TableSpec, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(clean, anomalies): rows without reasons, typed; rows with reasons, raw text kept."""
    flagged = with_flags(df, spec.types, strict)
    clean = flagged.filter(is_clean(F.col("anomaly_reasons"))).select(_typed(spec))
    anomalies = flagged.filter(
        is_anomaly(F.col("anomaly_reasons")) if spec.typed_columns else F.lit(False)
    ).select(*spec.columns, "anomaly_reasons")
    return clean, anomalies


def store_silver(
    wh: Warehouse, df: DataFrame, spec: TableSpec, strict: bool = False, metrics: Mapping[str, Column] | None = None
) -> Written:
    """Write both halves in one pass over the raw table, and count the rejected rows in it.

    Each row is flagged once. Clean rows fill the typed columns, rejected rows fill the ``raw``
    struct; the unused half is all NULL and costs next to nothing in Parquet. Both halves share
    files, so a rare bad row does not cost each task a file of its own: readers of the clean half
    skip the ``raw`` columns, readers of the rejected half skip row groups without bad rows.
    """
    flagged = with_flags(df, spec.types, strict).withColumn(
        "is_anomaly", is_anomaly(F.col("anomaly_reasons"))
    )
    bad = F.col("is_anomaly")
    return wh.write(
        flagged.select(
            *_typed(spec, lambda c: F.when(~bad, c)),
            F.when(bad, F.struct(*spec.columns)).alias("raw"),
            "anomaly_reasons",
            "is_anomaly",
        ),
        "silver",
        spec.silver_name,
        metrics={"rejected": F.count_if(F.col("is_anomaly")), **(metrics or {})},
    )


def read_clean(wh: Warehouse, table: str) -> DataFrame:
    return wh.read("silver", TABLES[table].silver_name)


def read_anomalies(wh: Warehouse, table: str) -> DataFrame:
    return wh.read("silver", TABLES[table].silver_name + ANOMALIES)


def anomaly_summary(flagged: dict[str, DataFrame]) -> DataFrame:
    """Rows, rejected rows and rows per reason of each flagged table.

    ``flagged`` maps table names to frames with an ``anomaly_reasons`` column. One row per table
    and reason; tables without rejected rows have one row with a NULL reason.
    """
    parts = [
        df.select(F.lit(name).alias("table_name"), "anomaly_reasons") for name, df in flagged.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # Collapse equal reason lists on the map side first; the rest works on a handful of rows.
    lists = rows.groupBy("table_name", "anomaly_reasons").agg(F.count(F.lit(1)).alias("n"))
    totals = lists.groupBy("table_name").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(is_anomaly(F.col("anomaly_reasons")), F.col("n")).otherwise(0)).alias(
            "rejected_rows"
        ),
    )
    reasons = (
        lists.select("table_name", "n", F.explode("anomaly_reasons").alias("reason"))
        .groupBy("table_name", "reason")
        .agg(F.sum("n").alias("reason_rows"))
    )
    return totals.join(reasons, "table_name", "left").select(
        "table_name", "total_rows", "rejected_rows", "reason",
        F.coalesce("reason_rows", F.lit(0)).alias("reason_rows"),
    )


def stored_summary(wh: Warehouse, tables: list[str] | None = None) -> DataFrame:
    """Anomaly summary of the stored Silver tables; the reasons are read, not computed again."""
    return anomaly_summary({
        TABLES[t].silver_name: stored_reasons(wh, t) for t in tables or silver_tables()})


def stored_reasons(wh: Warehouse, table: str) -> DataFrame:
    """``anomaly_reasons`` of every stored row, clean ones included."""
    return wh.spark.read.schema("anomaly_reasons array<string>").parquet(
        wh.snapshot_path("silver", TABLES[table].silver_name))
