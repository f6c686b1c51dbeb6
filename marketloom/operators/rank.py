"""Ranking. Global row numbers and ntiles without moving all rows to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import checkpointed

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def tile_of(rn: Column, n: Column, k: int) -> Column:
    """ntile(k) of row number rn among n rows: the first n mod k tiles hold one row more."""
    q, m = F.floor(n / k), n % k
    big = m * (q + 1)
    in_big = F.floor((rn - 1) / (q + 1)) + 1
    in_small = m + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1
    return F.when(rn <= big, in_big).otherwise(in_small).cast("int")


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    row_number: str | None = None,
    tiles: Mapping[str, int] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add a global row number and / or ntiles over ``order``, and the number of all rows.

    ``order`` must be total: put the business key last, which also lets the range sort split a
    value shared by a large part of the rows. Every task sorts one range and numbers its own
    rows; only the row count per range (one row per task) is gathered to shift them. The sorted
    rows are checkpointed so that counts and numbers come from the same ranges.
    """
    ranged = checkpointed(
        df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    )
    part = F.shiftright("_pos", _ROW_BITS)
    in_order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the sort; this window never sees data rows.
    offsets = (
        ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy()).alias("_n"),
        )
    )
    rn = F.col("_before") + F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    numbered = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    added = {row_number: rn} if row_number else {}
    added |= {total: F.col("_n")} if total else {}
    added |= {name: tile_of(rn, F.col("_n"), k) for name, k in (tiles or {}).items()}
    return numbered.withColumns(added).drop("_part", "_pos", "_before", "_n")


def stacked_tiles(
    df: DataFrame, key: str, measures: Mapping[str, tuple[Column, bool]], k: int
) -> DataFrame:
    """Add an ntile(k) over each of several numeric measures, by one sort.

    ``measures`` maps the name of a tile column to its measure and whether it falls. Rising order puts
    NULLs last, falling order first; ties go by the key, which is unique. The measures are stacked as
    (number, null, value, key) and sorted as one range; the first stack carries the row itself, so that one
    regrouping by key ends it. Every stack has as many rows as the table, so a row's place
    within its own is its place in the whole less that many rows per stack before.
    """
    value = lambda c, down: -c.cast("decimal(38,6)") if down else c.cast("decimal(38,6)")
    stack = F.array(*[
        F.struct(F.lit(i).alias("_stack"), F.when(c.isNull(), F.lit(-1 if down else 1)).otherwise(0).alias("_null"), value(c, down).alias("_value"))
        for i, (c, down) in enumerate(measures.values())])
    rest = [c for c in df.columns if c != key]
    rows = df.select(key, F.struct(*rest).alias("_row"), F.explode(stack).alias("_s")).select(
        key, "_s.*", F.when(F.col("_s._stack") == 0, F.col("_row")).alias("_row"))
    ranked = global_rank(rows, [F.col(c).asc() for c in ("_stack", "_null", "_value", key)], row_number="_place", total="_all")
    n = F.floor(F.col("_all") / len(measures))
    tile = tile_of(F.col("_place") - F.col("_stack") * n, n, k)
    out = ranked.groupBy(key).agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        *[F.max(F.when(F.col("_stack") == i, tile)).alias(name) for i, name in enumerate(measures)])
    return out.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], *measures)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    return global_rank(df, order, row_number=name)


def global_ntile(df: DataFrame, k: int, order: Sequence[Column], name: str = "ntile") -> DataFrame:
    return global_rank(df, order, tiles={name: k})


def top_n_per(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int | None
) -> DataFrame:
    """First n rows per group; all rows when n is None.

    Catalyst cuts each group to n rows before the shuffle as well, so a hot group sends at most
    n rows per task.
    """
    if n is None:
        return df
    rn = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top n (per-task heaps, then one merge of n rows per task)."""
    return df.orderBy(*order).limit(n)


def bounded(df: DataFrame, n: int = 200) -> DataFrame:
    """Result cap for interactive answers."""
    return df.limit(n)
