"""Sinks that Parquet lacks: upsert and insert-if-absent as whole-table results, event logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row with the highest ``seq`` per key. Combines on the map side, so a key written
    many times sends one row per task."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def merge_by_key(
    old: DataFrame, new: DataFrame, keys: Sequence[str], seq: str | None = None
) -> DataFrame:
    """Upsert: rows of ``new`` replace rows of ``old`` with the same key; other rows stay. Null keys are
    equal to each other. For stored tables see ``upsert``, which writes what has changed only.

    Without ``seq`` the keys of ``new`` must be unique; with it the last write per key wins.
    """
    fresh = last_per_key(new, keys, seq) if seq else new
    return fresh.unionByName(_without(old, fresh, keys))


def insert_missing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert if absent: rows of ``new`` whose key is not in ``old`` are added; null keys are equal."""
    return old.unionByName(_without(new, old, keys))


def _without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``other``."""
    held = other.select(*[F.col(k).alias(f"_held_{i}") for i, k in enumerate(keys)])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_held_{i}")) for i, k in enumerate(keys)])
    return df.join(held, same, "left_anti")


def latest_events(events: DataFrame, key: str, seq: str) -> DataFrame:
    """State of an append-only event log: each column's last non-NULL value per key."""
    rest = [c for c in events.columns if c not in (key, seq)]
    return events.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in rest]
    )
