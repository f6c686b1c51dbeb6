"""Upsert into stored tables that rewrites only what changed.

A keyed table lies in buckets of its keys' hash, below its partition columns; every bucket is a folder
that a commit of the warehouse lists. Rows carry a hash of their other columns. An upsert compares keys
and hashes, reads no more than those two columns of the old rows, and writes the buckets that hold
a new or changed row; all others are listed again as they stand. Readers see the old table or the new
one. If another writer has changed one of the same buckets meanwhile, the upsert starts again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.warehouse import BUCKET, ROW_HASH, VERSION, Commit, Warehouse

BUCKETS = 16


@dataclass(frozen=True)
class Upserted:
    """Rows that were new or had changed, and the folders that were written for them."""

    changed: int
    touched: tuple[str, ...]


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of values; which of them are null is part of it."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null keys are equal to each other."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def _placed(df: DataFrame, keys: Sequence[str], partition_by: Sequence[str], buckets: int) -> DataFrame:
    """Rows with their hash, their bucket and the folder it has below a version."""
    rest = [c for c in df.columns if c not in keys and c not in partition_by]
    bucket = F.concat(F.lit(f"{buckets}-"), F.pmod(row_hash(keys), F.lit(buckets)).cast("string"))
    return df.withColumns({ROW_HASH: row_hash(rest) if rest else F.lit(0).cast("long"), BUCKET: bucket})


def _write(wh: Warehouse, base: str, rows: DataFrame, partition_by: Sequence[str], keys: Sequence[str]) -> tuple[tuple[str, str], ...]:
    """A version's folders: (folder, its part below the version)."""
    import uuid

    version = f"{VERSION}={uuid.uuid4().hex}"
    parts = [*partition_by, BUCKET]
    # One file per bucket, sorted by key, so that readers of a key range skip row groups.
    rows.repartition(*parts).sortWithinPartitions(*parts, *keys).write.mode("error").partitionBy(*parts).parquet(f"{base}/{version}")
    folders = [""]
    for _ in parts:
        folders = [f"{f}/{n}" for f in folders for n in wh.files.names(f"{base}/{version}{f}") if "=" in n]
    return tuple((f"{version}{f}", f[1:]) for f in folders)


def _buckets_of(commit: Commit) -> int | None:
    return int(commit.folders[0][1].rsplit(f"{BUCKET}=", 1)[1].split("-")[0]) if commit.folders else None


def replace_keyed(
    wh: Warehouse, df: DataFrame, layer: str, name: str, keys: Sequence[str], partition_by: Sequence[str] = (), buckets: int = BUCKETS
) -> Upserted:
    """Replace a whole keyed table. Keys must be unique."""
    base = wh.path(layer, name)
    folders = _write(wh, base, _placed(df, keys, partition_by, buckets), partition_by, keys)
    _commit(wh, base, lambda old: replace(old, folders=folders))
    return Upserted(wh.read(layer, name).count(), tuple(f for _, f in folders))


def upsert(
    wh: Warehouse, df: DataFrame, layer: str, name: str, keys: Sequence[str], partition_by: Sequence[str] = (),
    buckets: int = BUCKETS, only_added: Column | None = None,
) -> Upserted:
    """Rows of ``df`` replace rows with the same key, or are added; all other rows stay. Keys of ``df``
    must be unique; null keys are equal. A key that moves to another partition value leaves its old row
    there, so partition columns should follow from the key. Rows for which ``only_added`` holds never
    replace a row. ``buckets`` counts for a new table only.
    """
    base = wh.path(layer, name)
    while True:
        seen = wh.newest(layer, name)
        if not seen.folders:
            return replace_keyed(wh, df, layer, name, keys, partition_by, buckets)
        placed = _placed(df, keys, partition_by, _buckets_of(seen))
        at = [*partition_by, BUCKET, *keys]
        held = wh.read_folders(base, [f for f, _ in seen.folders], hidden=True).select(*at, F.col(ROW_HASH).alias("_held"))
        found = placed.join(held, same_key(placed, held, at), "left").select(*[placed[c] for c in placed.columns], "_held")
        differs = F.col("_held").isNull() | (F.col("_held") != F.col(ROW_HASH))
        if only_added is not None:
            differs = F.when(only_added, F.col("_held").isNull()).otherwise(differs)
        # Changed rows are read for their buckets and for the merge: written once.
        changed = wh.scratch(found.filter(differs).drop("_held"), f"changed-{name}")
        parts = [*partition_by, BUCKET]
        counted = changed.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per bucket
        if not counted:
            return Upserted(0, ())
        touched = {_folder(r, parts) for r in counted}
        old = [f for f, part in seen.folders if part in touched]
        rows = changed
        if old:
            before = wh.read_folders(base, old, hidden=True).select(*changed.columns)
            rows = changed.unionByName(before.join(changed.select(*at), same_key(before, changed, at), "left_anti"))
        folders = _write(wh, base, rows, partition_by, keys)

        def change(now: Commit) -> Commit | None:
            if {x for x in now.folders if x[1] in touched} != {x for x in seen.folders if x[1] in touched}:
                return None
            return replace(now, folders=(*folders, *(x for x in now.folders if x[1] not in touched)))

        if _commit(wh, base, change):
            return Upserted(sum(r["n"] for r in counted), tuple(sorted(touched)))
        wh.files.delete(f"{base}/{folders[0][0].split('/')[0]}")  # another writer was faster in a bucket


def _folder(row, parts: Sequence[str]) -> str:
    """Name of a partition's folder as Spark writes it."""
    escape = lambda v: "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{}[]^\x7f" or ord(c) < 32 else c for c in str(v))
    return "/".join(f"{p}={'__HIVE_DEFAULT_PARTITION__' if row[p] is None or row[p] == '' else escape(row[p])}" for p in parts)


def _commit(wh: Warehouse, base: str, change) -> bool:
    """Commits, and deletes the folders that the commit before this one had replaced."""
    gone: list[str] = []

    def with_stale(old: Commit) -> Commit | None:
        new = change(old)
        if new is None:
            return None
        gone[:] = old.stale
        kept = {f for f, _ in new.folders}
        return replace(new, stale=tuple(f for f, _ in old.folders if f not in kept))

    done = wh.commit(base, with_stale)
    for folder in gone if done else ():
        wh.files.delete(f"{base}/{folder}")
    return done is not None
