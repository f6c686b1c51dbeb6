"""Sharding by extendible hashing.

A document's key is a string of 60 bits: 36 bits of a hash of its id, then 24 bits that tell rows
of one id apart. A directory starts as one bucket; every bucket over the byte limit splits on
its next bit until each fits. Sums for ``STEP`` further bits are taken at once, only over the
rows of buckets that are still too large, and the levels between are added up from those sums.
A bucket of one row, or of rows that no bit tells apart, stays whole.

The directory has an entry for each run of ``STEP`` bits below a split bucket and names the
bucket it points to. Documents look their shard up in it, one equi-join per step: the rows themselves
while the directory is small enough to be broadcast, else their keys alone, and then the texts move
once, to the shards of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.store import stored

STEP = 10
ID_HEX, ROW_HEX = 9, 6
LIMIT = 32 << 20
BROADCAST_ENTRIES = 1 << 16  # of at most 130 bytes each


def _bits(hex_digits: Column, n: int) -> Column:
    return F.lpad(F.conv(hex_digits, 16, 2), 4 * n, "0")


def key_bits(id: Column, row: Column) -> Column:
    return F.concat(_bits(F.substring(F.md5(F.coalesce(id.cast("string"), F.lit(""))), 1, ID_HEX), ID_HEX),
                    _bits(F.substring(F.md5(row.cast("string")), 1, ROW_HEX), ROW_HEX))


def _look_up(rows: DataFrame, steps: list[tuple[DataFrame, int, int]], small: bool) -> DataFrame:
    """Rows (with ``key``) and the shard of the directory entry that fits; the last bits of the directory
    where none does."""
    rows = rows.withColumn("shard", F.lit(None).cast("string"))
    for entries, _, hi in steps:
        d = entries.select("entry", "bucket")
        rows = rows.join(F.broadcast(d) if small else d, F.col("shard").isNull() & (F.substring("key", 1, hi) == F.col("entry")), "left").withColumn(
            "shard", F.coalesce("shard", "bucket")).drop("entry", "bucket")
    return rows.withColumn("shard", F.coalesce("shard", F.substring("key", 1, steps[-1][2])))


def directory(slim: DataFrame, limit: int, step: int = STEP) -> list[tuple[DataFrame, int, int]]:
    """Per step: (entry, bucket) rows, and the first and last bit. ``slim`` has key and bytes."""
    width = 4 * (ID_HEX + ROW_HEX)
    total = slim.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    if total <= limit:
        return []
    steps, open_rows, lo = [], slim, 0
    while True:
        hi = min(lo + step, width)
        cells = stored(open_rows.groupBy(F.substring("key", 1, hi).alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "cells")
        # Every prefix of an entry with its sum; a few columns per entry, no data rows.
        prefixes = cells.select("entry", F.explode(F.sequence(F.lit(lo + 1), F.lit(hi))).alias("depth"), "bytes", "rows").withColumn(
            "prefix", F.expr("substring(entry, 1, depth)"))
        sums = prefixes.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        fits = sums.filter((F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.length("prefix") == width))
        found = prefixes.select("entry", "prefix").join(fits.select("prefix"), "prefix").groupBy("entry").agg(
            F.min_by("prefix", F.length("prefix")).alias("bucket"))
        # The shallowest bucket that fits; entries without one split further.
        entries = stored(cells.select("entry").join(found, "entry", "left"), "directory")
        steps.append((entries.filter("bucket IS NOT NULL"), lo, hi))
        still = entries.filter("bucket IS NULL").select("entry")
        if hi == width or still.isEmpty():
            return steps
        open_rows = open_rows.join(still, F.substring(open_rows["key"], 1, hi) == F.col("entry"), "left_semi")
        lo = hi


def shard(docs: DataFrame, limit: int = LIMIT, id: str = "doc_id", text: str = "text", broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """The input rows with all columns plus ``shard`` (hash prefix as bits, '' for the whole) and
    ``shard_bytes`` (UTF-8 bytes of the row's text).

    Null and empty texts have no bytes. Null ids share the first 36 bits and are told apart by
    the rest, as are repeated rows. A single text above the limit is a shard of its own. Columns
    of the input named like the added ones are replaced; all other names may occur. An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("shard", "shard_bytes")]
    keyed = docs.select(
        F.struct(*[docs[c] for c in kept]).alias("row"), key_bits(docs[id], F.monotonically_increasing_id()).alias("key"),
        F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long").alias("bytes"))
    slim = stored(keyed.select("key", "bytes"), "keys")
    steps = directory(slim, limit)
    if not steps:
        rows = keyed.withColumn("shard", F.lit(""))
    elif sum(entries.count() for entries, _, _ in steps) <= broadcast_entries:
        rows = _look_up(keyed, steps, True)
    else:
        assigned = stored(_look_up(slim.select("key").distinct(), steps, False), "assigned")
        last = F.substring("key", 1, steps[-1][2])
        rows = keyed.join(assigned, "key", "left").withColumn("shard", F.coalesce("shard", last))
    return rows.select(*[F.col("row")[c].alias(c) for c in kept], "shard", F.col("bytes").alias("shard_bytes"))


def shard_digest(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    return shard(docs.select("doc_id", "text"), limit).select("doc_id", F.col("shard_bytes").alias("bytes"), "shard")


def digest_sql(limit: int = LIMIT, depth: int = 20) -> str:
    """The same in SQL: the shallowest prefix that fits, over the first bits of the id's hash."""
    return f"""
WITH keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
    lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {ID_HEX}))::BIGINT), {4 * ID_HEX}, '0') AS key
  FROM documents),
prefixes AS (SELECT doc_id, bytes, key, unnest(range(0, {depth + 1})) AS d FROM keyed),
sums AS (SELECT substr(key, 1, d) AS prefix, sum(bytes) AS bytes, count(*) AS n FROM prefixes GROUP BY 1),
fitting AS (SELECT p.doc_id, p.key, min_by(prefix, len(prefix)) AS shard
  FROM prefixes p JOIN sums s ON substr(p.key, 1, p.d) = s.prefix AND (s.bytes <= {limit} OR s.n = 1) GROUP BY ALL)
SELECT k.doc_id, k.bytes, f.shard FROM keyed k JOIN fitting f ON k.doc_id IS NOT DISTINCT FROM f.doc_id AND k.key = f.key"""
