"""Mixing sources to target weights.

Sizes are added up per source (partial sums first, so a hot source costs one row per task).
Targets fill up by weight: each source gets its weight times a common level, but no more than
``max_repeat`` times its size; what is above is shared again until none is. A document is taken
floor(rate) times, and once more if a hash of a seed, its id and its text falls below the rest of the
rate. Rows that agree in id and text have a coin each, by their place in the table.

The words taken of a source spread around its target: with n documents, f the fraction of the rate
and s the mean of squared sizes, the standard deviation is sqrt(n * s * f * (1 - f)).

Only DataFrame functions. The text is read once for sizes; only ids, sources and sizes move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.sqlwords import count_words
from marketloom.llm.store import stored
from marketloom.operators.rank import global_row_number

#: Weights by the order of the sources, repeating, and the largest repetition.
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target for a frame with ``source`` and ``size``; a row per source.

    Sources are ordered by code point, null last. Only sums over all sources come to the driver,
    one row for each time the excess is shared again. With no words at all, targets are 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = global_row_number(per, [F.col("source").asc_nulls_last()], "_rn")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("_rn") - 1) % len(weights)).cast("int"))
    table = stored(ordered.select("source", "source_size", weight.alias("weight")), "sources")
    cap, w = max_repeat * F.col("source_size"), F.col("weight")
    level = 0.0
    while True:
        full = cap < level * w
        sums = table.agg(
            F.sum("source_size").alias("size"), F.sum(F.when(full, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(full, 0).otherwise(w)).alias("weight")).first()
        raised = (sums["size"] - sums["capped"]) / sums["weight"] if sums["weight"] else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(cap.cast("double"), F.lit(level) * w).alias("target"))


def coin(id: Column, text: Column, seed: str = SEED) -> Column:
    """Hash of seed, id and text; a null id is an empty one."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def _own_coins(rows: DataFrame, coins: DataFrame) -> DataFrame:
    """Rows whose ``_coin`` stands more than once in ``coins`` get one of their own, by their place."""
    twins = stored(coins.groupBy("_coin").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("_coin").alias("_twin")), "twins")
    if twins.isEmpty():
        return rows
    place = F.concat_ws(":", "_coin", F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("_own", F.md5(place)).join(twins, F.col("_coin") == F.col("_twin"), "left")
    return rows.withColumn("_coin", F.when(F.col("_twin").isNull(), F.col("_coin")).otherwise(F.col("_own"))).drop("_own", "_twin")


def copies(coin: Column, rate: Column) -> Column:
    """floor(rate), plus 1 with probability of the fraction, by 52 bits of the coin."""
    u = F.conv(F.substring(coin, 1, 13), 16, 10).cast("double")
    whole = F.floor(rate)
    return whole + F.when(u / float(1 << 52) < rate - whole, 1).otherwise(0)


def plan_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: id, source, size, source_size, target, n_copies, taken.

    Null and empty texts have size 0 and take no words; a null source is a source of its own, the
    last one; a null id is hashed as empty. Rows that repeat an id, or an id and a text, have coins of
    their own; which of several equal rows is taken follows from their places in the files.
    An empty table gives no rows. Other columns are not read.
    """
    sizes = stored(docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), count_words(F.col(text)).alias("size"),
        coin(F.col(id), F.col(text)).alias("_coin")), "sizes")
    t = source_targets(sizes).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        _own_coins(sizes, sizes).join(t, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("n_copies", copies(F.col("_coin"), rate))
        .select(F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target", "n_copies",
                (F.col("size") * F.col("n_copies")).alias("taken"))
    )


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents: each input row as often as it is taken, with all its columns.

    The rate of a row depends on its source alone, so only the table of sources is joined, and where
    rows agree in id and text the table of those. Rows without words are taken like others of their
    source. Columns may have any names.
    """
    sizes = docs.select(F.col(source).alias("source"), count_words(F.col(text)).alias("size"))
    t = source_targets(sizes).select(
        F.col("source").alias("_source"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), coin(docs[id], docs[text]).alias("_coin"))
    rows = _own_coins(packed, packed.select("_coin"))
    n = copies(F.col("_coin"), F.col("_rate")).cast("int")
    return (
        rows.join(t, F.col("_row")[source].eqNullSafe(F.col("_source")))
        .select("_row", F.explode(F.array_repeat(F.lit(1), n)))
        .select(*[F.col("_row")[c].alias(c) for c in docs.columns])
    )


def mix_digest(docs: DataFrame) -> DataFrame:
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def digest_sql() -> str:
    """The same in SQL; the level is the largest of those that cap all sources fuller than one."""
    m = MAX_REPEAT
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, ([{weights}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight FROM per),
at_least AS (
  SELECT *, sum(source_size) OVER () AS total,
    sum({m} * source_size) OVER (ORDER BY {m} * source_size / weight::DOUBLE DESC) AS cap_sum,
    sum(weight) OVER (ORDER BY {m} * source_size / weight::DOUBLE DESC) AS weight_sum
  FROM weighed),
leveled AS (SELECT *, max((cap_sum - {m - 1} * total)::DOUBLE / weight_sum::DOUBLE) OVER () AS level FROM at_least),
targets AS (SELECT source, source_size, least({m}.0::DOUBLE * source_size, level * weight) AS target FROM leveled),
rated AS (
  SELECT doc_id, size::BIGINT AS size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 13))::BIGINT::DOUBLE / {1 << 52}::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated"""
