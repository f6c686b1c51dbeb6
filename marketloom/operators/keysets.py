"""Sets of integer keys as bitmaps: the set goes to the rows, so the rows need not be shuffled.

A set is a table of words: ``_key_word`` is a key without its last six bits, ``_key_bits`` has a bit
for each of the 64 keys that share it. Surrogate keys lie close together, so a word holds up to 64 keys; a
set of scattered keys has a word for each and is no larger than a list of the keys. The words are written once to the shared folder and counted.
Up to ``LIMIT_BYTES`` they are broadcast; a larger set is joined by a shuffle on the words, with the same
rows as its result, and skewed partitions are split at run time.

NULL is in no set, and NULL keys of the set are left out. Repeated keys count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import checkpointed

WORD_BYTES = 96  # at most, of one word in a broadcast hash table
LIMIT_BYTES = 128 << 20  # of a set that is broadcast: 89 million keys that lie close together
_SHIFT = 6


@dataclass(frozen=True)
class KeySet:
    words: DataFrame
    n_words: int
    limit_bytes: int = LIMIT_BYTES

    @property
    def is_small(self) -> bool:
        return self.n_words * WORD_BYTES <= self.limit_bytes


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def key_set(df: DataFrame, key: str, limit_bytes: int = LIMIT_BYTES) -> KeySet:
    """The distinct values of an integer column."""
    if not is_integer(df, key):
        raise TypeError(f"{key} is not an integer column")
    value = F.col(key).cast("bigint")
    bit = F.expr("shiftleft(1L, CAST(_key & 63 AS INT))")
    words = (
        df.select(value.alias("_key")).dropna()
        .groupBy(F.shiftright("_key", _SHIFT).alias("_key_word")).agg(F.bit_or(bit).alias("_key_bits"))
    )
    words = checkpointed(words)
    return KeySet(words, words.count(), limit_bytes)


def _join(df: DataFrame, column: str, keys: KeySet, how: str) -> DataFrame:
    if not is_integer(df, column):
        raise TypeError(f"{column} is not an integer column")
    words = F.broadcast(keys.words) if keys.is_small else keys.words
    return df.join(words, _holds(F.col(column).cast("bigint")), how)


def _holds(value: Column) -> Column:
    at = value.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    return (F.shiftright(value, _SHIFT) == F.col("_key_word")) & (F.getbit("_key_bits", at) == 1)


def members(df: DataFrame, column: str, keys: KeySet) -> DataFrame:
    """Rows whose value is in the set."""
    return _join(df, column, keys, "left_semi")


def non_members(df: DataFrame, column: str, keys: KeySet) -> DataFrame:
    """Rows whose value is not in the set, NULL among them."""
    return _join(df, column, keys, "left_anti")


def missing(df: DataFrame, wanted: Sequence[tuple[str, str, KeySet]]) -> DataFrame:
    """(name, failures): non-NULL values of a column that are not in its set, for each wanted (name,
    column, set). All are counted in one pass over the rows; so the sets are small ones."""
    if not all(keys.is_small for _, _, keys in wanted):
        raise ValueError("a key set is too large to be sent to the rows")
    for c in {c for _, c, _ in wanted}:
        if not is_integer(df, c):
            raise TypeError(f"{c} is not an integer column")
    columns = list(dict.fromkeys(c for _, c, _ in wanted))
    place = {c: f"v{i}" for i, c in enumerate(columns)}
    rows = df.select(*[F.col(c).cast("bigint").alias(v) for c, v in place.items()])
    for i, (_, column, keys) in enumerate(wanted):
        value = F.col(place[column])
        words = keys.words.select(F.col("_key_word").alias("w"), F.col("_key_bits").alias(f"b{i}"))
        at = value.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        rows = rows.join(F.broadcast(words), F.shiftright(value, _SHIFT) == F.col("w"), "left").drop("w")
        rows = rows.withColumn(f"b{i}", value.isNotNull() & (F.coalesce(F.getbit(f"b{i}", at), F.lit(0)) == 0))
    counted = rows.agg(*[F.count_if(f"b{i}").alias(f"b{i}") for i in range(len(wanted))])
    names = F.create_map(*[F.lit(x) for i, (name, _, _) in enumerate(wanted) for x in (f"b{i}", name)])
    return counted.unpivot([], counted.columns, "b", "failures").select(names[F.col("b")].alias("name"), "failures")
