"""A corpus pipeline over documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontamination, mixing, neardup, sharding, toxicity
from marketloom.llm.store import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEY = "_document"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of their id and text: null and repeated ids keep their own rows."""
    return docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias(KEY))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network accepts; it learns from the labels of the folder."""
    scored = toxicity.score_documents(docs.select(*COLUMNS), _table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id (null last).

    Rows that repeat an id and a text are one document. Texts without words are in no group.
    """
    keyed = _keyed(docs)
    groups = stored(neardup.near_duplicates(keyed, id=KEY), "near_duplicates")
    names = keyed.select("doc_id", F.col(KEY).alias("key")).distinct()
    keep = groups.select(F.col("doc_id").alias("key"), F.col("component_id").alias("grp")).distinct().join(names, "key").groupBy(
        "grp").agg(F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias(KEY))
    return keyed.join(keep, KEY, "left_semi").dropDuplicates([KEY]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    keyed = _keyed(docs)
    found = stored(decontamination.contaminated(keyed, _table(spark, sf_dir, "benchmark"), id=KEY).select(KEY).distinct(), "leaks")
    return keyed.join(found, KEY, "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target weight asks for."""
    return mixing.mix(docs.select(*COLUMNS))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the shard they belong to."""
    return sharding.shard(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Training a network, similarity joins and SimHash have no SQL form; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
