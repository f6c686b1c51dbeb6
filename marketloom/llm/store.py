"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketloom.session import new_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back.

    Lineage ends there, so lost executors cost no recomputation, and the planner knows the size
    of the files: a join broadcasts the table only if it measured below the threshold.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
