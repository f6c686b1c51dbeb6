"""Join shapes used by marts and graph. The physical strategy is left to Catalyst and AQE:
a side is broadcast only when its measured size is below the session threshold, and skewed
partitions of a shuffled join are split at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dates(df: DataFrame, dates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner join of a date key to attributes of the date dimension."""
    wanted = dates.select("d_date_sk", *columns)
    return df.join(wanted, df[key] == wanted["d_date_sk"]).drop("d_date_sk")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return left.join(right, on, "left")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row, one-column aggregate to every row, as a scalar subquery."""
    return df.withColumn(one_row.columns[0], one_row.scalar())


def enrich_customer(
    customers: DataFrame, demographics: DataFrame, households: DataFrame, bands: DataFrame
) -> DataFrame:
    """Customer with demographics and income bounds, through the household."""
    cd = demographics.select("cd_demo_sk", "cd_gender", "cd_marital_status", "cd_education_status")
    # The two small tables meet first, so the customers are joined once for the pair.
    hd = (
        households.select("hd_demo_sk", "hd_income_band_sk")
        .join(bands, F.col("hd_income_band_sk") == F.col("ib_income_band_sk"), "left")
        .select("hd_demo_sk", F.col("ib_lower_bound").alias("income_lower"),
                F.col("ib_upper_bound").alias("income_upper"))
    )
    return (
        customers.join(cd, F.col("c_current_cdemo_sk") == F.col("cd_demo_sk"), "left")
        .join(hd, F.col("c_current_hdemo_sk") == F.col("hd_demo_sk"), "left")
    )
