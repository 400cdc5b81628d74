"""First looks at a result of strict and filled minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("tau_strict_min", "tau_fill_min", "tau_filled_min")


def preview(result: DataFrame, n: int = 5) -> DataFrame:
    return result.limit(n)


def overall(result: DataFrame, unit: str = "grid_uid") -> DataFrame:
    return result.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("uuid").alias("n_users"), F.countDistinct(unit).alias("n_units"), *[F.sum(c).alias(f"{c}_sum") for c in SUMS], F.count_if(F.col("tau_fill_min") > 0).alias("n_rows_tau_fill_pos"))


def by_window(result: DataFrame) -> DataFrame:
    out = result.groupBy("window", "is_weekend").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(f"{c}_sum") for c in SUMS])
    return out.withColumn("fill_share", F.try_divide("tau_fill_min_sum", "tau_filled_min_sum")).orderBy("window", "is_weekend")


def top_units(result: DataFrame, unit: str = "grid_uid", n: int = 20) -> DataFrame:
    """The units with the most filled minutes; ties by name."""
    return result.groupBy(F.col(unit).alias("unit_uid")).agg(F.sum("tau_filled_min").alias("tau_filled_min_sum")).orderBy(F.desc("tau_filled_min_sum"), "unit_uid").limit(n)
