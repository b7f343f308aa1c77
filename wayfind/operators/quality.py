"""Data quality of dimensions: tiers, uniqueness, references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tier_distribution(provinces: DataFrame) -> DataFrame:
    return provinces.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("province").alias("distinct_n"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known."""
    return rows.join(known.select(key).distinct(), key, "left_anti")
