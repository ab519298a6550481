"""Keeping one row per key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    All columns follow as tie-breakers, so that a re-run picks the same row. Spark limits each
    key to one row per task before the shuffle, so a key with very many copies stays cheap.
    """
    ties = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def newest_landed(df: DataFrame) -> list[Column]:
    """The order of landed answers, the last one first, where the table has their time."""
    return [newest("landed_at")] if "landed_at" in df.columns else []


def newest(column: str) -> Column:
    """Descending order with NULL first: a row without a timestamp counts as the newest."""
    return F.col(column).desc_nulls_first()
