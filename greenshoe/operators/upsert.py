"""Upsert of one table into another by key."""

from pyspark.sql import Column, DataFrame

from greenshoe.operators.latest import latest_by


def upsert(
    current: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """The table after the merge: incoming rows replace those with their key, others are added.

    Of several incoming rows with one key the first in ``order`` counts. A plain Parquet table
    has no MERGE, so the result is the next version of the table. A batch that Spark finds small
    is broadcast, and then the current rows are not shuffled.
    """
    batch = latest_by(incoming, keys, order)
    kept = current.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*current.columns))
