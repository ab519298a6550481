"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenshoe.llm.shared import Scratch


def _largest_first(edges: DataFrame) -> DataFrame:
    ends = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    return edges.where(F.col("a") != F.col("b")).select(*ends).distinct()


def _state(edges: DataFrame) -> tuple:
    """Two numbers that stay the same once the edges do."""
    mark = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its least node.

    Alternates two steps until nothing changes, each of which ties the neighbours of a node to
    the least of them: first its larger neighbours, then its smaller ones. The edges end as one
    star per component. Nothing but two sums comes to the driver.
    """
    current = scratch.save(_largest_first(edges), f"{name}-0")
    state, step = _state(current), 0
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").where(F.col("v") > F.col("u"))
        larger = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where(F.col("v") != F.col("m"))
        smaller = smaller.select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = smaller.unionByName(least.withColumnRenamed("m", "v")).distinct()
        step += 1
        following = scratch.save(tied, f"{name}-{step}")
        reached = _state(following)
        scratch.drop(f"{name}-{step - 1}")
        current = following
        if reached == state:
            break
        state = reached
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
