"""Connected components of a link table, by alternating large and small stars.

Each round is two aggregations by node and two joins with their minima; a node with
very many links is aggregated before the shuffle, and its join is one that adaptive
execution splits.  The links of a round are written to the shared folder, so a
lost executor costs one round at most.  Nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelab.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    others = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return others.union(least.select("hi", F.col("m").alias("lo")))


def components(links: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that has a link to another node; the component
    is its smallest node.  Links may repeat, point either way or join a node to itself;
    links with a null end are ignored.  No links: an empty table."""
    current = staged(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "links",
    )
    seen = None
    for _ in range(max_rounds):
        current = staged(_small_star(_large_star(current).where("hi <> lo").distinct()).distinct(), "links")
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
