"""Connected components of a link table, as rounds of joins and partial aggregates.

Large-star and small-star alternate (Kiveris et al., 2014): each round points every node at the least
node it knows of, so stars form in a logarithmic number of rounds. No neighbour list is ever gathered:
a round takes the minimum of each node by a partial aggregate and joins it back, so a node with
very many links costs rows in many tasks, and AQE can split its join. Whether stars are left is asked before a round, by one
aggregate that stops at the first node against it, so no round is run only to see that it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyharbor.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v), u > v. Large star links the larger neighbours of a node to its least; small star the smaller ones."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    joined = both.join(least, both["u"] == least["c"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
    return out.where("u > v").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has either larger neighbours only or one link. links: (u, v), u > v, distinct."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).where("m < u AND n > 1").isEmpty()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node with a link to another; component is the least node reachable.

    links may hold self-links, repeats, nulls and both directions; those change nothing. Node types that Spark orders will do.
    """
    a, b = F.col(left), F.col(right)
    now = written(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while not _are_stars(now):
        now = written(_star(_star(now, True), False), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
