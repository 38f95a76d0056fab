"""Connected components of an undirected graph given as rows of (a, b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut


def _relinked(links: DataFrame) -> DataFrame:
    """Links (a, b), a being the larger: each a is linked to the least that its b is linked to, then all that one a is linked to
    to the least of them.

    The second step runs where the first one's rows were dealt to, so a round has three or four exchanges.
    """
    up = links.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    first = links.join(up, "b", "left").select("a", F.coalesce("m", "b").alias("b")).repartition("a").distinct()
    least = first.groupBy("a").agg(F.min("b").alias("m"))
    second = first.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return second.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").repartition("a").distinct()


def _stars(links: DataFrame) -> bool:
    """Each node is linked to one lesser node that is linked to none; relinking would change nothing."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))
    nodes = links.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.down").alias("down"), F.min("e.down").alias("centre"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("centre") == 0)))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, least) for every node that has an edge, ``least`` being the least node it can reach.

    Alternating relinking to the least neighbour ends in one star a component after a number of rounds that grows with the
    logarithm of the longest path. Each round's edges are written to the shared folder; only a count reaches the driver.
    An empty edge table gives no rows; loops and repeated edges change nothing.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").repartition("a").distinct())
    while not _stars(now):
        now = cut(_relinked(now))
    return now.select(F.col("a").alias("node"), F.col("b").alias("least")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct()
    )
