"""Connected components of an edge table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import stored
from capstan.operators.joins import join_splittable


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(id, component) for every id in ``edges(a, b)``; component is the smallest id reachable.

    Alternates two contractions until every component is a star: each id hands
    its larger neighbours to its smallest neighbour, then its smaller
    neighbours.  Both keep connectivity and shrink distances, so the number of
    rounds grows with the logarithm of the longest path.  Each round is stored
    in the shared folder; nothing is collected but two counts.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = stored(e, "edges")
    for _ in range(max_rounds):
        # larger neighbours of x go to the smallest of x and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # (a hub's edges meet the hub's row: joins that can be split)
        large = (join_splittable(both.filter("v > u"), least, ["u"], "inner").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # smaller neighbours of x (and x) go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (join_splittable(large, low, ["u"], "inner").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        e = stored(small, "edges")
        # a star forest: every child has one parent, and no parent is a child
        kids = e.groupBy("u").agg(F.count("*").alias("n"))
        roots = e.select(F.col("v").alias("u")).distinct()
        if not kids.filter("n > 1").limit(1).count() and not kids.join(roots, "u").limit(1).count():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
