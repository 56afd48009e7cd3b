"""Connected components of links between documents, by alternating stars of neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.session import materialize

def smallest_reachable(*links: DataFrame) -> DataFrame:
    """(doc_id, component_id) for each id linked with a smaller one: the smallest reachable id.

    Each step points every node at the smallest of its neighbours: first those larger than
    itself, then those smaller. The sums are pre-aggregated, the joins split a hub's rows,
    and each step's edges are written to the shared folder, so that a lost executor costs
    one step. The number of steps grows with the logarithm of the longest chain.
    """
    both = None
    for x in links:
        a, b = x.columns[:2]
        pair = x.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v")
        both = pair if both is None else both.union(pair)
    edges = materialize(both.distinct(), "edges")
    while True:
        # Larger neighbours of u, and u itself, point at the smallest neighbour of u.
        ways = edges.union(edges.select("v", "u"))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ways.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u != v").distinct(), "edges")
        # Smaller neighbours of u, and u itself, point at the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Unchanged edges are stars: no node points at a node that points further.
        changed = after.exceptAll(edges).limit(1).count() or after.count() != edges.count()
        edges = after
        if not changed:
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("component_id"))
    return stars.select(F.col("u").alias("doc_id"), "component_id")
