"""Connected components over links, settled in the shared folder round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``_node`` and ``_component`` (its smallest node) for every node that has a link.

    Each round, every root takes the smallest root that a link joins it to, and then all nodes follow
    their root's root. Links inside one component fall away, so the work shrinks. Minima are taken in
    each task before they are shuffled; no task holds the neighbours of a hub, and nothing but one number
    a round reaches the driver.
    """
    edges = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    nodes = edges.select(F.col("u").alias("_node")).unionAll(edges.select("v")).distinct()
    label = nodes.select("_node", F.col("_node").alias("_component"))
    while edges.limit(1).count():
        low = edges.groupBy("u").agg(F.min("v").alias("to"))
        # hops along the chosen links: twice as far each time, to the end of every chain
        while True:
            far = low.alias("l").join(low.alias("m"), F.col("l.to") == F.col("m.u"), "left")
            low = cut_lineage(far.select("l.u", F.coalesce("m.to", "l.to").alias("to"), F.col("m.to").isNotNull().alias("moved")))
            if not low.filter("moved").limit(1).count():
                break
            low = low.select("u", "to")
        low = low.select("u", "to")
        label = label.join(low, F.col("_component") == F.col("u"), "left").select("_node", F.coalesce("to", "_component").alias("_component"))
        one = edges.join(low, "u").select("to", "v").join(low.withColumnRenamed("to", "other"), F.col("v") == F.col("u"), "left")
        one = one.select(F.col("to").alias("x"), F.coalesce("other", "v").alias("y")).filter("x <> y")
        edges = cut_lineage(one.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
        label = cut_lineage(label)
    return label
