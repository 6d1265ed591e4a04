"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for the nodes of ``links`` (``a``, ``b``: bigint).

    Each round takes the least root among a node and its neighbours and then the root of that root,
    so the number of rounds grows with the logarithm of the longest path. Every round is a table in
    the shared folder; the driver sees a count only. Links with a NULL end count for nothing; without
    links there are no rows. A hot node is a hot join key on the side that Spark splits, and its
    neighbours' roots are reduced before the shuffle.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "links")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", F.least("root", "near").alias("up"), F.col("root").alias("was"))
        above = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        step = lower.join(above, "up").select("node", F.least("up", "top").alias("root"), (F.least("up", "top") < F.col("was")).alias("moved"))
        step = stored(step, "roots")
        roots = step.select("node", "root")
        if step.where("moved").limit(1).count() == 0:
            return roots
