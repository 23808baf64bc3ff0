"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, keep

MAX_ROUNDS = 64


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for all nodes of the links other than the roots: root is the smallest node that can be reached.

    A round points each node to its smallest neighbour if that is smaller, follows the pointers one
    step further, and replaces each link by the link of the roots its ends have now; links within a
    root vanish. A star ends after a round, and a chain of n after about log n. Each round is a few
    joins and a written table; a hub's links are reduced before they are shuffled, and a join with
    a hub is split by adaptive execution. Null ends are ignored, and so are links to oneself.
    """
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    edges = stored = keep(edges, "links")
    steps: list[DataFrame] = []
    while len(steps) < MAX_ROUNDS and not edges.isEmpty():
        up = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        jump = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
        parent = keep(up.join(jump, "up", "left").select("node", F.coalesce("next", "up").alias("root")), "parents")
        steps.append(parent)
        for end in ("a", "b"):
            edges = edges.join(parent.select(F.col("node").alias(end), "root"), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        left = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
        discard(stored)
        edges = stored = left
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("false")
    if not edges.isEmpty():
        raise ValueError("too many rounds")
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("then"))
        moved = found.join(later, "root", "left").select("node", F.coalesce("then", "root").alias("root"))
        # A node that others were pointed to while it had a smaller neighbour itself is in several steps.
        found = moved.unionAll(step).groupBy("node").agg(F.min("root").alias("root"))
    discard(stored)
    if len(steps) == 1:
        return found
    out = keep(found, "components")
    discard(*steps)
    return out
