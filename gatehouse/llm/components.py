"""Connected components of a link table, by repeated contraction.

Every round hooks each node to its smallest neighbour, shortens the hooks by
pointer jumping, and replaces the links by the distinct links between the
nodes that remain. A round at least halves the nodes that are not yet alone,
so the number of rounds grows with the logarithm of the longest chain. All
steps are joins and partial aggregates of two-column tables; the driver sees
one count per round. The tables of a round are written to the shared folder,
so no lineage grows and a lost executor costs one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehouse.llm.common import written

JUMPS = 3


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the component's smallest node.

    Self-links and repeated links change nothing; links with a null end are
    dropped. An empty table gives an empty result.
    """
    edges = written(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("a < b").distinct(), "cc-links")
    labels = None
    while not edges.isEmpty():
        # hook: smallest neighbour, never larger than the node itself
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a").alias("p")),
                                              F.struct(F.col("b").alias("node"), F.col("a").alias("p")))).alias("e"))
        hooks = written(ends.select("e.*").groupBy("node").agg(F.min("p").alias("p")), "cc-hooks")
        for _ in range(JUMPS):
            up = hooks.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            hooks = written(hooks.join(up, "p").select("node", F.col("pp").alias("p")), "cc-hooks")
        if labels is None:
            labels = hooks.select("node", F.col("p").alias("root"))
        else:
            up = hooks.select(F.col("node").alias("root"), "p")
            labels = written(labels.join(up, "root", "left")
                             .select("node", F.coalesce("p", "root").alias("root")), "cc-labels")
        on_a = hooks.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        on_b = hooks.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        half = written(edges.join(on_a, "a").select("pa", "b"), "cc-half")
        edges = written(half.join(on_b, "b")
                        .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                        .where("a < b").distinct(), "cc-links")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return labels
