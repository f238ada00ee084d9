"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.llm.staging import staged


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of `edges` (a, b): the root is the least node of the component.

    A round takes the least label among the neighbours and then the label of that label, so chains halve and the
    number of rounds grows with the logarithm of the longest. Each round ends in a stored table. Null nodes are left out.
    """
    known = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = staged(known.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .union(known.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("seen")), "other")
        own = labels.select("node", F.col("root").alias("seen"), "root")
        lower = (near.select("node", "seen", F.lit(None).cast(labels.schema["root"].dataType).alias("root")).unionByName(own)
                 .groupBy("node").agg(F.max("root").alias("root"), F.min("seen").alias("low")))
        jumped = lower.join(labels.select(F.col("node").alias("low"), F.col("root").alias("far")), "low")
        moved = staged(jumped.select("node", "root", F.least("low", "far").alias("next")), "labels")
        labels = moved.select("node", F.col("next").alias("root"))
        if moved.where(F.col("root") != F.col("next")).isEmpty():
            return labels
    raise RuntimeError(f"components are not settled after {most_rounds} rounds")
