"""Connected components of a link table, in Spark.

Each round hooks every node's root to the smallest root among its neighbours
and then shortens the pointers, until no root changes.  Labels are cut by
``checkpoint`` into the shared folder every round; nothing but a count comes to
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """``node component`` (smallest node reachable) of every node of ``links`` (``a b`` longs, any direction, repeats allowed)."""
    spark = links.sparkSession
    both = checkpoint(
        links.select("a", "b").union(links.select("b", "a")).where(F.col("a") != F.col("b")).distinct().toDF("a", "b"), spark
    )
    label = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")).toDF("node", "c")
    label = checkpoint(label, spark)
    while True:
        # the smallest label around each label's own node: stars shrink to their smallest member
        near = both.join(label.toDF("b", "nc"), "b").groupBy("a").agg(F.min("nc").alias("nc")).toDF("node", "nc")
        low = label.join(near, "node").select("node", "c", F.least("c", "nc").alias("n"))
        hook = low.groupBy("c").agg(F.min("n").alias("h")).toDF("c", "h")  # a root follows the smallest its members see
        jump = label.toDF("h", "hc")
        new = (
            low.join(hook, "c").select("node", F.col("c"), F.least("n", "h").alias("h"))
            .join(jump, "h", "left").select("node", F.col("c").alias("old"), F.least("h", F.coalesce("hc", "h")).alias("c"))
        )
        new = checkpoint(new, spark)
        changed = new.where(F.col("old") != F.col("c")).limit(1).count()
        label = new.select("node", "c")
        if not changed:
            return label.toDF("node", "component")


def joined(label: DataFrame, more: DataFrame) -> DataFrame:
    """``label`` (``node component``, where a node without a row is its own component) after the components of the pairs ``more`` (``a b``,
    cut by ``checkpoint``) became one.  Only the graph of these pairs is gone through."""
    if more.isEmpty():
        return label
    found = components(more).toDF("component", "to")
    every = label.select("node", "component").union(found.select("component", "component")).distinct()
    return every.join(found, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
