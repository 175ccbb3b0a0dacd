"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from editsieve.llm.exchange import written


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that links lead to, for every node with a link.

    In each round every node points to its smallest neighbour or itself, and links are rewritten between what they
    point to; the roots of a round are the nodes of the next. A round at least halves the nodes that have links, and
    a group of copies around one document is done in one. Nothing is collected.
    """
    pairs = links.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).filter("a < b").distinct()
    pairs = written(pairs)
    label = None
    while not pairs.isEmpty():
        ends = pairs.union(pairs.select("b", "a"))
        parent = ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent"))
        parent = written(parent)
        # a chain of pointers is followed two steps, which keeps the next round small
        parent = written(
            parent.alias("x").join(parent.alias("y"), F.col("x.parent") == F.col("y.node"))
            .select("x.node", F.col("y.parent").alias("parent"))
        )
        if label is None:
            label = parent.withColumnRenamed("parent", "component")
        else:
            step = parent.withColumnRenamed("node", "component")
            label = label.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        label = written(label)
        pairs = (
            pairs.join(parent.selectExpr("node AS a", "parent AS pa"), "a").join(parent.selectExpr("node AS b", "parent AS pb"), "b")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).filter("a < b").distinct()
        )
        pairs = written(pairs)
    if label is None:
        label = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
