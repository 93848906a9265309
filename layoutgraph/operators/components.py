"""Connected components by label spreading and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layoutgraph.plans.session import cut


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, cls): the least id of each node's connected component. Labels spread over the edges and are shortened by
    pointer jumping; each round is cut to the shared folder. ``edges``: (a, b) in one direction."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = cut(nodes.select("id", F.col("id").alias("cls")), "labels")
    while True:  # labels only fall, so the rounds end
        spread = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("cls").alias("other"))
        new = labels.join(spread.withColumnRenamed("a", "id"), "id", "left").select("id", F.least("cls", F.coalesce("other", "cls")).alias("new"), F.col("cls").alias("old"))
        jump = new.select(F.col("id").alias("new"), F.col("new").alias("further"))
        step = cut(new.join(jump, "new", "left").select("id", F.coalesce("further", "new").alias("cls"), "old"), "labels")
        labels = step.select("id", "cls")
        if step.filter("cls <> old").isEmpty():
            return labels
