"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node.

    Each round points every node to its least neighbour, follows that pointer once more,
    and replaces the links by those between the nodes pointed to. Pointers only go down, so
    nodes become fewer every round and the least one is what remains; paths shrink to a third
    or so per round, but a star around a large node loses few nodes in its first.
    Tables of a round are written to the shared folder; only a count reaches the driver.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    while links.limit(1).count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        down = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
        down = stage(down, "pointers")
        beyond = down.select(F.col("a").alias("to"), F.col("to").alias("next"))
        down = stage(down.join(beyond, "to").select(F.col("a").alias("from"), F.col("next").alias("to")), "pointers")
        labels = stage(
            labels.join(down, labels.component == down["from"], "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            "labels",
        )
        left = down.select(F.col("from").alias("a"), F.col("to").alias("x"))
        right = down.select(F.col("from").alias("b"), F.col("to").alias("y"))
        moved = links.join(left, "a").join(right, "b").where("x <> y")
        links = stage(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    return labels
