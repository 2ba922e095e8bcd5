"""Connected components of a table of links, by contraction.

Each round every node points to its smallest neighbour (or itself), then one step
further; links are rewritten to what their ends point to, until none is left. Ids
are meant to be digests, whose order has nothing to do with the links: a constant
share of the nodes then vanishes each round. (A chain of ascending ids would lose
two nodes a round only; the result is right all the same.) A hot node costs no
more than its links: neighbours are only reduced to a minimum, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long); label is the smallest node reachable."""
    links = links.select("a", "b").filter("a <> b")
    links = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = links.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")).checkpoint()
    while not links.isEmpty():
        to = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("to"))
        # one jump more halves long chains
        hop = to.withColumnRenamed("to", "far").withColumnRenamed("a", "to")
        to = to.join(hop, "to", "left").select("a", F.coalesce("far", "to").alias("to")).checkpoint()
        labels = (labels.join(to.withColumnRenamed("a", "label"), "label", "left")
                  .select("node", F.coalesce("to", "label").alias("label")).checkpoint())
        left = links.join(to, "a").select(F.col("to").alias("x"), "b")
        links = (left.join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
                 .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct().checkpoint())
    return labels
