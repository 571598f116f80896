"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """links (a, b): returns node, label with one label, the least node, for
    each component. Each round takes the least label among a node and its
    neighbours and then the label of that label, so chains halve; every round
    is staged, and only the number of changed labels reaches the driver.
    Links with a null end or equal ends are left out."""
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    both = stage(pairs.select("a", "b").union(pairs.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                   .select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stage(hooked.join(jump, "label").select("node", F.least("label", "further").alias("label"),
                                                        (F.least("label", "further") != F.col("old")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels
