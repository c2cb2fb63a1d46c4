"""Connected components by label spreading with jumps, in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeforge.session import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root``: of every node of ``links(a, b)`` the least node it is connected with.

    Each round a node takes the least label of its neighbours and then the label of that
    label, so chains shorten by half; it stops as soon as no label changes. Every round is a
    table in the shared folder: lost executors cost a task, not the history."""
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("low"))
        stepped = labels.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "low").alias("next"))
        up = labels.select(F.col("node").alias("of"), F.col("root").alias("top"))
        after = cut(
            stepped.join(up, F.col("next") == F.col("of"), "left").select(
                "node", F.least("next", F.coalesce("top", "next")).alias("root"), (F.col("root") != F.least("next", F.coalesce("top", "next"))).alias("moved")
            ),
            "labels",
        )
        labels = after.select("node", "root")
        if not after.filter("moved").limit(1).count():
            return labels
