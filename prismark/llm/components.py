"""Connected components of a link table, by smallest labels and pointer jumping.

Every round a node takes the smallest label among its neighbours and then its
label's label; labels are stored in the shared folder, so a lost executor costs
one round at most.  The loop ends when no label changes; nothing is collected
but that count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prismark.llm.runtime import discard, stored


#: Links or labels that one task of a round handles at least.
ROWS_PER_TASK = 50_000


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every end of the links ``a, b``."""
    tasks = 2 * links.count() // ROWS_PER_TASK + 1
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct().coalesce(tasks),
        "component-links",
    )
    labels = held = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")).coalesce(tasks), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("now")
        )
        up = labels.select(F.col("node").alias("now"), F.col("component").alias("up"))
        moved = stored(
            lower.join(up, "now", "left").select("node", "was", F.least("now", "up").alias("component")).coalesce(tasks), "component-labels"
        )
        discard(held)
        held, labels = moved, moved.select("node", "component")
        if moved.where("was <> component").isEmpty():
            discard(both)
            return labels
