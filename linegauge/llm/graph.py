"""Connected components of links between integer nodes, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import released, stored


@released
def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (a, b): component is the smallest node reachable.

    Each round takes the least label among the neighbours and then the label of that label, so paths shorten by half. Rounds are written to
    the shared folder, which keeps plans short; no link passes through the driver.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("least"))
        step = labels.join(seen, "node").select("node", F.least("component", "least").alias("near"), F.col("component").alias("before"))
        of_label = labels.select(F.col("node").alias("near"), F.col("component").alias("further"))
        step = step.join(of_label, "near", "left").select(
            "node", F.least("near", F.coalesce("further", "near")).alias("component"), "before"
        )
        after = stored(step, "labels")
        if not after.where("component != before").limit(1).count():
            return after.select("node", "component")
        labels = after.select("node", "component")
