"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyspark.llm.common import cut
from tallyspark.session import scratch_path
from tallyspark.sources.store import written


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (a, b).

    Smallest labels pass along links and are then looked up through the label
    itself, so chains shrink by halves.  Sums over hot nodes combine before the
    shuffle.  Each round is written to files under the checkpoint folder and read back, so that its
    size is that of its files: a checkpoint keeps the estimate of its plan, which
    for joins is a product and would have twice the digits after every round.
    """
    spark = links.sparkSession
    kept = lambda df: written(df, scratch_path(spark, "components"))
    both = cut(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = step.join(labels.select(F.col("node").alias("component"), F.col("component").alias("far")), "component", "left")
        new = kept(jump.select("node", "was", F.least("component", F.coalesce("far", "component")).alias("component")))
        labels = new.select("node", "component")
        if not new.where("was <> component").head(1):
            return labels
