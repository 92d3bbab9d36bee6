"""Connected components of a link table, without collecting links or labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialise, release


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, label) of every node with a link; label is the least node reachable.

    Each round a node takes the least label among its neighbours and itself and then its label's label, so labels move
    along a path by a growing number of links a round. Rounds are cut by tables in the shared folder. The joins are plain
    equi-joins, which adaptive execution splits at hot nodes.
    """
    spark = links.sparkSession
    both = links.select(F.col(u).alias("u"), F.col(v).alias("v"))
    both, p_links = materialise(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "links")
    labels, path = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new, new_path = materialise(step.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        release(spark, path)
        labels, path = new.select("node", "label"), new_path
        if not new.where("was <> label").limit(1).count():
            release(spark, p_links)
            return labels
