"""Connected components of a links table by minimum label with pointer jumping, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize


def components(links: DataFrame) -> DataFrame:
    """links: a, b (bigint, no nulls). Returns id, label for every id in a link; label is the smallest id reachable.

    An empty links table gives an empty result. Each round lowers every label to the least among the neighbours and
    then to that label's own label, so that chains shorten by powers of two; the round's table is written out."""
    both = links.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    rows = 2 * links.count()
    both = materialize(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), rows)
    labels = materialize(both.groupBy(F.col("src").alias("id")).agg(F.least(F.first("src"), F.min("dst")).alias("label")), rows)
    while True:
        near = both.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        after = materialize(lower.join(jump, "label", "left").select("id", "was", F.least("label", "jump").alias("label")), rows)
        labels = after.select("id", "label")
        if after.where("label <> was").isEmpty():
            return labels
