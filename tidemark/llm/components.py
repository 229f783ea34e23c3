"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions

#: Links of a file, about: few links take few tasks, whatever the number of shuffle partitions.
LINKS = 200_000


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, label): the smallest node that links reach from each node of `links`.

    Every round takes the smallest label among the neighbours and then the label's own label, so that long chains
    shorten by halves. Rounds are written to the shared folder; they end when no label changes.
    """
    files = min(partitions(links.sparkSession), 2 * links.count() // LINKS + 1)
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct().coalesce(files))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label"))
    labels = materialize(labels.coalesce(files))
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("heard"))
        better = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        own = labels.select(F.col("node").alias("head"), F.col("label").alias("further"))
        jumped = better.join(own, F.col("label") == F.col("head"), "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        jumped = materialize(jumped.coalesce(files))
        labels = jumped.select("node", "label")
        if not jumped.filter("old != label").limit(1).count():
            return labels
