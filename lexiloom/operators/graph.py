"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of edges (a, b).

    Labels spread to neighbours and jump to their label's label until nothing changes, so a long chain takes
    few rounds; each round is written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("src", "dst"), "edges")
    labels = written(both.groupBy("src").agg(F.min("dst").alias("low")).select(F.col("src").alias("node"), F.least("src", "low").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("src") == F.col("node")).groupBy("dst").agg(F.min("component").alias("low"))
        spread = labels.join(near, F.col("node") == F.col("dst")).select("node", F.col("component").alias("was"), F.least("component", "low").alias("now"))
        up = labels.select(F.col("node").alias("over"), F.col("component").alias("root"))
        moved = written(spread.join(up, F.col("now") == F.col("over")).select("node", "was", F.least("now", "root").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.filter("was != component").isEmpty():
            return labels
