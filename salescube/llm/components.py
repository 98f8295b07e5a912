"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on node ids; the driver learns only
whether the edges have become stars. A hub with a large share of
the edges only ever meets the grouped minimum (combined before the shuffle)
and a join whose other side has one row per node, which Spark splits when
skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, component), component = least node reachable.

    Null ends and self loops are ignored; repeated edges count once; no edges
    give an empty table. Nodes without edges do not appear.
    """
    e = stored(edges.where("a is not null and b is not null and a <> b")
               .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
               .distinct(), "edges")
    while True:
        both = e.union(e.select("other", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("node"), F.col("m").alias("other")).distinct())
        root = large.groupBy("node").agg(F.min("other").alias("m"))
        small = (large.join(root, "node").where("other <> m")
                 .select(F.col("other").alias("node"), F.col("m").alias("other"))
                 .union(root.select("node", "m")))
        e = stored(small.distinct(), "edges")
        if _is_star_forest(e):
            return e.select("node", F.col("other").alias("component"))


def _is_star_forest(e: DataFrame) -> bool:
    """Each node has one edge and no node is another one's root."""
    if not e.groupBy("node").count().where("count > 1").isEmpty():
        return False
    return e.select(F.col("other").alias("node")).join(e.select("node"), "node", "left_semi").isEmpty()
