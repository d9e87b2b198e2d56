"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.support import written


def components(edges: DataFrame) -> DataFrame:
    """(id, root): for each id in the edges (a, b) the smallest id it is connected with.

    Every round an id takes the smallest root among its neighbours' and then the
    root of that root, so distances halve. Roots are written between rounds, and
    neighbours' roots meet in a partial ``min``, so a hub of any degree is fine.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = written(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("seen"))
        lower = roots.join(near, "id").select("id", "root", F.least("root", "seen").alias("next"))
        over = roots.select(F.col("id").alias("next"), F.col("root").alias("beyond"))
        step = written(
            lower.join(over, "next").select("id", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") != F.col("root")).alias("moved")),
            "roots",
        )
        roots = step.select("id", "root")
        if step.where("moved").isEmpty():
            return roots
