"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Alternates large-star and small-star steps until no edge changes. A step groups by a node and keeps only a minimum,
    and each one's result is written to the shared folder, so plans stay short and lost executors cost one step.
    """
    now = written(edges.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above u go to u's minimum
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: u and its neighbours below go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        after = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        after = written(after, "edges")
        changed = after.join(now, ["u", "v"], "left_anti").limit(1).count() + now.join(after, ["u", "v"], "left_anti").limit(1).count()
        now = after
        if not changed:
            break
    else:
        raise RuntimeError("links did not settle")
    nodes = edges.select(F.col(a).cast("bigint").alias("node")).union(edges.select(F.col(b).cast("bigint"))).distinct()
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").groupBy("node").agg(F.min(F.coalesce("c", "node")).alias("component"))
