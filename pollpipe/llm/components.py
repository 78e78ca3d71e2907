"""Connected components of a graph given as pairs, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links``.

    Each round hooks every node to its smallest neighbour or itself, follows those hooks to the
    end of two steps, and replaces the ends of every link by what they were hooked to; links
    that became loops go. The number of links shrinks in every round until none is left. A node
    with very many links is combined before the shuffle (minimum) and split by adaptive
    execution (join). Rows with a NULL end and loops do not count. No links, no rows.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes = written(edges.select("u").unionAll(edges.select(F.col("v").alias("u"))).distinct().select(F.col("u").alias("node"), F.col("u").alias("root")), "components-nodes")
    edges = written(_loopless(edges), "components-links")
    while not edges.isEmpty():
        near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("v"))
        hook = near.select("u", F.least("u", "v").alias("to"))
        hook = written(hook, "components-hooks")
        far = hook.select(F.col("u").alias("to"), F.col("to").alias("end"))
        hook = written(hook.join(far, "to", "left").select("u", F.coalesce("end", "to").alias("to")), "components-hooks")
        nodes = written(
            nodes.join(hook, nodes.root == hook.u, "left").select("node", F.coalesce("to", "root").alias("root")),
            "components-nodes",
        )
        ends = hook.select(F.col("u").alias("v"), F.col("to").alias("w"))
        moved = edges.join(hook, "u").select(F.col("to").alias("u"), "v").join(ends, "v").select("u", F.col("w").alias("v"))
        edges = written(_loopless(moved), "components-links")
    return nodes


def _loopless(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
