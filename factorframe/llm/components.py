"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from factorframe.llm.common import drop_saved, saved


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """Edges (u, v), v < u, after each node has linked its neighbours to the least of them.

    The large star links a node's larger neighbours, the small star its smaller ones and itself.
    """
    ways = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    joined = ways.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", F.col("least").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """u and v of every linked id but the least of each component: v is that least one.

    ``links`` has columns a and b. A round joins and groups the edges, and is written to the shared folder;
    their number never grows, and the rounds needed grow with the logarithm of a component's size.
    """
    edges = saved(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state:
            return edges
        state, before = mark, edges
        edges = saved(_star(_star(edges, large=True), large=False), label)
        drop_saved(before)
