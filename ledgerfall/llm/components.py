"""Connected components of a table of links, by alternating star contraction.

Rounds of two groupings, each halving distances or better; each round's links are
a written table.  No component or adjacency list is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm.shared import stored


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links of every node's neighbours to the least node among them and itself.

    ``larger_only``: only those of the larger neighbours are rewritten (the large
    star); else each node links its smaller neighbours and itself to the least.
    """
    if larger_only:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = near.join(least, "a")
    if larger_only:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    ).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node of its component) for every node of a link ``a, b``.

    Nodes are longs.  Null ends and links of a node to itself are no links.
    """
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    sign = _signature(links)
    while True:
        links = stored(_star(_star(links, True), False))
        before, sign = sign, _signature(links)
        if sign == before:
            break
    heads = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)


def _signature(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mark = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first())
