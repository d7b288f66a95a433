"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import forget, written


def _nearest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every greater neighbour of a node on the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _nearest(both).select("u", F.least("u", "least").alias("least"))
    return (
        both.join(least, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its lesser neighbours on the least of these. Rows have u > v."""
    least = _nearest(links)
    moved = links.join(least, "u").where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links(u, v)``; the component is its least node.

    Both star steps keep the components; together they end in stars after about log(size)
    rounds. A node's links are only ever aggregated to a minimum or joined to one row, so no
    node is too popular. Each round is written to the shared folder. No links, no rows. Links
    of a node with itself or NULL are no links.
    """
    links = (
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    links = written(links, label)
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        done, links = links, written(_small_star(_large_star(links)), label)
        forget(done)
