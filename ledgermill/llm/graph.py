"""Connected components of links, as alternating star contractions.

Each round joins every node's neighbours to its smallest neighbour, first over
larger neighbours, then over smaller ones (the large-star and small-star steps
of published map-reduce components). Components keep connected, edges do not
multiply, and a number of rounds that grows with the logarithm leaves stars
whose centre is the smallest node. Minima are combined before they are shuffled,
so a hub is no hot group; rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.session import stage


def _distinct(e: DataFrame) -> DataFrame:
    return e.where("u <> v").distinct()


def _round(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = _distinct(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(small.unionByName(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another; the component is its smallest node.

    Nulls, self links and repeated links are ignored; no links give no rows.
    """
    e = stage(_distinct(links.where(f"{a} IS NOT NULL AND {b} IS NOT NULL").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))), "components")
    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, e = now, stage(_round(e), "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
