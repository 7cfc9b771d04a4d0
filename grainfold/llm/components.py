"""Connected components of a table of links, without a graph in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.session import written


def _toward_smaller(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("least").alias("a"), "b").where("a < b").distinct()


def _among_smaller(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    smaller = links.join(least, "b")
    moved = smaller.select(F.col("least").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("least").alias("a"), "b")
    return moved.unionByName(own).where("a < b").distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node either starts links or ends a single one."""
    ends = F.explode(F.array(*(F.struct(F.col(c).alias("node"), F.lit(n).alias("end")) for c, n in (("a", 0), ("b", 1)))))
    nodes = links.select(ends.alias("at")).groupBy("at.node").agg(F.sum("at.end").alias("ends"), F.min("at.end").alias("least"))
    return not nodes.agg(F.max((F.col("ends") > 1) | ((F.col("ends") == 1) & (F.col("least") == 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it is linked with.

    ``links`` is read several times. Alternates the two star operations until the links are stars, about log(n) rounds; each
    round is written, and runs when this is called. Links of a node with itself or with
    null are ignored.
    """
    stars = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    while True:
        stars = written(_among_smaller(_toward_smaller(stars)), "links")
        if _are_stars(stars):
            break
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return stars.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(centres)
