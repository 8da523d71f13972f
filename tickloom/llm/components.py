"""Connected components of a graph held in a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import dropped, written


def connected(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (id, component): each linked id and the smallest id it reaches.

    Every round points the neighbours of an id at the smallest of them, first those
    above the id, then those below it, until each component is a star. A round is
    sums and joins on ids; neighbours of an id are never gathered in one place. Rounds
    grow with the logarithm of the graph. Self-links and nulls are left out.

    Links are written after both halves of a round: each half reads its links twice, and
    reading a table takes few tasks where computing them again takes a whole shuffle.
    """
    links = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while not _all_stars(links):
        for step in (_down_from_lower_end, _down_from_upper_end):
            before = links
            links = written(step(links), "links")
            dropped(links.sparkSession, before._written_at)
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _lowest(links: DataFrame, end: str) -> DataFrame:
    """Per id that links lead down from, as the column ``end``, the smallest id that they lead to."""
    # The same join at every size: a broadcast would come after both sides were dealt out already.
    return links.groupBy(F.col("a").alias(end)).agg(F.min("b").alias("low")).hint("merge")


def _down_from_lower_end(links: DataFrame) -> DataFrame:
    """Each link (a, b) leads to the smallest id below b, if there is one."""
    return links.join(_lowest(links, "b"), "b", "left").select("a", F.coalesce("low", "b").alias("b"))


def _down_from_upper_end(links: DataFrame) -> DataFrame:
    """Each id below a, a included, is linked to the smallest id below a."""
    is_low = F.col("b") == F.col("low")
    return links.join(_lowest(links, "a"), "a").select(
        F.when(is_low, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")
    ).distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every id has one link down at most, and none that is linked to has any."""
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("low"), F.lit(0).alias("below")).unionByName(
        links.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("low"), F.lit(1).alias("below"))
    )
    odd = ends.groupBy("id").agg(F.min("low").alias("l1"), F.max("low").alias("l2"), F.max("below").alias("below"))
    return odd.where("l1 <> l2 OR (l1 IS NOT NULL AND below = 1)").isEmpty()
