"""Connected components of a table of links, by stars that grow and shrink."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import stored


def _are_stars(links: DataFrame) -> bool:
    """True if every node hangs on one other, on which nothing but such nodes hang."""
    up, down = F.lit(1).alias("up"), F.lit(0).alias("up")
    ends = links.select(F.col("hi").alias("node"), up).unionByName(
        links.select(F.col("lo").alias("node"), down)
    )
    hung = F.sum("up")
    # A node that hangs must do so once, and have nothing hung on it.
    wrong = ends.groupBy("node").agg(hung.alias("hung"), F.count("*").alias("n")).where(
        "hung > 1 OR (hung = 1 AND n > 1)"
    )
    return wrong.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, but for the roots themselves.

    Takes links (a, b) of longs. A round hangs the larger neighbours of each node
    on its least one, then the smaller ones, until all are stars; the number of
    rounds grows with the logarithm of the links. Each round is stored. Joins are
    on nodes; a node with many links is a heavy key whose partition Spark splits.
    """
    pair = [F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")]
    stars = stored(links.select(*pair).where("hi <> lo").distinct(), "stars")
    while not _are_stars(stars):
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = (
            large.join(lowest, "hi")
            .where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        kept = lowest.select("hi", F.col("m").alias("lo"))
        stars = stored(hung.unionByName(kept).distinct(), "stars")
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
