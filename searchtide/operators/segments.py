"""Run-together words, split by the words of the log itself.

The letters of a word are a lattice whose edges are the substrings that are words of
the log; an edge costs the negative logarithm of its word's share of all words. The
cheapest path is the split. Edges come from a join with the log's words, and the path
is found by an aggregate over the letters of one word.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.operators.counts import roll_up

#: Costs are whole numbers, millionths of a natural logarithm.
COST = 1_000_000

#: Letters and searches that a word of the log needs to be part of a split.
SHORTEST, LEAST = 2, 2

#: Letters up to which a word is looked at; a longer one is left as it is.
LONGEST = 64

_PATHS = "array<struct<cost: bigint, n: int, words: array<string>>>"


def tokens(counts: DataFrame) -> DataFrame:
    """(keyword, search_count, at, word): the words of every distinct keyword."""
    words = roll_up(counts, ["keyword"]).select(
        "keyword", "search_count", F.posexplode(F.split("keyword", " +")).alias("at", "word")
    )
    return words.where("word <> ''")


def word_counts(counts: DataFrame) -> DataFrame:
    """(word, n): searches per word of the keywords, words being parted by blanks."""
    return tokens(counts).groupBy("word").agg(F.sum("search_count").alias("n"))


def _paths(edges: DataFrame) -> DataFrame:
    """(word, parts): the cheapest path through the edges (word, start, end, part, cost).

    Of equal costs the path with fewer parts wins, then the one first in order.
    """
    lattice = edges.groupBy("word").agg(
        F.collect_list(F.struct("start", "end", "part", "cost")).alias("edges")
    )
    begin = F.expr(f"CAST(array(struct(0L, 0, array())) AS {_PATHS})")

    def step(best, end):
        """The best path to a place, appended to those of the places before it."""
        here = F.filter("edges", lambda e: (e["end"] == end) & F.element_at(best, e["start"] + 1).isNotNull())
        longer = F.transform(
            here,
            lambda e: F.struct(
                (F.element_at(best, e["start"] + 1)["cost"] + e["cost"]).alias("cost"),
                (F.element_at(best, e["start"] + 1)["n"] + 1).alias("n"),
                F.concat(F.element_at(best, e["start"] + 1)["words"], F.array(e["part"])).alias("words"),
            ),
        )
        return F.concat(best, F.array(F.array_min(longer)))

    places = F.sequence(F.lit(1), F.char_length("word"))
    last = F.element_at(F.aggregate(places, begin, step), -1)
    return lattice.select("word", last["words"].alias("parts")).where(F.col("parts").isNotNull())


def word_splits(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, parts): the words of the log that are cheaper in parts than as they are.

    A word of the log searched ``least`` times is itself a path of one edge, so a
    common word stays whole. Words without any path are not in the result.
    """
    words = word_counts(counts)
    total = words.agg(F.sum("n").cast("double")).scalar()
    cost = F.floor(COST * F.log(total / F.col("n").cast("double")))
    known = words.where((F.col("n") >= least) & (F.char_length("word") >= SHORTEST))
    parts = known.select(F.col("word").alias("part"), cost.alias("cost"))
    size = F.char_length("word")
    starts = F.explode(F.sequence(F.lit(0), size - SHORTEST)).alias("start")
    lattice = (
        words.where((size >= SHORTEST) & (size <= LONGEST))
        .select("word", starts)
        .select("word", "start", F.explode(F.sequence(F.col("start") + SHORTEST, size)).alias("end"))
        .withColumn("part", F.substring("word", F.col("start") + 1, F.col("end") - F.col("start")))
    )
    return _paths(lattice.join(parts, "part")).where(F.size("parts") > 1)


def split_keywords(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(keyword, search_count, split): distinct keywords, run-together words split.

    Null stays null, and blanks between words become single ones where a word is split.
    """
    splits = word_splits(counts, least).select("word", F.array_join("parts", " ").alias("apart"))
    placed = tokens(counts).join(splits, "word")
    # Only keywords that change are put together again.
    changed = placed.select("keyword").distinct()
    again = (
        tokens(counts)
        .join(changed, "keyword", "left_semi")
        .join(splits, "word", "left")
        .groupBy("keyword")
        .agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("apart", "word").alias("word")))).alias("all"))
        .select("keyword", F.array_join(F.col("all")["word"], " ").alias("split"))
    )
    return (
        roll_up(counts, ["keyword"])
        .join(again, "keyword", "left")
        .select("keyword", "search_count", F.coalesce("split", "keyword").alias("split"))
    )


def merge_run_together(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """Searches per keyword, run-together spellings counted as the words they are made of."""
    split = split_keywords(counts, least)
    return split.groupBy(F.col("split").alias("keyword")).agg(
        F.sum("search_count").alias("search_count"), F.count("*").alias("spellings")
    )
