"""Misspelt keywords and what was most likely meant, from the counts alone.

Two spellings with up to two letters left out of each meet in a common rest if they
are at most two edits apart. So every keyword gives all its rests, equal rests pair
up, and the edit distance decides. The more popular spelling wins by a noisy channel:
each edit has to be paid for by so many times the searches.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.operators.counts import merge_aliases, roll_up

#: Searches that a spelling needs for each edit, as a multiple of the misspelt one's.
RATIO = 20

#: Letters of a keyword that rests are made of. Two spellings within two edits have a
#: common rest in the first letters already, whatever comes after.
HEAD = 64

#: Shortest keywords in which one and two edits are looked for.
ONE_EDIT, TWO_EDITS = 4, 8


def edits_allowed(length: Column) -> Column:
    return F.when(length < ONE_EDIT, 0).when(length < TWO_EDITS, 1).otherwise(2)


def _rests(keyword: Column) -> Column:
    """Hashes of the keyword's head with no, one, or (in long ones) two letters left out."""
    head = F.substring(keyword, 1, HEAD)
    size = F.char_length(head)

    def cut(start: Column, stop: Column | None = None) -> Column:
        """Letters from ``start`` on, up to and without ``stop``."""
        return F.substring(head, start, F.lit(HEAD) if stop is None else stop - start)

    one = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(cut(F.lit(1), i), cut(i + 1)))
    two = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size - 1),
            lambda i: F.transform(
                F.sequence(i + 1, size),
                lambda j: F.concat(cut(F.lit(1), i), cut(i + 1, j), cut(j + 1)),
            ),
        )
    )
    rests = F.concat(F.array(head), one, F.when(size >= TWO_EDITS, two).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.transform(rests, lambda rest: F.xxhash64(rest)))


def corrections(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(keyword, search_count, corrected, corrected_count, distance) of misspelt keywords.

    ``corrected`` is the keyword within the allowed edits that was searched more than
    ``ratio`` times as often for each edit, and of those the one with the most searches
    once edits are paid for, then the nearest, then the first in order. The shorter of
    both spellings decides how many edits are allowed: none below four letters, one
    below eight, else two. An edit puts in, leaves out or replaces one letter, also a
    blank. Keywords without such a spelling, and null, have no row.

    Only keywords searched more than ``ratio`` times can win, so pairs are made between
    those and the others, never among all spellings that share a rest.
    """
    if ratio < 1:
        raise ValueError("ratio must be 1 or more")
    spellings = roll_up(counts, ["keyword"]).where(
        F.col("keyword").isNotNull() & (F.char_length("keyword") >= ONE_EDIT)
    )
    typed = spellings.select("keyword", "search_count", F.explode(_rests(F.col("keyword"))).alias("rest"))
    meant = spellings.where(F.col("search_count") > ratio).select(
        F.col("keyword").alias("corrected"),
        F.col("search_count").alias("corrected_count"),
        F.explode(_rests(F.col("keyword"))).alias("rest"),
    )
    least = F.least(F.char_length("keyword"), F.char_length("corrected"))
    distance = F.levenshtein("keyword", "corrected", 2)
    # In whole numbers, so that equal offers are equal: searches times ratio for each edit not made.
    pay = F.when(F.col("distance") == 1, F.lit(ratio)).otherwise(F.lit(1))
    worth = F.col("corrected_count").cast("decimal(38,0)") * pay
    needs = F.when(F.col("distance") == 1, F.lit(ratio)).otherwise(F.lit(ratio * ratio))
    found = (
        typed.join(meant, "rest")
        .where(F.col("corrected_count") > F.col("search_count") * ratio)
        .withColumn("distance", distance)
        .where((F.col("distance") > 0) & (F.col("distance") <= edits_allowed(least)))
        .where(F.col("corrected_count") > F.col("search_count").cast("decimal(38,0)") * needs)
    )
    best = F.min(F.struct(-worth, "distance", "corrected", "corrected_count"))
    chosen = found.groupBy("keyword", "search_count").agg(best.alias("best"))
    return chosen.select("keyword", "search_count", "best.corrected", "best.corrected_count", "best.distance")


def followed(corrected: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(keyword, corrected) with corrections of corrections followed to their end.

    Each step goes to a keyword searched more than ``ratio`` times as often, so there
    are no circles and few steps; a round doubles the steps that are followed.
    """
    steps = corrected.select("keyword", "corrected")
    most = corrected.agg(F.max("corrected_count")).first()[0]
    depth = math.ceil(math.log(max(most or 1, 2)) / math.log(max(ratio, 2)))
    for _ in range(math.ceil(math.log2(max(depth, 1)))):
        on = steps.select(F.col("keyword").alias("corrected"), F.col("corrected").alias("further"))
        steps = steps.join(on, "corrected", "left").select(
            "keyword", F.coalesce("further", "corrected").alias("corrected")
        )
    return steps


def merge_typos(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Searches per keyword, misspelt ones counted as what was meant."""
    end = followed(corrections(counts, ratio), ratio)
    return merge_aliases(counts, end.select(F.col("keyword").alias("variant"), F.col("corrected").alias("canonical")))
