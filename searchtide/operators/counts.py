"""Search counts per keyword, user and month, and the cleaning before them.

All counts are partial aggregates before their one shuffle, keyed by the
keyword too, so a user or keyword that holds much of the log arrives as one row
per map task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions import text
from searchtide.functions.dates import search_date, with_month
from searchtide.schema import MONTHS, count_column


def drop_null_keywords(df: DataFrame) -> DataFrame:
    """A plain null test, which unlike ``dropna`` reaches the Parquet scan."""
    return df.where(F.col("keyword").isNotNull())


def drop_blank_keywords(df: DataFrame) -> DataFrame:
    """Drop null keywords and those made of blanks only."""
    return df.where(F.col("keyword").isNotNull() & ~text.is_blank(F.col("keyword")))


def normalize_keywords(df: DataFrame) -> DataFrame:
    """Put every keyword into its plain form and drop those left empty."""
    return df.withColumn("keyword", text.normalize(F.col("keyword"))).where("keyword <> ''")


def count_searches(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Searches per group; null is a group of its own."""
    return df.groupBy(*by).agg(F.count("*").alias("search_count"))


def user_keyword_counts(log: DataFrame) -> DataFrame:
    return count_searches(log, ["user_id", "keyword"])


def user_month_keyword_counts(log: DataFrame) -> DataFrame:
    return count_searches(with_month(log), ["user_id", "month", "keyword"])


def user_keyword_counts_by_month(log: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Searches per user and keyword: all of them, and those of each asked month.

    One shuffle's worth of counts for the top keywords over all months and for
    the monthly favourites alike.
    """
    month = F.month(search_date(log))
    per_month = [F.count_if(month == m).alias(count_column(m)) for m in months]
    return log.groupBy("user_id", "keyword").agg(
        F.count("*").alias("search_count"), *per_month
    )


def keyword_counts(log: DataFrame) -> DataFrame:
    return count_searches(log, ["keyword"])


def roll_up(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Coarser counts out of finer ones, without another look at the log."""
    return counts.groupBy(*by).agg(F.sum("search_count").alias("search_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order; each task keeps n rows at most."""
    return df.orderBy(*order).limit(n)


def top_keywords(counts: DataFrame, n: int) -> DataFrame:
    """The n keywords searched most; ties in keyword order."""
    return top_rows(
        counts.select("keyword", "search_count"),
        n,
        F.desc("search_count"),
        F.asc_nulls_last("keyword"),
    )


def fold_keywords(counts: DataFrame, collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Unite the spellings of a keyword that a collation holds for equal.

    The spelling searched most stands for the group. Counting byte for byte
    comes first, so that the slower collation keys see distinct spellings only.
    """
    spellings = roll_up(counts, ["keyword"])
    best = F.min(F.struct(-F.col("search_count"), F.col("keyword").alias("keyword")))
    return (
        spellings.groupBy(text.fold(F.col("keyword"), collation).alias("folded"))
        .agg(
            best["keyword"].alias("keyword"),
            F.sum("search_count").alias("search_count"),
            F.count("*").alias("spellings"),
        )
        .drop("folded")
    )


def fold_counts(counts: DataFrame, by: Sequence[str], collation: str = "UNICODE_CI_AI") -> DataFrame:
    """Finer counts, such as those of users, under the spelling that stands for each keyword.

    All other columns are counts and add up. The spellings, one row per keyword, are
    joined; a keyword of many users is a heavy key whose partition Spark splits.
    """
    sums = [c for c in counts.columns if c not in (*by, "keyword")]
    spellings = roll_up(counts, ["keyword"]).withColumn("folded", text.fold(F.col("keyword"), collation))
    best = F.min(F.struct(-F.col("search_count"), F.col("keyword").alias("keyword")))
    chosen = spellings.groupBy("folded").agg(best["keyword"].alias("chosen"))
    names = spellings.join(chosen, "folded").select("keyword", "chosen")
    return (
        counts.join(names, "keyword", "left")
        .groupBy(*by, F.col("chosen").alias("keyword"))
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def merge_aliases(counts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Count the variants of an alias table (variant, canonical) as one keyword.

    A variant that is listed repeatedly stands for the first of its names in
    order, so no search counts twice; rows without a name are left out. Takes
    counted keywords, one row each, so no join key is heavy; whether the alias
    table is small enough to broadcast is left to its measured size.
    """
    names = (
        aliases.where(F.col("canonical").isNotNull())
        .groupBy(F.col("variant").alias("keyword"))
        .agg(F.min("canonical").alias("canonical"))
    )
    return (
        roll_up(counts, ["keyword"])
        .join(names, "keyword", "left")
        .groupBy(F.coalesce("canonical", "keyword").alias("keyword"))
        .agg(F.sum("search_count").alias("search_count"))
    )
