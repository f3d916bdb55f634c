"""Top keywords of a user, over the whole log or month by month."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.functions.dates import of_year, search_date
from searchtide.operators.counts import (
    count_searches,
    drop_blank_keywords,
    drop_null_keywords,
    roll_up,
    user_keyword_counts_by_month,
)
from searchtide.operators.ranking import number_rows
from searchtide.schema import MONTHS, count_column, favourite_column


def best_first() -> list[Column]:
    """Ascending keys: highest count first, then by keyword, null last."""
    return [-F.col("search_count"), F.col("keyword").isNull(), F.col("keyword")]


def _best(count: str = "search_count") -> Column:
    """The best (count, keyword) of a group as an aggregate of its rows."""
    found = F.col(count)
    row = F.struct(
        (-found).alias("minus"),
        F.col("keyword").isNull().alias("missing"),
        F.col("keyword").alias("keyword"),
    )
    return F.min(F.when(found > 0, row))


def rank_keywords(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank all keywords of each group by search count; heavy groups are split."""
    return number_rows(counts, best_first(), by)


def first_ranked(counts: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The first n keywords of each group by search count, with their rank.

    Made for a small n: Spark cuts each map task's rows to n per group before the
    shuffle, up to its own limit for n (1,000 unless set otherwise). For a larger
    n filter ``rank_keywords``.
    """
    window = Window.partitionBy(*by).orderBy(*best_first())
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def best_keyword(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The first-ranked keyword of each group, by a plain aggregate."""
    best = counts.groupBy(*by).agg(_best().alias("best"))
    return best.select(
        *by,
        F.col("best.keyword").alias("keyword"),
        (-F.col("best.minus")).alias("search_count"),
    )


def in_report_order(top: DataFrame) -> DataFrame:
    """Highest counts first, then by group and rank.

    Counts repeat a lot: without a second key, all rows of one count would be
    sorted by one task.
    """
    last = [F.asc_nulls_last(c) for c in top.columns if c not in ("search_count", "keyword")]
    return top.orderBy(F.desc("search_count"), *last)


def top_n_keywords(
    log: DataFrame, n: int, by: Sequence[str] = ("user_id",), clean: bool = False
) -> DataFrame:
    """Top n keywords of each group of a log, with count and rank.

    Null keywords count as a keyword unless ``clean`` drops null and blank ones
    first.
    """
    rows = drop_blank_keywords(log) if clean else log
    ranked = first_ranked(count_searches(rows, [*by, "keyword"]), by, n)
    return ranked.select(*by, "keyword", "search_count", "rank")


def top_keyword_per_user(log: DataFrame, clean: bool = False) -> DataFrame:
    rows = drop_blank_keywords(log) if clean else log
    return best_keyword(count_searches(rows, ["user_id", "keyword"]), ["user_id"])


def first_of_top(top: DataFrame) -> DataFrame:
    """Top 1 out of a top-n table."""
    return top.where(F.col("rank") == 1)


def favourites(counts: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """One row per user, the best keyword of each month side by side.

    Takes counts by user and keyword with a column per month; ranking and pivot
    are one aggregate on the user. Users with no search in these months keep a
    row of nulls.
    """
    cells = [_best(count_column(m))["keyword"].alias(favourite_column(m)) for m in months]
    return counts.groupBy("user_id").agg(*cells)


def pivot_ranked(top: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """The same layout out of a table that holds one keyword per user and month."""
    wide = top.groupBy("user_id").pivot("month", list(months)).agg(F.first("keyword"))
    return wide.toDF("user_id", *[favourite_column(m) for m in months])


def monthly_favourites(
    log: DataFrame,
    months: Sequence[int] = MONTHS,
    year: int | None = None,
    clean: bool = False,
) -> DataFrame:
    """Top keyword per user and month, straight from a log.

    Months that are not asked for only keep their users in the table, so their
    searches fold into one row per user before the first shuffle.
    """
    rows = drop_blank_keywords(log) if clean else log
    if year is not None:
        rows = of_year(rows, year)
    wanted = F.month(search_date(rows)).isin(*months)
    folded = rows.withColumn("keyword", F.when(wanted, F.col("keyword")))
    return favourites(user_keyword_counts_by_month(folded, months), months)


def top_user_rows(top1: DataFrame, n: int = 30) -> DataFrame:
    """The first n users of the top-1 report with a real keyword, and their place."""
    order = [F.desc("search_count"), F.asc_nulls_last("user_id"), F.asc("keyword")]
    rows = drop_blank_keywords(top1).orderBy(*order).limit(n)
    # n rows at most, so one task may number them.
    return rows.withColumn("pos", F.row_number().over(Window.orderBy(*order)))


def total_of_favourites(top1: DataFrame) -> DataFrame:
    """Searches per keyword, counting each user's top keyword only."""
    return roll_up(drop_null_keywords(top1), ["keyword"])
