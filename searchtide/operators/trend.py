"""Month against month: users per favourite, growth, and who kept theirs.

The counts of these tables are users whose favourite a keyword is, not searches.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.operators.counts import top_rows
from searchtide.schema import MONTHS, count_column, favourite_column


def _favourites(wide: DataFrame, months: Sequence[int]) -> DataFrame:
    """(month, keyword), one row per user and month with a favourite."""
    cells = [
        F.struct(F.lit(m).alias("month"), F.col(favourite_column(m)).alias("keyword"))
        for m in months
    ]
    return wide.select(F.inline(F.array(*cells))).where("keyword IS NOT NULL")


def users_per_favourite(wide: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    return _favourites(wide, months).groupBy("month", "keyword").agg(F.count("*").alias("users"))


def compare_months(wide: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Users per favourite in each month, 0 where a month lacks the keyword.

    What a full outer join of two monthly counts gives, in one pass and one
    shuffle.
    """
    counts = [F.count_if(F.col("month") == m).alias(count_column(m)) for m in months]
    return _favourites(wide, months).groupBy("keyword").agg(*counts)


def top_compared(compared: DataFrame, n: int = 20, months: Sequence[int] = MONTHS) -> DataFrame:
    """The first n by the earlier month's count, then by the later one's."""
    order = [F.desc(count_column(m)) for m in months]
    return top_rows(compared, n, *order, F.asc("keyword"))


def with_growth(compared: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Add the change in percent; null, and ``is_new``, if the keyword was not there before."""
    before, after = (F.col(count_column(m)).cast("double") for m in months)
    change = (after - before) / F.nullif(before, F.lit(0.0)) * 100
    return compared.withColumn("change_pct", change).withColumn("is_new", before == 0)


def top_growth(grown: DataFrame, n: int = 10) -> DataFrame:
    """The n largest changes; an undefined change comes last."""
    return top_rows(grown, n, F.desc_nulls_last("change_pct"), F.asc("keyword"))


def with_trend(compared: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Add ``trend``: how sure it is that a keyword's share has changed, with the sign of the change.

    Twice the log-likelihood ratio of both months' counts against one share for both.
    It is defined for keywords that are new or gone, and puts them on one scale with
    all others: a keyword that nobody had before ranks by how many have it now. Null
    if either month has no counts at all.
    """
    before, after = (F.col(count_column(m)).cast("double") for m in months)
    totals = [compared.agg(F.sum(count_column(m)).cast("double")).scalar() for m in months]
    both = F.nullif(totals[0], F.lit(0.0)) + F.nullif(totals[1], F.lit(0.0))

    def part(seen: Column, total: Column, of_all: Column) -> Column:
        """A cell's share of the ratio; nothing where nothing was seen."""
        return F.when(seen > 0, seen * F.log(seen * both / (total * of_all))).otherwise(F.lit(0.0))

    ratio = (
        part(before, totals[0], before + after)
        + part(after, totals[1], before + after)
        + part(totals[0] - before, totals[0], both - before - after)
        + part(totals[1] - after, totals[1], both - before - after)
    )
    rises = F.when(after * totals[0] < before * totals[1], F.lit(-1.0)).otherwise(F.lit(1.0))
    # Rounding may leave a little less than nothing.
    return compared.withColumn("trend", F.when(both > 0, rises * 2 * F.greatest(ratio, F.lit(0.0))))


def top_trends(trends: DataFrame, n: int = 10) -> DataFrame:
    """The n keywords that rise most surely."""
    return top_rows(trends, n, F.desc_nulls_last("trend"), F.asc("keyword"))


def with_change(wide: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Users with a favourite in both months, and whether it is the same one."""
    before, after = (favourite_column(m) for m in months)
    both = wide.select("user_id", before, after).where(
        F.col(before).isNotNull() & F.col(after).isNotNull()
    )
    return both.withColumn("is_same", F.col(before) == F.col(after))


def share_of(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, ``n``, and their share in percent, ``pct``.

    The total is a scalar subquery over the same counts, so no window has to
    bring all values to one task.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("pct", F.col("n").cast("double") / total * 100)


def retention(wide: DataFrame, months: Sequence[int] = MONTHS) -> DataFrame:
    """Share of users who kept or changed their favourite."""
    return share_of(with_change(wide, months), "is_same")
