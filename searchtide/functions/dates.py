"""Date and month of a search."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def search_date(df: DataFrame, column: str = "datetime") -> Column:
    """The day of a search; text that is no date gives null, not an error."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        return value.try_cast("date")
    return F.to_date(value)


def with_month(df: DataFrame, column: str = "datetime") -> DataFrame:
    """Add ``date`` and ``month`` (1 to 12, whatever the year)."""
    return df.withColumn("date", search_date(df, column)).withColumn("month", F.month("date"))


def of_year(df: DataFrame, year: int, column: str = "datetime") -> DataFrame:
    """Keep one year; on a timestamp column the bounds reach the Parquet scan."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.where(F.year(search_date(df, column)) == year)
    kind = df.schema[column].dataType
    low = F.lit(f"{year}-01-01 00:00:00").cast(kind)
    high = F.lit(f"{year + 1}-01-01 00:00:00").cast(kind)
    return df.where((F.col(column) >= low) & (F.col(column) < high))
