"""What is in a table: its columns, size and missing values."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_column(df: DataFrame, *fields) -> DataFrame:
    """One row per column from one pass: ``fields`` are (name, aggregate of a column)."""
    names = df.columns
    summary = df.agg(
        F.count("*").alias("_rows"),
        *[make(F.col(c)).alias(f"_{i}_{name}") for i, c in enumerate(names) for name, make in fields],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.lit(df.schema[c].nullable).alias("nullable"),
            F.col("_rows").alias("n_rows"),
            F.lit(len(names)).alias("n_columns"),
            *[F.col(f"_{i}_{name}").alias(name) for name, _ in fields],
        )
        for i, c in enumerate(names)
    ]
    return summary.select(F.inline(F.array(*rows)))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and missing values per column."""
    profile = _per_column(df, ("n_nulls", lambda c: F.count_if(c.isNull())))
    return profile.select("position", "column_name", "n_rows", "n_columns", "n_nulls")


def schema_profile(df: DataFrame) -> DataFrame:
    """Type and declared nullability per column, beside the number of values found."""
    profile = _per_column(df, ("n_values", F.count))
    return profile.select("position", "column_name", "data_type", "nullable", "n_values")


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first n rows in an order, or any n rows."""
    return (df.orderBy(*order) if order else df).limit(n)
