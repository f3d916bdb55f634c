"""Column types of every stage, and the fixed values shared by the modules."""

from pyspark.sql import types as T

LOG = T.StructType(
    [
        T.StructField("eventID", T.StringType()),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("networkType", T.StringType()),
    ]
)

TOP_KEYWORDS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("search_count", T.LongType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

CLASSIFIED = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

REPLIES = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("positions", T.ArrayType(T.LongType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("reply", T.StringType()),
        T.StructField("answers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)

# The two months the reports set side by side unless told otherwise.
MONTHS = (6, 7)


def favourite_column(month: int) -> str:
    return f"most_search_t{month}"


def count_column(month: int) -> str:
    return f"count_t{month}"


def wide_schema(months=MONTHS, user_type: T.DataType | None = None) -> T.StructType:
    """One row per user, one favourite keyword per month."""
    fields = [T.StructField("user_id", user_type or T.StringType())]
    fields += [T.StructField(favourite_column(m), T.StringType()) for m in months]
    return T.StructType(fields)
