"""A search log out of order lines: who ordered which part, and when.

The ordering customer stands for the user, the order date for the time of the
search, the part's name for the keyword and its type for the category.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("user_id", "datetime", "keyword", "category")

# Types of the columns in use; giving them saves a job per table that would look
# for them in the files.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_type string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string,"
    " value double, props string",
    "documents": "doc_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def search_log(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS, dirty: bool = False
) -> DataFrame:
    """One row per order line; seventh lines have no keyword.

    ``dirty`` also gives sixth lines a blank keyword, and fifth lines one in
    capitals with blanks and marks around it. Orders and parts have unique keys
    and are joined from the left, so a side whose columns are not asked for
    need not be read.
    """
    log = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    if {"user_id", "datetime"} & set(columns):
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("datetime")
        )
        log = log.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if {"keyword", "category"} & set(columns):
        line = F.col("l_linenumber")
        keyword = F.when(line == 7, F.lit(None))
        if dirty:
            shouted = F.concat(F.lit("  "), F.upper("p_name"), F.lit("!! "))
            keyword = keyword.when(line == 6, F.lit("  ")).when(line == 5, shouted)
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
        log = (
            log.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .withColumn("keyword", keyword.otherwise(F.col("p_name")))
            .withColumnRenamed("p_type", "category")
        )
    return log.select(*columns)
