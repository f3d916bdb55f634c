"""Result tables as CSV and JSON.

CSV is for export. Quotes are doubled and edge blanks kept, so every keyword
but the empty one survives the way out and back.
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.sources.csv_records import records
from searchtide.sources.parquet_log import list_files, missing_files

CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

CSV_FILES = "*.csv"

# A private-use character that ends a line for counting its fields.
END = "\ue000"

# Rows of one file at most.
FILE_ROWS = 1_000_000


def _parsed(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """Rows as text with their ``_file``, without those that have more fields than the schema.

    Spark marks longer and shorter lines alike. A shorter one is told by reading
    it again with one field put after it, which then falls into the schema.
    """
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, "_corrupt"]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    if multiline:
        whole = F.from_csv("record", F.lit(text.toDDL()), {**CSV, **options, "header": "false"})
        rows = records(spark, path, CSV_FILES).select(F.col("file_path").alias("_file"), whole.alias("_row"))
        rows = rows.select("_file", "_row.*")
    else:
        reader = spark.read.options(**CSV, **options, enforceSchema="true", pathGlobFilter=CSV_FILES)
        rows = reader.schema(text).csv(path)
        rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    fields = [f"f{i}" for i in range(len(schema))]
    again = F.from_csv(
        F.concat("_corrupt", F.lit(f",{END}")),
        ", ".join(f"{name} STRING" for name in fields),
        {"escape": '"'},
    )
    shorter = F.array_contains(F.array(*[again[name] for name in fields]), END)
    # Spark wants a second column beside the corrupt one, whatever is selected.
    same = F.col(f"`{schema.names[0]}`").eqNullSafe(again["f0"])
    return rows.where(F.col("_corrupt").isNull() | (shorter & same))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """A headed CSV table with columns named by position.

    Lines with too many fields are skipped, missing fields and empty ones are
    null, a value that does not fit its type is null. Only files named ``*.csv``
    right inside the folder are read; a folder without any is an error.
    ``multiline`` allows line breaks inside quotes; many tasks read a large file, and
    the lines of splits in which there are such breaks are shuffled (see ``csv_records``).
    """
    if not csv_exists(spark, path):
        raise FileNotFoundError(f"no CSV file in {path}")
    fields = [
        F.nullif(F.col(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema
    ]
    return _parsed(spark, path, schema, multiline).select(*fields)


def csv_exists(spark: SparkSession, path: str) -> bool:
    """True for a CSV file, or a folder with one right inside it."""
    try:
        return not list_files(spark, path, CSV_FILES, recursive=False).isEmpty()
    except AnalysisException as error:
        if missing_files(error):
            return False
        raise


def load_report(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """Lines, parsed rows and skipped lines of each CSV file.

    Lines are physical ones, so a line break inside quotes counts as skipped.
    ``multiline`` is that of the reader.
    """
    if not csv_exists(spark, path):
        raise FileNotFoundError(f"no CSV file in {path}")
    name = F.col("_metadata.file_path").alias("file_path")
    of = F.col("_file").alias("file_path")
    lines = (
        spark.read.option("pathGlobFilter", CSV_FILES).text(path).select(name)
        .groupBy("file_path").agg(F.count("*").alias("lines"))
    )
    parsed = (
        _parsed(spark, path, schema, multiline).select(of)
        .groupBy("file_path").agg(F.count("*").alias("parsed"))
    )
    rows = F.coalesce("parsed", F.lit(0))
    return lines.join(parsed, "file_path", "left").select(
        "file_path", "lines", rows.alias("parsed"), (F.col("lines") - rows - 1).alias("skipped")
    )


def or_empty(
    read: Callable[[], DataFrame], spark: SparkSession, schema: T.StructType
) -> DataFrame:
    """What a reader returns, or an empty table if its input is missing."""
    try:
        return read()
    except FileNotFoundError:
        pass
    except AnalysisException as error:
        if not missing_files(error):
            raise
    return spark.createDataFrame([], schema)


def write_csv(
    df: DataFrame, path: str, single_file: bool = False, file_rows: int = FILE_ROWS
) -> None:
    """Replace a folder by a headed CSV table.

    ``single_file`` is for tables whose size is bounded by what they are, such as
    a top 20: one task writes them. Others have a file per task, in order, and
    more than one where a task has more than ``file_rows`` rows.
    """
    rows = df.coalesce(1) if single_file else df
    writer = rows.write.mode("overwrite").options(**CSV)
    if not single_file:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
