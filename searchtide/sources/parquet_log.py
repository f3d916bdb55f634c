"""Search logs at rest: a folder of day folders of Parquet files."""

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_FILES = ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")


def missing_files(error: AnalysisException) -> bool:
    return str(error.getCondition()).startswith(NO_FILES)


def list_files(
    spark: SparkSession, path: str, pattern: str = "*.parquet", recursive: bool = True
) -> DataFrame:
    """The files below a path, by name and size; file contents are not read.

    Without ``recursive`` only those right inside the folder.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    size = F.col("_metadata.file_size")
    return found.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        size.alias("file_size"),
        (size / F.lit(1048576)).alias("size_mb"),
    )


def file_inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Size and row count of every file of a log; rows come from the file footers."""
    rows = (
        read_log(spark, path, pattern=pattern)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count("*").alias("n_rows"))
    )
    files = list_files(spark, path, pattern)
    return files.join(rows, "file_path", "left").fillna(0, ["n_rows"])


def _no_files(path: str, pattern: str) -> FileNotFoundError:
    return FileNotFoundError(f"no file {pattern} below {path}")


def read_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    pattern: str = "*.parquet",
) -> DataFrame:
    """Every Parquet file below a path as one table; none at all is an error.

    Folder names never become columns. With a schema given Spark takes an empty
    tree for an empty table, so the files are looked for, but only if the table
    turns out empty.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        if schema is None:
            return reader.parquet(path)
        log = reader.schema(schema).parquet(path)
        if log.isEmpty() and list_files(spark, path, pattern).isEmpty():
            raise _no_files(path, pattern)
        return log
    except AnalysisException as error:
        if missing_files(error):
            raise _no_files(path, pattern) from error
        raise


def read_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The files right inside one day's folder, such as ``20220601``."""
    return read_days(spark, root, [day])


def read_days(spark: SparkSession, root: str, days: Iterable[str]) -> DataFrame:
    """Some days of a log; the other folders are neither listed nor opened."""
    folders = [f"{root.rstrip('/')}/{day}" for day in days]
    try:
        return spark.read.option("pathGlobFilter", "*.parquet").parquet(*folders)
    except AnalysisException as error:
        if missing_files(error):
            raise _no_files(", ".join(folders), "*.parquet") from error
        raise


def unite(*parts: DataFrame) -> DataFrame:
    """Parts of a log whose columns may differ in order or be missing."""
    whole, *others = parts
    for part in others:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
