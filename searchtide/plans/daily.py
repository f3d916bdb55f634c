"""Counts of a growing log, day by day: each file is read once.

Below a store lie partial counts, one folder per batch of files, and versions of a
manifest that says which files are counted and in which batch. Counts are written
first and the manifest after them; a batch that no manifest names counts for nothing
and is written over. So a run that dies at any point can be repeated, and nothing
counts twice. One run at a time may write to a store.
"""

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.operators import counts as N
from searchtide.plans.reports import prepared
from searchtide.schema import MONTHS, count_column
from searchtide.sources import parquet_log

#: Files of a batch at most; more are counted in several batches, each safe by itself.
FILES = 10_000

#: Batches from which on the partial counts are merged into one.
MERGE_FROM = 32

MANIFEST = "file_path string, file_size long, modified timestamp, batch string, settings string"


def _folder(spark: SparkSession, path: str):
    """Hadoop's view of a folder, which may be in any store that Spark can reach."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _versions(spark: SparkSession, store: str) -> list[str]:
    """The complete versions of the manifest, the newest last."""
    files, pattern = _folder(spark, f"{store}/manifest/*/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in files.globStatus(pattern) or [])


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def counted_files(spark: SparkSession, store: str) -> DataFrame:
    """The files that are counted: (file_path, file_size, modified, batch, settings)."""
    versions = _versions(spark, store)
    if not versions:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{store}/manifest/{versions[-1]}")


def _next(spark: SparkSession, store: str) -> str:
    versions = _versions(spark, store)
    return f"{int(versions[-1]) + 1 if versions else 1:012d}"


def _commit(spark: SparkSession, store: str, counts: DataFrame, files: DataFrame) -> None:
    """Write a batch of counts, then the manifest that makes it count."""
    number = _next(spark, store)
    counts.write.mode("overwrite").parquet(f"{store}/counts/{number}")
    whole = files.withColumn("batch", F.coalesce("batch", F.lit(number)))
    whole.select("file_path", "file_size", "modified", "batch", "settings").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{store}/manifest/{number}")


def _listed(spark: SparkSession, log_path: str, pattern: str) -> DataFrame:
    try:
        found = parquet_log.list_files(spark, log_path, pattern)
    except AnalysisException as error:
        if parquet_log.missing_files(error):
            raise FileNotFoundError(f"no file {pattern} below {log_path}") from error
        raise
    return found.select("file_path", "file_size", F.col("_metadata.file_modification_time").alias("modified"))


def update(
    spark: SparkSession,
    log_path: str,
    store: str,
    months: Sequence[int] = MONTHS,
    pattern: str = "*.parquet",
    **options,
) -> DataFrame:
    """Count the files of a log that the store has not counted yet; all counts are returned.

    ``options`` are those of ``reports.prepared``. They and ``months`` go with the
    store: others are an error, as is a counted file that has changed since. A file
    that is gone stays counted.
    """
    settings = json.dumps({"months": list(months), **options}, sort_keys=True)
    known = counted_files(spark, store)
    found = _listed(spark, log_path, pattern)
    other = known.where(F.col("settings") != settings).select("settings").first()
    if other:
        raise ValueError(f"{store} was counted with {other[0]}, not with {settings}")
    before = known.select("file_path", F.col("file_size").alias("_size"), F.col("modified").alias("_time"))
    changed = found.join(before, "file_path").where("file_size <> _size OR modified <> _time").first()
    if changed:
        raise ValueError(f"{changed['file_path']} has changed since it was counted")
    # Names of files only, which the driver lists for every read anyway.
    new = sorted(tuple(r) for r in found.join(before, "file_path", "left_anti").collect())
    for start in range(0, len(new), FILES):
        part = new[start : start + FILES]
        log = prepared(spark.read.parquet(*[path for path, _, _ in part]), **options)
        files = spark.createDataFrame([(*row, None, settings) for row in part], MANIFEST)
        done = counted_files(spark, store).unionByName(files)
        _commit(spark, store, N.user_keyword_counts_by_month(log, months), done)
    batches = counted_files(spark, store).select("batch").distinct().count()
    if batches >= MERGE_FROM:
        merge(spark, store)
    elif not batches:
        raise FileNotFoundError(f"no file {pattern} below {log_path}")
    return totals(spark, store)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Searches per user and keyword over all counted files, in all and by month."""
    known = counted_files(spark, store)
    batches = sorted(r[0] for r in known.select("batch").distinct().collect())
    if not batches:
        raise FileNotFoundError(f"no counts below {store}")
    months = json.loads(known.first()["settings"])["months"]
    partial = spark.read.parquet(*[f"{store}/counts/{batch}" for batch in batches])
    sums = ["search_count", *[count_column(m) for m in months]]
    return partial.groupBy("user_id", "keyword").agg(*[F.sum(c).alias(c) for c in sums])


def merge(spark: SparkSession, store: str) -> None:
    """Make one batch of all; the old ones go when the new manifest is there."""
    old_versions = _versions(spark, store)
    known = counted_files(spark, store)
    old = [r[0] for r in known.select("batch").distinct().collect()]
    files = spark.createDataFrame(known.collect(), MANIFEST).withColumn("batch", F.lit(None).cast("string"))
    _commit(spark, store, totals(spark, store), files)
    for batch in old:
        _delete(spark, f"{store}/counts/{batch}")
    for version in old_versions:
        _delete(spark, f"{store}/manifest/{version}")
