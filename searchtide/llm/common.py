"""Helpers shared by the corpus operators."""

import atexit
import contextlib
import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from searchtide.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()

#: Bytes of rows that a Python worker is handed at a time, unless the session says so.
BATCH_BYTES = 8 << 20
_BATCH_BYTES, _DEFAULT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application, in small batches.

    Batches are bounded by bytes, as ten thousand long texts are too many at once; a
    setting of the session's own stays.

    Nothing is done where ``PYTHONPATH`` names its folder or it runs out of an
    archive, as with ``--py-files``.
    """
    if spark.conf.get(_BATCH_BYTES) == _DEFAULT_BYTES:
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    package = Path(__file__).resolve().parents[1]
    named = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if not package.is_dir() or str(package.parent) in named or context.applicationId in _SHIPPED:
        return
    # The driver hands the archive out as long as it runs.
    folder = tempfile.mkdtemp(prefix=f"{package.name}-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared checkpoint folder and read again.

    Later jobs read the files, so a lost executor costs tasks and not the work
    before, and rows with random or positional parts stay as they were. The files
    are deleted when the driver's Python ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no model learns from."""
    third = F.crc32(F.col(doc_id).cast("string")) % 3 == 1
    return F.coalesce(third, F.lit(False))


def whole(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns as one struct, so that no working column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def plus(df: DataFrame, *added: str) -> list[Column]:
    """The columns of ``row`` but for those that ``added`` replaces, then ``added``."""
    fields = [f for f in df.schema["row"].dataType.names if f not in added]
    return [F.col("row")[f].alias(f) for f in fields] + [F.col(a) for a in added]


def hex_number(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """A number out of the hexadecimal digits of a digest."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def text_groups(
    batches: Iterator[pa.RecordBatch], at: int, chars: int
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of Arrow batches with their texts (null as empty), the column ``at``.

    A part has about ``chars`` characters, and at least one text, so that a task
    never holds a whole batch as Python strings.
    """
    for batch in batches:
        start, size = 0, 0
        texts: list[str] = []
        for i, value in enumerate(batch.column(at)):
            texts.append(value.as_py() or "")
            size += len(texts[-1])
            if size >= chars or i == batch.num_rows - 1:
                yield batch.slice(start, len(texts)), texts
                start, size, texts = i + 1, 0, []


def give_back() -> None:
    """Return freed memory to the system at a task's end, as the next tasks use the same worker."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # Other C libraries have no such call.
        ctypes.CDLL(None).malloc_trim(0)


def with_text_columns(
    df: DataFrame,
    compute: Callable[[list[str]], list[list]],
    added: str,
    text: str = "text",
    chars: int = 1_500_000,
    prefix: str = "",
) -> DataFrame:
    """Columns worked out in Arrow batches from whole texts, the others passed through.

    ``compute`` takes texts (null as empty) of about ``chars`` characters at a time,
    and at least one text, and returns a list of values for each column of the
    schema ``added``, whose names get ``prefix``. Columns of those names that are
    there already are replaced.
    """
    ship_package(df.sparkSession)
    fields = T._parse_datatype_string(added)
    new = T.StructType([T.StructField(prefix + f.name, f.dataType) for f in fields])
    kept = df.drop(*new.names)
    schema = T.StructType([*kept.schema.fields, *new.fields])
    at = kept.columns.index(text)
    kinds = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, texts in text_groups(batches, at, chars):
            found = compute(texts)
            values = [pa.array(v, f.type) for v, f in zip(found, kinds, strict=True)]
            del found, texts
            yield pa.RecordBatch.from_arrays([*own.columns, *values], schema.names)
        give_back()

    return kept.mapInArrow(run, schema)


def spare_prefix(df: DataFrame) -> str:
    """A beginning that no column's name has."""
    prefix = "found_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


#: Most values of a column that a sample is taken by; each gets a part of a model.
MOST_VALUES = 1_000


def sampled(df: DataFrame, column: str, size: int, seed: int = 0) -> DataFrame:
    """About ``size`` rows of each value of a column, all of them where there are fewer.

    Rows are picked by a hash of their doc_id at a rate that follows from the
    counts, so nothing is sorted or brought together. Null values are left out. The
    rates, one row per value, are broadcast; more than MOST_VALUES are an error, as
    the column is meant for labels.
    """
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(column).count().limit(MOST_VALUES + 1).collect()
    if len(counts) > MOST_VALUES:
        raise ValueError(f"{column} has more than {MOST_VALUES} values")
    kind = df.schema[column].dataType.simpleString()
    rates = df.sparkSession.createDataFrame(
        [(row[0], 1e6 * size / row[1]) for row in counts], f"sampled_value {kind}, rate double"
    )
    spread = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000))
    return (
        known.join(F.broadcast(rates), F.col(column) == F.col("sampled_value"))
        .where(spread < F.col("rate"))
        .drop("sampled_value", "rate")
    )
