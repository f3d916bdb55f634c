"""Whitening of embeddings over their distinct vectors.

Equal integer vectors are brought together first, so a vector that a third of all
rows share is one row of the fit (or as many as it has copies, with
``weights="count"``). Sums, then the products of centred blocks, are made block by
block in the tasks and added up in Spark; the driver sees one square matrix per
vector length. Each distinct vector is whitened once and joined back to its rows by
its key and a part of its copies, so that no task gets all rows of a hot vector.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import ship_package, stored
from searchtide.llm.kdtree import usable

SCALE, SHIFT = 64, 1_000_000

#: A component beyond this in size counts as this, so that sums stay whole numbers.
LARGEST = 2.0**40

#: Lengths of vectors that are fitted in one go; more take further rounds.
LENGTHS = 64

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


def whole_numbers(embedding: Column) -> Column:
    """floor(64 c) + 1,000,000 of every component c."""
    size = F.lit(LARGEST)
    return F.transform(
        embedding,
        lambda c: F.floor(F.greatest(-size, F.least(size, F.lit(float(SCALE)) * c.cast("double"))))
        + F.lit(SHIFT),
    )


@dataclass
class Fit:
    """What is learned from the distinct vectors of one length."""

    n: int  # weight of all of them together
    sums: list[int]
    centre: np.ndarray
    values: np.ndarray | None = None  # eigenvalues, largest first
    vectors: np.ndarray | None = None  # one eigenvector in a column
    explained: np.ndarray | None = None


def _blocks(df: DataFrame, compute: Callable, schema: str) -> DataFrame:
    """Rows made of one Arrow batch at a time; ``compute`` takes its columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                yield from compute(columns)

    return df.mapInArrow(run, schema)


def _by_length(columns: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, which rows, their vectors as a matrix, their weights) of a batch."""
    lists = columns["x"]
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.asarray(lists.value_lengths()))
    dims = columns["dim"].to_numpy()
    weights = columns["weight"].to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        at = (ends[rows] - dim)[:, None] + np.arange(dim)
        yield int(dim), rows, flat[at], weights[rows]


def _sums(columns: dict) -> Iterator[pa.RecordBatch]:
    for dim, _, x, weight in _by_length(columns):
        fits_long = float(np.abs(x).max()) * float(weight.sum()) < 2**62
        total = [str(v) for v in weight @ (x if fits_long else x.astype(object))]
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array([dim], pa.int32()),
                "n": pa.array([int(weight.sum())], pa.int64()),
                "total": pa.array([total], pa.list_(pa.string())),
            }
        )


def _added(parts: DataFrame, column: str, kind: str, *keys: str) -> DataFrame:
    """Arrays added up place by place: (keys, column) with one row for each key."""
    places = parts.select(*keys, F.posexplode(column).alias("at", "value"))
    added = places.groupBy(*keys, "at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    listed = added.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("all"))
    return listed.select(*keys, F.col("all")["value"].alias(column))


def _products(rows: np.ndarray, weight: np.ndarray, dim: int) -> pa.RecordBatch:
    product = (rows * weight[:, None]).T @ rows
    d = len(product)
    flat = pa.array(product.ravel(), pa.float64())
    return pa.RecordBatch.from_pydict(
        {
            "dim": pa.array(np.full(d, dim), pa.int32()),
            "line": pa.array(np.arange(d), pa.int32()),
            "product": pa.ListArray.from_arrays(pa.array(np.arange(0, d * d + 1, d), pa.int32()), flat),
        }
    )


_PRODUCT = "dim int, line int, product array<double>"


def _matrices(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sum of all blocks' products, per length."""
    lines: dict[int, list] = {}
    for row in _added(parts, "product", "double", "dim", "line").collect():
        lines.setdefault(row["dim"], []).append((row["line"], row["product"]))
    return {dim: np.array([p for _, p in sorted(found)]) for dim, found in lines.items()}


def _fitted(distinct: DataFrame) -> dict[int, Fit]:
    sums = _blocks(distinct, _sums, "dim int, n long, total array<string>")
    sizes = dict(tuple(r) for r in sums.groupBy("dim").agg(F.sum("n")).collect())
    fits = {
        dim: Fit(sizes[dim], [int(v) for v in total], np.array([int(v) / sizes[dim] for v in total]))
        for dim, total in _added(sums, "total", "decimal(38,0)", "dim").collect()
    }

    def centred(columns: dict) -> Iterator[pa.RecordBatch]:
        for dim, _, x, weight in _by_length(columns):
            yield _products(x - fits[dim].centre, weight.astype(float), dim)

    for dim, matrix in _matrices(_blocks(distinct, centred, _PRODUCT)).items():
        fit, covariance = fits[dim], matrix / fits[dim].n
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        # One sign per component: its largest entry is above zero.
        largest = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)
        trace = float(np.trace(covariance))
        fit.explained = values / trace if trace > 0 else np.zeros_like(values)
        fit.values, fit.vectors = values, vectors
    return fits


def _kept(fit: Fit, components: int) -> np.ndarray:
    """True for the components that have a variance, beyond what rounding leaves."""
    values = fit.values[:components]
    return values > max(float(fit.values[0]), 0.0) * len(fit.values) * 1e-13


def _deviation(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over the dimensions of (n x - S)**2, null where no long holds it."""
    largest = float(np.abs(x - fit.centre).max()) * fit.n + 1
    if largest * largest * x.shape[1] < 2**62 and float(np.abs(x).max()) * fit.n < 2**62:
        apart = x * fit.n - np.array(fit.sums)
        return (apart * apart).sum(axis=1).tolist()
    found = [sum((v * fit.n - s) ** 2 for v, s in zip(row, fit.sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in found]


def _whitened(distinct: DataFrame, fits: dict[int, Fit], components: int) -> DataFrame:
    def whiten(columns: dict) -> Iterator[pa.RecordBatch]:
        for dim, rows, x, weight in _by_length(columns):
            fit = fits[dim]
            kept = _kept(fit, components)
            scale = np.sqrt(np.where(kept, fit.values[:components], 1.0))
            found = (x - fit.centre) @ fit.vectors[:, :components] / scale
            values = pa.array(found.ravel(), pa.float64(), mask=np.tile(~kept, len(x)))
            ends = pa.array(np.arange(len(x) + 1) * len(kept), pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "a": columns["a"].take(pa.array(rows)),
                    "b": columns["b"].take(pa.array(rows)),
                    "dim": pa.array(np.full(len(x), dim), pa.int32()),
                    "weight": pa.array(weight, pa.int64()),
                    "deviation": pa.array(_deviation(x, fit), pa.int64()),
                    "x": pa.ListArray.from_arrays(ends, values),
                }
            )

    return _blocks(
        distinct, whiten, "a long, b long, dim int, weight long, deviation long, x array<double>"
    )


def _identity_errors(whitened: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float]:
    """Largest entry of the whitened vectors' own covariance minus the identity."""
    mean = F.sum(F.coalesce("value", F.lit(0.0)) * F.col("weight"))
    places = whitened.select("dim", "weight", F.posexplode("x").alias("at", "value"))
    centre = {dim: np.zeros(min(components, len(fit.values))) for dim, fit in fits.items()}
    for dim, at, total in places.groupBy("dim", "at").agg(mean).collect():
        centre[dim][at] = total / fits[dim].n
    length = {dim: len(values) for dim, values in centre.items()}

    def centred(columns: dict) -> Iterator[pa.RecordBatch]:
        dims = columns["dim"].to_numpy()
        for dim in map(int, np.unique(dims)):
            rows = np.flatnonzero(dims == dim)
            flat = columns["x"].take(pa.array(rows)).flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            found = flat.reshape(len(rows), length[dim])
            yield _products(found - centre[dim], columns["weight"].to_numpy()[rows].astype(float), dim)

    errors = {}
    for dim, matrix in _matrices(_blocks(whitened, centred, _PRODUCT)).items():
        kept = _kept(fits[dim], components)
        own = (matrix / fits[dim].n)[np.ix_(kept, kept)]
        errors[dim] = float(np.abs(own - np.eye(len(own))).max(initial=0.0))
    return errors


def whiten(
    embeddings: DataFrame, components: int = 16, weights: str = "one", spread: int = 256
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row for every usable row and component, as many components as ``components``
    or the vector's length, numbered from 1 by falling eigenvalue. The fit list has
    each distinct vector of whole numbers once, or as often as rows have it with
    ``weights="count"``; n is its weight. Rows whose vector is null, empty or holds
    null or non-finite components are left out; repeated rows and null ids stay as
    they are. Vectors of different lengths are fitted apart. A component without
    variance, as with one distinct vector, has a null ``whitened`` and does not count
    for ``identity_error``; ``deviation`` is null where it goes beyond a long. An
    empty table gives no rows, and columns beside vec_id and embedding do not matter.
    ``spread`` is the number of parts that the copies of one vector are joined in.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be one or count, not {weights}")
    spark = embeddings.sparkSession
    ship_package(spark)
    x = whole_numbers(F.col("embedding"))
    numbered = embeddings.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")
    )
    rows = stored(
        numbered.select(
            "vec_id",
            "x",
            F.xxhash64(F.lit(1), "x").alias("a"),
            F.xxhash64(F.lit(2), "x").alias("b"),
            F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(spread)).cast("int").alias("part"),
        ),
        "whole",
    )
    parts = stored(
        rows.groupBy("a", "b", "part").agg(F.first("x").alias("x"), F.count("*").alias("copies")),
        "copies",
    )
    weight = F.lit(1).cast("long") if weights == "one" else F.sum("copies")
    distinct = stored(
        parts.groupBy("a", "b").agg(F.first("x").alias("x"), weight.alias("weight")).withColumn("dim", F.size("x")),
        "distinct",
    )
    lengths = sorted(r[0] for r in distinct.select("dim").distinct().collect())
    found = spark.createDataFrame([], RESULT)
    for start in range(0, len(lengths), LENGTHS):
        block = lengths[start : start + LENGTHS]
        one = distinct if len(lengths) <= LENGTHS else distinct.where(F.col("dim").isin(block))
        fits = _fitted(one)
        white = stored(_whitened(one, fits, components), "whitened")
        errors = _identity_errors(white, fits, components)
        learned = spark.createDataFrame(
            [(d, f.n, f.explained[:components].tolist(), errors[d]) for d, f in fits.items()],
            "dim int, n long, explained array<double>, identity_error double",
        )
        back = (
            white.join(F.broadcast(learned), "dim")
            .join(parts.select("a", "b", "part"), ["a", "b"])
            .join(rows.select("vec_id", "a", "b", "part"), ["a", "b", "part"])
        )
        each = back.select(
            "vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("x").alias("at", "whitened")
        )
        found = found.unionByName(
            each.select(
                "vec_id",
                (F.col("at") + 1).alias("component"),
                "n",
                "deviation",
                "whitened",
                F.element_at("explained", F.col("at") + 1).alias("explained"),
                "identity_error",
            )
        )
    return found
