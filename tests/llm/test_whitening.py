"""Whitening against numpy, exact sums against Python's integers."""

import numpy as np
import pytest

from searchtide.llm import whitening
from tests.helpers import bag

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    found = (rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20))).astype(np.float32)
    found[100:250] = found[7]  # one vector many times
    return found


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()


def expected(points, counts: bool):
    x = np.floor(points.astype(float) * 64).astype(int) + 1_000_000
    fit = x if counts else np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - sums / n) @ axes[:, :16] / np.sqrt(values[:16])
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return n, white, values[:16] / np.trace(covariance), deviation


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whiten(vectors, points, weights):
    n, white, explained, deviation = expected(points, weights == "count")
    found = whitening.whiten(vectors, weights=weights).toPandas()
    assert len(found) == 400 * 16 and (found["n"] == n).all()
    table = found.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * signs).max() < 1e-8
    first = found[found["component"] == 1].sort_values("vec_id")
    assert first["deviation"].tolist() == deviation
    by_component = found.groupby("component")["explained"].first().to_numpy()
    assert np.abs(by_component / explained - 1).max() < 1e-9
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9


def test_rows_do_not_depend_on_partitions(vectors):
    columns = ["vec_id", "component", "n", "deviation"]
    one = bag(whitening.whiten(vectors.coalesce(1), spread=1), *columns)
    assert one == bag(whitening.whiten(vectors.repartition(13), spread=9), *columns)


def test_odd_vectors(spark):
    """Null and infinite entries leave out a row; lengths are fitted apart; huge entries are cut."""
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.0]), (2, None), (3, [1.0, None]), (4, []),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, [0.5, -0.5, 1.0]), (8, [3e38, -3e38]),
    ]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r["vec_id"]) for r in found) == sorted(["1"] * 4 + ["None"] * 2 + ["7"] * 3 + ["8"] * 2)
    # One vector has no variance: no component can be whitened.
    assert {(r["n"], r["whitened"], r["explained"]) for r in found if r["vec_id"] == 7} == {(1, None, 0.0)}
    assert {r["n"] for r in found if r["vec_id"] != 7} == {3}


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [x, -x]) for i, x in enumerate([3e38, -3e38, 1.0])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: r["deviation"] is None for r in found} == {0: True, 1: True, 2: False} or all(
        r["deviation"] is None for r in found if r["vec_id"] < 2
    )


def test_clashing_columns(vectors):
    clashing = vectors.selectExpr("*", "'x' AS x", "'y' AS part", "'z' AS dim", "'w' AS weight", "1 AS component")
    columns = ["vec_id", "component", "n", "deviation"]
    assert bag(whitening.whiten(clashing), *columns) == bag(whitening.whiten(vectors), *columns)


def test_weights_are_checked(vectors):
    with pytest.raises(ValueError, match="one or count"):
        whitening.whiten(vectors, weights="many")
