"""Month against month."""

import pytest

from searchtide.operators import trend as M
from tests.helpers import bag, tuples

WIDE = [
    (1, "a", "a"), (2, "a", "b"), (3, "a", None), (4, "a", None), (5, None, "new"),
    (6, None, None), (7, "c", "b"), (8, "b", "c"),
]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        WIDE, "user_id long, most_search_t6 string, most_search_t7 string"
    )


def test_compare(wide):
    assert bag(M.compare_months(wide)) == [("a", 4, 1), ("b", 1, 2), ("c", 1, 1), ("new", 0, 1)]


def test_users_per_favourite(wide):
    assert bag(M.users_per_favourite(wide)) == [
        (6, "a", 4), (6, "b", 1), (6, "c", 1), (7, "a", 1), (7, "b", 2), (7, "c", 1), (7, "new", 1),
    ]


def test_comparison_order(spark, wide):
    top = tuples(M.top_compared(M.compare_months(wide), 3), "keyword")
    assert top == [("a",), ("b",), ("c",)]
    even = spark.createDataFrame(
        [("z", 1, 1), ("y", 1, 1), ("x", 1, 2)], "keyword string, count_t6 long, count_t7 long"
    )
    assert tuples(M.top_compared(even), "keyword") == [("x",), ("y",), ("z",)]


def test_growth(spark):
    rows = [("new", 0, 5), ("gone", 4, 0), ("up", 2, 5), ("same", 3, 3)]
    df = spark.createDataFrame(rows, "keyword string, count_t6 long, count_t7 long")
    top = tuples(M.top_growth(M.with_growth(df)), "keyword", "change_pct", "is_new")
    assert top == [
        ("up", 150.0, False), ("same", 0.0, False), ("gone", -100.0, False), ("new", None, True),
    ]
    assert tuples(M.top_growth(M.with_growth(df), 1), "keyword") == [("up",)]


def test_retention(wide):
    assert bag(M.retention(wide)) == [(False, 3, 75.0), (True, 1, 25.0)]


def test_retention_when_nobody_stays(spark):
    wide = spark.createDataFrame(
        [(1, "a", "b")], "user_id long, most_search_t6 string, most_search_t7 string"
    )
    assert tuples(M.retention(wide)) == [(False, 1, 100.0)]


def test_other_months(spark):
    wide = spark.createDataFrame(
        [(1, "a", "b")], "user_id long, most_search_t1 string, most_search_t2 string"
    )
    grown = M.with_growth(M.compare_months(wide, (1, 2)), (1, 2))
    assert bag(grown) == [("a", 1, 0, -100.0, False), ("b", 0, 1, None, True)]


def test_cells_add_up(wide):
    compared = tuples(M.compare_months(wide))
    assert sum(r[1] for r in compared) == sum(w[1] is not None for w in WIDE)
    assert sum(r[2] for r in compared) == sum(w[2] is not None for w in WIDE)
