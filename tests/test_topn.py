"""Top-n tables on hand-made searches."""

import datetime

import pytest

from searchtide.functions.dates import with_month
from pyspark.sql import functions as F

from searchtide.operators import counts as N
from searchtide.operators import topn as T
from tests.helpers import bag, tuples

SEARCHES = (
    [(1, "b")] * 2
    + [(1, "a")] * 2
    + [(2, None)] * 3
    + [(2, "x")]
    + [(None, "q")] * 2
    + [(3, "z")]
    + [(6, " "), (6, " "), (6, "w")]
)


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(SEARCHES, "user_id long, keyword string")


def at(month, user, keyword, year=2022):
    return (user, datetime.datetime(year, month, 3, 12), keyword)


@pytest.fixture(scope="module")
def dated(spark):
    rows = [
        at(6, 1, "b"), at(6, 1, "a"), at(7, 1, "b"), at(7, 1, "b"), at(7, 1, "a"),
        at(5, 4, "may only"),
        at(6, 5, "a", 2022), at(6, 5, "a", 2023), at(6, 5, "b", 2023),
        at(6, 7, None), at(6, 7, None), at(6, 7, "k"), at(7, 7, "k"),
        at(7, None, "n"),
        (8, None, "no date"),
    ]
    return spark.createDataFrame(rows, "user_id long, datetime timestamp, keyword string")


WIDE = [
    (1, "a", "b"), (4, None, None), (5, "a", None), (7, None, "k"), (8, None, None),
    (None, None, "n"),
]


def test_top3_with_ties_nulls_and_short_groups(log):
    assert bag(T.top_n_keywords(log, 3)) == sorted(
        [
            (1, "a", 2, 1), (1, "b", 2, 2),
            (2, None, 3, 1), (2, "x", 1, 2),
            (3, "z", 1, 1),
            (6, " ", 2, 1), (6, "w", 1, 2),
            (None, "q", 2, 1),
        ],
        key=repr,
    )


def test_clean_drops_null_and_blank_first(log):
    top = T.top_n_keywords(log, 1, clean=True)
    assert bag(top, "user_id", "keyword") == sorted(
        [(1, "a"), (2, "x"), (3, "z"), (6, "w"), (None, "q")], key=repr
    )


def test_top1_is_rank_one_of_top3(log):
    first = T.first_of_top(T.top_n_keywords(log, 3)).drop("rank")
    assert bag(first) == bag(T.top_keyword_per_user(log))
    assert bag(first) == bag(T.top_n_keywords(log, 1).drop("rank"))


def test_null_keyword_ranks_last_among_equals(spark):
    log = spark.createDataFrame([(1, None), (1, "zz")], "user_id long, keyword string")
    assert tuples(T.top_keyword_per_user(log)) == [(1, "zz", 1)]
    assert tuples(T.top_n_keywords(log, 1)) == [(1, "zz", 1, 1)]


def test_report_order(log):
    top = tuples(T.in_report_order(T.top_keyword_per_user(log)))
    assert [r[2] for r in top] == [3, 2, 2, 2, 1]
    assert [r[0] for r in top] == [2, 1, 6, None, 3]


def test_first_ranks_are_the_head_of_all_ranks(spark, log):
    counts = N.user_keyword_counts(log)
    for n in (1, 2, 5000):
        head = T.rank_keywords(counts, ["user_id"]).where(F.col("rank") <= n)
        assert bag(T.first_ranked(counts, ["user_id"], n)) == bag(head)


def test_month_columns(dated):
    assert bag(T.monthly_favourites(dated)) == sorted(WIDE, key=repr)


def test_month_columns_from_stored_counts(dated):
    counts = N.user_keyword_counts_by_month(dated)
    assert bag(T.favourites(counts)) == sorted(WIDE, key=repr)
    assert bag(counts.where("user_id IN (4, 5)")) == [
        (4, "may only", 1, 0, 0), (5, "a", 2, 2, 0), (5, "b", 1, 1, 0),
    ]
    total = counts.select("user_id", "keyword", "search_count")
    assert bag(total) == bag(N.user_keyword_counts(dated))


def test_month_columns_from_ranked_rows(dated):
    top = T.top_n_keywords(with_month(dated), 1, ["user_id", "month"])
    assert bag(T.pivot_ranked(top)) == sorted(WIDE, key=repr)


def test_other_months_and_one_year(dated):
    assert T.monthly_favourites(dated, months=(5, 6)).columns == [
        "user_id", "most_search_t5", "most_search_t6",
    ]
    late = T.monthly_favourites(dated, year=2023)
    assert tuples(late) == [(5, "a", None)]


def test_dates_as_text(spark):
    rows = [(1, "2022-06-01 10:00:00", "a"), (1, "garbage", "b"), (2, "2022-07-09", "c"), (3, "", "d"),
            (4, "2022-06-30T23:30:00-05:00", "e")]
    log = spark.createDataFrame(rows, "user_id long, datetime string, keyword string")
    assert bag(with_month(log), "user_id", "month") == sorted(
        [(1, 6), (1, None), (2, 7), (3, None), (4, 6)], key=repr
    )
    assert bag(T.monthly_favourites(log)) == [
        (1, "a", None), (2, None, "c"), (3, None, None), (4, "e", None),
    ]
    assert bag(T.monthly_favourites(log, year=2022)) == [
        (1, "a", None), (2, None, "c"), (4, "e", None),
    ]


def test_first_user_rows_skip_blank_and_keep_repeats(spark):
    rows = [("u1", "a", 9), ("u2", None, 8), ("u3", " ", 8), ("u4", "a", 7), ("u5", "b", 7), (None, "c", 7)]
    top1 = spark.createDataFrame(rows, "user_id string, keyword string, search_count long")
    assert tuples(T.top_user_rows(top1, 3), "user_id", "keyword", "pos") == [
        ("u1", "a", 1), ("u4", "a", 2), ("u5", "b", 3),
    ]


def test_total_of_favourites(spark):
    rows = [(1, "a", 3), (2, "a", 1), (3, "b", 2), (4, None, 9)]
    top1 = spark.createDataFrame(rows, "user_id long, keyword string, search_count long")
    top = N.top_keywords(T.total_of_favourites(top1), 20)
    assert tuples(top) == [("a", 4), ("b", 2)]
