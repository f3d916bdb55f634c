"""What must hold between the tables of one log."""

import os

import pytest
from pyspark.sql import functions as F

from searchtide.functions.dates import with_month
from searchtide.operators import classify as C
from searchtide.operators import counts as N
from searchtide.operators import profile as P
from searchtide.operators import topn as T
from searchtide.operators import trend as M
from searchtide.sources.star_log import search_log
from tests.helpers import bag, tuples

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def log(spark):
    return search_log(spark, SF_DIR, dirty=True).cache()


def total(df, column="search_count"):
    return df.agg(F.sum(column)).first()[0]


def test_counts_add_up_to_the_log(log):
    rows = log.count()
    by_month = N.user_month_keyword_counts(log)
    assert total(by_month) == total(N.user_keyword_counts(log)) == rows
    assert total(N.keyword_counts(log)) == rows
    assert bag(N.roll_up(by_month, ["user_id", "keyword"])) == bag(N.user_keyword_counts(log))


def test_month_columns_count_the_months(log):
    wide = N.user_keyword_counts_by_month(log, (6, 7))
    dated = with_month(log)
    for month in (6, 7):
        assert total(wide, f"count_t{month}") == dated.where(F.col("month") == month).count()


def test_ranks_run_without_gaps_and_counts_never_rise(log):
    by_user = {}
    for user, count, rank in tuples(
        T.rank_keywords(N.user_keyword_counts(log), ["user_id"]), "user_id", "search_count", "rank"
    ):
        by_user.setdefault(user, []).append((rank, count))
    for ranked in by_user.values():
        ranked.sort()
        assert [r for r, _ in ranked] == list(range(1, len(ranked) + 1))
        assert [c for _, c in ranked] == sorted((c for _, c in ranked), reverse=True)


def test_top_n_is_the_head_of_the_full_rank(log):
    full = T.rank_keywords(N.user_keyword_counts(log), ["user_id"])
    columns = ["user_id", "keyword", "search_count", "rank"]
    assert bag(full.where("rank <= 3"), *columns) == bag(T.top_n_keywords(log, 3), *columns)


def test_both_ways_to_the_monthly_table(log):
    long = T.top_n_keywords(with_month(log), 1, ["user_id", "month"])
    wide = bag(T.monthly_favourites(log))
    assert wide == bag(T.pivot_ranked(long))
    assert wide == bag(T.favourites(N.user_keyword_counts_by_month(log)))
    assert len(wide) == log.select("user_id").distinct().count()


def test_comparison_counts_the_cells(log):
    wide = T.monthly_favourites(log)
    compared = M.compare_months(wide)
    cells = wide.agg(F.count("most_search_t6"), F.count("most_search_t7")).first()
    assert (total(compared, "count_t6"), total(compared, "count_t7")) == tuple(cells)


def test_shares_add_up(log):
    for column in ("category", "keyword"):
        shares = tuples(M.share_of(log, column), "n", "pct")
        assert sum(n for n, _ in shares) == log.count()
        assert sum(p for _, p in shares) == pytest.approx(100)


def test_batches_hold_every_keyword_once(log):
    keywords = N.keyword_counts(N.drop_blank_keywords(log))
    batches = tuples(C.cut_batches(C.with_positions(keywords)), "batch", "keywords")
    sizes = [len(words) for _, words in sorted(batches)]
    assert all(size == 10 for size in sizes[:-1]) and 1 <= sizes[-1] <= 10
    assert sorted(w for _, words in batches for w in words) == [r[0] for r in bag(keywords, "keyword")]


def test_profile_agrees_with_counting(log):
    rows = log.count()
    nulls = {r[0]: r[1] for r in tuples(P.table_profile(log), "column_name", "n_nulls")}
    values = {r[0]: r[1] for r in tuples(P.schema_profile(log), "column_name", "n_values")}
    assert {c: rows - n for c, n in nulls.items()} == values
    assert nulls["keyword"] == log.where("keyword IS NULL").count() > 0
    assert P.preview(log, 4).count() == 4
