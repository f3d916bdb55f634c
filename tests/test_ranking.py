"""Distributed row numbers against brute force, with heavy groups."""

import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from searchtide.operators import counts as N
from searchtide.operators import ranking
from searchtide.operators import topn as T
from searchtide.operators import trend as M
from searchtide.operators.ranking import number_rows
from tests.helpers import bag, plan, tuples

SCHEMA = "user_id long, keyword string, search_count long"


def brute(rows):
    numbered = []
    for user in {r[0] for r in rows}:
        mine = sorted(
            (r for r in rows if r[0] == user), key=lambda r: (-r[2], r[1] is None, r[1] or "")
        )
        numbered += [(*r, i) for i, r in enumerate(mine, 1)]
    return sorted(numbered, key=repr)


def heavy_rows():
    """A third of the rows in one group, whose keywords share their beginning, most with one count."""
    draw = random.Random(7)
    rows = [
        (None if i % 3 == 0 else i % 40, f"the same long beginning {i:04}", draw.choice([1, 1, 1, 2, 5]))
        for i in range(4000)
    ]
    return [*rows, (None, None, 3), (5, None, 1)]


def test_heavy_group_is_numbered_across_parts(spark, monkeypatch):
    rows = heavy_rows()
    counts = spark.createDataFrame(rows, SCHEMA).repartition(7)
    ranked = number_rows(counts, T.best_first(), ["user_id"], sample=4)
    assert bag(ranked) == brute(rows)
    placed = number_rows(counts, [*T.best_first(), F.col("user_id")], sample=4)
    assert [r[0] for r in sorted(tuples(placed, "rank"))] == list(range(1, len(rows) + 1))
    assert bag(T.rank_keywords(counts, ["user_id"])) == brute(rows)


def test_no_part_is_near_a_heavy_group(spark, monkeypatch):
    """The parts of the heavy group are many and even, whatever its keywords begin with."""
    monkeypatch.setattr(ranking, "STEP", 40)
    counts = spark.createDataFrame(heavy_rows(), SCHEMA).repartition(3)
    numbered = number_rows(counts, T.best_first(), ["user_id"], sample=2)
    heavy = sum(r[0] is None for r in heavy_rows())
    text = plan(numbered)
    assert "_part" in text
    sizes = parts_of(counts, 2)
    assert len(sizes) >= 14 and max(sizes) < 0.2 * heavy


def test_borders_in_many_blocks(spark, monkeypatch):
    """More borders than one array takes: a part for every few rows, still numbered without a gap."""
    monkeypatch.setattr(ranking, "STEP", 2)
    monkeypatch.setattr(ranking, "WIDTH", 20)
    rows = heavy_rows()
    counts = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert bag(number_rows(counts, T.best_first(), ["user_id"], sample=2)) == brute(rows)
    sizes = parts_of(counts, 2)
    assert len(sizes) > 10 * 20 and sum(sizes) == sum(r[0] is None for r in rows)


def test_every_heavy_group_is_split(spark, monkeypatch):
    """However many they are: here 1,500 groups, each with more rows than a part."""
    monkeypatch.setattr(ranking, "STEP", 2)
    rows = [(u, f"k{i:02}", i % 7) for u in range(1500) for i in range(12)]
    counts = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert bag(number_rows(counts, T.best_first(), ["user_id"], sample=1)) == brute(rows)
    assert len({u for u, _ in parts_by_group(counts, 1)}) == 1500


def test_a_long_table_is_sampled_less(spark, monkeypatch):
    """Borders are bounded by MOST, not by the table; the numbers stay the same."""
    monkeypatch.setattr(ranking, "STEP", 4)
    rows = heavy_rows()
    counts = spark.createDataFrame(rows, SCHEMA).repartition(3)
    many = len(parts_of(counts, 1))
    monkeypatch.setattr(ranking, "MOST", 400)
    few = len(parts_of(counts, 1))
    assert few < many / 5 and few > 5
    assert bag(number_rows(counts, T.best_first(), ["user_id"], sample=1)) == brute(rows)


def parts_of(counts, sample):
    """Sizes of the heavy group's parts: rows that share a start of their numbers."""
    return [n for user, n in parts_by_group(counts, sample) if user is None]


def parts_by_group(counts, sample):
    """(group, size) of each part of a group that is split."""
    seen = []
    original = type(counts).withColumn

    def noted(df, name, value):
        if name == "_local":
            seen.append(df)
        return original(df, name, value)

    type(counts).withColumn = noted
    try:
        number_rows(counts, T.best_first(), ["user_id"], sample=sample)
    finally:
        type(counts).withColumn = original
    placed = seen[0].where("_part >= 0").groupBy("user_id", "_part").count()
    return [(r["user_id"], r["count"]) for r in placed.collect()]


def test_the_log_is_read_once_for_a_heavy_group(spark, tmp_path):
    """Borders, sizes and numbers all read the shuffle of the counts."""
    spark.createDataFrame(heavy_rows(), SCHEMA).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    ranked = number_rows(N.user_keyword_counts(log), T.best_first(), ["user_id"], sample=4)
    ranked.collect()
    final = plan(ranked).split("== Initial Plan ==")[0]
    assert final.count("FileScan") - final.count("ReusedExchange") <= 1
    assert final.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in final


def test_order_over_the_whole_table(spark):
    rows = [(1, f"k{i}", i) for i in range(500)]
    placed = number_rows(
        spark.createDataFrame(rows, SCHEMA).repartition(5), [-F.col("search_count")], name="pos", sample=3
    )
    assert bag(placed, "keyword", "pos") == sorted(
        [(f"k{i}", 500 - i) for i in range(500)], key=repr
    )


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.rank_keywords(empty, ["user_id"]).count() == 0


searches = st.lists(
    st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a", "b", "B", "é"])),
    min_size=1, max_size=30,
)


@pytest.mark.parametrize("n", [1, 3])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=searches)
def test_top_n_against_brute_force(spark, n, rows):
    log = spark.createDataFrame(rows, "user_id long, keyword string")
    counted = [(u, k, rows.count((u, k))) for u, k in set(rows)]
    expected = [r for r in brute(counted) if r[3] <= n]
    assert bag(T.top_n_keywords(log, n)) == expected
    if n == 1:
        assert bag(T.top_keyword_per_user(log)) == sorted((r[:3] for r in expected), key=repr)


months = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2]),
        st.sampled_from([5, 6, 7, None]),
        st.sampled_from([None, "a", "b", "c"]),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=months)
def test_monthly_tables_against_brute_force(spark, rows):
    dated = [(u, None if m is None else datetime.datetime(2022, m, 2), k) for u, m, k in rows]
    wide = T.monthly_favourites(
        spark.createDataFrame(dated, "user_id long, datetime timestamp, keyword string")
    )

    def best(user, month):
        mine = [k for u, m, k in rows if (u, m) == (user, month)]
        return min(mine, key=lambda k: (-mine.count(k), k is None, k or ""), default=None)

    expected = [(u, best(u, 6), best(u, 7)) for u in {r[0] for r in rows}]
    assert bag(wide) == sorted(expected, key=repr)
    both = [r for r in expected if r[1] is not None and r[2] is not None]
    kept = sum(r[1] == r[2] for r in both)
    shares = {r[0]: (r[1], round(r[2], 9)) for r in tuples(M.retention(wide))}
    assert shares == {
        same: (n, round(n / len(both) * 100, 9))
        for same, n in ((True, kept), (False, len(both) - kept))
        if n
    }
    cells = [c for r in expected for c in r[1:] if c is not None]
    assert sum(r[1] + r[2] for r in tuples(M.compare_months(wide))) == len(cells)
