"""Physical plans: what is read, how often rows are shuffled, where Python runs."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from searchtide.functions.dates import of_year, with_month
from searchtide.operators import counts as N
from searchtide.operators import topn as T
from searchtide.operators import trend as M
from searchtide.sources import star_log
from tests.helpers import bag, plan

SF_DIR = "/root/testdata/sf0.001"
USES_PYTHON = {"classify_function", "classify_top30", "classify_retries"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "log")
    star_log.search_log(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_top_n_cuts_groups_before_the_shuffle(log):
    text = plan(T.top_n_keywords(log, 3))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning(user_id")
    assert ", Partial" in text and ", Final" in text
    assert exchanges(T.top_n_keywords(log, 3)) == 2


def test_ranks_take_one_shuffle_beside_the_counts(log):
    ranked = T.rank_keywords(N.user_keyword_counts(log), ["user_id"])
    ranked.collect()
    # What follows holds the initial plan of the count of picked rows too.
    final, _, initial = plan(ranked).partition("== Initial Plan ==")
    # No group is heavy here, so the joins with borders and sizes fall away.
    assert final.count("Exchange hashpartitioning") == 2 and final.count("FileScan") == 1
    assert "Join" not in final and "SortMergeJoin" not in initial and "Scan ExistingRDD" not in initial


def test_month_columns_take_two_shuffles(log):
    wide = T.monthly_favourites(log)
    assert exchanges(wide) == 2 and "Window" not in plan(wide)
    assert exchanges(M.compare_months(wide)) == 3


def test_only_needed_columns_are_read(log):
    assert "ReadSchema: struct<user_id:bigint,keyword:string>" in plan(T.top_keyword_per_user(log))
    assert "ReadSchema: struct<keyword:string>" in plan(N.keyword_counts(log))


def test_filters_reach_the_scan(log):
    assert "IsNotNull(keyword)" in plan(N.keyword_counts(N.drop_null_keywords(log)))
    assert "GreaterThanOrEqual(datetime" in plan(with_month(of_year(log, 1997)))


def test_short_lists_are_kept_per_task(log):
    assert "TakeOrderedAndProject" in plan(N.top_keywords(N.keyword_counts(log), 10))


def test_unused_tables_are_not_joined(spark):
    assert plan(star_log.search_log(spark, SF_DIR, ["keyword"])).count("FileScan") == 2
    assert plan(star_log.search_log(spark, SF_DIR, ["user_id", "keyword"])).count("FileScan") == 3


@pytest.mark.parametrize("name", sorted(set(contract.log_queries()) - USES_PYTHON))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.files.maxPartitionBytes": "20KB",
}


def test_a_heavy_part_is_split_between_tasks(spark, tmp_path):
    for name in ("lineitem", "orders", "part"):
        df = star_log.table(spark, SF_DIR, name)
        if name == "lineitem":
            heavy = F.when(F.col("l_quantity") < 18, 7).otherwise(F.col("l_partkey"))
            df = df.withColumn("l_partkey", heavy.cast("long")).repartition(16)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    expected = bag(N.keyword_counts(star_log.search_log(spark, str(tmp_path), ["keyword"])))
    before = {key: spark.conf.get(key, None) for key in SPLIT_EARLY}
    try:
        for key, value in SPLIT_EARLY.items():
            spark.conf.set(key, value)
        counts = N.keyword_counts(star_log.search_log(spark, str(tmp_path), ["keyword"]))
        assert bag(counts) == expected
        assert "SortMergeJoin(skew=true)" in plan(counts)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "most_search_t6", "most_search_t7"] and df.count() > 0
