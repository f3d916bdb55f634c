"""Every query against its SQL counterpart on the same Parquet tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in records)


# Queries beside the log's are here if SQL can express them, and else in tests of their own.
NAMES = sorted({*contract.log_queries(), *contract.oracle_sql()})


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    found = result.collect()
    assert found, "no rows"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    cursor = duck.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows(result.columns, found) == rows(columns, cursor.fetchall())


SETTINGS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.session.timeZone": "America/New_York",
}


@pytest.mark.parametrize(
    "name", ["extract_json", "rank_user_month_keyword", "month_growth", "merge_aliases", "derive_month"]
)
def test_query_under_other_settings(spark, duck, name):
    before = {key: spark.conf.get(key) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        test_query(spark, duck, name)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_sql_only_for_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
