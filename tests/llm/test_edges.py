"""Every query over empty tables and over rows that are hard to take."""

import pytest

import __spark_entry__ as contract
from searchtide.llm.queries import QUERIES
from tests.helpers import bag

NAMES = sorted([*QUERIES, "pipeline"])


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty_tables, name):
    assert contract.queries()[name](spark, empty_tables).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_odd_tables(spark, odd_tables, name):
    found = contract.queries()[name](spark, odd_tables)
    ids = {"op1": "page_id", "op11": "page_id"} | dict.fromkeys(
        ("op2", "op3", "op4", "op9", "op12", "op13", "pipeline")
    )
    per_row = ids.get(name.split("_")[0], "doc_id")
    rows = found.collect()
    assert rows
    if per_row:
        table = "pages" if per_row == "page_id" else "documents"
        wanted = spark.read.parquet(f"{odd_tables}/{table}.parquet").select(per_row)
        assert sorted(repr(r[per_row]) for r in rows) == sorted(repr(r[0]) for r in wanted.collect())


def test_searches_of_odd_vectors(spark, odd_tables):
    """Null, empty and infinite vectors take no part, nor other lengths; equal scores go by id."""
    found = bag(QUERIES["op2_kd_tree"](spark, odd_tables), "query_id", "rank", "vec_id")
    assert [r[2] for r in found if r[0] == 0] == [9, 100, 4, 7, 200] or [
        r[2] for r in found if r[0] == 0
    ] == [9, 100, 4, 7, 200][: len(found)]
    near = bag(QUERIES["op3_pruned_graph"](spark, odd_tables), "query_id", "rank", "vec_id", "score")
    assert [r[2:] for r in near if r[0] == 0][0] == (100, 0.0)
    assert not any(r[2] in (1, 2, 3, 4, 5, 6, 8) for r in near)
