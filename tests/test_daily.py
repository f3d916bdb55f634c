"""Counts of a growing log: the same as of the whole, whatever dies in between."""

import datetime
import os
import random

import pytest

from searchtide import __main__ as command
from searchtide.operators import counts as N
from searchtide.plans import daily
from searchtide.schema import LOG
from searchtide.sources.parquet_log import read_log
from tests.helpers import bag


def add_day(spark, root, n, rows=80):
    draw = random.Random(n)
    found = [
        ("e", datetime.datetime(2022, draw.choice([5, 6, 7]), 1 + n, 9), draw.choice(["u1", "u2", None]),
         draw.choice(["a", "b", "c d", None]), "c", "p", "n")
        for _ in range(rows)
    ]
    spark.createDataFrame(found, LOG).coalesce(2).write.parquet(f"{root}/202206{n:02d}")


def whole(spark, root):
    return bag(N.user_keyword_counts_by_month(read_log(spark, root)))


def test_counts_of_a_growing_log(spark, tmp_path):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    for n in range(1, 4):
        add_day(spark, root, n)
        assert bag(daily.update(spark, root, store)) == whole(spark, root)
    assert daily.counted_files(spark, store).count() == sum(
        f.endswith(".parquet") for _, _, names in os.walk(root) for f in names
    )
    batches = daily.counted_files(spark, store).select("batch").distinct().count()
    assert batches == 3
    # Nothing new: nothing is written.
    versions = daily._versions(spark, store)
    assert bag(daily.update(spark, root, store)) == whole(spark, root)
    assert daily._versions(spark, store) == versions


def test_only_new_files_are_read(spark, tmp_path):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    add_day(spark, root, 1)
    daily.update(spark, root, store)
    before = whole(spark, root)
    # Were the first day read again, this would fail.
    for name in os.listdir(f"{root}/20220601"):
        if name.endswith(".parquet"):
            path = f"{root}/20220601/{name}"
            stat = os.stat(path)
            with open(path, "r+b") as file:
                file.write(b"\0" * stat.st_size)
            os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
            crc = f"{root}/20220601/.{name}.crc"
            if os.path.exists(crc):
                os.utime(crc)
    assert bag(daily.update(spark, root, store)) == before
    add_day(spark, root, 2)
    assert sum(r["search_count"] for r in daily.update(spark, root, store).collect()) == 160


@pytest.mark.parametrize("dies", ["before counts", "before manifest", "in manifest"])
def test_a_run_that_dies_counts_nothing_twice(spark, tmp_path, monkeypatch, dies):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    add_day(spark, root, 1)
    daily.update(spark, root, store)
    add_day(spark, root, 2)

    def half(spark, store, counts, files):
        number = daily._next(spark, store)
        if dies != "before counts":
            counts.write.mode("overwrite").parquet(f"{store}/counts/{number}")
        if dies == "in manifest":
            files.write.mode("overwrite").parquet(f"{store}/manifest/{number}")
            os.remove(f"{store}/manifest/{number}/_SUCCESS")
        raise RuntimeError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "_commit", half)
        with pytest.raises(RuntimeError):
            daily.update(spark, root, store)
    first = whole(spark, f"{root}/20220601")
    assert bag(daily.totals(spark, store)) == first
    add_day(spark, root, 3)
    assert bag(daily.update(spark, root, store)) == whole(spark, root)


def test_batches_are_merged(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    monkeypatch.setattr(daily, "FILES", 1)
    monkeypatch.setattr(daily, "MERGE_FROM", 4)
    add_day(spark, root, 1)
    add_day(spark, root, 2)
    assert bag(daily.update(spark, root, store)) == whole(spark, root)
    assert len(os.listdir(f"{store}/counts")) == 1 and len(daily._versions(spark, store)) == 1
    add_day(spark, root, 3)
    assert bag(daily.update(spark, root, store)) == whole(spark, root)

    # A merge that dies before its manifest leaves the old batches in force.
    def half(spark, store, counts, files):
        counts.write.mode("overwrite").parquet(f"{store}/counts/{daily._next(spark, store)}")
        raise RuntimeError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "_commit", half)
        with pytest.raises(RuntimeError):
            daily.merge(spark, store)
    assert bag(daily.totals(spark, store)) == whole(spark, root)
    daily.merge(spark, store)
    assert bag(daily.totals(spark, store)) == whole(spark, root)


def test_what_is_an_error(spark, tmp_path):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        daily.update(spark, root, store)
    add_day(spark, root, 1)
    daily.update(spark, root, store, clean=True)
    with pytest.raises(ValueError, match="was counted with"):
        daily.update(spark, root, store)
    name = next(f for f in os.listdir(f"{root}/20220601") if f.endswith(".parquet"))
    os.utime(f"{root}/20220601/{name}", (1, 1))
    with pytest.raises(ValueError, match="has changed"):
        daily.update(spark, root, store, clean=True)


def test_report_from_a_store(spark, tmp_path):
    root, store = str(tmp_path / "log"), str(tmp_path / "store")
    for n in (1, 2):
        add_day(spark, root, n)
        command.main(["report", root, str(tmp_path / f"out{n}"), "--store", store, "--inside", "--nearest"])
    command.main(["report", root, str(tmp_path / "plain")])
    for name in ("top3_keywords", "top_keyword_by_month", "keyword_classified"):
        one, other = (spark.read.parquet(f"{tmp_path}/{o}/{name.replace('keyword_', '') if name.endswith('fied') else name}") for o in ("out2", "plain"))
        assert bag(one) == bag(other)
