"""Logs and result tables on disk."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from searchtide.schema import CLASSIFIED, LOG, TOP_KEYWORDS, wide_schema
from searchtide.sources import parquet_log, tables
from tests.helpers import bag, tuples


def search(user, keyword, day=1, category="c"):
    when = datetime.datetime(2022, 6, day, 8)
    return (f"e{user}{keyword}", when, user, keyword, category, "ios", "wifi")


@pytest.fixture(scope="module")
def log_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("log")
    for day in (1, 2, 3):
        rows = [search(f"u{i}", f"k{day}", day) for i in range(day)]
        frame = spark.createDataFrame(rows, LOG).repartition(2)
        frame.write.parquet(str(root / f"2022060{day}"))
    (root / "20220601" / "notes.txt").write_text("not a log")
    return str(root)


def test_whole_tree(spark, log_dir):
    log = parquet_log.read_log(spark, log_dir)
    assert log.count() == 6 and log.columns == LOG.names
    assert parquet_log.read_log(spark, log_dir, LOG).count() == 6


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("x")
    for schema in (None, LOG):
        with pytest.raises(FileNotFoundError, match=str(tmp_path)):
            parquet_log.read_log(spark, str(tmp_path), schema)
        with pytest.raises(FileNotFoundError):
            parquet_log.read_log(spark, str(tmp_path / "gone"), schema)
    with pytest.raises(FileNotFoundError):
        parquet_log.read_day(spark, str(tmp_path), "20220601")


def test_files_without_rows_are_no_error(spark, tmp_path):
    spark.createDataFrame([], LOG).write.parquet(str(tmp_path / "day"))
    assert parquet_log.read_log(spark, str(tmp_path), LOG).count() == 0


def test_some_days(spark, log_dir):
    assert parquet_log.read_day(spark, log_dir, "20220602").count() == 2
    days = parquet_log.read_days(spark, log_dir, ["20220601", "20220603"])
    assert bag(days.select("keyword").distinct()) == [("k1",), ("k3",)]


def test_inventory(spark, log_dir):
    files = tuples(parquet_log.file_inventory(spark, log_dir), "file_name", "file_size", "size_mb", "n_rows")
    on_disk = {
        name: os.path.getsize(os.path.join(folder, name))
        for folder, _, names in os.walk(log_dir)
        for name in names
        if name.endswith(".parquet")
    }
    assert {f[0]: f[1] for f in files} == on_disk
    assert all(f[2] == f[1] / 1048576 for f in files)
    assert sum(f[3] for f in files) == 6


def test_inventory_tells_equal_names_apart(spark, tmp_path):
    for day in ("d 1", "d2"):
        source = str(tmp_path / "made")
        spark.range(3).coalesce(1).write.mode("overwrite").parquet(source)
        (part,) = (tmp_path / "made").glob("*.parquet")
        folder = tmp_path / "log" / day
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_bytes(part.read_bytes())
    files = tuples(parquet_log.file_inventory(spark, str(tmp_path / "log")), "file_name", "n_rows")
    assert files == [("part-0.parquet", 3)] * 2


def test_unite_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2, True)], "b string, a int, c boolean")
    assert bag(parquet_log.unite(a, b)) == [(1, "x", None), (2, "y", True)]


KEYWORDS = [
    'he said "hi", ok', "two\nlines", "  edge  ", "NA", "null", "nan", "back\\slash", 'a "', ",", "đại", "'", "#x",
]


def test_csv_round_trip(spark, tmp_path):
    rows = [(f"u{i}", k, i, 1) for i, k in enumerate([*KEYWORDS, None])]
    path = str(tmp_path / "top")
    tables.write_csv(spark.createDataFrame(rows, TOP_KEYWORDS), path)
    assert bag(tables.read_csv(spark, path, TOP_KEYWORDS)) == sorted(rows, key=repr)


def test_single_file_keeps_order(spark, tmp_path):
    rows = [(f"u{i}", "k", i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, TOP_KEYWORDS).repartition(4).orderBy(F.desc("search_count"))
    path = tmp_path / "one"
    tables.write_csv(df, str(path), single_file=True)
    (part,) = path.glob("*.csv")
    assert part.read_text().splitlines()[:2] == ["user_id,keyword,search_count,rank", "u49,k,49,1"]
    assert [r[2] for r in tuples(tables.read_csv(spark, str(path), TOP_KEYWORDS))] == list(range(49, -1, -1))


@pytest.mark.parametrize("n", [1, 200_000])
def test_layout_does_not_depend_on_the_number_of_rows(spark, tmp_path, n):
    df = spark.range(n).selectExpr("string(id) AS keyword", "'c' AS category").repartition(3)
    tables.write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    tables.write_csv(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("*.csv"))) == min(n, 3)
    assert tables.read_csv(spark, str(tmp_path / "many"), CLASSIFIED).count() == n


def test_files_stay_short(spark, tmp_path):
    df = spark.range(95).selectExpr("string(id) AS keyword", "'c' AS category").coalesce(1)
    tables.write_csv(df, str(tmp_path), file_rows=10)
    assert len(list(tmp_path.glob("*.csv"))) == 10
    assert tables.read_csv(spark, str(tmp_path), CLASSIFIED).count() == 95


def test_other_files_are_not_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,c\na,News\n")
    (tmp_path / "notes.txt").write_text("k,c\nnot,a table\n")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.csv").write_text("k,c\nb,News\n")
    for multiline in (True, False):
        assert tuples(tables.read_csv(spark, str(tmp_path), CLASSIFIED, multiline)) == [("a", "News")]
        report = tables.load_report(spark, str(tmp_path), CLASSIFIED, multiline)
        assert tuples(report, "lines", "parsed", "skipped") == [(2, 1, 0)]


def test_csv_in_a_folder_below_only(spark, tmp_path):
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.csv").write_text("k,c\nb,News\n")
    for read in (tables.read_csv, tables.load_report):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path), CLASSIFIED)


BAD = "user_id,keyword,extra\n1,x\n2,y,EXTRA\n3\n4,y,,\n5,,\n6,\n\n7,\"q\nr\"\n8,a,b,c,d\n"


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(BAD.replace(",extra", "", 1))
    schema = CLASSIFIED
    found = bag(tables.read_csv(spark, str(tmp_path), schema))
    assert found == sorted([("1", "x"), ("3", None), ("6", None), ("7", "q\nr")], key=repr)
    report = tuples(tables.load_report(spark, str(tmp_path), schema), "lines", "parsed", "skipped")
    assert report == [(11, 4, 6)]


def test_split_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,c\na,News\nb,Drama,more\nc\n")
    found = tables.read_csv(spark, str(tmp_path), CLASSIFIED, multiline=False)
    assert bag(found) == sorted([("a", "News"), ("c", None)], key=repr)


def test_names_go_by_position_and_types_may_fail(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\nu,k,5,1\nv,k,many,2\n")
    assert tuples(tables.read_csv(spark, str(tmp_path), TOP_KEYWORDS)) == [
        ("u", "k", 5, 1), ("v", "k", None, 2),
    ]


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("keyword,category\nđại chiến titan,Animation\n".encode("utf-8-sig"))
    path = str(tmp_path / "c.csv")
    assert tuples(tables.read_csv(spark, path, CLASSIFIED)) == [("đại chiến titan", "Animation")]


def test_marker_files_are_left_out(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame([("a", "News")], CLASSIFIED), path)
    assert os.path.exists(f"{path}/_SUCCESS")
    assert tables.read_csv(spark, path, CLASSIFIED).count() == 1


def test_missing_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path), CLASSIFIED)
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "gone"), CLASSIFIED)
    empty = tables.or_empty(
        lambda: tables.read_csv(spark, str(tmp_path), wide_schema()), spark, wide_schema()
    )
    assert empty.count() == 0 and empty.columns == ["user_id", "most_search_t6", "most_search_t7"]
    gone = tables.or_empty(lambda: spark.read.parquet(str(tmp_path / "gone")), spark, LOG)
    assert gone.count() == 0


def test_other_errors_are_not_hidden(spark):
    with pytest.raises(Exception, match="nowhere"):
        tables.or_empty(lambda: spark.table("nowhere"), spark, LOG)


def test_json_round_trip(spark, tmp_path):
    rows = [("a", "News"), ("đ", None)]
    path = str(tmp_path / "json")
    tables.write_json(spark.createDataFrame(rows, CLASSIFIED), path)
    assert bag(tables.read_json(spark, path, CLASSIFIED)) == sorted(rows, key=repr)


def test_inventory_agrees_with_the_file_system(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    found = {r["file_name"]: (r["file_size"], r["size_mb"], r["n_rows"]) for r in parquet_log.file_inventory(spark, folder, "part.parquet").collect()}
    size = os.stat(f"{folder}/part.parquet").st_size
    assert found == {"part.parquet": (size, size / 1048576, 200)}
    listed = {r["file_name"]: r["file_size"] for r in parquet_log.list_files(spark, folder).collect()}
    assert listed == {n: os.stat(f"{folder}/{n}").st_size for n in os.listdir(folder) if n.endswith(".parquet")}
