"""Whole jobs on a small log, against counts made in plain Python."""

import datetime
import json
import random
from collections import Counter

import pytest

from searchtide import __main__ as command
from searchtide.functions.rules import CATEGORIES
from searchtide.plans import reports
from searchtide.schema import CLASSIFIED, LOG, TOP_KEYWORDS, wide_schema
from searchtide.sources import tables
from searchtide.sources.parquet_log import read_log
from tests.helpers import bag, tuples

WORDS = ["NARUTO", "vtv1", "love song", "bolero", "phim hay", 'x "y", z', None, " "]


def searches():
    draw = random.Random(3)
    for _ in range(600):
        day = datetime.datetime(2022, draw.choice([5, 6, 7]), draw.randint(1, 28), 9)
        user = draw.choice(["u1", "u2", "u3", "u4", None, "u1"])
        yield ("e", day, user, draw.choice(WORDS), "c", "p", "n")


@pytest.fixture(scope="module")
def log_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("searches")
    rows = list(searches())
    for month in (5, 6, 7):
        part = [r for r in rows if r[1].month == month]
        spark.createDataFrame(part, LOG).write.parquet(str(root / f"20220{month}01"))
    return str(root)


def best(counter, user, n):
    mine = [(k, c) for (u, k), c in counter.items() if u == user]
    return sorted(mine, key=lambda r: (-r[1], r[0] is None, r[0] or ""))[:n]


def test_search_report(spark, log_dir, tmp_path):
    out = str(tmp_path / "report")

    def classifier(keywords):
        return "Sure: " + json.dumps({k: "Drama" for k in keywords if k != "bolero"})

    results = reports.search_report(
        spark, log_dir, out, classifier=classifier, wait_seconds=0, top=30
    )

    counter = Counter((r[2], r[3]) for r in searches())
    users = {u for u, _ in counter}
    top3 = [(u, k, c, i) for u in users for i, (k, c) in enumerate(best(counter, u, 3), 1)]
    assert bag(results["top3_keywords"]) == sorted(top3, key=repr)
    assert bag(tables.read_csv(spark, f"{out}/csv/top3_keywords", TOP_KEYWORDS)) == sorted(
        top3, key=repr
    )
    ordered = [r[2] for r in tuples(tables.read_csv(spark, f"{out}/csv/top1_keywords", TOP_KEYWORDS))]
    assert ordered == sorted(ordered, reverse=True)

    months = {m: Counter((r[2], r[3]) for r in searches() if r[1].month == m) for m in (6, 7)}
    wide = [(u, *[best(months[m], u, 1)[0][0] for m in (6, 7)]) for u in users]
    assert bag(results["top_keyword_by_month"]) == sorted(wide, key=repr)
    assert bag(tables.read_csv(spark, f"{out}/csv/top_keyword_by_month", wide_schema())) == sorted(
        wide, key=repr
    )

    firsts = {r[1] for r in top3 if r[3] == 1 and r[1] and r[1].strip()}
    found = dict(bag(results["keyword_classified"], "keyword", "category"))
    assert found == {k: "Other" if k == "bolero" else "Drama" for k in firsts}
    stored = tables.read_csv(spark, f"{out}/csv/keyword_classified", CLASSIFIED)
    assert dict(bag(stored)) == found
    sizes = {r[0]: r[1] for r in tuples(results["profiles"], "table_name", "n_rows")}
    assert sizes["top3_keywords"] == len(top3) and sizes["top_keyword_by_month"] == len(users)
    for name in ("profiles", "top20_overall", "month_compare_top20", "top_keyword_retention",
                 "month_growth_top10", "category_distribution"):
        assert spark.read.csv(f"{out}/csv/{name}", header=True).columns


def test_clean_report_of_every_keyword_by_rules(spark, log_dir, tmp_path):
    out = str(tmp_path / "report")
    results = reports.search_report(spark, log_dir, out, counting={"clean": True})
    found = dict(bag(results["keyword_classified"], "keyword", "category"))
    assert found == {
        "NARUTO": "Animation", "vtv1": "TV Channel", "love song": "Romance", "bolero": "Music",
        "phim hay": "Other", 'x "y", z': "Other",
    }
    assert set(found.values()) <= set(CATEGORIES)
    assert results["top3_keywords"].where("keyword IS NULL OR trim(keyword) = ''").count() == 0


def test_long_form_per_month(spark, log_dir, tmp_path):
    top = reports.top_per_month(read_log(spark, log_dir), str(tmp_path), 1)
    june = Counter((r[2], r[3]) for r in searches() if r[1].month == 6)
    expected = [(u, *best(june, u, 1)[0]) for u in {u for u, _ in june}]
    assert bag(top.where("month = 6"), "user_id", "keyword", "search_count") == sorted(
        expected, key=repr
    )


def test_command_line(spark, log_dir, tmp_path):
    command.main(["day", log_dir, "20220601", str(tmp_path / "day")])
    rows = [r for r in searches() if r[1].month == 6]
    top = spark.read.csv(str(tmp_path / "day/csv/top_keywords"), header=True, escape='"')
    assert int(top.first()["search_count"]) == max(Counter(r[3] for r in rows).values())
    command.main(["months", log_dir, str(tmp_path / "months"), "--top", "2", "--clean"])
    long = spark.read.parquet(str(tmp_path / "months/top2_keywords_by_month"))
    assert {r[0] for r in tuples(long, "rank")} == {1, 2}
    assert {r[0] for r in tuples(long, "month")} == {5, 6, 7}
    command.main(["report", log_dir, str(tmp_path / "all"), "--months", "5", "6"])
    wide = tables.read_csv(spark, str(tmp_path / "all/csv/top_keyword_by_month"), wide_schema((5, 6)))
    assert wide.count() == len({r[2] for r in searches()})


def test_a_second_run_asks_nothing(spark, tmp_path):
    words = spark.createDataFrame([(f"k{i:02}", i) for i in range(1, 26)], "keyword string, pos long")
    asked = tmp_path / "asked"
    asked.mkdir()
    answering = [False]

    def classifier():
        good = answering[0]

        def reply(keywords):
            (asked / keywords[0]).write_text("")
            return json.dumps({k: "Drama" for k in keywords}) if good or keywords[0] == "k01" else "no"

        return reply

    def run():
        for path in asked.glob("*"):
            path.unlink()
        found = reports.classification(words, str(tmp_path / "out"), classifier(), wait_seconds=0)
        return dict(bag(found, "keyword", "category")), sorted(p.name for p in asked.glob("*"))

    first, names = run()
    assert names == ["k01", "k11", "k21"] and set(first.values()) == {"Drama", "Other"}
    answering[0] = True
    second, names = run()
    assert names == ["k11", "k21"] and set(second.values()) == {"Drama"} and len(second) == 25
    assert run() == (second, [])


SPELLED = [
    ("u1", 2022, "Love"), ("u1", 2022, "love!"), ("u1", 2022, "LOVE"), ("u1", 2021, "old"), ("u1", 2021, "old"),
    ("u1", 2021, "old"), ("u1", 2021, "old"), ("u2", 2022, "bolero"), ("u2", 2022, " "),
]


@pytest.fixture(scope="module")
def spelled_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("spelled") / "day")
    rows = [("e", datetime.datetime(y, 6, 3), u, k, "c", "p", "n") for u, y, k in SPELLED]
    spark.createDataFrame(rows, LOG).write.parquet(path)
    return path


@pytest.mark.parametrize(
    "options,expected",
    [
        ([], [("u1", "old", 4), ("u2", " ", 1)]),
        (["--year", "2022", "--clean"], [("u1", "LOVE", 1), ("u2", "bolero", 1)]),
        (["--year", "2022", "--normalize"], [("u1", "love", 3), ("u2", "bolero", 1)]),
        (["--year", "2022", "--clean", "--fold"], [("u1", "LOVE", 2), ("u2", "bolero", 1)]),
    ],
)
def test_options_of_the_report(spark, spelled_dir, tmp_path, options, expected):
    (tmp_path / "names.csv").write_text("keyword,category\nBOLERO,Music of old\nlove,Nothing\n")
    command.main(["report", spelled_dir, str(tmp_path / "out"), "--names", str(tmp_path / "names.csv"), *options])
    first = spark.read.parquet(str(tmp_path / "out/top3_keywords")).where("rank = 1")
    assert bag(first, "user_id", "keyword", "search_count") == expected
    found = dict(bag(spark.read.parquet(str(tmp_path / "out/classified")), "keyword", "category"))
    assert found["bolero"] == "Music of old"
    assert {found[k] for k in found if k.lower() == "love"} == {"Romance"}


def test_year_of_the_months(spark, spelled_dir, tmp_path):
    command.main(["months", spelled_dir, str(tmp_path / "out"), "--year", "2021"])
    assert bag(spark.read.parquet(str(tmp_path / "out/top3_keywords_by_month")), "keyword") == [("old",)]


def test_a_missing_log(spark, tmp_path):
    gone = str(tmp_path / "gone")
    with pytest.raises(FileNotFoundError):
        command.main(["report", gone, str(tmp_path / "out")])
    command.main(["report", gone, str(tmp_path / "out"), "--allow-missing"])
    assert spark.read.parquet(str(tmp_path / "out/top_keyword_by_month")).count() == 0


def test_first_rows_only(spark, log_dir, tmp_path):
    command.main(["report", log_dir, str(tmp_path / "out"), "--top", "2", "--clean"])
    assert 1 <= spark.read.parquet(str(tmp_path / "out/classified")).count() <= 2
