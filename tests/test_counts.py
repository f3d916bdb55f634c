"""Cleaning, folding and roll-ups."""

import pytest
from pyspark.sql import functions as F

from searchtide.functions import text
from searchtide.operators import counts as N
from tests.helpers import bag, tuples


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "keyword string")


def test_blank_keywords_of_all_kinds(spark):
    df = frame(spark, ["a", "", " ", "\t", " ", "　", "\x1c", " b ", None])
    assert bag(N.drop_blank_keywords(df)) == [(" b ",), ("a",)]
    assert N.drop_null_keywords(df).count() == 8


@pytest.mark.parametrize(
    "raw", ["  x ", " x　", "\tx\n", "x", "\x1fx y\x1c", "", " ", " đ ́ "]
)
def test_strip_agrees_with_python(spark, raw):
    row = frame(spark, [raw]).select(text.strip(F.col("keyword"))).first()
    assert row[0] == raw.strip()


def test_words_that_look_missing_are_kept(spark):
    df = frame(spark, ["NA", "null", "nan", "None"])
    assert N.drop_blank_keywords(df).count() == 4


def test_normalize(spark):
    df = frame(spark, ["  Trò  CHƠI! ", "a - b", "S.W.A.T.", "!!", None])
    assert bag(N.normalize_keywords(df)) == sorted(
        [("trò chơi",), ("a b",), ("swat",)], key=repr
    )


def test_blanks_of_every_kind_part_words(spark):
    blanks = ["\x85", "\x1c", "\x1f", "\u00a0", "\u3000", "\u2028", "\t", "\x0b"]
    df = frame(spark, [f"a{b}{i}" for i, b in enumerate(blanks)])
    assert bag(N.normalize_keywords(df)) == sorted([(f"a {i}",) for i in range(len(blanks))], key=repr)


def test_a_repeated_alias_counts_once(spark):
    counts = spark.createDataFrame([("x", 5), ("y", 2)], "keyword string, search_count long")
    rows = [("x", "z"), ("x", "b"), ("x", None), ("x", "b"), ("y", None), (None, "q")]
    aliases = spark.createDataFrame(rows, "variant string, canonical string")
    assert bag(N.merge_aliases(counts, aliases)) == [("b", 5), ("y", 2)]


def test_folded_counts_of_users_add_up(spark):
    rows = [(1, "love", 2, 1), (1, "LOVE", 1, 0), (2, "LÖVE", 1, 1), (2, None, 3, 0), (3, "x", 1, 1)]
    counts = spark.createDataFrame(rows, "user_id long, keyword string, search_count long, count_t6 long")
    assert bag(N.fold_counts(counts, ["user_id"])) == sorted(
        [(1, "love", 3, 1), (2, "love", 1, 1), (2, None, 3, 0), (3, "x", 1, 1)], key=repr
    )


def test_fold_unites_case_and_accents(spark):
    rows = [("đại", 1), ("dai", 2), ("Đại", 4), ("NARUTO", 1), ("narúto", 1), (None, 5)]
    counts = spark.createDataFrame(rows, "keyword string, search_count long")
    assert bag(N.fold_keywords(counts)) == sorted(
        [("Đại", 7, 3), ("NARUTO", 2, 2), (None, 5, 1)], key=repr
    )


def test_composed_and_decomposed_accents(spark):
    counts = N.keyword_counts(frame(spark, ["viê", "viê", "viê", "vie"]))
    assert counts.count() == 3
    folded = N.fold_keywords(counts, "UNICODE")
    assert bag(folded) == sorted([("viê", 3, 2), ("vie", 1, 1)], key=repr)


def test_aliases(spark):
    counts = spark.createDataFrame(
        [("yt", 2), ("youtube", 3), ("x", 1), (None, 4)], "keyword string, search_count long"
    )
    aliases = spark.createDataFrame([("yt", "youtube")], "variant string, canonical string")
    assert bag(N.merge_aliases(counts, aliases)) == sorted(
        [("youtube", 5), ("x", 1), (None, 4)], key=repr
    )


def test_roll_up_and_top(spark):
    rows = [(1, 6, "a", 2), (1, 7, "a", 3), (2, 6, None, 5), (2, 6, "b", 5)]
    counts = spark.createDataFrame(rows, "user_id long, month int, keyword string, search_count long")
    assert bag(N.roll_up(counts, ["user_id", "keyword"])) == sorted(
        [(1, "a", 5), (2, None, 5), (2, "b", 5)], key=repr
    )
    assert tuples(N.top_keywords(N.roll_up(counts, ["keyword"]), 2)) == [("a", 5), ("b", 5)]
