"""Names inside keywords: the longest phrase of a table that a keyword holds.

The table is an inverted index of runs of words. A keyword gives its runs of as many
words as some phrase has, and both are joined on the run; neither is broadcast by
hint, and nothing is compared without a key.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.functions import text


def phrase_index(phrases: DataFrame) -> DataFrame:
    """(phrase, n_words, category): a table (keyword, category) by its plain phrases.

    Phrases compare in lower case, without marks. One listed repeatedly has the first
    of its categories in order; blank ones and those without a category are left out.
    """
    plain = phrases.select(text.normalize(F.col("keyword")).alias("phrase"), "category")
    kept = plain.where((F.col("phrase") != "") & F.col("category").isNotNull())
    return kept.groupBy("phrase").agg(F.min("category").alias("category")).select(
        "phrase", F.size(F.split("phrase", " ")).alias("n_words"), "category"
    )


def with_phrases(keywords: DataFrame, phrases: DataFrame) -> DataFrame:
    """The distinct keywords with ``phrase`` and ``phrase_category``, null where none is inside.

    Whole words only. The phrase of the most words wins, then the one of the most
    letters, the one that comes first, and the first category in order. Null and blank
    keywords hold nothing; all rows and columns stay.
    """
    index = phrase_index(phrases)
    lengths = index.agg(F.array_sort(F.collect_set("n_words"))).scalar()
    words = F.split(text.normalize(F.col("_of")), " ")
    distinct = keywords.select(F.col("keyword").alias("_of")).where(F.col("_of").isNotNull()).distinct()
    worded = distinct.select("_of", words.alias("_words")).withColumn("_lengths", lengths)
    fitting = F.filter("_lengths", lambda n: n <= F.size("_words"))
    runs = F.flatten(
        F.transform(
            fitting,
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size("_words") - n + 1),
                lambda at: F.struct(at.alias("at"), F.array_join(F.slice("_words", at, n), " ").alias("run")),
            ),
        )
    )
    placed = worded.select("_of", F.inline(runs))
    order = F.struct(
        -F.col("n_words"), -F.char_length("phrase"), F.col("at"), F.col("category"), F.col("phrase").alias("phrase")
    )
    best = (
        placed.join(index, F.col("run") == F.col("phrase"))
        .groupBy("_of")
        .agg(F.min(order).alias("_best"))
        .select("_of", F.col("_best.phrase").alias("phrase"), F.col("_best.category").alias("phrase_category"))
    )
    return keywords.join(best, F.col("keyword") == F.col("_of"), "left").drop("_of")
