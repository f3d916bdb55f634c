"""The nearest category for keywords that have none, learned from those that have.

Naive Bayes over runs of three letters. All numbers are whole, so the result does not
depend on the order in which Spark adds them up.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions import text
from searchtide.functions.replies import DEFAULT_CATEGORY

#: Millionths of a natural logarithm.
UNIT = 1_000_000


def letter_runs(keyword: Column) -> Column:
    """All runs of three letters of the plain keyword, with its borders marked."""
    bordered = F.concat(F.lit("^"), text.normalize(keyword), F.lit("$"))
    last = F.greatest(F.char_length(bordered) - 2, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(bordered, i, F.lit(3)))


def learn(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What keywords (keyword, category) tell: (run, category, gain) and (category, prior, base).

    The default category and null are no categories to learn. A category's score for a
    keyword is its prior, and for each run of letters the gain less the base.
    """
    told = known.where(F.col("category").isNotNull() & (F.col("category") != DEFAULT_CATEGORY))
    told = told.where(F.col("keyword").isNotNull()).select("keyword", "category").distinct()
    runs = told.select("category", F.explode(letter_runs(F.col("keyword"))).alias("run"))
    counts = runs.groupBy("run", "category").agg(F.count("*").alias("n"))
    kinds = counts.agg(F.count_distinct("run")).scalar()
    keywords = told.groupBy("category").agg(F.count("*").alias("keywords"))
    total = keywords.agg(F.sum("keywords").cast("double")).scalar()
    size = counts.groupBy("category").agg(F.sum("n").alias("size"))
    prior = F.floor(UNIT * F.log(F.col("keywords").cast("double") / total))
    base = F.floor(UNIT * F.log((F.col("size") + kinds).cast("double")))
    return (
        counts.select("run", "category", F.floor(UNIT * F.log((F.col("n") + 1).cast("double"))).alias("gain")),
        keywords.join(size, "category").select("category", prior.alias("prior"), base.alias("base")),
    )


def nearest_category(keywords: DataFrame, known: DataFrame) -> DataFrame:
    """(keyword, category, score) of the distinct keywords that share letters with a known one.

    Of all categories that have one of the keyword's runs the likeliest; equal scores
    go to the first in order. A keyword that shares no run with any, and null, has no
    row.
    """
    gains, categories = learn(known)
    distinct = keywords.select("keyword").where(F.col("keyword").isNotNull()).distinct()
    runs = distinct.select("keyword", F.explode(letter_runs(F.col("keyword"))).alias("run"))
    # How often a run is in a keyword, and how many runs it has in all.
    counted = runs.groupBy("keyword", "run").agg(F.count("*").alias("times"))
    gained = counted.join(gains, "run").groupBy("keyword", "category").agg(
        F.sum(F.col("times") * F.col("gain")).alias("gained")
    )
    n_runs = F.size(letter_runs(F.col("keyword")))
    score = F.col("prior") + F.col("gained") - n_runs * F.col("base")
    scored = gained.join(categories, "category").select("keyword", "category", score.alias("score"))
    best = F.min(F.struct(-F.col("score"), "category"))["category"]
    return scored.groupBy("keyword").agg(best.alias("category"), F.max("score").alias("score"))


def fill_nearest(classified: DataFrame) -> DataFrame:
    """Keywords with their category, the default one replaced by the nearest where there is one."""
    none = F.col("category") == DEFAULT_CATEGORY
    found = nearest_category(classified.where(none), classified.where(~none)).select(
        F.col("keyword").alias("_of"), F.col("category").alias("_nearest")
    )
    joined = classified.join(found, none & (F.col("keyword") == F.col("_of")), "left")
    return joined.withColumn("category", F.coalesce("_nearest", "category")).drop("_of", "_nearest")
