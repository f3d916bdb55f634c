"""Accents put back into keywords that were typed without them.

The log's own accented keywords say which words a plain word may stand for and which
words follow each other. A keyword is a chain of such choices, and the most likely
chain is found by a Viterbi search over bigrams.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.functions.text import unaccent
from searchtide.operators.counts import roll_up
from searchtide.operators.segments import COST
from searchtide.session import scratch_path

#: Weight of a word's own share against that of the pair it is in.
SMOOTH = 2

#: Hashes at which words that change are marked, a power of two: 2 MB, whatever the log.
KEYS = 2**24

_STATE = "array<struct<cost: bigint, text: string>>"


def is_accented(text: Column) -> Column:
    return text != unaccent(text)


def _stored(spark: SparkSession, table: DataFrame, name: str) -> DataFrame:
    """The table, worked out once and read from the session's checkpoint folder."""
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _spaced(keyword: Column) -> Column:
    """The words of a keyword with one blank between them."""
    trimmed = F.trim(keyword)
    return F.when(trimmed.contains("  "), F.regexp_replace(trimmed, " +", " ")).otherwise(trimmed)


def _words(keyword: Column) -> Column:
    """The words that blanks part; one empty word if there is none."""
    return F.split(_spaced(keyword), " ")


def _steps(keywords: DataFrame, *columns: str) -> DataFrame:
    """(*columns, at, before, word): each word and the one before it, the empty one before the first."""
    placed = keywords.withColumn("words", _words(F.col("keyword"))).select(
        *columns, "words", F.posexplode("words").alias("at", "word")
    )
    before = F.coalesce(F.get("words", F.col("at") - 1), F.lit(""))
    return placed.where("word <> ''").select(*columns, "at", before.alias("before"), "word")


def _choices(pairs: DataFrame) -> DataFrame:
    """(word, names, n, shares): what a word may stand for, in order, with its searches and their share.

    Known words and plain forms of known words are here; any other word stands for
    itself. A word with accents stands for itself too. A keyword's beginning is a word
    of its own, the empty one.
    """
    total = pairs.agg(F.sum("together").cast("double")).scalar()
    known = pairs.groupBy(F.col("second").alias("word")).agg(F.sum("together").alias("n"))
    shares = known.withColumn("share", F.coalesce(F.col("n"), F.lit(0)).cast("double") / total)
    choice = F.struct(F.col("word").alias("name"), "n", "share")
    forms = shares.groupBy(unaccent(F.col("word")).alias("plain")).agg(
        F.sort_array(F.collect_list(choice)).alias("choices")
    )
    plain = F.col("plain")
    form = F.filter(
        F.array(F.struct(plain.alias("word"), "choices")), lambda f: (f["word"] != "") & ~is_accented(f["word"])
    )
    own = F.transform(
        F.filter("choices", lambda c: c["name"] != plain),
        lambda c: F.struct(c["name"].alias("word"), F.array(c).alias("choices")),
    )
    # One row, or none where nothing is known.
    begins = pairs.where("first = ''").agg(F.sum("together").alias("n")).where("n IS NOT NULL")
    empty = F.struct(F.lit("").alias("name"), "n", F.lit(0.0).alias("share"))
    first = begins.select(F.lit("").alias("word"), F.array(empty).alias("choices"))
    each = F.col("choices")
    return (
        forms.select(F.inline(F.concat(form, own)))
        .unionByName(first)
        .select("word", each["name"].alias("names"), each["n"].alias("n"), each["share"].alias("shares"))
    )


def _place(word: Column) -> Column:
    return F.hash(word).bitwiseAND(F.lit(KEYS - 1))


def _marks(words: DataFrame) -> Column:
    """Marks at the hashes of words, 64 in a number: one array of a fixed size."""
    slot = F.shiftright(_place(F.col("word")), 6).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _place(F.col("word")))
    marked = words.select(slot.alias("id"), bit.alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = words.sparkSession.range(max(KEYS // 64, 1)).join(marked, "id", "left")
    bits = F.coalesce("bits", F.lit(0).cast("long")).alias("bits")
    return every.agg(F.sort_array(F.collect_list(F.struct("id", bits)))["bits"]).scalar()


def _marked(marks: Column, word: Column) -> Column:
    """True for words that were marked, and for a few others."""
    bits = F.get(marks, F.shiftright(_place(word), 6))
    return F.call_function("shiftright", bits, _place(word)).bitwiseAND(F.lit(1)) == 1


def _costs(asked: DataFrame, choices: DataFrame, pairs: DataFrame) -> DataFrame:
    """(before, word, seconds, costs) of two words in a row, where they differ from the words alone.

    ``seconds`` are the choices of the second word, null if it stays as it is; ``costs``
    those of every pair of choices, in order, null if there is only one.
    """

    def alone(column: str, value: Column) -> Column:
        return F.coalesce(column, F.array(value))

    # Choices are told from their words by accents alone, so their pairs have one plain form.
    seen = pairs.groupBy(unaccent(F.col("first")).alias("plain_first"), unaccent(F.col("second")).alias("plain_second")).agg(
        F.collect_list(F.struct("first", "second", "together")).alias("seen")
    )
    plain = (F.col("plain_first") == unaccent(F.col("before"))) & (F.col("plain_second") == unaccent(F.col("word")))
    none = F.lit(0).cast("long")
    both = (
        asked.join(choices.withColumnRenamed("word", "before"), "before", "left")
        .select("before", "word", alone("names", F.col("before")).alias("firsts"), alone("n", none).alias("n"))
        .join(choices.select("word", "names", "shares"), "word", "left")
        .select("before", "word", "firsts", "n", alone("names", F.col("word")).alias("names"), alone("shares", F.lit(0.0)).alias("shares"))
        .join(seen, plain, "left")
    )

    def cost(a: Column, n: Column, b: Column, share: Column) -> Column:
        own = F.filter("seen", lambda s: (s["first"] == a) & (s["second"] == b))
        together = F.coalesce(F.get(own, F.lit(0))["together"], F.lit(0))
        likely = (together + SMOOTH * share) / (F.coalesce(n, F.lit(0)) + SMOOTH)
        # What is not known has no choice beside it, so any cost will do; its logarithm is null.
        return F.coalesce(F.floor(-COST * F.log(likely)).cast("long"), F.lit(0))

    costs = F.flatten(
        F.transform(
            "firsts",
            lambda a, i: F.transform("names", lambda b, j: cost(a, F.get("n", i), b, F.get("shares", j))),
        )
    )
    changed = F.col("names") != F.array("word")
    priced = (F.size("firsts") > 1) | (F.size("names") > 1)
    return both.where(changed | priced).select(
        "before", "word", F.when(changed, F.col("names")).alias("seconds"), F.when(priced, costs).alias("costs")
    )


def _cheapest(words: str, found: str) -> Column:
    """The cheapest chain of the choices of words, parted by blanks, by what was found for some of them.

    Choices differ in accents alone, so chains are in the same order as their words.
    """

    def joined(start: Column, end: Column) -> Column:
        """Words in a row, each after a blank."""
        row = F.concat(F.array(F.lit("")), F.slice(words, start + 1, end - start))
        return F.when(end > start, F.array_join(row, " ")).otherwise("")

    def behind(i: Column) -> Column:
        """The place behind the word before the i-th of those found."""
        return F.coalesce(F.get(found, i - 1)["at"] + 1, F.lit(0))

    steps = F.transform(
        found,
        lambda p, i: F.struct(
            joined(behind(i), p["at"]).alias("gap"),
            F.coalesce(p["seconds"], F.array(F.get(words, p["at"]))).alias("seconds"),
            p["costs"].alias("costs"),
        ),
    )
    begin = F.expr(f"CAST(array(struct(0L, '')) AS {_STATE})")

    def onward(state: Column, step: Column) -> Column:
        """For each choice of a word the cheapest chain that ends in it."""
        n = F.size(step["seconds"])
        return F.transform(
            step["seconds"],
            lambda b, j: F.array_min(
                F.transform(
                    state,
                    lambda s, i: F.struct(
                        (s["cost"] + F.coalesce(F.get(step["costs"], i * n + j), F.lit(0))).alias("cost"),
                        F.concat(s["text"], step["gap"], F.lit(" "), b).alias("text"),
                    ),
                )
            ),
        )

    chain = F.array_min(F.aggregate(steps, begin, onward))["text"]
    return F.ltrim(F.concat(chain, joined(behind(F.size(found)), F.size(words))))


def restore_accents(counts: DataFrame) -> DataFrame:
    """(keyword, search_count, restored): distinct keywords with accents put back.

    The accented keywords of ``counts``, those with at least one accent, are what is
    learned from. Words that none of them has stay as they are, as do words with
    accents; of chains that cost the same the first in order wins. Words are parted by
    blanks, which become single ones. Null, empty and blank keywords stay.

    The distinct keywords, the pairs of words learned, the choices and the words asked
    for are stored once, below the session's checkpoint folder, and read from there.
    Words that change are marked by their hash in an array of a fixed size, so that only
    they and their neighbours are shuffled, by the number of their keyword; a word marked
    by chance is looked up for nothing.
    """
    spark = counts.sparkSession
    numbered = roll_up(counts, ["keyword"]).withColumn("key", F.monotonically_increasing_id())
    kept = _stored(spark, numbered, "keywords")
    accented = kept.where(is_accented(F.col("keyword")))
    learned = (
        _steps(accented, "search_count")
        .groupBy(F.col("before").alias("first"), F.col("word").alias("second"))
        .agg(F.sum("search_count").alias("together"))
    )
    pairs = _stored(spark, learned, "pairs")
    choices = _stored(spark, _choices(pairs), "choices")
    open_ = _marks(choices.where(F.size("names") > 1))
    changed = _marks(choices.where(F.col("names") != F.array("word")))

    # A word that has no choice, nor the one before it, is asked for as if it were the first.
    priced = _marked(open_, F.col("word")) | _marked(open_, F.col("before"))
    spots = _stored(
        spark,
        _steps(kept, "key")
        .where(_marked(changed, F.col("word")) | _marked(open_, F.col("before")))
        .select("key", "at", F.when(priced, F.col("before")).otherwise("").alias("before"), "word"),
        "spots",
    )
    near = pairs.where(_marked(open_, unaccent(F.col("first"))) | _marked(open_, unaccent(F.col("second"))))
    costs = _costs(spots.select("before", "word").distinct(), choices, near)
    found = (
        spots.join(costs, ["before", "word"])
        .repartition("key")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("at", "seconds", "costs"))).alias("found"))
    )
    split = kept.join(found, "key", "left").withColumn(
        "words", F.when(F.col("found").isNotNull(), _words(F.col("keyword")))
    )
    best = F.when(F.col("found").isNull(), _spaced(F.col("keyword"))).otherwise(_cheapest("words", "found"))
    restored = F.when(F.trim("keyword") != "", best).otherwise(F.col("keyword"))
    return split.select("keyword", "search_count", F.coalesce(restored, "keyword").alias("restored"))
