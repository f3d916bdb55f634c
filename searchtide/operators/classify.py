"""A category for every keyword: by rules, by a table, or by a batch classifier.

The classifier is any function from a list of keywords to a reply text. Its
batches are rows of a DataFrame, so they are asked for in parallel, and its
answers are parsed and merged by column expressions.
"""

import json
import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.functions import replies
from searchtide.functions.replies import DEFAULT_CATEGORY
from searchtide.functions.rules import CATEGORIES, category_by_rules, default_rules
from searchtide.operators.nearest import fill_nearest
from searchtide.operators.phrases import with_phrases
from searchtide.operators.ranking import number_rows
from searchtide.operators.topn import best_first
from searchtide.operators.trend import share_of
from searchtide.schema import REPLIES

BATCH_SIZE = 10
#: Batches that a task asks for at most; a lost task repeats no more than these.
BATCHES_PER_TASK = 50
OUTCOME = ("reply", "answers", "status", "attempts", "error")


def distinct_keywords(positioned: DataFrame) -> DataFrame:
    """Each keyword once, at its first position."""
    return positioned.groupBy("keyword").agg(F.min("pos").alias("pos"))


def with_positions(counts: DataFrame) -> DataFrame:
    """Place of every keyword by popularity, however many there are."""
    return number_rows(counts, best_first(), name="pos")


def cut_batches(positioned: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Consecutive positions (from 1) in batches of ``size``, keywords in order."""
    batch = F.floor((F.col("pos") - 1) / F.lit(size)).cast("long")
    entries = F.array_sort(F.collect_list(F.struct("pos", "keyword")))
    return (
        positioned.withColumn("batch", batch)
        .groupBy("batch")
        .agg(entries.alias("entries"))
        .select(
            "batch",
            F.col("entries.pos").cast("array<long>").alias("positions"),
            F.col("entries.keyword").alias("keywords"),
            F.to_json("entries.keyword").alias("payload"),
        )
    )


def prompt_parts(
    categories: Sequence[str] = CATEGORIES,
    rules: Sequence[tuple[str, str]] | None = None,
) -> tuple[str, str]:
    """The text before and after a batch's keywords."""
    hints = default_rules() if rules is None else rules
    head = "\n".join(
        [
            "You sort search keywords of a video service into content categories.",
            "Keywords may be misspelt, lack Vietnamese accents or run words together;"
            " read them as the title, person, team or topic most likely meant.",
            "Categories: " + ", ".join(categories) + ".",
            "Hints (regular expression: category):",
            *[f"  {pattern}: {category}" for pattern, category in hints],
            "Countries, clubs and matches are Sports; names from Chinese or Korean"
            " series are C Drama or K Drama; cartoon and anime names are Animation.",
            f"Use {DEFAULT_CATEGORY} only when nothing else fits.",
            "Keywords:",
            "",
        ]
    )
    tail = (
        "\nAnswer with one JSON object and nothing else:"
        " each keyword exactly as given, and its category."
    )
    return head, tail


def prompt(keywords: Sequence[str], **parts) -> str:
    """The prompt of one batch, for use inside a classifier function."""
    head, tail = prompt_parts(**parts)
    payload = json.dumps(list(keywords), ensure_ascii=False, separators=(",", ":"))
    return head + payload + tail


def with_prompts(batches: DataFrame, **parts) -> DataFrame:
    """The prompt of every batch, as a column."""
    head, tail = prompt_parts(**parts)
    return batches.withColumn("prompt", F.concat(F.lit(head), F.col("payload"), F.lit(tail)))


def reply_reader() -> tuple[Callable[[str], str], Callable[[str], dict | None]]:
    """Two functions for tasks: a text fit for storage, and the answers in a reply.

    The same reading as ``replies.parse_reply``, by a decoder that takes no constants. Inner
    functions travel to the workers by themselves, so these need not have this
    package.
    """
    pattern = replies.OBJECT

    def storable(text: str) -> str:
        # Half a surrogate pair, which JSON allows, cannot be stored as UTF-8.
        return text.encode("utf-8", "replace").decode("utf-8")

    def refuse(number: str):
        raise ValueError(f"{number} is no JSON")

    def written(value) -> str:
        plain = value if isinstance(value, str) else json.dumps(
            value, ensure_ascii=False, separators=(",", ":")
        )
        return storable(plain)

    def answers_in(reply: str) -> dict | None:
        span = re.search(pattern, reply)
        try:
            found = json.loads(span[0], parse_constant=refuse) if span else {}
        except (ValueError, RecursionError):
            return None
        answers = {storable(k): None if v is None else written(v) for k, v in found.items()}
        return answers or None

    return storable, answers_in


def ask(
    batches: DataFrame,
    classifier: Callable[[list[str]], str],
    attempts: int = 3,
    wait_seconds: float = 3.0,
    batches_per_task: int = BATCHES_PER_TASK,
) -> DataFrame:
    """One reply per batch, with up to ``attempts`` tries.

    A reply that is not one JSON object is asked for again at once; after an
    exception there is a wait first. ``status`` ends as ok, invalid or failed,
    and ``error`` holds the last exception.
    The batches are counted first and dealt to as many tasks as it takes for
    ``batches_per_task`` each, and to no fewer than run at once. A task that is lost
    repeats its calls, so store the result before reading it more than once.
    """

    storable, answers_in = reply_reader()

    def answer(keywords: list[str]) -> tuple:
        reply, status, error = None, "failed", None
        for attempt in range(1, attempts + 1):
            try:
                reply = storable(classifier(keywords))
                answers = answers_in(reply)
            except Exception as problem:
                status, error = "failed", storable(repr(problem))
                if attempt < attempts:
                    time.sleep(wait_seconds)
                continue
            if answers:
                return reply, answers, "ok", attempt, error
            status = "invalid"
        return reply, None, status, attempts, error

    def per_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(len(frame)):
                one = frame.iloc[i : i + 1]
                outcome = [answer(list(one["keywords"].iloc[0]))]
                found = pd.DataFrame(outcome, columns=list(OUTCOME), index=one.index)
                yield pd.concat([one, found], axis=1)

    at_once = batches.sparkSession.sparkContext.defaultParallelism
    tasks = max(at_once, -(-batches.count() // batches_per_task))
    wanted = batches.select("batch", "positions", "keywords").repartition(tasks, "batch")
    return wanted.mapInPandas(per_task, REPLIES)


def with_parsed_answers(stored: DataFrame, column: str = "reply") -> DataFrame:
    """Stored reply texts with their answers; null if the reply is not one object."""
    return stored.withColumn("answers", replies.parse_reply(F.col(column)))


def not_asked(batches: DataFrame, stored: DataFrame) -> DataFrame:
    """Batches for whose keywords no good reply is stored."""
    good = stored.where("status = 'ok'").select(F.to_json("keywords").alias("payload")).distinct()
    return batches.join(good, "payload", "left_anti")


def with_stored_answers(batches: DataFrame, stored: DataFrame) -> DataFrame:
    """Batches with the stored answers to their keywords, a good reply before others."""
    best = F.max_by("answers", F.struct(F.col("status") == "ok", F.col("reply")))
    known = stored.groupBy(F.to_json("keywords").alias("payload")).agg(best.alias("answers"))
    return batches.join(known, "payload", "left")


def look_up(answered: DataFrame) -> DataFrame:
    """Category of every keyword of every batch; the default if the reply lacks it."""
    entries = F.arrays_zip(F.col("positions").alias("pos"), F.col("keywords").alias("keyword"))
    return answered.select("batch", "answers", F.inline(entries)).select(
        "batch",
        "pos",
        "keyword",
        replies.lookup(F.col("answers"), F.col("keyword")).alias("category"),
    )


def not_answered(keywords: DataFrame, answered: DataFrame) -> DataFrame:
    """Keywords that no reply names."""
    named = answered.select(F.explode(F.map_keys("answers")).alias("keyword")).distinct()
    return keywords.select("keyword").distinct().join(named, "keyword", "left_anti")


def merge_answers(looked_up: DataFrame) -> DataFrame:
    """One category per keyword: its last batch wins, its first position stays."""
    last = F.max(F.struct("batch", "pos", "category"))["category"]
    return looked_up.groupBy("keyword").agg(
        last.alias("category"), F.min("pos").alias("pos")
    )


def classify_by_rules(
    keywords: DataFrame,
    rules: Sequence[tuple[str, str]] | None = None,
    known: DataFrame | Mapping[str, str] | None = None,
    inside: bool = False,
) -> DataFrame:
    """Category by the first matching rule, then by name, then the default.

    ``known`` names the category of whole keywords, whatever the case: a short
    mapping, or a table (keyword, category) of any size, which is joined. With
    ``inside`` a name counts also where it is some words of a longer keyword, the
    longest name first, after whole keywords. Give distinct keywords: one row per key
    keeps the join even.
    """
    phrases = known if isinstance(known, DataFrame) or not inside else _named(keywords, known or {})
    by_rule = category_by_rules(F.col("keyword"), rules)
    if isinstance(known, DataFrame):
        names = known.groupBy(F.lower("keyword").alias("_name")).agg(
            F.min("category").alias("_known")
        )
        keywords = keywords.join(names, F.lower("keyword") == F.col("_name"), "left")
        by_name = F.col("_known")
    elif known:
        pairs = [F.lit(text) for name in known for text in (name.lower(), known[name])]
        by_name = F.try_element_at(F.create_map(*pairs), F.lower("keyword"))
    else:
        by_name = F.lit(None)
    by_phrase = F.lit(None)
    if inside:
        keywords, by_phrase = with_phrases(keywords, phrases), F.col("phrase_category")
    category = F.coalesce(by_rule, by_name, by_phrase, F.lit(DEFAULT_CATEGORY))
    return keywords.withColumn("category", category).drop("_name", "_known", "phrase", "phrase_category")


def _named(keywords: DataFrame, known: Mapping[str, str]) -> DataFrame:
    return keywords.sparkSession.createDataFrame(list(known.items()), "keyword string, category string")


def category_distribution(classified: DataFrame) -> DataFrame:
    """Keywords per category and their share in percent."""
    known = classified.where(F.col("category").isNotNull())
    return share_of(known, "category").withColumnRenamed("n", "count")


def classify(
    positioned: DataFrame, classifier: Callable[[list[str]], str], nearest: bool = False, **options
) -> DataFrame:
    """Batches, replies, lookup and merge in one go: (keyword, category, pos).

    With ``nearest`` a keyword left without an answer gets the category whose keywords
    its letters are most like.
    """
    found = merge_answers(look_up(ask(cut_batches(positioned), classifier, **options)))
    return fill_nearest(found) if nearest else found
