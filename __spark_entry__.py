"""

The queries run on a search log made of order lines (see
``searchtide.sources.star_log``); a few read ``events`` or ``documents``.
"""

from __future__ import annotations

import importlib
import json
import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from searchtide.functions import replies, text
from searchtide.functions.dates import with_month
from searchtide.functions.rules import KNOWN_KEYWORDS
from searchtide.operators import accents, phrases, segments, typos
from searchtide.operators import classify as C
from searchtide.operators import counts as N
from searchtide.operators import nearest as K
from searchtide.operators import profile as P
from searchtide.operators import topn as T
from searchtide.operators import trend as M
from searchtide.plans import daily, reports
from searchtide.schema import CLASSIFIED, REPLIES
from searchtide.session import scratch_path
from searchtide.sources import parquet_log, tables
from searchtide.sources.star_log import search_log, table

SMOKE_DIR = "/root/testdata/sf0.001"



def _optional(name: str):
    """A module that may have been taken away; only its own absence is accepted."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "searchtide.llm"):
            raise
        return None


_LLM = _optional("searchtide.llm.queries")
_PIPELINE = _optional("corpus_pipeline")

# Rules on the words of the log's own keywords, first match wins.
WORD_RULES = [
    ("widget|gizmo", "Animation"),
    (r"\bring\b", "Romance"),
    ("gear|BOLT", "Sports"),
]

# Words of the log's keywords and what stands for them where the default rules
# are tried.
TITLE_WORDS = [
    ("old widget", "NARUTO"),
    ("small widget", "fairy tail"),
    ("large widget", "đại chiến titan"),
    ("hot widget", "ARGEN"),
    ("cold widget", "pent"),
    ("blue widget", "những người thừa kế"),
    ("red widget", "bolero"),
    ("new widget", "S.W.A.T."),
    ("old anvil", "Bigfoot"),
    ("new anvil", "YOUTUBE"),
    ("ring", "LOVE"),
    ("rod", "Master Key 2"),
    ("gear", "vtv3"),
    ("bolt", "breaking"),
    ("anvil", "wizard"),
    ("plate", "olive"),
    ("gizmo", "war"),
]


# --- inputs derived from the tables ----------------------------------------


def _log(spark: SparkSession, d: str, *columns: str, dirty: bool = False) -> DataFrame:
    return search_log(spark, d, columns, dirty) if columns else search_log(spark, d, dirty=dirty)


def _user_keyword(spark, d):
    return N.user_keyword_counts(_log(spark, d, "user_id", "keyword"))


def _wide(spark, d):
    return T.monthly_favourites(_log(spark, d, "user_id", "datetime", "keyword"))


def _top1(spark, d):
    return T.top_keyword_per_user(_log(spark, d, "user_id", "keyword"))


def _clean_counts(spark, d):
    return N.keyword_counts(N.drop_blank_keywords(_log(spark, d, "keyword", dirty=True)))


def _batches(spark, d):
    return C.cut_batches(C.with_positions(_clean_counts(spark, d)))


def _answer(keyword: Column, first: str = "Drama", other: str = "News") -> Column:
    return F.when(keyword.contains("widget"), first).otherwise(other)


def _replied(batches: DataFrame, known: Callable[[Column], Column], *answers: str) -> DataFrame:
    """A reply text per batch that names the keywords of one kind."""
    pairs = F.transform(
        F.filter("keywords", known), lambda k: F.struct(k, _answer(k, *answers))
    )
    told = F.to_json(F.map_from_entries(pairs))
    return batches.withColumn("reply", F.concat(F.lit("Sure:\n"), told, F.lit("\nDone.")))


def _not_hot(keyword: Column) -> Column:
    return ~F.lower(keyword).contains("hot ")


def _answered(spark, d):
    return C.with_parsed_answers(_replied(_batches(spark, d), _not_hot))


def _local_classifier() -> Callable[[list[str]], str]:
    def reply(keywords: list[str]) -> str:
        cold = [k for k in keywords if "hot " not in k.lower()]
        return "Sure: " + json.dumps({k: "Drama" if "widget" in k else "News" for k in cold})

    return reply


def _spelled(spark, d):
    """The log's keywords, in capitals where the category is PROMO."""
    log = _log(spark, d, "keyword", "category")
    loud = F.when(F.col("category") == "PROMO", F.upper("keyword")).otherwise(F.col("keyword"))
    return N.keyword_counts(log.withColumn("keyword", loud))


def _loud_counts(spark, d):
    """Counts by user, the keyword in capitals where the category is PROMO."""
    log = _log(spark, d, "user_id", "keyword", "category")
    loud = F.when(F.col("category") == "PROMO", F.upper("keyword")).otherwise(F.col("keyword"))
    return N.user_keyword_counts(log.withColumn("keyword", loud))


def _aliases(spark, d):
    """A name for every part, listed as often as parts have it."""
    names = table(spark, d, "part").select(F.col("p_name").alias("variant"))
    return names.withColumn("canonical", F.element_at(F.split("variant", " "), -1))


def _known(spark, d):
    """Every part's name with its type as the category, some names more than once."""
    part = table(spark, d, "part").select("p_name", "p_type")
    return part.select(F.upper("p_name").alias("keyword"), F.concat(F.lit("of "), "p_type").alias("category"))


def _titles(spark, d):
    """The log's keywords with words that the default rules know put in."""
    keyword = F.col("keyword")
    for old, new in TITLE_WORDS:
        keyword = F.replace(keyword, F.lit(old), F.lit(new))
    log = N.drop_null_keywords(_log(spark, d, "keyword"))
    return N.keyword_counts(log.withColumn("keyword", keyword))


def _sentences(spark, d):
    """Keywords that hold a part's name between other words."""
    words = F.concat(F.lit("Buy "), F.upper("keyword"), F.lit(", "), F.lower("category"))
    return N.keyword_counts(_log(spark, d, "keyword", "category").select(words.alias("keyword")))


def _names(spark, d):
    """Names of parts with their types, and the last words of names by themselves."""
    part = table(spark, d, "part")
    kind = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    last = part.select(kind.alias("keyword"), F.concat(F.lit("any "), kind).alias("category"))
    return _known(spark, d).where("category <> 'of PROMO' AND keyword NOT LIKE 'HOT %'").unionByName(last)


def _nearest(spark, d):
    """Names of parts; those with a hot thing are the ones without an answer."""
    answers = F.when(~_not_hot(F.col("p_name")), "Other").otherwise(F.split_part("p_name", F.lit(" "), F.lit(2)))
    part = table(spark, d, "part").select(F.col("p_name").alias("keyword"), answers.alias("category"))
    return K.fill_nearest(part.distinct())


def _ruled(spark, d):
    keywords = N.keyword_counts(N.drop_null_keywords(_log(spark, d, "keyword")))
    return C.classify_by_rules(keywords, WORD_RULES, _known(spark, d))


def _part_replies(spark, d):
    name = F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))
    kind = F.col("p_type")
    reply = (
        F.when(kind == "ECONOMY", F.concat(F.lit("Here: {"), name, F.lit(': "Drama"} bye')))
        .when(kind == "LARGE", F.concat(F.lit("{"), name, F.lit(': "Action",\n "x": "News"}')))
        .when(kind == "MEDIUM", F.concat(F.lit("no object for "), F.col("p_name")))
        .when(kind == "PROMO", F.concat(F.lit("[{"), name, F.lit(': "Music"}]')))
        .when(kind == "SMALL", F.lit("{}"))
        .otherwise(F.concat(F.lit("{"), name, F.lit(': "Drama"} or {"x": "News"}')))
    )
    return table(spark, d, "part").select("p_partkey", "p_name", reply.alias("reply"))


def _parsed_parts(spark, d):
    answers = replies.parse_reply(F.col("reply"))
    return _part_replies(spark, d).select(
        "p_partkey",
        replies.preview(F.col("reply")).alias("preview"),
        replies.object_text(F.col("reply")).alias("object_text"),
        F.when(answers.isNull(), 0).otherwise(F.size(answers)).alias("n_keys"),
        answers.isNotNull().alias("is_valid"),
        replies.lookup(answers, F.col("p_name")).alias("category"),
    )


def _csv_round_trip(spark, d):
    path = scratch_path(spark, "top3")
    top = T.top_n_keywords(_log(spark, d, "user_id", "keyword"), 3)
    tables.write_csv(T.in_report_order(top), path)
    return tables.read_csv(spark, path, top.schema)


def _csv_with_mark(spark, d):
    """A CSV table whose files start with a byte-order mark, by position."""
    path = scratch_path(spark, "marked")
    part = table(spark, d, "part").select("p_partkey", "p_name")
    tables.write_csv(part.withColumnRenamed("p_partkey", "\ufeffp_partkey"), path)
    return tables.read_csv(spark, path, part.schema)


def _csv_load_report(spark, d):
    path = scratch_path(spark, "counts")
    counts = N.user_keyword_counts(_log(spark, d, "user_id", "keyword", dirty=True))
    tables.write_csv(counts, path)
    report = tables.load_report(spark, path, counts.schema)
    return report.agg(F.sum("parsed").alias("parsed"), F.sum("skipped").alias("skipped"))


def _classification_csv(spark, d):
    path = scratch_path(spark, "classified")
    keywords = C.with_positions(_clean_counts(spark, d))
    reports.classification(keywords, path, names=_known(spark, d))
    return tables.read_csv(spark, f"{path}/csv/keyword_classified", CLASSIFIED)


def _json_round_trip(spark, d):
    path = scratch_path(spark, "answers")
    tables.write_json(_answered(spark, d), path)
    return C.look_up(tables.read_json(spark, path, REPLIES))


def _missing_input(spark, d):
    """Events beside a log that is missing, which counts as an empty one."""
    events = table(spark, d, "events")
    gone = tables.or_empty(
        lambda: parquet_log.read_log(spark, f"{d}/no-such-log"), spark, events.schema
    )
    return parquet_log.unite(events, gone)


def _error_of(read: Callable[[], DataFrame]) -> str:
    try:
        read()
    except FileNotFoundError as error:
        return type(error).__name__
    return "none"


def _missing_errors(spark, d):
    """What reading raises: a tree without such files, a folder without CSV."""
    parquet = _error_of(lambda: parquet_log.read_log(spark, d, pattern="no-such-*.parquet"))
    csv = _error_of(lambda: tables.read_csv(spark, d, CLASSIFIED))
    found = _error_of(lambda: parquet_log.read_log(spark, d, pattern="events.parquet"))
    return table(spark, d, "events").agg(
        F.count("*").alias("n_rows"),
        F.lit(parquet).alias("no_parquet"),
        F.lit(csv).alias("no_csv"),
        F.lit(found).alias("events"),
    )


def _union_days(spark, d):
    events = table(spark, d, "events")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    early = F.coalesce(F.col("ts") < middle, F.lit(False))
    late = events.where(~early).select(*reversed(events.columns))
    return parquet_log.unite(events.where(early), late)


def _failing_classifier() -> Callable[[list[str]], str]:
    """Fails in a fixed way, by the first keyword of a batch."""

    def reply(keywords: list[str]) -> str:
        if "gizmo" in keywords[0]:
            raise OSError("no answer")
        if "bolt" in keywords[0]:
            return "no object"
        return json.dumps({k: "Drama" for k in keywords})

    return reply


def _retries(spark, d):
    asked = C.ask(_batches(spark, d), _failing_classifier(), attempts=2, wait_seconds=0)
    return asked.select("batch", "status", "attempts", "error", F.size("answers").alias("n_answers"))


def _text_words(spark, d):
    """All words of the documents, whose letters have accents, composed and decomposed."""
    word = F.col("word")
    texts = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    loud = F.when(F.col("doc_id") % 3 == 0, F.upper(word)).otherwise(word)
    apart = F.replace(loud, F.lit("é"), F.lit("e\u0301"))
    spelled = F.when(F.col("doc_id") % 2 == 0, apart).otherwise(loud)
    return N.keyword_counts(texts.select(spelled.alias("keyword")))


# Keywords with typing errors put in by the order's number: a letter left out, doubled
# or replaced, two left out, two swapped, two replaced.
_MISTYPED = """CASE l_orderkey % 40
    WHEN 1 THEN concat(substr(p_name, 1, CAST(p - 1 AS INT)), substr(p_name, CAST(p + 1 AS INT)))
    WHEN 2 THEN concat(substr(p_name, 1, CAST(p AS INT)), substr(p_name, CAST(p AS INT)))
    WHEN 3 THEN concat(substr(p_name, 1, CAST(p - 1 AS INT)), 'x', substr(p_name, CAST(p + 1 AS INT)))
    WHEN 4 THEN concat(substr(p_name, 1, CAST(p - 1 AS INT)), substr(p_name, CAST(p + 2 AS INT)))
    WHEN 5 THEN concat(substr(p_name, 1, CAST(p - 1 AS INT)), substr(p_name, CAST(p + 1 AS INT), 1),
      substr(p_name, CAST(p AS INT), 1), substr(p_name, CAST(p + 2 AS INT)))
    WHEN 6 THEN concat('q', substr(p_name, 2, length(p_name) - 2), 'q')
    ELSE p_name END"""


def _mistyped(spark, d):
    """Counts of the log's keywords with typing errors."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    named = lines.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    place = named.withColumn("p", 2 + F.col("l_partkey") % (F.length("p_name") - 2))
    return N.keyword_counts(place.select(F.expr(_MISTYPED).alias("keyword")))


def _run_together(spark, d):
    """Counts of the log's keywords, without blanks where the category is PROMO."""
    log = _log(spark, d, "keyword", "category")
    joined = F.replace(F.col("keyword"), F.lit(" "), F.lit(""))
    return N.keyword_counts(
        log.withColumn("keyword", F.when(F.col("category") == "PROMO", joined).otherwise(F.col("keyword")))
    )


def _phrases(spark, d):
    """Counts of all texts' runs of six words, those of odd documents without accents."""
    runs = F.regexp_extract_all(text.normalize(F.col("text")), F.lit("[^ ]+(?: [^ ]+){0,5}"), F.lit(0))
    each = table(spark, d, "documents").select("doc_id", F.explode(runs).alias("keyword"))
    typed = F.when(F.col("doc_id") % 2 == 1, text.unaccent(F.col("keyword"))).otherwise(F.col("keyword"))
    return N.keyword_counts(each.select(typed.alias("keyword")))


def _daily(spark, d):
    """Counts of a log that comes in three parts, each counted when it is there."""
    log, root = _log(spark, d, "user_id", "datetime", "keyword"), scratch_path(spark, "days")
    store, year = scratch_path(spark, "daily"), F.coalesce(F.year("datetime"), F.lit(0))
    for i, part in enumerate([year < 1994, (year >= 1994) & (year < 1997), year >= 1997]):
        log.where(part).write.parquet(f"{root}/day{i}")
        counts = daily.update(spark, root, store)
    return counts


def _merged(spark, d):
    batches = _batches(spark, d)
    first = C.look_up(C.with_parsed_answers(_replied(batches, _not_hot)))
    again = batches.withColumn("batch", F.col("batch") + 1_000_000_000).withColumn(
        "keywords", F.filter("keywords", lambda k: k.contains("ring"))
    ).where(F.size("keywords") > 0)
    again = again.withColumn("positions", F.transform("keywords", lambda k: F.lit(1_000_000_000)))
    second = C.look_up(
        C.with_parsed_answers(_replied(again, lambda k: F.lit(True), "Music", "Music"))
    )
    return C.merge_answers(parquet_log.unite(first, second)).select("keyword", "category", "pos")


# --- the contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Top keyword per user, June beside July."""
    return _wide(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or report; each takes (spark, sf_dir)."""
    found = log_queries()
    if _LLM:
        found |= _LLM.QUERIES
    if _PIPELINE:
        found["pipeline"] = _PIPELINE.run
    return found


def log_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources
        "scan_log": lambda s, d: parquet_log.read_log(s, d, pattern="lineitem.parquet"),
        "scan_day": lambda s, d: parquet_log.read_day(s, d, "events.parquet"),
        "union_days": _union_days,
        "missing_input": _missing_input,
        "missing_errors": _missing_errors,
        "source_inventory": lambda s, d: parquet_log.file_inventory(s, d, "lineitem.parquet"),
        "source_rows": lambda s, d: parquet_log.file_inventory(s, d, "lineitem.parquet").select(
            "file_name", "n_rows"
        ),
        "csv_round_trip": _csv_round_trip,
        "csv_with_mark": _csv_with_mark,
        "csv_load_report": _csv_load_report,
        "json_round_trip": _json_round_trip,
        "schema_profile": lambda s, d: P.schema_profile(table(s, d, "lineitem")),
        "table_profile": lambda s, d: P.table_profile(_log(s, d)),
        "preview": lambda s, d: P.preview(_log(s, d), 5, _log(s, d).columns),
        # cleaning and derived columns
        "derive_month": lambda s, d: with_month(_log(s, d, "user_id", "datetime")).select(
            "user_id", "date", "month"
        ),
        "drop_null_keyword": lambda s, d: N.drop_null_keywords(_log(s, d, dirty=True)),
        "drop_blank_keyword": lambda s, d: N.drop_blank_keywords(_log(s, d, dirty=True)),
        "strip_keyword": lambda s, d: _log(s, d, "user_id", "keyword", dirty=True).select(
            "user_id", text.strip(F.col("keyword")).alias("keyword")
        ),
        "normalize_keyword": lambda s, d: N.normalize_keywords(
            _log(s, d, "user_id", "keyword", dirty=True)
        ),
        "normalize_text": lambda s, d: table(s, d, "documents").select(
            "doc_id", text.normalize(F.col("text")).alias("keyword")
        ),
        "fold_keyword": lambda s, d: N.fold_keywords(_spelled(s, d)),
        "fold_accents": lambda s, d: N.fold_keywords(_text_words(s, d)),
        "fold_user_counts": lambda s, d: N.fold_counts(_loud_counts(s, d), ["user_id"]),
        "merge_aliases": lambda s, d: N.merge_aliases(
            N.keyword_counts(_log(s, d, "keyword")), _aliases(s, d)
        ),
        "typo_corrections": lambda s, d: typos.corrections(_mistyped(s, d), 5),
        "typo_merged_counts": lambda s, d: typos.merge_typos(_mistyped(s, d), 5),
        "split_run_together": lambda s, d: segments.split_keywords(_run_together(s, d)),
        "merge_run_together": lambda s, d: segments.merge_run_together(_run_together(s, d)),
        "restore_accents": lambda s, d: accents.restore_accents(_phrases(s, d)),
        # counts
        "user_keyword_count": _user_keyword,
        "user_month_keyword_count": lambda s, d: N.user_month_keyword_counts(
            _log(s, d, "user_id", "datetime", "keyword")
        ),
        "user_keyword_count_by_month": lambda s, d: N.user_keyword_counts_by_month(
            _log(s, d, "user_id", "datetime", "keyword")
        ),
        "daily_counts": _daily,
        "keyword_frequency": lambda s, d: N.keyword_counts(_log(s, d, "keyword")),
        "distinct_category": lambda s, d: N.distinct_values(_log(s, d, "category"), "category"),
        # ranks and top-n
        "rank_user_keyword": lambda s, d: T.rank_keywords(_user_keyword(s, d), ["user_id"]),
        "rank_user_month_keyword": lambda s, d: T.rank_keywords(
            N.user_month_keyword_counts(_log(s, d, "user_id", "datetime", "keyword")),
            ["user_id", "month"],
        ),
        "top1_per_user": lambda s, d: T.in_report_order(_top1(s, d)),
        "top3_per_user": lambda s, d: T.in_report_order(
            T.top_n_keywords(_log(s, d, "user_id", "keyword"), 3)
        ),
        "top3_per_user_clean": lambda s, d: T.top_n_keywords(
            _log(s, d, "user_id", "keyword", dirty=True), 3, clean=True
        ),
        "top1_from_top3": lambda s, d: T.first_of_top(
            T.top_n_keywords(_log(s, d, "user_id", "keyword"), 3)
        ),
        "top3_per_user_month": lambda s, d: T.top_n_keywords(
            with_month(_log(s, d, "user_id", "datetime", "keyword")), 3, ["user_id", "month"]
        ),
        "top3_events_per_user": lambda s, d: T.top_n_keywords(
            table(s, d, "events").select("user_id", F.col("event_type").alias("keyword")), 3
        ),
        "top_keyword_by_month": _wide,
        "top_keyword_by_month_1997": lambda s, d: T.monthly_favourites(
            _log(s, d, "user_id", "datetime", "keyword"), year=1997
        ),
        "pivot_month_top": lambda s, d: T.pivot_ranked(
            T.top_n_keywords(
                with_month(_log(s, d, "user_id", "datetime", "keyword")), 1, ["user_id", "month"]
            )
        ),
        "top10_raw_keywords": lambda s, d: N.top_keywords(
            N.keyword_counts(_log(s, d, "keyword")), 10
        ),
        "top30_keywords": lambda s, d: N.top_keywords(_clean_counts(s, d), 30),
        "top20_overall": lambda s, d: N.top_keywords(T.total_of_favourites(_top1(s, d)), 20),
        "top30_user_rows": lambda s, d: T.top_user_rows(_top1(s, d)),
        # month against month
        "month_top_users": lambda s, d: M.users_per_favourite(_wide(s, d)),
        "month_compare": lambda s, d: M.compare_months(_wide(s, d)),
        "month_compare_top20": lambda s, d: M.top_compared(M.compare_months(_wide(s, d))),
        "month_growth": lambda s, d: M.with_growth(M.compare_months(_wide(s, d))),
        "month_growth_top10": lambda s, d: M.top_growth(
            M.with_growth(M.compare_months(_wide(s, d)))
        ),
        "month_trend": lambda s, d: _trend(s, d),
        "month_trend_top10": lambda s, d: M.top_trends(_trend(s, d)),
        "user_month_change": lambda s, d: M.with_change(_wide(s, d)),
        "top_keyword_retention": lambda s, d: _rounded(M.retention(_wide(s, d))),
        # classification
        "classify_input": lambda s, d: C.distinct_keywords(T.top_user_rows(_top1(s, d))),
        "classify_batches": lambda s, d: _batches(s, d).select("batch", "payload"),
        "classify_prompts": lambda s, d: C.with_prompts(_batches(s, d)).select("batch", "prompt"),
        "extract_json": _parsed_parts,
        "classify_lookup": lambda s, d: C.look_up(_answered(s, d)),
        "classify_missing": lambda s, d: C.not_answered(_clean_counts(s, d), _answered(s, d)),
        "classify_merge": _merged,
        "classify_function": lambda s, d: C.classify(
            C.with_positions(_clean_counts(s, d)), _local_classifier()
        ),
        "classify_retries": _retries,
        "classification_csv": _classification_csv,
        "classify_rules": lambda s, d: _ruled(s, d).select("keyword", "search_count", "category"),
        "classify_phrases": lambda s, d: phrases.with_phrases(_sentences(s, d), _names(s, d)),
        "classify_inside": lambda s, d: C.classify_by_rules(
            _sentences(s, d), WORD_RULES[1:2], _names(s, d), inside=True
        ),
        "classify_nearest": _nearest,
        "classify_default_rules": lambda s, d: C.classify_by_rules(
            _titles(s, d), known=KNOWN_KEYWORDS
        ),
        "classify_top30": lambda s, d: C.classify(
            T.top_user_rows(_top1(s, d)), _local_classifier(), attempts=1
        ),
        "category_distribution": lambda s, d: _rounded(C.category_distribution(_ruled(s, d))),
    }


def _trend(spark, d):
    return M.with_trend(M.compare_months(_wide(spark, d))).withColumn("trend", F.round("trend", 6))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("pct", F.round("pct", 6))


# --- the same in SQL ----------------------------------------------------------

_JOINS = """
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
"""
_COLUMNS = "o_custkey AS user_id, o_orderdate AS datetime, p_type AS category"
_PLAIN = f"""log AS (
    SELECT {_COLUMNS}, CASE WHEN l_linenumber = 7 THEN NULL ELSE p_name END AS keyword {_JOINS}
)"""
_DIRTY = f"""log AS (
    SELECT {_COLUMNS},
      CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN '  '
        WHEN 5 THEN '  ' || upper(p_name) || '!! ' ELSE p_name END AS keyword {_JOINS}
)"""
_RANKED = """ranked AS (
    SELECT user_id, keyword, search_count,
      row_number() OVER (PARTITION BY user_id
        ORDER BY search_count DESC, keyword ASC NULLS LAST) AS place
    FROM (SELECT user_id, keyword, count(*) AS search_count FROM log GROUP BY ALL)
)"""
_MONTHLY = """monthly AS (
    SELECT user_id, month, keyword, search_count,
      row_number() OVER (PARTITION BY user_id, month
        ORDER BY search_count DESC, keyword ASC NULLS LAST) AS place
    FROM (SELECT user_id, CAST(month(datetime) AS INTEGER) AS month, keyword,
            count(*) AS search_count FROM log GROUP BY ALL)
)"""
_WIDE = f"""{_MONTHLY}, wide AS (
    SELECT user_id, max(CASE WHEN month = 6 THEN keyword END) AS most_search_t6,
      max(CASE WHEN month = 7 THEN keyword END) AS most_search_t7
    FROM monthly WHERE place = 1 GROUP BY user_id
)"""
_COMPARED = f"""{_WIDE}, compared AS (
    SELECT keyword, coalesce(n6, 0) AS count_t6, coalesce(n7, 0) AS count_t7
    FROM (SELECT most_search_t6 AS keyword, count(*) AS n6 FROM wide
          WHERE most_search_t6 IS NOT NULL GROUP BY 1) a
    FULL OUTER JOIN (SELECT most_search_t7 AS keyword, count(*) AS n7 FROM wide
          WHERE most_search_t7 IS NOT NULL GROUP BY 1) b USING (keyword)
)"""
_GROWN = f"""{_COMPARED}, grown AS (
    SELECT keyword, count_t6, count_t7,
      (CAST(count_t7 AS DOUBLE) - CAST(count_t6 AS DOUBLE))
        / nullif(CAST(count_t6 AS DOUBLE), 0) * 100 AS change_pct,
      count_t6 = 0 AS is_new
    FROM compared
)"""
_TOP30 = """firsts AS (
    SELECT user_id, keyword, search_count, CAST(row_number() OVER (
      ORDER BY search_count DESC, user_id ASC NULLS LAST, keyword) AS INTEGER) AS pos
    FROM ranked WHERE place = 1 AND trim(keyword) <> ''
    ORDER BY pos LIMIT 30
)"""
_PLACED = f"""{_DIRTY}, counted AS (
    SELECT keyword, count(*) AS search_count FROM log WHERE trim(keyword) <> '' GROUP BY 1
), placed AS (
    SELECT keyword, search_count,
      row_number() OVER (ORDER BY search_count DESC, keyword) AS pos FROM counted
), batched AS (
    SELECT CAST((pos - 1) // 10 AS BIGINT) AS batch, pos, keyword,
      CASE WHEN lower(keyword) LIKE '%hot %' THEN 'Other'
        WHEN keyword LIKE '%widget%' THEN 'Drama' ELSE 'News' END AS category
    FROM placed
), payloads AS (
    SELECT batch, CAST(to_json(list(keyword ORDER BY pos)) AS VARCHAR) AS payload
    FROM batched GROUP BY batch
)"""
_RULED = f"""{_PLAIN}, ruled AS (
    SELECT keyword, count(*) AS search_count,
      CASE WHEN keyword LIKE '%widget%' OR keyword LIKE '%gizmo%' THEN 'Animation'
        WHEN keyword LIKE '% ring' THEN 'Romance'
        WHEN keyword LIKE '%gear%' OR keyword LIKE '%bolt%' THEN 'Sports'
        ELSE coalesce(min(kind), 'Other') END AS category
    FROM log LEFT JOIN (SELECT lower(p_name) AS name, min('of ' || p_type) AS kind
      FROM part GROUP BY 1) ON lower(keyword) = name
    WHERE keyword IS NOT NULL GROUP BY keyword
)"""


_TREND = f"""{_COMPARED}, totals AS (
    SELECT CAST(sum(count_t6) AS DOUBLE) AS n6, CAST(sum(count_t7) AS DOUBLE) AS n7 FROM compared
), cells AS (
    SELECT *, unnest([count_t6, count_t7, n6 - count_t6, n7 - count_t7]) AS seen,
      unnest([n6 * (count_t6 + count_t7), n7 * (count_t6 + count_t7),
        n6 * (n6 + n7 - count_t6 - count_t7), n7 * (n6 + n7 - count_t6 - count_t7)]) / (n6 + n7) AS wanted
    FROM compared, totals
), trends AS (
    SELECT keyword, count_t6, count_t7, round(CASE WHEN count_t7 * n6 < count_t6 * n7 THEN -1 ELSE 1 END
      * 2 * greatest(sum(CASE WHEN seen > 0 THEN seen * ln(seen / wanted) ELSE 0 END), 0), 6) AS trend
    FROM cells GROUP BY keyword, count_t6, count_t7, n6, n7
)"""
_PHRASES = f"""{_PLAIN}, sentences AS (
    SELECT 'Buy ' || upper(keyword) || ', ' || lower(category) AS keyword, count(*) AS search_count
    FROM log GROUP BY 1
), names AS (
    SELECT lower(p_name) AS phrase, min('of ' || p_type) AS category FROM part
    WHERE p_type <> 'PROMO' AND p_name NOT LIKE 'hot %' GROUP BY 1
    UNION ALL SELECT DISTINCT split_part(p_name, ' ', 2), 'any ' || split_part(p_name, ' ', 2) FROM part
), found AS (
    SELECT keyword, phrase, category, row_number() OVER (PARTITION BY keyword ORDER BY
        len(string_split(phrase, ' ')) DESC, length(phrase) DESC, category, phrase) AS place
    FROM sentences JOIN names ON contains(' ' || lower(replace(keyword, ',', '')) || ' ', ' ' || phrase || ' ')
), best AS (
    SELECT keyword, phrase, category AS phrase_category FROM found WHERE place = 1
)"""
_NEAREST = """WITH answers AS (
    SELECT DISTINCT p_name AS keyword, CASE WHEN p_name LIKE '%hot %' THEN 'Other'
      ELSE split_part(p_name, ' ', 2) END AS category FROM part
), runs AS (
    SELECT keyword, category, substr('^' || keyword || '$', i, 3) AS run
    FROM (SELECT *, unnest(range(1, length(keyword) + 1)) AS i FROM answers)
), told AS (SELECT * FROM runs WHERE category <> 'Other'
), counts AS (SELECT run, category, count(*) AS n FROM told GROUP BY ALL
), sizes AS (
    SELECT category, count(*) AS size, count(DISTINCT keyword) AS keywords FROM told GROUP BY 1
), categories AS (
    SELECT category, CAST(floor(1000000 * ln(keywords / (SELECT CAST(sum(keywords) AS DOUBLE) FROM sizes)))
        AS BIGINT) AS prior,
      CAST(floor(1000000 * ln(CAST(size + (SELECT count(DISTINCT run) FROM counts) AS DOUBLE))) AS BIGINT) AS base
    FROM sizes
), scored AS (
    SELECT r.keyword, g.category, sum(CAST(floor(1000000 * ln(CAST(n + 1 AS DOUBLE))) AS BIGINT))
      + any_value(prior) - any_value(length(r.keyword)) * any_value(base) AS score
    FROM runs r JOIN counts g USING (run) JOIN categories ON categories.category = g.category
    WHERE r.category = 'Other' GROUP BY r.keyword, g.category
), best AS (
    SELECT keyword, first(category ORDER BY score DESC, category) AS nearest FROM scored GROUP BY 1
)
SELECT keyword, CASE WHEN category = 'Other' THEN coalesce(nearest, 'Other') ELSE category END AS category
FROM answers LEFT JOIN best USING (keyword)"""


def _profile_sql() -> str:
    columns = ["user_id", "datetime", "keyword", "category"]
    rows = [
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) AS n_rows,"
        f" {len(columns)} AS n_columns, count(*) - count({c}) AS n_nulls FROM log"
        for i, c in enumerate(columns, 1)
    ]
    return f"WITH {_PLAIN} " + " UNION ALL ".join(rows)


def _schema_sql() -> str:
    kinds = {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    }
    rows = [
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type,"
        f" true AS nullable, count({c}) AS n_values FROM lineitem"
        for i, (c, kind) in enumerate(kinds.items(), 1)
    ]
    return " UNION ALL ".join(rows)


# The prompt's text, written out.
_PROMPT_HEAD = """You sort search keywords of a video service into content categories.
Keywords may be misspelt, lack Vietnamese accents or run words together; read them as the title, person, team or topic most likely meant.
Categories: Action, Romance, Comedy, Horror, Animation, Drama, C Drama, K Drama, Sports, Music, Reality Show, TV Channel, News, Other.
Hints (regular expression: category):
  vtv|htv|channel: TV Channel
  \\b(running|master key|reality|idol|show|challenge)\\b: Reality Show
  \\b(romantic|love|kiss)\\b: Romance
  \\b(potter|hogwarts|wizard|magic)\\b: Drama
  \\b(fight|gun|hero|war)\\b: Action
  \\b(breaking|live|news)\\b: News
Countries, clubs and matches are Sports; names from Chinese or Korean series are C Drama or K Drama; cartoon and anime names are Animation.
Use Other only when nothing else fits.
Keywords:
"""
_PROMPT_TAIL = """
Answer with one JSON object and nothing else: each keyword exactly as given, and its category."""


def _prompt_sql() -> str:
    head, tail = (part.replace("'", "''") for part in (_PROMPT_HEAD, _PROMPT_TAIL))
    return f"WITH {_PLACED} SELECT batch, '{head}' || payload || '{tail}' AS prompt FROM payloads"


def _titles_sql() -> str:
    title = "keyword"
    for old, new in TITLE_WORDS:
        title = f"replace({title}, '{old}', '{new}')"
    return f"""WITH {_PLAIN}, titles AS (
          SELECT {title} AS keyword, count(*) AS search_count
          FROM log WHERE keyword IS NOT NULL GROUP BY 1)
        SELECT keyword, search_count,
          CASE WHEN keyword LIKE '%vtv3' THEN 'TV Channel'
            WHEN keyword LIKE '%Master Key 2' THEN 'Reality Show'
            WHEN keyword LIKE '%LOVE' THEN 'Romance'
            WHEN keyword LIKE '%wizard' THEN 'Drama'
            WHEN keyword LIKE '%war' THEN 'Action'
            WHEN keyword LIKE '%breaking' THEN 'News'
            WHEN keyword IN ('NARUTO', 'fairy tail', 'đại chiến titan') THEN 'Animation'
            WHEN keyword = 'ARGEN' THEN 'Sports'
            WHEN keyword = 'pent' THEN 'C Drama'
            WHEN keyword = 'những người thừa kế' THEN 'K Drama'
            WHEN keyword = 'bolero' THEN 'Music'
            WHEN keyword = 'Bigfoot' THEN 'Horror'
            WHEN keyword = 'S.W.A.T.' THEN 'Action'
            ELSE 'Other' END AS category FROM titles"""


def _normalized_sql(column: str) -> str:
    parted = f"regexp_replace(lower({column}), '[\\p{{Z}}\\s\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g')"
    kept = f"regexp_replace({parted}, '[^\\p{{L}}\\p{{M}}\\p{{N}} ]', '', 'g')"
    return f"trim(regexp_replace({kept}, ' +', ' ', 'g'))"


_TYPOS = f"""counted AS (
    SELECT {_MISTYPED} AS keyword, count(*) AS search_count
    FROM (SELECT *, 2 + l_partkey % (length(p_name) - 2) AS p
      FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1
), spelled AS (SELECT * FROM counted WHERE length(keyword) >= 4
), pairs AS (
    SELECT a.*, b.keyword AS corrected, b.search_count AS corrected_count,
      levenshtein(a.keyword, b.keyword) AS distance, least(length(a.keyword), length(b.keyword)) AS short
    FROM spelled a JOIN spelled b ON b.search_count > 5 * a.search_count
), better AS (
    SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY
      corrected_count * CASE WHEN distance = 1 THEN 5 ELSE 1 END DESC, distance, corrected) AS place
    FROM pairs WHERE distance <= CASE WHEN short < 8 THEN 1 ELSE 2 END
      AND corrected_count > search_count * CASE WHEN distance = 1 THEN 5 ELSE 25 END
), corrections AS (
    SELECT keyword, search_count, corrected, corrected_count, CAST(distance AS INTEGER) AS distance
    FROM better WHERE place = 1
), followed AS (
    SELECT keyword, corrected FROM corrections
    UNION ALL SELECT f.keyword, c.corrected FROM followed f JOIN corrections c ON f.corrected = c.keyword
)"""
_SPLITS = f"""log AS (
    SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN p_type = 'PROMO' THEN replace(p_name, ' ', '')
      ELSE p_name END AS keyword FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
), counted AS (SELECT keyword, count(*) AS search_count FROM log GROUP BY 1
), tokens AS (
    SELECT keyword, search_count, unnest(string_split(keyword, ' ')) AS word,
      unnest(range(len(string_split(keyword, ' ')))) AS pos FROM counted WHERE keyword IS NOT NULL
), words AS (
    SELECT word, sum(search_count) AS n FROM tokens GROUP BY 1
), known AS (
    SELECT word AS part, CAST(floor(1000000 * ln((SELECT CAST(sum(n) AS DOUBLE) FROM words)
      / CAST(n AS DOUBLE))) AS BIGINT) AS cost FROM words WHERE n >= 2 AND length(word) >= 2
), paths AS (
    SELECT word, 0 AS pos, CAST(0 AS BIGINT) AS cost, CAST([] AS VARCHAR[]) AS parts FROM words
    UNION ALL
    SELECT word, pos + length(part), paths.cost + known.cost, list_append(parts, part)
    FROM paths JOIN known ON substr(word, pos + 1, length(part)) = part
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY cost, len(parts), parts) AS place
    FROM paths WHERE pos = length(word)
), apart AS (
    SELECT word, array_to_string(parts, ' ') AS apart FROM ranked WHERE place = 1 AND len(parts) > 1
), again AS (
    SELECT keyword, string_agg(coalesce(apart, word), ' ' ORDER BY pos) AS split
    FROM tokens LEFT JOIN apart USING (word) GROUP BY 1
), split_up AS (
    SELECT keyword, search_count, split FROM counted LEFT JOIN again USING (keyword)
)"""


def _accents_sql() -> str:
    return f"""WITH RECURSIVE texts AS (
          SELECT doc_id, string_split({_normalized_sql("text")}, ' ') AS words FROM documents
        ), runs AS (
          SELECT doc_id, unnest(list_transform(range(0, len(words), 6),
            lambda i: array_to_string(words[i + 1:i + 6], ' '))) AS keyword FROM texts
        ), counted AS (
          SELECT CASE WHEN doc_id % 2 = 1 THEN strip_accents(keyword) ELSE keyword END AS keyword,
            count(*) AS search_count FROM runs WHERE keyword <> '' GROUP BY 1
        ), placed AS (
          SELECT keyword, search_count, unnest(string_split(keyword, ' ')) AS word,
            unnest(range(len(string_split(keyword, ' ')))) AS pos FROM counted
        ), tokens AS (
          SELECT *, coalesce(lag(word) OVER (PARTITION BY keyword ORDER BY pos), '') AS before FROM placed
        ), accented AS (SELECT * FROM tokens WHERE keyword <> strip_accents(keyword)
        ), known AS (
          SELECT word, CAST(sum(search_count) AS BIGINT) AS n FROM accented GROUP BY 1
        ), single AS (
          SELECT * FROM known UNION ALL
          SELECT '', CAST(sum(search_count) AS BIGINT) FROM accented WHERE pos = 0
        ), pairs AS (
          SELECT before AS first, word AS second, CAST(sum(search_count) AS BIGINT) AS together
          FROM accented GROUP BY ALL
        ), choices AS (
          SELECT w.word, coalesce(known.word, w.word) AS choice FROM (SELECT DISTINCT word FROM tokens) w
          LEFT JOIN known ON w.word = strip_accents(known.word)
          UNION ALL SELECT '', ''
        ), both_ AS (
          SELECT before, t.word, a.choice AS first, b.choice AS second
          FROM (SELECT DISTINCT before, word FROM tokens) t
          JOIN choices a ON a.word = before JOIN choices b ON b.word = t.word
        ), likely AS (
          SELECT before, b.word, b.first, b.second, (coalesce(together, 0)
            + 2 * (CAST(coalesce(k.n, 0) AS DOUBLE) / (SELECT CAST(sum(n) AS DOUBLE) FROM known)))
            / (coalesce(f.n, 0) + 2) AS likely
          FROM both_ b LEFT JOIN pairs USING (first, second)
          LEFT JOIN single f ON f.word = b.first LEFT JOIN known k ON k.word = b.second
        ), edges AS (
          SELECT *, CAST(CASE WHEN likely > 0 THEN floor(-1000000 * ln(likely)) ELSE 0 END AS BIGINT)
            AS cost FROM likely
        ), chains AS (
          SELECT keyword, CAST(-1 AS BIGINT) AS pos, '' AS choice,
            {{'cost': CAST(0 AS BIGINT), 'words': CAST([] AS VARCHAR[])}} AS best FROM counted
          UNION ALL
          SELECT t.keyword, t.pos, e.second, min({{'cost': c.best.cost + e.cost,
            'words': list_append(c.best.words, e.second)}})
          FROM chains c JOIN tokens t ON t.keyword = c.keyword AND t.pos = c.pos + 1
          JOIN edges e ON e.word = t.word AND e.before = t.before AND e.first = c.choice GROUP BY ALL
        ), ends AS (
          SELECT keyword, min(best) AS best FROM chains c
          WHERE pos + 1 = len(string_split(keyword, ' ')) GROUP BY 1
        )
        SELECT keyword, search_count, array_to_string(best.words, ' ') AS restored
        FROM counted JOIN ends USING (keyword)"""


def oracle_sql() -> dict[str, str]:
    """The SQL for each query, but for those that SQL cannot express."""
    found = _log_sql()
    if _LLM:
        found |= _LLM.ORACLE_SQL
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found


def _log_sql() -> dict[str, str]:
    top3 = "user_id, keyword, search_count, CAST(place AS INTEGER) AS rank"
    share = "CAST(n AS DOUBLE) / sum(n) OVER () * 100"
    return {
        "scan_log": "SELECT * FROM lineitem",
        "scan_day": "SELECT * FROM events",
        "union_days": """SELECT * FROM events WHERE coalesce(ts < TIMESTAMP '2024-01-16', false)
            UNION ALL SELECT * FROM events WHERE NOT coalesce(ts < TIMESTAMP '2024-01-16', false)""",
        "missing_input": "SELECT * FROM events",
        "missing_errors": """SELECT count(*) AS n_rows, 'FileNotFoundError' AS no_parquet,
            'FileNotFoundError' AS no_csv, 'none' AS events FROM events""",
        "csv_with_mark": "SELECT p_partkey, p_name FROM part",
        "preview": f"""WITH {_PLAIN} SELECT * FROM log
            ORDER BY user_id NULLS FIRST, datetime NULLS FIRST, keyword NULLS FIRST,
              category NULLS FIRST LIMIT 5""",
        "fold_accents": """WITH words AS (
              SELECT unnest(string_split(text, ' ')) AS word, doc_id FROM documents
            ), loud AS (
              SELECT CASE WHEN doc_id % 3 = 0 THEN upper(replace(word, 'ß', 'ss')) ELSE word END AS word, doc_id
              FROM words
            ), spelled AS (
              SELECT CASE WHEN doc_id % 2 = 0 THEN replace(word, 'é', 'e' || chr(769)) ELSE word END
                AS word, count(*) AS n FROM loud GROUP BY 1
            )
            SELECT first(word ORDER BY n DESC, word) AS keyword, CAST(sum(n) AS BIGINT) AS search_count,
              count(*) AS spellings FROM spelled
            GROUP BY replace(strip_accents(nfc_normalize(lower(word))), 'ß', 'ss')""",
        "fold_user_counts": f"""WITH {_PLAIN}, counted AS (
              SELECT user_id, count(*) AS n,
                CASE WHEN category = 'PROMO' THEN upper(keyword) ELSE keyword END AS keyword
              FROM log GROUP BY ALL
            ), spelled AS (SELECT keyword, sum(n) AS n FROM counted GROUP BY keyword
            ), chosen AS (
              SELECT lower(keyword) AS folded, first(keyword ORDER BY n DESC, keyword) AS keyword
              FROM spelled WHERE keyword IS NOT NULL GROUP BY 1
            )
            SELECT user_id, chosen.keyword, CAST(sum(n) AS BIGINT) AS search_count
            FROM counted LEFT JOIN chosen ON lower(counted.keyword) = folded GROUP BY ALL""",
        "classify_retries": f"""WITH {_PLACED}, firsts AS (
              SELECT batch, first(keyword ORDER BY pos) AS keyword,
                count(DISTINCT keyword) AS n FROM batched GROUP BY batch
            )
            SELECT batch,
              CASE WHEN keyword LIKE '%gizmo%' THEN 'failed' WHEN keyword LIKE '%bolt%'
                THEN 'invalid' ELSE 'ok' END AS status,
              CAST(CASE WHEN keyword LIKE '%gizmo%' OR keyword LIKE '%bolt%' THEN 2 ELSE 1 END
                AS INTEGER) AS attempts,
              CASE WHEN keyword LIKE '%gizmo%' THEN 'OSError(''no answer'')' END AS error,
              CAST(CASE WHEN keyword LIKE '%gizmo%' OR keyword LIKE '%bolt%' THEN NULL ELSE n END
                AS INTEGER) AS n_answers
            FROM firsts""",
        "classification_csv": f"""WITH {_PLACED}, names AS (
              SELECT lower(p_name) AS name, min('of ' || p_type) AS category FROM part GROUP BY 1)
            SELECT keyword, coalesce(names.category, 'Other') AS category
            FROM placed LEFT JOIN names ON lower(keyword) = name""",
        "source_rows": """SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows
            FROM lineitem""",
        "csv_round_trip": f"""WITH {_PLAIN}, {_RANKED}
            SELECT {top3} FROM ranked WHERE place <= 3""",
        "csv_load_report": f"""WITH {_DIRTY}
            SELECT count(*) AS parsed, CAST(0 AS BIGINT) AS skipped
            FROM (SELECT DISTINCT user_id, keyword FROM log)""",
        "json_round_trip": f"WITH {_PLACED} SELECT batch, pos, keyword, category FROM batched",
        "schema_profile": _schema_sql(),
        "table_profile": _profile_sql(),
        "derive_month": f"""WITH {_PLAIN} SELECT user_id, CAST(datetime AS DATE) AS date,
            CAST(month(datetime) AS INTEGER) AS month FROM log""",
        "drop_null_keyword": f"WITH {_DIRTY} SELECT * FROM log WHERE keyword IS NOT NULL",
        "drop_blank_keyword": f"WITH {_DIRTY} SELECT * FROM log WHERE trim(keyword) <> ''",
        "strip_keyword": f"WITH {_DIRTY} SELECT user_id, trim(keyword) AS keyword FROM log",
        "normalize_keyword": f"""WITH {_DIRTY}, plain AS (
            SELECT user_id, {_normalized_sql("keyword")} AS keyword FROM log)
            SELECT * FROM plain WHERE keyword <> ''""",
        "normalize_text": f"SELECT doc_id, {_normalized_sql('text')} AS keyword FROM documents",
        "fold_keyword": f"""WITH {_PLAIN}, spelled AS (
              SELECT CASE WHEN category = 'PROMO' THEN upper(keyword) ELSE keyword END AS keyword,
                count(*) AS n FROM log GROUP BY 1)
            SELECT CASE WHEN count(keyword) > 0 THEN
                first(keyword ORDER BY n DESC, keyword) END AS keyword,
              CAST(sum(n) AS BIGINT) AS search_count, count(*) AS spellings
            FROM spelled GROUP BY strip_accents(lower(keyword))""",
        "typo_corrections": f"WITH RECURSIVE {_TYPOS} SELECT * FROM corrections",
        "typo_merged_counts": f"""WITH RECURSIVE {_TYPOS}, ends AS (
              SELECT keyword, corrected FROM followed
              WHERE corrected NOT IN (SELECT keyword FROM corrections))
            SELECT coalesce(corrected, keyword) AS keyword, CAST(sum(search_count) AS BIGINT) AS search_count
            FROM counted LEFT JOIN ends USING (keyword) GROUP BY 1""",
        "split_run_together": f"WITH RECURSIVE {_SPLITS} SELECT * FROM split_up",
        "merge_run_together": f"""WITH RECURSIVE {_SPLITS}
            SELECT split AS keyword, CAST(sum(search_count) AS BIGINT) AS search_count,
              count(*) AS spellings FROM split_up GROUP BY 1""",
        "restore_accents": _accents_sql(),
        "merge_aliases": f"""WITH {_PLAIN}
            SELECT string_split(keyword, ' ')[-1] AS keyword, count(*) AS search_count
            FROM log GROUP BY 1""",
        "user_keyword_count": f"""WITH {_PLAIN}
            SELECT user_id, keyword, count(*) AS search_count FROM log GROUP BY ALL""",
        "user_month_keyword_count": f"""WITH {_PLAIN}, {_MONTHLY}
            SELECT user_id, month, keyword, search_count FROM monthly""",
        "user_keyword_count_by_month": f"""WITH {_PLAIN}
            SELECT user_id, keyword, count(*) AS search_count,
              count(*) FILTER (WHERE month(datetime) = 6) AS count_t6,
              count(*) FILTER (WHERE month(datetime) = 7) AS count_t7
            FROM log GROUP BY user_id, keyword""",
        "daily_counts": f"""WITH {_PLAIN}
            SELECT user_id, keyword, count(*) AS search_count,
              count(*) FILTER (WHERE month(datetime) = 6) AS count_t6,
              count(*) FILTER (WHERE month(datetime) = 7) AS count_t7
            FROM log GROUP BY user_id, keyword""",
        "keyword_frequency": f"""WITH {_PLAIN}
            SELECT keyword, count(*) AS search_count FROM log GROUP BY ALL""",
        "distinct_category": f"WITH {_PLAIN} SELECT DISTINCT category FROM log",
        "rank_user_keyword": f"""WITH {_PLAIN}, {_RANKED}
            SELECT user_id, keyword, search_count, place AS rank FROM ranked""",
        "rank_user_month_keyword": f"""WITH {_PLAIN}, {_MONTHLY}
            SELECT user_id, month, keyword, search_count, place AS rank FROM monthly""",
        "top1_per_user": f"""WITH {_PLAIN}, {_RANKED}
            SELECT user_id, keyword, search_count FROM ranked WHERE place = 1
            ORDER BY search_count DESC, user_id""",
        "top3_per_user": f"""WITH {_PLAIN}, {_RANKED}
            SELECT {top3} FROM ranked WHERE place <= 3 ORDER BY search_count DESC, user_id, place""",
        "top3_per_user_clean": f"""WITH all_{_DIRTY}, log AS (
              SELECT * FROM all_log WHERE trim(keyword) <> ''), {_RANKED}
            SELECT {top3} FROM ranked WHERE place <= 3""",
        "top1_from_top3": f"WITH {_PLAIN}, {_RANKED} SELECT {top3} FROM ranked WHERE place = 1",
        "top3_per_user_month": f"""WITH {_PLAIN}, {_MONTHLY}
            SELECT user_id, month, keyword, search_count, CAST(place AS INTEGER) AS rank
            FROM monthly WHERE place <= 3""",
        "top3_events_per_user": f"""WITH log AS (
              SELECT user_id, event_type AS keyword FROM events), {_RANKED}
            SELECT {top3} FROM ranked WHERE place <= 3""",
        "top_keyword_by_month": f"WITH {_PLAIN}, {_WIDE} SELECT * FROM wide",
        "top_keyword_by_month_1997": f"""WITH all_{_PLAIN}, log AS (
              SELECT * FROM all_log WHERE year(datetime) = 1997), {_WIDE}
            SELECT * FROM wide""",
        "pivot_month_top": f"WITH {_PLAIN}, {_WIDE} SELECT * FROM wide",
        "top10_raw_keywords": f"""WITH {_PLAIN}
            SELECT keyword, count(*) AS search_count FROM log GROUP BY keyword
            ORDER BY search_count DESC, keyword ASC NULLS LAST LIMIT 10""",
        "top30_keywords": f"""WITH {_PLACED}
            SELECT keyword, search_count FROM placed ORDER BY pos LIMIT 30""",
        "top20_overall": f"""WITH {_PLAIN}, {_RANKED}
            SELECT keyword, CAST(sum(search_count) AS BIGINT) AS search_count
            FROM ranked WHERE place = 1 AND keyword IS NOT NULL GROUP BY keyword
            ORDER BY search_count DESC, keyword LIMIT 20""",
        "top30_user_rows": f"WITH {_PLAIN}, {_RANKED}, {_TOP30} SELECT * FROM firsts",
        "month_top_users": f"""WITH {_PLAIN}, {_MONTHLY}
            SELECT month, keyword, count(*) AS users FROM monthly
            WHERE place = 1 AND month IN (6, 7) AND keyword IS NOT NULL GROUP BY ALL""",
        "month_compare": f"WITH {_PLAIN}, {_COMPARED} SELECT * FROM compared",
        "month_compare_top20": f"""WITH {_PLAIN}, {_COMPARED} SELECT * FROM compared
            ORDER BY count_t6 DESC, count_t7 DESC, keyword LIMIT 20""",
        "month_growth": f"WITH {_PLAIN}, {_GROWN} SELECT * FROM grown",
        "month_growth_top10": f"""WITH {_PLAIN}, {_GROWN} SELECT * FROM grown
            ORDER BY change_pct DESC NULLS LAST, keyword LIMIT 10""",
        "month_trend": f"WITH {_PLAIN}, {_TREND} SELECT * FROM trends",
        "month_trend_top10": f"""WITH {_PLAIN}, {_TREND} SELECT * FROM trends
            ORDER BY trend DESC NULLS LAST, keyword LIMIT 10""",
        "user_month_change": f"""WITH {_PLAIN}, {_WIDE}
            SELECT *, most_search_t6 = most_search_t7 AS is_same FROM wide
            WHERE most_search_t6 IS NOT NULL AND most_search_t7 IS NOT NULL""",
        "top_keyword_retention": f"""WITH {_PLAIN}, {_WIDE}
            SELECT is_same, n, round({share}, 6) AS pct FROM (
              SELECT most_search_t6 = most_search_t7 AS is_same, count(*) AS n FROM wide
              WHERE most_search_t6 IS NOT NULL AND most_search_t7 IS NOT NULL GROUP BY 1)""",
        "classify_input": f"""WITH {_PLAIN}, {_RANKED}, {_TOP30}
            SELECT keyword, min(pos) AS pos FROM firsts GROUP BY keyword""",
        "classify_batches": f"WITH {_PLACED} SELECT batch, payload FROM payloads",
        "classify_prompts": _prompt_sql(),
        "extract_json": """WITH replies AS (
              SELECT p_partkey, p_name, CASE p_type
                WHEN 'ECONOMY' THEN 'Here: {"' || p_name || '": "Drama"} bye'
                WHEN 'LARGE' THEN '{"' || p_name || '": "Action",' || chr(10) || ' "x": "News"}'
                WHEN 'MEDIUM' THEN 'no object for ' || p_name
                WHEN 'PROMO' THEN '[{"' || p_name || '": "Music"}]'
                WHEN 'SMALL' THEN '{}'
                ELSE '{"' || p_name || '": "Drama"} or {"x": "News"}' END AS reply
              FROM part
            ), cut AS (
              SELECT *, nullif(regexp_extract(reply, '(?s)\\{.*\\}', 0), '') AS object_text FROM replies
            ), parsed AS (
              SELECT *, CASE WHEN json_valid(object_text) AND len(json_keys(object_text)) > 0
                THEN object_text END AS object FROM cut
            )
            SELECT p_partkey, substr(reply, 1, 500) AS preview, object_text,
              CAST(coalesce(len(json_keys(object)), 0) AS INTEGER) AS n_keys,
              object IS NOT NULL AS is_valid,
              coalesce(json_extract_string(object, '$."' || p_name || '"'), 'Other') AS category
            FROM parsed""",
        "classify_lookup": f"WITH {_PLACED} SELECT batch, pos, keyword, category FROM batched",
        "classify_missing": f"""WITH {_PLACED}
            SELECT keyword FROM placed WHERE lower(keyword) LIKE '%hot %'""",
        "classify_merge": f"""WITH {_PLACED}
            SELECT keyword, CASE WHEN keyword LIKE '%ring%' THEN 'Music' ELSE category END
              AS category, pos FROM batched""",
        "classify_function": f"WITH {_PLACED} SELECT keyword, category, pos FROM batched",
        "classify_rules": f"WITH {_RULED} SELECT keyword, search_count, category FROM ruled",
        "classify_phrases": f"""WITH {_PHRASES}
            SELECT keyword, search_count, phrase, phrase_category FROM sentences LEFT JOIN best USING (keyword)""",
        "classify_inside": f"""WITH {_PHRASES}
            SELECT keyword, search_count, CASE WHEN keyword LIKE '% RING,%' THEN 'Romance'
              ELSE coalesce(phrase_category, 'Other') END AS category
            FROM sentences LEFT JOIN best USING (keyword)""",
        "classify_nearest": _NEAREST,
        "classify_default_rules": _titles_sql(),
        "classify_top30": f"""WITH {_PLAIN}, {_RANKED}, {_TOP30}
            SELECT keyword, CASE WHEN keyword LIKE 'hot %' THEN 'Other'
                WHEN keyword LIKE '%widget%' THEN 'Drama' ELSE 'News' END AS category,
              CAST(min(pos) AS BIGINT) AS pos
            FROM firsts GROUP BY keyword""",
        "category_distribution": f"""WITH {_RULED}
            SELECT category, n AS count, round({share}, 6) AS pct
            FROM (SELECT category, count(*) AS n FROM ruled GROUP BY category)""",
    }
