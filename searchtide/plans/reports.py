"""Jobs that read a log once, store its counts, and derive every report from them.

Each stage is written as Parquet below the output folder and read back, so a
lost executor costs a stage and no report counts the log again. What people
read goes beside it as CSV, under ``csv``.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.functions.dates import of_year, with_month
from searchtide.functions.rules import KNOWN_KEYWORDS
from searchtide.operators import classify as C
from searchtide.operators import counts as N
from searchtide.operators import profile as P
from searchtide.operators import topn as T
from searchtide.operators import trend as M
from searchtide.operators.nearest import fill_nearest
from searchtide.schema import LOG, MONTHS, REPLIES
from searchtide.sources import parquet_log, tables


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepared(
    log: DataFrame, clean: bool = False, normalize: bool = False, year: int | None = None
) -> DataFrame:
    """The log of one year, or all, with clean or normalised keywords as asked."""
    rows = log if year is None else of_year(log, year)
    if normalize:
        return N.normalize_keywords(rows)
    return N.drop_blank_keywords(rows) if clean else rows


def store_counts(
    log: DataFrame, out: str, months: Sequence[int] = MONTHS, fold: bool = False, **options
) -> DataFrame:
    """Searches per user and keyword, in all and by month; the stage that reads the log.

    ``fold`` counts the spellings of a keyword as one, ``options`` are those of
    ``prepared``.
    """
    counts = _stored(N.user_keyword_counts_by_month(prepared(log, **options), months), f"{out}/counts")
    return _stored(N.fold_counts(counts, ["user_id"]), f"{out}/folded") if fold else counts


def top_keywords(counts: DataFrame, out: str, n: int = 3) -> tuple[DataFrame, DataFrame]:
    """Top n and top 1 keywords per user, over all months."""
    ranked = T.first_ranked(counts.select("user_id", "keyword", "search_count"), ["user_id"], n)
    top = _stored(ranked, f"{out}/top{n}_keywords")
    first = T.first_of_top(top)
    tables.write_csv(T.in_report_order(top), f"{out}/csv/top{n}_keywords")
    tables.write_csv(T.in_report_order(first), f"{out}/csv/top1_keywords")
    return top, first


def top_keyword_by_month(
    counts: DataFrame, out: str, months: Sequence[int] = MONTHS
) -> DataFrame:
    """Favourite keyword per user, the months side by side."""
    wide = _stored(T.favourites(counts, months), f"{out}/top_keyword_by_month")
    tables.write_csv(wide, f"{out}/csv/top_keyword_by_month")
    return wide


def top_per_month(log: DataFrame, out: str, n: int = 3, **options) -> DataFrame:
    """Top n keywords per user and month, in long form, for every month of the log."""
    top = T.top_n_keywords(with_month(prepared(log, **options)), n, ["user_id", "month"])
    return _stored(top, f"{out}/top{n}_keywords_by_month")


def figures(
    top1: DataFrame, wide: DataFrame, out: str, months: Sequence[int] = MONTHS
) -> dict[str, DataFrame]:
    """The table behind each chart of the search report, one short CSV each."""
    compared = _stored(M.compare_months(wide, months), f"{out}/month_compare")
    short = {
        "top20_overall": N.top_keywords(T.total_of_favourites(top1), 20),
        "month_compare_top20": M.top_compared(compared, 20, months),
        "top_keyword_retention": M.retention(wide, months),
        "month_growth_top10": M.top_growth(M.with_growth(compared, months), 10),
    }
    for name, df in short.items():
        tables.write_csv(df, f"{out}/csv/{name}", single_file=True)
    return short


def profiles(stored: dict[str, DataFrame], out: str) -> DataFrame:
    """Rows, columns and missing values of the stored tables."""
    parts = [
        P.table_profile(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in stored.items()
    ]
    profile = parquet_log.unite(*parts)
    tables.write_csv(profile, f"{out}/csv/profiles", single_file=True)
    return profile


def classification(
    keywords: DataFrame,
    out: str,
    classifier: Callable[[list[str]], str] | None = None,
    names: DataFrame | Mapping[str, str] = KNOWN_KEYWORDS,
    inside: bool = False,
    nearest: bool = False,
    **options,
) -> DataFrame:
    """A category for each of the positioned keywords, and how they spread.

    Without a classifier the written rules decide, and then ``names``, keywords
    with their categories, with ``inside`` also as words of a longer keyword. With
    ``nearest`` keywords left over go to the category they are most like. Replies are stored as JSON and kept: a later run into
    the same folder asks only for batches that have no good reply yet.
    """
    spark = keywords.sparkSession
    if classifier is None:
        found = C.classify_by_rules(C.distinct_keywords(keywords), known=names, inside=inside)
    else:
        replies = f"{out}/replies"
        batches = _stored(C.cut_batches(keywords), f"{out}/batches")
        stored = tables.or_empty(lambda: tables.read_json(spark, replies, REPLIES), spark, REPLIES)
        tables.write_json(C.ask(C.not_asked(batches, stored), classifier, **options), replies, "append")
        answered = C.with_stored_answers(batches, tables.read_json(spark, replies, REPLIES))
        found = C.merge_answers(C.look_up(answered))
    if nearest:
        # Learning reads the answers several times.
        answers = _stored(found.select("keyword", "category", "pos"), f"{out}/answers")
        found = fill_nearest(answers)
    classified = _stored(found.select("keyword", "category", "pos"), f"{out}/classified")
    ordered = classified.orderBy("pos", "keyword").select("keyword", "category")
    tables.write_csv(ordered, f"{out}/csv/keyword_classified")
    tables.write_csv(
        C.category_distribution(classified).orderBy(F.desc("count"), "category"),
        f"{out}/csv/category_distribution",
        single_file=True,
    )
    return classified


def read_input(spark: SparkSession, path: str, allow_missing: bool = False) -> DataFrame:
    """The log below a path; if allowed, an empty one where there is none."""
    if allow_missing:
        return tables.or_empty(lambda: parquet_log.read_log(spark, path), spark, LOG)
    return parquet_log.read_log(spark, path)


def search_report(
    spark: SparkSession,
    log_path: str,
    out: str,
    months: Sequence[int] = MONTHS,
    classifier: Callable[[list[str]], str] | None = None,
    names: DataFrame | Mapping[str, str] = KNOWN_KEYWORDS,
    top: int | None = None,
    allow_missing: bool = False,
    counting: dict | None = None,
    counts: DataFrame | None = None,
    **options,
) -> dict[str, DataFrame]:
    """All reports of a log. Every keyword is classified, or the first ``top`` user rows.

    ``counts`` are searches per user and keyword, in all and by month, that are there
    already, as ``daily.update`` keeps them; then the log is not read.

    ``counting`` has the options of ``store_counts``, ``options`` are those of
    ``classification`` and ``classify.ask``. Everything that is written goes below ``out``.
    """
    if counts is None:
        counts = store_counts(read_input(spark, log_path, allow_missing), out, months, **(counting or {}))
    else:
        fold = (counting or {}).get("fold", False)
        counts = _stored(N.fold_counts(counts, ["user_id"]) if fold else counts, f"{out}/counts")
    top3, top1 = top_keywords(counts, out)
    wide = top_keyword_by_month(counts, out, months)
    stored = {"top3_keywords": top3, "top1_keywords": top1, "top_keyword_by_month": wide}
    results = stored | figures(top1, wide, out, months)
    if top is None:
        keywords = C.with_positions(N.drop_blank_keywords(N.roll_up(counts, ["keyword"])))
    else:
        keywords = T.top_user_rows(top1, top)
    stored["keyword_classified"] = classification(keywords, out, classifier, names, **options)
    return results | stored | {"profiles": profiles(stored, out)}


def day_report(spark: SparkSession, root: str, day: str, out: str) -> dict[str, DataFrame]:
    """One day of a log: its files, columns, categories, and what was searched most."""
    log = parquet_log.read_day(spark, root, day)
    counts = _stored(N.user_keyword_counts(log), f"{out}/counts")
    results = {
        "files": parquet_log.file_inventory(spark, f"{root.rstrip('/')}/{day}"),
        "columns": P.schema_profile(log),
        "categories": N.distinct_values(log, "category"),
        "top_keywords": N.top_keywords(N.roll_up(counts, ["keyword"]), 10),
    }
    for name, df in results.items():
        # Files and categories are as many as the day has.
        bounded = name in ("columns", "top_keywords")
        tables.write_csv(df, f"{out}/csv/{name}", single_file=bounded)
    results["top1_keywords"] = T.in_report_order(T.best_keyword(counts, ["user_id"]))
    tables.write_csv(results["top1_keywords"], f"{out}/csv/top1_keywords")
    return results
