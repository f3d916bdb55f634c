"""Temporal URL lists: what was listed when a page was fetched.

A list is a log of dated entries, each adding or removing a pattern. Entries
become validity intervals, and every capture is joined as of its fetch time to
the intervals of the patterns that its URL falls under: its host, each parent
domain, and each prefix of its path that ends at a slash or the end.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.common import hex_number, plus, whole


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals out of entries (list, pattern, action, added, at).

    ``added`` says whether the entry adds or removes the pattern, ``action`` is
    ``block`` or ``allow``. An entry holds from its time until the next one of the
    same list and pattern; of entries of one time a removal wins, then ``block``.
    Entries lacking list, pattern, action, ``added`` or time are skipped, repeated
    ones count once, and patterns compare in lower case.
    """
    keyed = entries.select(
        "list",
        F.lower(F.trim("pattern")).alias("pattern"),
        "action",
        "added",
        F.col("at").cast("timestamp").alias("at"),
    ).dropna()
    one = F.min(F.struct("added", F.when(F.col("action") == "block", 0).otherwise(1).alias("weak"), "action"))
    per_time = keyed.groupBy("list", "pattern", "at").agg(one.alias("entry"))
    later = F.lead("at").over(Window.partitionBy("list", "pattern").orderBy("at"))
    valid = [F.col("at").alias("valid_from"), later.alias("valid_to")]
    return (
        per_time.select("list", "pattern", "entry.*", *valid)
        .where("added")
        .select("list", "pattern", "action", "valid_from", "valid_to")
    )


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and final dot; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    """Path in lower case without query and fragment; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1))


def patterns_of(url: Column) -> Column:
    """The patterns a URL falls under: host, parent domains, host with path prefixes."""
    host, labels = host_of(url), F.split(host_of(url), r"\.")
    ends = F.sequence(F.lit(1), F.size(labels))
    domains = F.transform(ends, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(parts)), lambda n: n > 0),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
    )
    found = F.array_distinct(F.concat(domains, F.array(host), prefixes))
    return F.when(host.isNotNull(), found)


def filter_captures(
    captures: DataFrame, valid: DataFrame, url: str = "url", fetched_at: str = "fetched_at"
) -> DataFrame:
    """All captures with ``blocked``, ``pattern``, ``list`` and ``n_active``.

    The longest active pattern decides, ``block`` over ``allow`` among equals;
    nothing active, no host or no fetch time leaves a capture unblocked. Repeated
    captures are judged one by one. Only (row number, pattern, time) is shuffled;
    a pattern that most captures fall under is a heavy join key, whose partition
    Spark splits. Input columns named like the new ones are replaced.
    """
    rows = whole(captures).select(
        "row",
        F.col("row")[url].alias("url"),
        F.col("row")[fetched_at].cast("timestamp").alias("fetched"),
    )
    # Captures of one URL at one time share their answer.
    sights = rows.select("url", "fetched").where("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    keys = sights.select("url", "fetched", F.explode(patterns_of(F.col("url"))).alias("pattern"))
    active = keys.join(valid, "pattern").where(
        (F.col("fetched") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    best = F.max(
        F.struct(
            F.length("pattern").alias("length"),
            (F.col("action") == "block").alias("blocked"),
            F.col("pattern"),
            F.col("list"),
        )
    )
    judged = active.groupBy("url", "fetched").agg(best.alias("best"), F.count("*").alias("n_active"))
    answered = rows.join(judged, ["url", "fetched"], "left").select(
        "row",
        F.coalesce("best.blocked", F.lit(False)).alias("blocked"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.list").alias("list"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
    )
    return answered.select(*plus(answered, "blocked", "pattern", "list", "n_active"))


# --- a dated list and fetch times derived from the crawl -----------------------

START = "2024-01-01 00:00:00"


def _time(digest: Column, start: int, days: int = 365) -> Column:
    """A time within ``days`` of the start, to the hour, out of a digest."""
    hours = hex_number(digest, start, 6) % (24 * days)
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))


def crawl_captures(pages: DataFrame) -> DataFrame:
    """Captures (page_id, url, fetched_at): the fetch time follows from id and URL."""
    digest = F.md5(F.concat_ws("/", "page_id", "url").cast("binary"))
    return pages.select("page_id", "url", _time(digest, 1).alias("fetched_at"))


def crawl_entries(pages: DataFrame) -> DataFrame:
    """Dated entries over all hosts, their domains and first path parts.

    Each pattern is added twice and removed in between at times of its digest;
    a quarter of the entries allow.
    """
    host = host_of(F.col("url"))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, -2, 2), ".")
    part = F.split_part(path_of(F.col("url")), F.lit("/"), F.lit(2))
    first = F.concat(host, F.lit("/"), F.nullif(part, F.lit("")))
    parent = F.when(F.size(labels) > 2, domain)
    patterns = pages.select(F.explode(F.array(host, parent, first)).alias("pattern")).where(
        "pattern IS NOT NULL"
    )
    digest = F.md5(F.col("pattern").cast("binary"))
    listed = patterns.distinct().withColumn("digest", digest)
    action = F.when(F.substring("digest", 31, 1) < "4", "allow").otherwise("block")
    cells = [
        F.struct(F.lit(added).alias("added"), _time(F.col("digest"), 1 + 6 * i).alias("at"))
        for i, added in enumerate([True, False, True])
    ]
    return listed.select(
        F.concat(F.lit("list-"), F.substring("digest", 32, 1)).alias("list"),
        "pattern",
        action.alias("action"),
        F.inline(F.array(*cells)),
    )


def filtered_crawl(pages: DataFrame) -> DataFrame:
    return filter_captures(crawl_captures(pages), intervals(crawl_entries(pages)))
