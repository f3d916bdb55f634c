"""Records of CSV files whose quoted fields hold line breaks, read by many tasks.

A file is read line by line in splits. What a line does to a reader depends on whether
it starts inside a quoted field, so a line is a function of two states: it keeps the
state, turns it, or sets it whatever it was. Such functions put together make the
function of a split, and those of the splits before tell in which state a split
starts. Then every split knows where its first record begins, and lines of one record
are put together. A split that starts outside and in which no line leaves a field open
has one record to a line, so its lines are neither shuffled nor sorted.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A quoted field's inside, and whole fields up to their comma. A quote is one only at
# the start of a field; two in a row are one that belongs to the text.
_INSIDE = r'(?:[^"]++|"")*+'
_FIELDS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf'^{_FIELDS}"{_INSIDE}$'
_STAYS_OPEN = rf'^{_INSIDE}$|^{_INSIDE}"[^,]*+,{_FIELDS}"{_INSIDE}$'

_BOM = "\ufeff"


def _turned(state: Column, turns: Column) -> Column:
    """A state after so many turns."""
    return state != (turns % 2 == 1)


def _with_state(rows: DataFrame, within: list[str], order: str, start: Column) -> DataFrame:
    """Rows with ``inside``, the state before each, and ``set_to`` and ``turns`` up to and with it.

    Rows hold ``sets``, the state that a row leaves whatever was before, or null, and
    ``turn``, 1 if it turns the state. ``set_to`` is what the last row that sets the
    state has set it to, ``turns`` counts the turns since then.
    """
    ordered = Window.partitionBy(*within).orderBy(order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("_all", F.sum("turn").over(so_far)).withColumn(
        "_last", F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "_all")), ignorenulls=True).over(so_far)
    )
    known = counted.withColumn("set_to", F.col("_last.sets")).withColumn(
        "turns", F.col("_all") - F.coalesce("_last._all", F.lit(0))
    )
    before = F.lag(F.struct("set_to", "turns")).over(ordered)
    state = _turned(F.coalesce(before["set_to"], start), F.coalesce(before["turns"], F.lit(0)))
    return known.withColumn("inside", state).drop("_all", "_last")


def _lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Physical lines in file order, and what they do to a reader."""
    read = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    line = F.when(F.col("_metadata.file_block_start") == 0, F.ltrim("value", F.lit(_BOM))).otherwise(F.col("value"))
    quoted = F.contains(line, F.lit('"'))
    opens, stays = quoted & line.rlike(_OPENS), ~quoted | line.rlike(_STAYS_OPEN)
    return read.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        F.when(opens == stays, opens).alias("sets"),
        F.when(opens & ~stays, 1).otherwise(0).alias("turn"),
    )


def records(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """(file_path, record): the records of CSV files below a path, without their headers.

    Lines end with a line feed, with or without a carriage return before it; breaks
    inside of fields stay as they are. A quote counts at the start of a field only. Empty
    lines between records are skipped; a header is the first record that is not empty.
    A field that is never closed takes the rest of its file. A file may be of any
    size; only a record as long as a split keeps two splits together.
    """
    lines = _lines(spark, path, pattern)
    where = ["file_path", "block"]
    empty = F.col("value").isin("", "\r")
    splits = lines.groupBy(*where).agg(
        F.bool_or(F.coalesce("sets", F.col("turn") == 1)).alias("opens"),
        F.bool_or(F.col("sets").isNotNull()).alias("closes"),
        F.count_if(~empty).alias("filled"),
        F.min(F.when(~empty, F.col("at"))).alias("first"),
    )
    # The splits of a file are few and small beside its lines, so they are the side to broadcast.
    opening = F.broadcast(splits.where("opens").select(*where))
    effects = lines.where("sets IS NOT NULL OR turn = 1").drop("value").join(opening, where)
    last = F.max_by(F.struct("set_to", "turns"), "at")
    ends = _with_state(effects, where, "at", F.lit(False)).groupBy(*where).agg(last.alias("last"))
    left = F.when(F.col("opens"), _turned(F.col("last.set_to"), F.col("last.turns"))).when(F.col("closes"), False)
    turned = F.when(F.col("opens") & F.col("last.set_to").isNull(), F.col("last.turns") % 2).otherwise(0)
    blocks = splits.join(ends, where, "left").select(
        *where, "opens", "filled", "first", left.alias("sets"), turned.alias("turn")
    )
    started = _with_state(blocks, ["file_path"], "block", F.lit(False)).select(
        *where, "filled", "first", F.col("inside").alias("open"), (F.col("opens") | F.col("inside")).alias("mixed")
    )
    mixed = F.broadcast(started.where("mixed").select(*where, "open"))
    placed = _with_state(lines.join(mixed, where), where, "at", F.col("open"))
    after = F.coalesce(F.col("sets"), _turned(F.col("inside"), F.col("turn")))
    begins = (~F.col("inside") & ~empty).cast("int")
    in_order = Window.partitionBy(*where).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        placed.withColumn("after", after)
        .withColumn("number", F.sum(begins).over(in_order))
        .where(F.col("inside") | ~empty)
    )
    one = ~F.col("inside") & ~F.col("after")
    plain = started.where(~F.col("mixed"))
    counted = (
        numbered.groupBy(*where)
        .agg(F.max("number").alias("most"))
        .unionByName(plain.select(*where, F.col("filled").alias("most")))
    )
    upto = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("most") > 0, F.struct(F.col("block").alias("block"), F.col("most").alias("number")))
    owners = counted.select(
        *where,
        F.last(begun, ignorenulls=True).over(upto).alias("owner"),
        (F.coalesce(F.sum("most").over(upto), F.lit(0)) == 0).alias("is_first"),
    )
    owned = numbered.join(owners, where)
    header = F.col("is_first") & (F.col("number") == 1)
    alone = owned.where(one & ~header).select("file_path", F.col("value").alias("record"))
    # Lines before the first record of a split belong to the last one of a split before.
    of = F.when(F.col("number") > 0, F.struct("block", "number")).otherwise(F.col("owner"))
    together = (
        owned.where(~one)
        .withColumn("of", of)
        .withColumn("at_start", F.col("is_first") & (F.col("number") > 0))
        .groupBy("file_path", "of")
        .agg(
            F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines"),
            F.min_by("at_start", F.struct("block", "at")).alias("at_start"),
        )
        .where(~(F.col("at_start") & (F.col("of.number") == 1)))
        .select("file_path", F.array_join(F.col("lines")["value"], "\n").alias("record"))
    )
    heads = F.broadcast(plain.join(owners, where).select(*where, "first", "is_first"))
    single = (
        lines.where(~empty)
        .join(heads, where)
        .where(~(F.col("is_first") & (F.col("at") == F.col("first"))))
        .select("file_path", F.col("value").alias("record"))
    )
    every = single.unionByName(alone).unionByName(together)
    return every.select("file_path", F.regexp_replace("record", "\r$", "").alias("record"))
