"""Reading a classifier's reply: one JSON object somewhere inside a text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category of a keyword the classifier says nothing about.
DEFAULT_CATEGORY = "Other"

# The object of a reply: as much as can stand between a pair of braces.
OBJECT = r"(?s)\{.*\}"


def object_text(reply: Column) -> Column:
    """From the first ``{`` to the last ``}``; null if there is no such span."""
    return F.nullif(F.regexp_extract(reply, OBJECT, 0), F.lit(""))


def parse_reply(reply: Column) -> Column:
    """The reply's object as a map, or null unless it is one non-empty object.

    Spark ignores what follows a complete value. So the span is parsed once as
    the only element of an array and once as the only field of an object: no
    text after it can go on in both. Numbers that JSON does not have, such as
    NaN, make a reply invalid.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    span = object_text(reply)
    items = F.from_json(
        F.concat(F.lit("["), span, F.lit("]")), "array<map<string,string>>", strict
    )
    field = F.from_json(
        F.concat(F.lit('{"":'), span, F.lit("}")), "map<string,string>", strict
    )
    whole = (F.size(items) == 1) & (F.size(field) == 1) & (F.size(items[0]) > 0)
    return F.when(whole, items[0])


def lookup(answers: Column, keyword: Column) -> Column:
    """Category of a keyword; a repeated key counts by its last value."""
    hits = F.filter(F.map_entries(answers), lambda entry: entry["key"] == keyword)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["value"], F.lit(DEFAULT_CATEGORY))


def preview(reply: Column, length: int = 500) -> Column:
    """The first characters of a reply, for logs."""
    return F.substring(reply, 1, length)
