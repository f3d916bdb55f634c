"""Categories and the written hints that lead to them."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The category labels.
CATEGORIES = [
    "Action",
    "Romance",
    "Comedy",
    "Horror",
    "Animation",
    "Drama",
    "C Drama",
    "K Drama",
    "Sports",
    "Music",
    "Reality Show",
    "TV Channel",
    "News",
    "Other",
]

# Words that hint at a category. A channel name may be the start
# of a longer word (a channel with its number), the others are whole words.
CHANNEL_HINTS = ["vtv", "htv", "channel"]
WORD_HINTS = [
    ("Reality Show", ["running", "master key", "reality", "idol", "show", "challenge"]),
    ("Romance", ["romantic", "love", "kiss"]),
    ("Drama", ["potter", "hogwarts", "wizard", "magic"]),
    ("Action", ["fight", "gun", "hero", "war"]),
    ("News", ["breaking", "live", "news"]),
]

# Names whose category no hint word tells.
KNOWN_KEYWORDS = {
    "naruto": "Animation",
    "fairy tail": "Animation",
    "đại chiến titan": "Animation",
    "argen": "Sports",
    "pent": "C Drama",
    "những người thừa kế": "K Drama",
    "bolero": "Music",
    "bigfoot": "Horror",
    "s.w.a.t.": "Action",
    "youtube": "Other",
}


def default_rules() -> list[tuple[str, str]]:
    """(pattern, category) in order of precedence."""
    rules = [("|".join(CHANNEL_HINTS), "TV Channel")]
    rules += [(rf"\b({'|'.join(words)})\b", category) for category, words in WORD_HINTS]
    return rules


def category_by_rules(text: Column, rules: Sequence[tuple[str, str]] | None = None) -> Column:
    """Category of the first rule that matches, whatever the case; else null."""
    chosen = F.lit(None).cast("string")
    for pattern, category in reversed(default_rules() if rules is None else list(rules)):
        chosen = F.when(text.rlike(f"(?iU){pattern}"), F.lit(category)).otherwise(chosen)
    return chosen
