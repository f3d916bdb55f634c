"""Cleaning and folding of keywords, as Column expressions."""

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks in the sense of Unicode, plus the four ASCII separators U+001C..U+001F.
BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Cut blanks of every kind off both ends."""
    return F.regexp_replace(text, rf"(?U)^{BLANK}+|{BLANK}+$", "")


def is_blank(text: Column) -> Column:
    """True if nothing but blanks is there; null stays null."""
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def normalize(text: Column) -> Column:
    """Lower case, letters, digits and accents only, single blanks between words.

    Blanks of every kind part words, marks are dropped.
    """
    # Single blanks, which most are, match nothing.
    parted = F.regexp_replace(F.lower(text), rf"(?U)[\p{{Z}}{BLANK[1:-1]}&&[^ ]]+", " ")
    kept = F.regexp_replace(parted, r"[^\p{L}\p{M}\p{N} ]+", "")
    return F.trim(F.regexp_replace(kept, "  +", " "))


def fold(text: Column, collation: str = "UNICODE_CI_AI") -> Column:
    """The text under a collation, so that grouping unites its spellings.

    ``UNICODE`` unites composed and decomposed accents, ``UNICODE_CI_AI`` also
    upper and lower case and letters with and without accents.
    """
    return F.collate(text, collation)


def _plain_letters() -> tuple[str, str]:
    """Latin letters with accents, and the letters without, by Unicode's own tables."""
    blocks = [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]
    bases = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in blocks}
    # Letters with a stroke, which Unicode does not take apart.
    bases |= {"đ": "d", "Đ": "D", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T"}
    changed = {letter: base for letter, base in bases.items() if letter != base}
    return "".join(changed), "".join(changed.values())


def unaccent(text: Column) -> Column:
    """The text without accents, composed or not, and without strokes through letters."""
    accented, plain = _plain_letters()
    is_ascii = F.is_valid_utf8(text) & (F.octet_length(text) == F.char_length(text))
    return F.when(is_ascii, text).otherwise(F.translate(F.regexp_replace(text, r"\p{Mn}+", ""), accented, plain))
