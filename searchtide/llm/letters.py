"""Texts as arrays of code points, and the words in them."""

from dataclasses import dataclass
from functools import cache

import numpy as np

# First and last code point of the blocks of each script.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
N_SCRIPTS = len(SCRIPT_RANGES) + 1  # the last one is any other


@cache
def scripts() -> np.ndarray:
    """Number of the script of every code point."""
    table = np.full(0x110000, N_SCRIPTS - 1, np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values()):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


@cache
def letters() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def word_marks() -> np.ndarray:
    """Letters, digits and the sign that stands for the letter a."""
    table = letters() | np.fromiter((chr(c).isdigit() for c in range(0x110000)), bool, 0x110000)
    table[ord("@")] = True
    return table


@cache
def lowered() -> np.ndarray:
    """Lower case of every code point, where that is one code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letters()):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


@dataclass
class Words:
    codes: np.ndarray  # all texts in lower case, with a zero after each
    first: np.ndarray  # where each text starts
    start: np.ndarray  # of each word
    end: np.ndarray
    doc: np.ndarray  # which text a word is in
    inside: np.ndarray  # True for code points of words


def words_of(texts: list[str], marks: np.ndarray) -> Words:
    """Runs of code points that ``marks`` is true for."""
    raw = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "replace"), "<u4")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(sizes) - sizes
    inside = marks[raw]
    edges = np.diff(inside.view(np.int8), prepend=0)
    start = np.flatnonzero(edges == 1)
    end = np.flatnonzero(edges == -1)
    doc = np.searchsorted(first, start, side="right") - 1
    return Words(lowered()[raw], first, start, end, doc, inside)
