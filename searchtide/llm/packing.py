"""Packing documents into windows by Karmarkar-Karp multiway differencing.

Documents are tokenized in place, whole, and cut into pieces; the pieces of a
block, a bounded number of tokens that one task has at hand, are dealt to windows.
Each piece starts as a partial partition that holds it in one window and nothing
in the others. The two partitions with the largest imbalance are merged again and
again, the fullest windows of the one onto the emptiest of the other, until one
partition is left, whose windows are near equal. If one of them is over capacity,
the block is dealt again to more windows.

No shuffle: a lost task is packed again from its part of the table.
"""

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm.common import give_back, ship_package, text_groups

NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = ", ".join(f"{name} long" for name in NAMES)
#: Blanks at which the tokenizer cuts in any case.
_WORDS = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]")
#: What it cuts lower-case text of one-byte characters into: letters, a contraction's
#: end, one digit, or other marks.
_LETTERS, _DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_PIECES = re.compile(
    rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+"
)
#: Characters of text whose words are held at once, and words remembered.
SEGMENT, REMEMBERED, LONGEST = 1_000_000, 200_000, 64
#: New words that the tokenizer is given at once.
LEARNT = 10_000


class WordTokenizer:
    """Token ids of texts, as little-endian 32-bit numbers.

    The tokenizer cuts at blanks whatever stands around them, so a text's ids are
    those of its words, and a word that was seen lately need not be cut again. It
    has no capitals: texts of one-byte characters, whose lower case is plain, are
    put into lower case first, and cut into the smallest pieces it knows.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: list[str], pieces: bool) -> dict[str, bytes]:
        """Ids of words, or of pieces that the tokenizer does not cut."""
        text = " ".join(words)
        if pieces:
            # Their ends show in the ids, so no offsets are asked for.
            (encoded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
        else:
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            starts = np.fromiter((span[0] for span in encoded.offsets), np.int64, len(ids))
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            cuts = np.searchsorted(starts, ends, side="left") * 4
        data, first, learnt = ids.tobytes(), 0, {}
        for word, last in zip(words, cuts.tolist(), strict=True):
            learnt[word] = data[first:last]
            first = last
        return learnt

    def _spelled(self, groups: list[list[str]], pieces: bool) -> list[bytes]:
        """Ids of each group of words."""
        recent, older = self.recent, self.older
        unseen = set().union(*groups).difference(recent)
        known = {w: older[w] for w in unseen if w in older}
        new = list(unseen.difference(known))
        recent.update(known)
        # The tokenizer takes many times the room of what it cuts, so it gets a part at a time.
        for first in range(0, len(new), LEARNT):
            recent.update(self._learn(new[first : first + LEARNT], pieces))
        found = [b"".join(map(recent.__getitem__, words)) for words in groups]
        for word in new:
            if len(word) > LONGEST:
                del recent[word]
        if len(recent) > REMEMBERED:
            self.older, self.recent = recent, {}
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; words of about SEGMENT characters are held at a time."""
        found: list[list[bytes]] = [[] for _ in texts]
        plain = [_plain(text) for text in texts]
        for kind, pattern in ((True, _PIECES), (False, _WORDS)):
            groups, owners, size = [], [], 0
            for i, text in enumerate(texts):
                if plain[i] != kind:
                    continue
                low = text.lower() if kind else text
                for start, end in _segments(low):
                    groups.append(pattern.findall(low, start, end))
                    owners.append(i)
                    size += end - start
                    if size >= SEGMENT:
                        for owner, ids in zip(owners, self._spelled(groups, kind), strict=True):
                            found[owner].append(ids)
                        groups, owners, size = [], [], 0
            if groups:
                for owner, ids in zip(owners, self._spelled(groups, kind), strict=True):
                    found[owner].append(ids)
        return [b"".join(parts) for parts in found]


def _plain(text: str) -> bool:
    """True for texts of one-byte characters that ``_PIECES`` cuts like the tokenizer.

    Not those with anything like a special token, or with the four separators that
    are blanks in Python alone.
    """
    if any(odd in text for odd in ("<|", "\x1c", "\x1d", "\x1e", "\x1f")):
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _segments(text: str) -> Iterator[tuple[int, int]]:
    """Parts of a text that end at blanks, of SEGMENT characters or little more."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        yield at, end
        at = end


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def differenced(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Window of every piece, by multiway differencing."""
    n = len(lengths)
    # A partition's sums, ascending, less its smallest, which all windows share.
    sums: list = [None] * (2 * n)
    merges: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(size), i) for i, size in enumerate(lengths)]
    heapq.heapify(heap)
    last = windows - 1

    def sums_of(node: int) -> np.ndarray:
        if node >= n:
            return sums[node]
        alone = np.zeros(windows, np.int64)
        alone[last] = lengths[node]
        return alone

    made = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums_of(a) + sums_of(b)[::-1]
        order = np.argsort(both, kind="stable")
        both = both[order]
        sums[a] = sums[b] = None
        sums[made] = both - both[0]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(sums[made][last]), made))
        made += 1
    place = np.zeros(n, np.int64)
    slots: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    for node in range(made - 1, n - 1, -1):
        a, b, order = merges[node - n]
        own = np.empty(windows, np.int64)
        own[order] = slots.pop(node)
        for child, seats in ((a, own), (b, own[::-1])):
            if child < n:
                place[child] = seats[last]
            else:
                slots[child] = seats
    if heap[0][1] < n:
        place[heap[0][1]] = last
    return place


def dealt(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of every piece, and how many windows there are."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    total = int(lengths.sum())
    windows = -(-total // capacity)
    while True:
        place = differenced(lengths, windows)
        sums = np.bincount(place, weights=lengths, minlength=windows).astype(np.int64)
        over = int(sums.max()) - capacity
        if over <= 0:
            break
        windows += max(1, over * windows // capacity // 2)
    order = np.argsort(place, kind="stable")
    run = np.cumsum(lengths[order]) - lengths[order]
    first = np.concatenate([[0], np.cumsum(sums)[:-1]])
    offset = np.empty(len(lengths), np.int64)
    offset[order] = run - first[place[order]]
    used = np.unique(place)
    return np.searchsorted(used, place), offset, len(used)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    piece: int = 512,
    block_tokens: int = 1_000_000,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: where it starts in its document and in which window it lies.

    A document's ids are the tokenizer's and ``end_id``; they are cut into full
    windows and, of what remains, pieces of up to ``piece`` ids. Null and empty
    texts have ``end_id`` alone; a null doc_id stays null and repeated rows are
    packed each for itself. Window numbers are unique, not consecutive. Columns
    other than doc_id and text are not read.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting = 0

        def closed() -> pa.RecordBatch:
            nonlocal sequence, rows, waiting
            columns = [list(column) for column in zip(*rows, strict=True)]
            lengths = np.array(columns[2], np.int64)
            full = lengths == capacity
            place, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            n_full = int(full.sum())
            place[full] = np.arange(n_full)
            windows, offsets, n_windows = dealt(lengths[~full], capacity)
            place[~full], offset[~full] = n_full + windows, offsets
            columns += [sequence + place, offset]
            sequence += n_full + n_windows
            rows, waiting = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for part, texts in text_groups(batches, 1, 2 * SEGMENT):
                yield from zip(part.column(0).to_pylist(), tokenizer.ids(texts), strict=True)

        for doc_id, own in documents():
            ids = own + end
            n, start = len(ids) // 4, 0
            while start < n:
                left = n - start
                size = capacity if left >= capacity else min(left, piece)
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + size)])
                rows.append((doc_id, start, size, crc, n))
                start += size
            waiting += n
            if waiting >= block_tokens:
                yield closed()
        if rows:
            yield closed()
        give_back()

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        packed, PIECES
    )
