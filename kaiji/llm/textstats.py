"""Per-document counts over whole texts, vectorised over slices of an Arrow batch.

Words are the maximal runs without space and ASCII 9 to 13, lines the parts
between newlines. All counts are exact: words and lines are compared through
dictionary codes, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # text handled at once (some 30 times that in arrays); a longer text is a slice of its own

#: Character classes, by UTF-8 byte: continuation bytes (class -1) don't count.
CLASSES = ("lower", "upper", "digit", "space", "newline", "symbol", "bar", "bang", "mark", "quote", "letter_other")
SYMBOLS = "#*$%&|<>"


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("mark"))
    for lo, hi, name in ((97, 122, "lower"), (65, 90, "upper"), (48, 57, "digit"), (0, 31, "space"), (32, 32, "space"), (192, 255, "letter_other")):
        table[lo:hi + 1] = CLASSES.index(name)
    table[10] = CLASSES.index("newline")
    for c in SYMBOLS:
        table[ord(c)] = CLASSES.index("symbol")
    table[ord("|")], table[ord("!")] = CLASSES.index("bar"), CLASSES.index("bang")
    for c in "\"'.,;:-()":
        table[ord(c)] = CLASSES.index("quote")
    table[128:192] = -1
    return table


CLASS_OF = _class_table()


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of at most ``SLICE_BYTES``, nulls as empty texts, none without rows."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield at, texts.slice(at, upto - at)
        at = upto


def _rows(lists: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def first_codes(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Codes of equal keys from 0 on, and their number."""
    coded = pa.array(key).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


class Slice:
    """Counts for the documents of one slice."""

    def __init__(self, texts: pa.Array):
        self.n = len(texts)
        self.texts = texts
        split = pc.ascii_split_whitespace(texts)
        words, doc = split.flatten(), _rows(split)
        some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        self.doc = doc[some]
        coded = words.filter(pa.array(some)).dictionary_encode()
        self.code, self.vocabulary = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        self.n_words = np.bincount(self.doc, minlength=self.n)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Sums per document of a value of each vocabulary entry."""
        return np.bincount(self.doc, weights=values[self.code], minlength=self.n)

    def word_chars(self) -> np.ndarray:
        return self.per_word(pc.utf8_length(self.vocabulary).to_numpy(zero_copy_only=False)).astype(np.int64)

    def n_distinct(self) -> np.ndarray:
        codes, n = first_codes(self.doc * max(1, len(self.vocabulary)) + self.code)
        owner = np.zeros(n, np.int64)
        owner[codes] = self.doc
        return np.bincount(owner, minlength=self.n)

    def repeat_words(self, window: int = 3) -> np.ndarray:
        """Words that lie in a window of words found twice or more in the text."""
        n = len(self.doc) - window + 1
        covered = np.zeros(len(self.doc), bool)
        if n > 0:
            key, _ = first_codes(self.doc[:n] * max(1, len(self.vocabulary)) + self.code[:n])
            for step in range(1, window):
                key, _ = first_codes(key * max(1, len(self.vocabulary)) + self.code[step:step + n])
            inside = self.doc[:n] == self.doc[window - 1:]
            again = inside & (np.bincount(key[inside], minlength=int(key.max()) + 1)[key] > 1)
            for step in range(window):
                covered[step:step + n] |= again
        return np.bincount(self.doc[covered], minlength=self.n)

    def line_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them equal to an earlier line of the text."""
        split = pc.split_pattern(self.texts, "\n")
        lines, doc = split.flatten(), _rows(split)
        some = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
        doc = doc[some]
        coded = lines.filter(pa.array(some)).dictionary_encode()
        key = doc * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False)
        codes, n = first_codes(key)
        owner = np.zeros(n, np.int64)
        owner[codes] = doc
        total = np.bincount(doc, minlength=self.n)
        return total, total - np.bincount(owner, minlength=self.n)

    def class_counts(self) -> np.ndarray:
        """Documents by character classes."""
        length = pc.binary_length(self.texts).to_numpy(zero_copy_only=False)
        data = text_bytes(self.texts)
        found = CLASS_OF[data]
        keep = found >= 0
        key = np.repeat(np.arange(self.n) * len(CLASSES), length)[keep] + found[keep]
        return np.bincount(key, minlength=self.n * len(CLASSES)).reshape(self.n, len(CLASSES))

    def char_count(self, char: str) -> np.ndarray:
        return pc.count_substring(self.texts, char).to_numpy(zero_copy_only=False).astype(np.int64)

    def bare_words(self) -> pa.Array:
        """The vocabulary in lower case without marks at either end."""
        return pc.utf8_trim(pc.utf8_lower(self.vocabulary), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¿¡«»„“”’…")


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The UTF-8 bytes of a large_string array without nulls, one text after the other."""
    _, offsets, data = texts.buffers()
    if data is None:
        return np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]]
