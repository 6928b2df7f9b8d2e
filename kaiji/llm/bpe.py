"""Byte-level BPE by tree reduction: leaves encode alone, neighbours join exactly.

The value of a node is the encoding of its own piece of text, and ``join`` makes
the value of a text from those of its two halves, so encoding is a reduction
over a binary tree. ``join`` re-encodes only a window at the boundary:

* A place between a visible character and ASCII white space always separates
  two pattern matches, and no match looks across it (white space only leads a
  match; the only lookahead is over a run of white space). So the window reaches
  from the last such place left of the boundary to the first one right of it.
* Matches of the window are found on stand-ins: each non-ASCII character is replaced by
  one of its class, and the library itself is asked for that class, so its Unicode
  version counts. The pattern may tell non-ASCII characters apart only as letters, numbers, white space and others.
* Inside the window, matches that begin and end alike in the halves and in the
  whole keep their tokens.
* One match cut in two joins token by token: the window of re-encoded tokens
  grows until the pairs at both its ends are stable, i.e. each pair, encoded by
  itself, gives the same two tokens. A token sequence whose neighbours are all
  stable pairs is the BPE encoding: the first merge across any boundary in the
  whole would also be made in that pair alone, as merges inside the pair happen
  in the same order in both.

Decoding concatenates the bytes of the ids up the tree.

Defined cases: a null or empty text has no ids and decodes to no bytes; a text
of any length, with or without white space, encodes as the whole; repeated rows
stay; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

CUT = re.compile(r"\S[ \t-\r]")  # a match ends inside, after the visible character


class Classes(dict):
    """Table for ``str.translate``: any non-ASCII code point to one stand-in of its class, as the library classes it.

    A code point is a letter, a number or another visible character if the library puts it
    into one match with ``a``, ``1`` or ``!``; the probing vocabulary merges just that pair of bytes.
    """

    STAND_INS = {"a": "\u00e9", "1": "\u0663", "!": "\u3002"}
    WHITE = "\u3000"

    def __init__(self, pattern: str):
        super().__init__((i, i) for i in range(128))
        ranks = {bytes([i]): i for i in range(256)}
        ranks |= {p.encode() + bytes([i]): 256 * k + i for k, p in enumerate(self.STAND_INS, 1) for i in range(256)}
        self.probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, code: int) -> str:
        joins = (s for p, s in self.STAND_INS.items() if self.probe.encode_ordinary(p + chr(code))[0] >= 256)
        self[code] = found = next(joins, self.WHITE)
        return found


class TreeTokenizer:
    """Encoder and decoder for one rank file. ``leaf_chars``: longest text encoded in one go."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = 16_384):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern, self.classes = regex.compile(pattern), Classes(pattern)
        self.leaf_chars = max(1, leaf_chars)
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.stable = lru_cache(1 << 16)(self._stable)
        self.reachable = lru_cache(1 << 16)(self._reachable)

    # ---- encoding

    def encode(self, text: str) -> np.ndarray:
        return self._node(text, 0, len(text))

    def _node(self, text: str, lo: int, hi: int) -> np.ndarray:
        if hi - lo <= self.leaf_chars:
            return self.bpe.encode_to_numpy(text[lo:hi], disallowed_special=()).astype(np.int32)
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self._node(text, lo, mid), self._node(text, mid, hi))

    def join(self, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Encoding of ``text[lo:hi]`` from those of ``text[lo:mid]`` and ``text[mid:hi]``."""
        start = self._cut_before(text, lo, mid)
        if start == mid:
            return np.concatenate([left, right])
        m = CUT.search(text, mid - 1, hi)
        end = m.start() + 1 if m else hi
        i = self._tokens_before(left, len(text[start:mid].encode()))
        j = self._tokens_after(right, len(text[mid:end].encode()))
        window = self._window(text[start:end], mid - start, left[i:].tolist(), right[:j].tolist())
        return np.concatenate([left[:i], np.array(window, np.int32), right[j:]])

    @staticmethod
    def _cut_before(text: str, lo: int, mid: int) -> int:
        """The last safe place up to ``mid``, or ``lo``; looks back in growing steps."""
        reach = 64
        while True:
            at = max(lo, mid - reach)
            found = [m.start() + 1 for m in CUT.finditer(text, at, min(len(text), mid + 1))]
            if found or at == lo:
                return found[-1] if found else lo
            reach *= 4

    def _tokens_before(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many of ``ids`` stand before their last ``n_bytes`` bytes."""
        i = len(ids)
        while n_bytes > 0:
            i -= 1
            n_bytes -= len(self.bytes_of[int(ids[i])])
        return i

    def _tokens_after(self, ids: np.ndarray, n_bytes: int) -> int:
        j = 0
        while n_bytes > 0:
            n_bytes -= len(self.bytes_of[int(ids[j])])
            j += 1
        return j

    def _window(self, text: str, mid: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text``, given those of its parts before and after ``mid``."""
        plain = text.translate(self.classes)
        spans = [m.span() for m in self.pattern.finditer(plain)]
        spans_l = [m.span() for m in self.pattern.finditer(plain[:mid])]
        spans_r = [(s + mid, e + mid) for s, e in (m.span() for m in self.pattern.finditer(plain[mid:]))]
        a = 0
        while a < min(len(spans), len(spans_l)) and spans[a] == spans_l[a]:
            a += 1
        b = 0
        while b < min(len(spans) - a, len(spans_r)) and spans[-1 - b] == spans_r[-1 - b]:
            b += 1
        middle = spans[a:len(spans) - b]
        keep_l = self._tokens_after(np.array(left), len(text[:spans[a][0] if a < len(spans) else mid].encode()) if a else 0)
        keep_r = self._tokens_before(np.array(right), len(text[spans[len(spans) - b][0]:].encode()) if b else 0)
        if len(middle) == 1 and a == len(spans_l) - 1 and b == len(spans_r) - 1:
            inside = self.join_match(left[keep_l:], right[:keep_r])
        else:
            inside = [i for s, e in middle for i in self.bpe._encode_single_piece(text[s:e].encode())]
        return left[:keep_l] + inside + right[keep_r:]

    def join_match(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of one pattern match from those of its two parts."""
        if not left or not right:
            return left + right
        size = sum(len(self.bytes_of[i]) for i in left[-self.longest:] + right[:self.longest])
        if size <= self.longest and (whole := self._bytes(left + right)) in self.ranks:
            return [self.ranks[whole]]
        sound = all(self.reachable(x[0]) for x in (left, right) if len(x) == 1)
        if sound and self.stable(left[-1], right[0]):
            return left + right
        reach = 4 if sound else max(len(left), len(right))
        while True:
            i, j = min(reach, len(left)), min(reach, len(right))
            inner = self.bpe._encode_single_piece(self._bytes(left[len(left) - i:] + right[:j]))
            all_l, all_r = i == len(left), j == len(right)
            if (all_l and all_r) or (len(inner) > 1 and (all_l or self.stable(left[-i - 1], inner[0]))
                                     and (all_r or self.stable(inner[-1], right[j]))):
                return left[:len(left) - i] + inner + right[j:]
            reach *= 2

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _stable(self, a: int, b: int) -> bool:
        return self.bpe._encode_single_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def _reachable(self, token: int) -> bool:
        """True if merges alone make the token (some vocabularies hold tokens they can't)."""
        parts = [bytes([x]) for x in self.bytes_of[token]]
        while len(parts) > 1:
            pairs = [(self.ranks[p + q], i) for i, (p, q) in enumerate(zip(parts, parts[1:])) if p + q in self.ranks]
            if not pairs:
                return False
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return True

    # ---- decoding

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf_chars:
            return self._bytes(ids.tolist())
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


@lru_cache(4)
def tokenizer(ranks_path: str, pattern: str, leaf_chars: int) -> TreeTokenizer:
    """One tokenizer for each worker process."""
    return TreeTokenizer(ranks_path, pattern, leaf_chars)


def _ids(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode(text: Column, ranks_path: str, pattern: str, leaf_chars: int = 16_384) -> Column:
    """Token ids of a text column: array<int>, empty for null."""
    @F.arrow_udf("array<int>")
    def bpe_encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(ranks_path, pattern, leaf_chars)
        for texts in batches:
            yield _ids([tok.encode(t.as_py() or "") for t in texts])

    return bpe_encode(text)


def decode(ids: Column, ranks_path: str, pattern: str, leaf_chars: int = 16_384) -> Column:
    """Bytes of an id column: binary, empty for null."""
    @F.arrow_udf("binary")
    def bpe_decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(ranks_path, pattern, leaf_chars)
        for lists in batches:
            yield pa.array([tok.decode(x.values.to_numpy()) if x.is_valid else b"" for x in lists], pa.binary())

    return bpe_decode(ids)


def round_trip(text: Column, ranks_path: str, pattern: str, leaf_chars: int = 16_384) -> Column:
    """struct<ids, decoded>: ``encode`` and ``decode`` of its ids in one pass through the same worker."""
    @F.arrow_udf("ids array<int>, decoded binary")
    def bpe_round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tok = tokenizer(ranks_path, pattern, leaf_chars)
        for texts in batches:
            ids = [tok.encode(t.as_py() or "") for t in texts]
            yield pa.StructArray.from_arrays([_ids(ids), pa.array([tok.decode(x) for x in ids], pa.binary())], ["ids", "decoded"])

    return bpe_round_trip.asNondeterministic()(text)
