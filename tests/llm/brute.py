"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from fractions import Fraction

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---- SimHash

def fingerprint(text, shingle=3):
    w = words(lower_ascii(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(fps, max_bits=3):
    """Component number of each fingerprint, by testing all pairs."""
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return [find(f) for f in fps]


def near_duplicates(rows, max_bits=3):
    """{(id, fingerprint hex, component id)} of rows (id, text), as a sorted list."""
    fps = [fingerprint(t) for _, t in rows]
    comps = components(fps, max_bits)
    least = {}
    for (i, _), c in zip(rows, comps):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, comps)), key=repr)


# ---- mixing

def targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    """{source: target} by rounds of sharing the excess anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = sum(sizes.values()) * share, set()
    while True:
        rest = [s for s in order if s not in capped]
        left = budget - sum(most * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in rest) if rest else Fraction(0)
        over = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not over:
            return {s: Fraction(most * sizes[s]) if s in capped else level * weight[s] for s in order}
        capped |= over


def mix(rows, seed="mix"):
    """Sorted (id, size, taken) of rows (id, source, size)."""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes)
    rank = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    queue, taken = [], []
    for s in sizes:
        def place(r):
            text = seed if r[0] is None else f"{seed}:{r[0]}"
            return hashlib.md5(text.encode()).hexdigest()[:16], (r[0] is not None, r[0] or 0), r[2]
        sent = 0
        for r in sorted((r for r in rows if r[1] == s), key=place):
            sent += r[2]
            taken.append([r[0], r[2], 0])
            for copy in range(2):
                if r[2]:
                    queue.append(((sent + copy * sizes[s]) / float(goal[s]), rank[s], copy, sent, len(taken) - 1))
    left = sum(sizes.values()) * 3 // 2
    for *_, at in sorted(queue):
        got = min(left, taken[at][1])
        taken[at][2] += got
        left -= got
    return sorted(map(tuple, taken), key=repr)


# ---- quality

def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed."""
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {x for x in windows if windows.count(x) > 1}
    covered = {i + d for i, x in enumerate(windows) if x in again for d in range(3)}
    n, rep = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, rep, n < 50 or 100 * rep > 50 * n


def js_distance(p, q):
    p, q = [x / max(1, sum(p)) for x in p], [x / max(1, sum(q)) for x in q]
    d = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        d += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(0.0, d))


def char_classes(text):
    """Counts by kind of character, in the order of textstats.CLASSES."""
    def kind(c):
        if "a" <= c <= "z":
            return "lower"
        if "A" <= c <= "Z":
            return "upper"
        if "0" <= c <= "9":
            return "digit"
        if c == "\n":
            return "newline"
        if c <= " ":
            return "space"
        if c in "#*$%&<>":
            return "symbol"
        if c == "|":
            return "bar"
        if c == "!":
            return "bang"
        if c in "\"'.,;:-()":
            return "quote"
        return "letter_other" if ord(c) > 127 else "mark"

    names = ("lower", "upper", "digit", "space", "newline", "symbol", "bar", "bang", "mark", "quote", "letter_other")
    found = [kind(c) for c in text or ""]
    return [found.count(n) for n in names]


MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¿¡«»„“”’…"


def common_words(text, listed):
    found = [w.lower().strip(MARKS) for w in words(text)]
    counts = [found.count(w) for w in listed]
    return counts + [0] * (20 - len(listed)) + [len(found) - sum(counts)]


def quality(rows, lists, class_guards, word_guards, scale, steps):
    """Kept or not, for each of rows (id, text, lang); references from all rows that pass."""
    stats = [(lang if lang in lists else None, base_counts(t)[5], char_classes(t), common_words(t, lists.get(lang, ())), len(words(t)))
             for _, t, lang in rows]

    def reference(use):
        ref = {}
        for lang, _, classes, common, _ in use:
            a, b = ref.setdefault(lang, ([0] * len(classes), [0] * len(common)))
            for sums, counts in ((a, classes), (b, common)):
                for i, c in enumerate(counts):
                    sums[i] += c * scale // sum(counts) if c else 0
        return ref

    passed = [s for s in stats if not s[1]]
    first = reference(passed)
    step = [math.floor(js_distance(s[2], first[s[0]][0]) * steps) for s in passed]
    half = {}
    for lang in first:
        found = sorted(x for s, x in zip(passed, step) if s[0] == lang)
        half[lang] = found[(len(found) + 1) // 2 - 1]
    last = reference([s for s, x in zip(passed, step) if x <= half[s[0]]])
    out = []
    for lang, failed, classes, common, n in stats:
        odd = False
        if lang in last:
            limit = max(((least, most) for least, most in class_guards if sum(classes) >= least), default=(0, 2.0))[1]
            odd |= js_distance(classes, last[lang][0]) > limit
            if lang is not None:
                limit = max(((least, most) for least, most in word_guards if n >= least), default=(0, 2.0))[1]
                odd |= js_distance(common, last[lang][1]) > limit
        out.append(not failed and not odd)
    return out


# ---- search

def top_k(vectors, queries, k):
    """Sorted (query, rank, id, score); vectors and queries are (id, list of ints)."""
    out = []
    for q, v in sorted({(i, tuple(x)) for i, x in queries}):
        scores = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in vectors if i != q and len(x) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)
