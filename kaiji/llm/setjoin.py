"""Jaccard join of word n-gram sets: a size-aware heavy-light join.

A text's set holds its distinct shingles as 64-bit hashes (texts under the
shingle length: the whole sequence as one). Two sets link when
``100 * intersection >= percent * union``. A partner shares ``need(n) =
ceil(percent * n / 100)`` elements of a set of size n at least, so under one
global order of the elements two linked sets share the first c of their common
elements within their first ``n - need(n) + c`` elements, for every c.

1. **Pruning.** An element that only one set holds can't be shared, so a set with
   fewer than ``need(n)`` others has no partner. A first round looks at the part
   of each set with the smallest hashes (where a partner shares a stated number),
   later rounds at whole sets of what is left, until a round drops little.
2. **Order.** What stays is ordered by frequency, rarest first, and cut to the first
   ``n - need(n) + 2``. Elements that stand in the same cut sets are one class (they
   lead to the same partners), and those of one cut set alone go.
3. **Light sets** (up to a size) enumerate the subsets of two elements of their cut,
   by class; **heavy sets** scan the inverted lists of their first
   ``n - need(n) + 1``, by class, in which all sets stand. The boundary is the size with the
   least total cost: subsets written against list entries read, summed by size.
4. **Check.** Sets that any chain of subsets or lists connects form a cluster;
   clusters are dealt in units of bounded size (a large cluster as pairs of its
   chunks). In a unit each set's candidates that aren't yet connected with it are
   compared exactly; a unit emits a spanning forest, never all pairs. The forest's
   components are those of all links.

Equal sets are one class, so copies cost one row each and nothing else.

Defined cases: a null or blank text has an empty set and links with nothing;
repeated rows keep their repeats; a component's id is its smallest, null if all its ids are
null; an empty table gives an empty result. Other columns take no part. Texts
are handled in slices of 256 KB, a longer text as one slice of some 60 times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.llm.common import stage
from kaiji.llm.simhash import components
from kaiji.llm.textstats import Slice, slices

UNIT_ELEMENTS = 1_000_000  # elements of one side of a unit
BROADCAST_SETS = 1_000_000  # sets (16 bytes each) up to which the kept ones are broadcast; shuffled beyond
FIRST_SHARE = 5  # percent of a set that must be shared within the part seen by the first round


def need(n, percent: int):
    """Elements of a set of size ``n`` that a partner shares at least; numbers, arrays or columns."""
    if isinstance(n, Column):
        return F.ceil(n * percent / 100).cast("int")
    return -(-percent * n // 100)


# ---- sets -----------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, elements): the distinct shingle hashes of each text, ascending, one text after the other."""
    part = Slice(pc.ascii_lower(texts))
    vocabulary = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer(), 7) for w in part.vocabulary), np.uint64, len(part.vocabulary))
    word = vocabulary[part.code]
    whole = part.n_words < words
    full = max(0, len(word) - words + 1)
    doc, h = part.doc[:full], np.ones(full, np.uint64)
    for step in range(words):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + word[step:step + full])
    inside = doc == part.doc[len(part.doc) - full:]
    doc, h = doc[inside], h[inside]
    if short := np.flatnonzero(whole & (part.n_words > 0)).tolist():  # one shingle each, its length in the seed
        starts = np.searchsorted(part.doc, short)
        one = np.array([xxhash.xxh64_intdigest(word[s:s + n].tobytes(), 100 + n) for s, n in zip(starts, part.n_words[short].tolist())], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, one])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return np.bincount(doc[new], minlength=part.n), h[new]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums (modulo 2^64) of runs of the given sizes."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.view(np.int64)))


def _set_rows(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                sizes, elements = shingle_sets(texts, words)
                first = np.minimum(sizes, sizes - need(sizes, percent) + -(-FIRST_SHARE * sizes // 100))
                spot = np.arange(len(elements)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                in_first = spot < np.repeat(first, sizes)
                sides = [_sums(_mix(elements ^ np.uint64(salt)), sizes) for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)]
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(sizes), [None, pa.py_buffer(np.column_stack(sides).tobytes())])
                yield pa.record_batch([batch.column("id").slice(at, len(texts)), pa.array(sizes.astype(np.int32)), key.cast(pa.binary()),
                                       _lists(elements[in_first], first), _lists(elements[~in_first], sizes - first)],
                                      names=["id", "n", "key", "first", "rest"])

    return run


# ---- pruning and order ----------------------------------------------------

def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by ``h``, whose ``h`` stands in a row beside them; both ends of the task's range count as such."""
    held, alike = [np.zeros(0, np.int64)] * 3, True  # the last row, whose successor isn't known yet; whether its predecessor is alike
    for batch in batches:
        num, least, h = (np.concatenate([a, batch.column(c).to_numpy()]) for a, c in zip(held, ("num", "least", "h")))
        if not len(h):
            continue
        same = h[1:] == h[:-1]
        shared = np.concatenate([[alike], same])
        alike = bool(shared[-1])
        shared[:-1] |= same
        out = np.flatnonzero(shared[:-1])
        yield pa.record_batch([pa.array(num[out], pa.int64()), pa.array(least[out].astype(np.int32))], names=["num", "least"])
        held = [num[-1:], least[-1:], h[-1:]]
    if len(held[0]):
        yield pa.record_batch([pa.array(held[0], pa.int64()), pa.array(held[1].astype(np.int32))], names=["num", "least"])


def _sharing(rows: DataFrame) -> DataFrame:
    """Sets ``num`` that share ``least`` of their elements ``h`` with others.

    Rows move once, in ranges of (h, num), so an element of many sets lies in many tasks.
    An element at an end of a range counts as shared, which only keeps more sets.
    """
    shared = rows.repartitionByRange("h", "num").sortWithinPartitions("h").mapInArrow(_alike, "num long, least int")
    return shared.groupBy("num", "least").count().filter("count >= least").select("num")


def _only(sets: DataFrame, nums: DataFrame) -> DataFrame:
    return sets.join(F.broadcast(nums) if nums.count() <= BROADCAST_SETS else nums, "num", "left_semi")


def _survivors(sets: DataFrame, percent: int) -> DataFrame:
    """One row (num, key, n, items) for each distinct set that the pruning can't rule out."""
    one = stage(sets.filter("n > 0").groupBy("key").agg(F.min("num").alias("num")).select("num"), "sets-nums")  # of equal sets
    share = F.ceil(need(F.col("n"), percent) * FIRST_SHARE / 100).cast("int")  # also of the smallest partner's part
    nums = stage(_sharing(_only(sets, one).select("num", share.alias("least"), F.explode("first").alias("h"))), "sets-nums")
    alive = stage(_only(sets, nums).select("num", "key", "n", F.concat("first", "rest").alias("items")), "sets-kept")
    n = nums.count()
    while n:
        nums = stage(_sharing(alive.select("num", need(F.col("n"), percent).alias("least"), F.explode("items").alias("h"))), "sets-nums")
        was, n = n, nums.count()
        if n < was:
            alive = stage(_only(alive, nums), "sets-kept")
        if n >= 0.9 * was:
            break
    return alive


def _cut(alive: DataFrame, percent: int) -> DataFrame:
    """(num, n, one, two): the shared elements among the first n - need + 1 (and + 2), rarest first, as (df, h)."""
    rows = alive.select("num", "n", F.explode("items").alias("h"))
    held = rows.join(rows.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "h").groupBy("num", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    alone = F.col("n") - F.size("s")  # elements of this set alone come first in the order
    upto = F.col("n") - need(F.col("n"), percent) - alone
    cut = lambda c: F.slice("s", F.lit(1), F.greatest(F.lit(0), upto + c))
    return held.select("num", "n", cut(1).alias("one"), cut(2).alias("two"))


def _classed(cut: DataFrame) -> DataFrame:
    """(num, n, one, two) as of ``_cut`` with the classes of its elements: each once, in ``two`` twice if it has two elements there.

    A class holds the elements of the same lists (cut sets that an element stands in), ``df`` is their length. Two sets that
    share an element, or two, share its class, or both, so none is lost, and a collision of lists only adds to what is compared.
    """
    at = cut.select("num", "n", F.size("one").alias("upto"), F.posexplode("two").alias("pos", "x")).select("num", "n", "upto", "pos", "x.h")
    same = F.xxhash64(F.bit_xor(F.xxhash64(F.lit(1), "num")), F.bit_xor(F.xxhash64(F.lit(2), "num")), F.count("*"))
    lists = at.groupBy("h").agg(F.count("*").alias("df"), same.alias("class")).filter("df > 1")
    found = at.join(lists, "h").groupBy("num", "n", "class").agg(
        F.min("df").alias("df"), (F.min("pos") < F.min("upto")).alias("in_one"), (F.count("*") > 1).alias("twice"))
    item = F.struct("df", F.col("class").alias("h"))
    return found.groupBy("num", "n").agg(F.collect_list(F.when(F.col("in_one"), item)).alias("one"),
                                         F.concat(F.collect_list(item), F.collect_list(F.when(F.col("twice"), item))).alias("two"))


def _ordered(alive: DataFrame, percent: int) -> DataFrame:
    """(num, n, one, two): the classes of elements by which each set may find a partner, as (df, h)."""
    return _classed(stage(_cut(alive, percent), "sets-cut"))


# ---- light and heavy sets -------------------------------------------------

def boundary(ordered: DataFrame) -> int:
    """The size up to which enumerating subsets costs less in total than scanning lists.

    Sizes are summed in bins of an eighth of a power of two: under 300 rows, whatever the input.
    """
    m = F.size("two").cast("double")
    bins = (ordered.groupBy(F.floor(F.log2("n") * 8).alias("bin"))
            .agg(F.max("n").alias("n"), F.sum(m * (m - 1) / 2).alias("light"),
                 F.sum(F.aggregate("one", F.lit(0).cast("long"), lambda a, x: a + x["df"])).alias("heavy")).orderBy("bin").collect())
    best, least = 0, sum(b["heavy"] for b in bins)
    for i, b in enumerate(bins):
        total = sum(x["light"] for x in bins[:i + 1]) + sum(x["heavy"] for x in bins[i + 1:])
        if total < least:
            best, least = b["n"], total
    return best


def _heavy(light_upto: int, percent: int) -> Column:
    """Sets over the boundary, and those that may share one element only with a partner."""
    return (F.col("n") > light_upto) | (need(F.col("n"), percent) < 2)


def _members(ordered: DataFrame, heavy: Column) -> DataFrame:
    """(bucket, num, asks, low): sets in the subsets and lists that connect two of them; ``low`` is a bucket's smallest."""
    pairs = F.array_distinct(F.flatten(F.transform("two", lambda x, i: F.transform(
        F.slice("two", i + 2, F.size("two")), lambda y: F.xxhash64(F.lit(2), F.least(x["h"], y["h"]), F.greatest(x["h"], y["h"]))))))
    subsets = ordered.filter(~heavy).select("num", F.lit(True).alias("asks"), F.explode(pairs).alias("bucket"))
    lists = ordered.select("num", heavy.alias("asks"), F.explode(F.transform("one", lambda x: F.xxhash64(F.lit(1), x["h"]))).alias("bucket"))
    rows = subsets.union(lists)
    good = rows.groupBy("bucket").agg(F.min("num").alias("low"), F.max("num").alias("high"), F.max("asks").alias("asked")).filter("low <> high and asked")
    return stage(rows.join(good.select("bucket", "low"), "bucket"), "sets-members")


# ---- exact check ----------------------------------------------------------

def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of several runs, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def unit_links(num: np.ndarray, side: np.ndarray, heavy: np.ndarray, sizes: np.ndarray, items: np.ndarray, asked: np.ndarray,
               ask: np.ndarray, answered: np.ndarray, answer: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links of one unit join.

    ``items`` are the sets, one after the other; ``ask`` and ``answer`` the buckets in which a
    set looks for partners or only stands, ``asked`` and ``answered`` their numbers per set.
    With two sides only pairs across them count.
    """
    total = len(num)
    cross = side.max() != side.min()
    _, code = np.unique(items, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    bucket = np.concatenate([ask, answer])
    owner = np.concatenate([np.repeat(np.arange(total), asked), np.repeat(np.arange(total), answered)])
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    lo, hi = np.searchsorted(bucket, ask, "left"), np.searchsorted(bucket, ask, "right")
    ask_at = np.concatenate([[0], np.cumsum(asked)])
    label, mark = np.arange(total), np.zeros(int(code.max()) + 1, bool)
    us, vs = [], []
    for u in range(total):
        of = slice(ask_at[u], ask_at[u + 1])
        if not asked[u] or (hi[of] - lo[of] < 2).all():
            continue
        near = np.zeros(total, bool)
        near[owner[_ranges(lo[of], hi[of] - lo[of])]] = True
        near &= (label != label[u]) & (100 * np.minimum(sizes, sizes[u]) >= percent * np.maximum(sizes, sizes[u]))
        near[:u] &= heavy[:u] != heavy[u]  # of two sets that both ask, the first does
        if cross:
            near &= side != side[u]
        v = np.flatnonzero(near)
        if not len(v):
            continue
        own = code[starts[u]:starts[u] + sizes[u]]
        mark[own] = True
        common = np.add.reduceat(mark[code[_ranges(starts[v], sizes[v])]].astype(np.int64), np.cumsum(sizes[v]) - sizes[v])
        mark[own] = False
        v = v[100 * common >= percent * (sizes[u] + sizes[v] - common)]
        if len(v):
            labels, where = np.unique(label[v], return_index=True)
            us.append(np.full(len(labels), num[u]))
            vs.append(num[v[where]])
            label[np.isin(label, labels)] = label[u]
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _check_units(percent: int):
    def values(lists: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists])
        return sizes, np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        flat = [np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in ("num", "side", "heavy")]
        lists = [x for c in ("items", "ask", "answer") for x in values([p.column(c) for p in parts])]
        u, v = unit_links(*flat, *lists, percent)
        return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:  # sorted by unit
            unit = batch.column("unit").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if unit[lo] != now and held:
                        yield links(held)
                        held = []
                    now = unit[lo]
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield links(held)

    return run


def _checked(alive: DataFrame, ordered: DataFrame, light_upto: int, percent: int, unit_elements: int) -> DataFrame:
    """Edges (u, v) whose closure is that of all links between the sets."""
    heavy = _heavy(light_upto, percent)
    members = _members(ordered, heavy)
    roots = components(members.filter("num <> low").select(F.col("num").alias("u"), F.col("low").alias("v")).distinct())
    buckets = members.groupBy("num").agg(F.collect_list(F.when(F.col("asks"), F.col("bucket"))).alias("ask"),
                                         F.collect_list(F.when(~F.col("asks"), F.col("bucket"))).alias("answer"))
    sets = alive.join(buckets, "num").join(roots, F.col("num") == F.col("node"), "left").select(
        "num", "n", "items", "ask", "answer", F.coalesce("root", "num").alias("cluster"))
    sets = stage(sets, "sets-checked")
    chunks = sets.groupBy("cluster").agg(F.ceil(F.sum("n") / unit_elements).cast("int").alias("chunks")).filter("chunks > 1")
    chunk = F.pmod(F.xxhash64("num"), F.col("chunks")).cast("int")
    dealt = sets.join(stage(chunks, "sets-chunks"), "cluster", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = dealt.select(F.xxhash64("cluster", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit"), "num",
                         (F.col("chunk") > F.col("other")).cast("int").alias("side"), heavy.alias("heavy"),
                         "items", "ask", "answer")
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_check_units(percent), "u long, v long")


# ---- operator -------------------------------------------------------------

def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85,
                 light_upto: int | None = None, unit_elements: int = UNIT_ELEMENTS) -> DataFrame:
    """(id, n_shingles, component_id) for each row; ``light_upto`` sets the boundary instead of its cost."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = rows.mapInArrow(_set_rows(words, percent), "id long, n int, key binary, first array<long>, rest array<long>")
    sets = stage(sets.withColumn("num", F.monotonically_increasing_id()), "sets")  # numbered once, by the written rows
    alive = _survivors(sets, percent)
    ordered = stage(_ordered(alive, percent), "sets-ordered")
    edges = _checked(alive, ordered, boundary(ordered) if light_upto is None else light_upto, percent, unit_elements)
    classes = sets.filter("n > 0").groupBy("key").agg(F.min("id").alias("least"))
    linked = components(edges).join(alive.select("num", "key"), F.col("node") == F.col("num")).select("key", "root")
    linked = linked.union(linked.select("root").distinct().join(alive.select("num", "key"), F.col("root") == F.col("num")).select("key", "root"))
    linked = stage(linked.join(classes, "key"), "sets-linked")
    joined = linked.join(linked.groupBy("root").agg(F.min("least").alias("component")), "root").select("key", "component")
    classes = classes.join(joined, "key", "left").select("key", F.coalesce("component", "least").alias("component"))
    out = sets.filter("n > 0").select("id", "n", "key").join(classes, "key").select("id", "n", "component")
    out = out.union(sets.filter("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
