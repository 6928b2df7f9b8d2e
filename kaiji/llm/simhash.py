"""SimHash near-duplicate groups found with BK-trees.

A fingerprint is 64 bits; two link when they differ in at most ``max_bits``.
With ``max_bits + 2`` blocks of bits, linked fingerprints agree in two blocks
at least, so each fingerprint goes to one shard per pair of blocks and every
link shows in some shard. A shard is searched with a BK-tree (children keyed by
their Hamming distance to the parent; a query follows only the edges within
``max_bits`` of its own distance). Trees are flat numpy arrays, and all shards
of a batch are built and searched level by level at once.

A shard over ``tree_size`` fingerprints becomes several trees, and each of its
blocks of queries meets each tree as a unit of its own: no shard is cut, and no
task or group holds more than one unit and one batch. A unit emits a spanning
forest of its links, not all pairs; components come from alternating large-star
and small-star steps over those edges, each step written to the shared folder.

Defined cases: a null or empty text has no words and the fingerprint zero, and
links like any other; texts with fewer words than the shingle length have one
shingle; repeated rows keep their repeats in the result; an empty table gives an
empty result; a component whose ids are all null has a null id. Other columns
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.llm.common import fresh, row_hash, stage

SEED = 42
BITS = 64


# ---- fingerprints ---------------------------------------------------------

def text_fingerprint(text: bytes, shingle_words: int) -> int:
    """SimHash of one UTF-8 text (A-Z lower-cased; words between ASCII white space)."""
    words = text.lower().split()  # bytes: ASCII only, splits at \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    total, counts = len(words) - shingle_words + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, 1 << 16):
        upto = min(total, at + (1 << 16))
        spans = zip(starts[at:upto].tolist(), ends[at + shingle_words - 1:upto + shingle_words - 1].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int) -> Column:
    """The fingerprint of a text column as a (signed) long."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        out = np.fromiter((text_fingerprint((t.as_py() or "").encode(), shingle_words) for t in texts), "<u8", len(texts))
        return pa.array(out.view(np.int64))

    return simhash(text)


# ---- BK-trees -------------------------------------------------------------

def bk_forest(unit: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over ``fps``, one for each run of equal ``unit`` (sorted; fps distinct in a unit).

    Returns the root of each node's tree, and the edges as sorted codes
    ``parent * 65 + distance`` with the child of each.
    """
    n = len(fps)
    first = np.concatenate([[True], unit[1:] != unit[:-1]]) if n else np.zeros(0, bool)
    root = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    active, at = np.flatnonzero(~first), root[~first]
    codes, children = [], []
    while len(active):
        code = at * (BITS + 1) + np.bitwise_count(fps[active] ^ fps[at]).astype(np.int64)
        edges, where, inverse = np.unique(code, return_index=True, return_inverse=True)
        codes.append(edges)
        children.append(active[where])
        at = active[where][inverse]
        stays = np.ones(len(active), bool)
        stays[where] = False
        active, at = active[stays], at[stays]
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    child = np.concatenate(children) if children else np.zeros(0, np.int64)
    order = np.argsort(code)
    return root, code[order], child[order]


def bk_search(queries: np.ndarray, roots: np.ndarray, fps: np.ndarray, code: np.ndarray, child: np.ndarray,
              radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query position, node) within ``radius``, level by level."""
    q, node = np.arange(len(queries)), roots
    while len(q):
        d = np.bitwise_count(queries[q] ^ fps[node]).astype(np.int64)
        near = d <= radius
        yield q[near], node[near]
        lo = np.searchsorted(code, node * (BITS + 1) + np.maximum(d - radius, 0), "left")
        hi = np.searchsorted(code, node * (BITS + 1) + np.minimum(d + radius, BITS), "right")
        width = hi - lo
        q = np.repeat(q, width)
        node = child[np.repeat(lo - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest labels after joining the groups of ``a`` and ``b`` pairwise."""
    while len(a):
        la, lb = label[a], label[b]
        if not (differ := la != lb).any():
            break
        a, b, low = a[differ], b[differ], np.minimum(la, lb)[differ]
        np.minimum.at(label, la[differ], low)
        np.minimum.at(label, lb[differ], low)
        while (label[label] != label).any():
            label = label[label]
    return label


def forest_links(unit: np.ndarray, asks: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links of each unit join. Rows are sorted by unit.

    ``asks``: 0 for a row that is in the tree and asks it, 1 for a row only in
    the tree, 2 for a row that only asks.
    """
    in_tree = np.flatnonzero(asks < 2)
    root, code, child = bk_forest(unit[in_tree], fps[in_tree])
    starts = np.searchsorted(unit[in_tree], unit, "left")
    has = (starts < len(in_tree)) & (asks != 1)
    has[has] = unit[in_tree][starts[has]] == unit[has]
    rows = np.flatnonzero(has)
    sizes = np.searchsorted(unit[in_tree], unit[rows], "right") - starts[rows]
    rows, starts = rows[sizes > (asks[rows] == 0)], starts[rows][sizes > (asks[rows] == 0)]
    sizes = sizes[sizes > (asks[np.flatnonzero(has)] == 0)]
    label = np.arange(len(fps))
    blocks = np.cumsum(sizes) // 1_000_000  # bounds what a level of the search can hold
    for cut in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(blocks)) + 1) if len(rows) else []:
        for q, node in bk_search(fps[rows[cut]], root[starts[cut]], fps[in_tree], code, child, radius):
            label = _merge(label, rows[cut][q], in_tree[node])
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _search_units(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: list[np.ndarray]) -> pa.RecordBatch:
            a, b = forest_links(rows[0], rows[1], rows[2].view(np.uint64), radius)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        for batch in batches:  # sorted by unit; the last unit of a batch may go on in the next
            part = [np.array(batch.column(c)) for c in range(3)]
            held = [np.concatenate(x) for x in zip(held, part)] if held else part
            if len(held[0]) and (upto := np.searchsorted(held[0], held[0][-1], "left")):
                yield links([x[:upto] for x in held])
                held = [x[upto:] for x in held]
        if held and len(held[0]):
            yield links(held)

    return run


def shard_keys(fp: Column, max_bits: int) -> list[Column]:
    """One shard number for each pair of bit blocks; linked fingerprints share one at least."""
    n = max_bits + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    block = [F.shiftrightunsigned(F.shiftleft(fp, BITS - cuts[i + 1]), BITS - cuts[i + 1] + cuts[i]) for i in range(n)]
    return [F.xxhash64(F.lit(a * n + b), block[a], block[b]) for a, b in combinations(range(n), 2)]


def links(fps: DataFrame, max_bits: int = 3, tree_size: int = 4096) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is that of all links.

    ``fps`` has the distinct fingerprints in a long column ``fp``.
    """
    keyed = fps.select("fp", F.explode(F.array(*shard_keys(F.col("fp"), max_bits))).alias("shard"))
    large = stage(keyed.groupBy("shard").count().filter(F.col("count") > tree_size)
                  .select("shard", F.ceil(F.col("count") / tree_size).cast("int").alias("trees")), "simhash-large")
    chunk = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("trees") - 1))
    split = keyed.join(large, "shard").withColumn("chunk", chunk).withColumn("other", other).select(
        F.xxhash64("shard", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit"),
        F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).alias("asks"), "fp")
    whole = keyed.join(large, "shard", "left_anti").select(F.col("shard").alias("unit"), F.lit(0).alias("asks"), "fp")
    units = whole.union(split).repartition("unit").sortWithinPartitions("unit")
    return units.mapInArrow(_search_units(max_bits), "u long, v long")


# ---- components -----------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that isn't the root of its component.

    Alternating large-star and small-star steps until nothing changes; each
    takes minima with partial aggregation, and no neighbour list is collected.
    """
    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")

    edges, seen = stage(down(edges).distinct(), "links"), None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = down(large).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select("u", "m")).distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


# ---- operator -------------------------------------------------------------

def _grouped(ids: DataFrame, order: list[str], max_bits: int, tree_size: int) -> DataFrame:
    """(fp, first): for each fingerprint the smallest ``order`` struct of its component."""
    fps = stage(ids.groupBy("fp").agg(F.min(F.struct(*order)).alias("first")), "simhash-fps")
    roots = components(links(fps.select("fp"), max_bits, tree_size))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(first, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 3, tree_size: int = 4096) -> DataFrame:
    """(id, fingerprint, component_id) for each row; the id of a component is its smallest."""
    ids = stage(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle_words).alias("fp")), "simhash")
    known = ids.select("fp", F.col("id").isNull().alias("none"), "id")  # null ids come last
    first = _grouped(known, ["none", "id"], max_bits, tree_size)
    return ids.join(first, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        F.col("first.id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
             max_bits: int = 3, tree_size: int = 4096) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that with the smallest id."""
    key, dup = fresh("row_key", docs), fresh("row_id", docs)
    ids = stage(docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("key"),
                            fingerprint(F.col(text_col), shingle_words).alias("fp")), "simhash")
    first = _grouped(ids.withColumn("none", F.col("id").isNull()), ["none", "id", "key"], max_bits, tree_size)
    kept = first.select(F.col("first.key").alias(key), F.col("first.id").alias(dup)).distinct()
    rows = docs.withColumn(key, row_hash(docs))
    return (rows.join(kept, (rows[key] == kept[key]) & rows[id_col].eqNullSafe(kept[dup]), "left_semi")
            .dropDuplicates([id_col, key]).drop(key))
