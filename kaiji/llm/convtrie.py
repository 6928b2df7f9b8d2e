"""Prefix trie of conversations by SQL ROLLUP over positional turn columns.

A conversation is a sequence of turns; each distinct sequence of its first d
turns is a node of depth d. Turns get content ids, ``BLOCK`` turns make one row
with a column for each position, and one ``ROLLUP`` over those columns
aggregates all prefixes of a block together; ``grouping_id`` tells the depth.
Long conversations continue in further rows, keyed by the node that their prior block
ends in. That key is a sum of 64-bit hashes of (position, turn id), kept twice with different
seeds, so it comes from running sums and no block waits for another.

Each node belongs to its smallest member, so a member's nodes are a path (its
chain) that hangs off another chain. Sums over subtrees are suffix sums along
the chains plus the totals of the chains that hang there; totals go up the chains
round by round, one row a chain, until they reach the root.

Positions and sums within a conversation run over sampled ranges of (conversation, position)
with the totals of earlier ranges added, so one conversation may hold any share of all rows. The
ids that end in a node are joined to text in such ranges first and hashed as a stream after.

Defined cases: rows without a conversation id take no part; turns sort by number, null first, then by
role and text; null role or text is empty; a conversation without turns belongs to the root
alone; repeated rows are turns of their own; an empty table has no nodes, not even the root.
Other columns take no part. A turn's text is one value, hashed where it is read and not
moved; ids of turns are MD5 sums of role and text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaiji.llm.common import stage

BLOCK = 8  # turns of a row
CHUNK_IDS = 4096  # ids joined to one text


def running(df: DataFrame, key: str, order: list[str], sums: dict[str, str], name: str, rows_per_range: int = 1_000_000) -> DataFrame:
    """Add to each row the sums ``{out: value column}`` over the rows of its key up to it, in ``order``.

    Runs inside sampled ranges of (key, order), staged with their number; earlier ranges that
    hold the same key add their sums, one row per key and range. ``order`` is total within a key.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_range))
    ranged = stage(df.repartitionByRange(n, key, *order).withColumn("_range", F.spark_partition_id()), name)
    parts = ranged.groupBy(key, "_range").agg(*[F.sum(v).alias(f"_{o}") for o, v in sums.items()])
    # a key in one range only has nothing before it; few keys lie in several
    split = parts.groupBy(key).agg(F.min("_range").alias("lo"), F.max("_range").alias("hi")).filter("lo < hi").select(key)
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.join(split, key).select(key, "_range", *[F.coalesce(F.sum(f"_{o}").over(earlier), F.lit(0)).alias(f"_{o}") for o in sums])
    inside = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged
    for o, v in sums.items():
        out = out.withColumn(o, F.sum(v).over(inside))
    out = out.join(stage(before, name + "-before"), [key, "_range"], "left")
    for o in sums:
        out = out.withColumn(o, F.col(o) + F.coalesce(f"_{o}", F.lit(0).cast("long")))
    return out.drop("_range", *[f"_{o}" for o in sums])


def positioned(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id): turns numbered from 1; an id holds the MD5 of role and text and the text's bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    md5 = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.concat_ws(":", F.octet_length(text).cast("string"), md5).alias("turn_id"), F.lit(1).cast("long").alias("one"))
    # equal turn numbers sort by content, so the order is total but for equal rows
    numbered = running(rows.withColumn("tie", F.xxhash64("turn_id")), "conv_id", ["turn", "tie", "turn_id"], {"pos": "one"}, "trie-turns")
    return numbered.select("conv_id", "pos", "turn_id")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: the first h turns of conversation c - c % 5, then c's own after its first h.

    Returns (conv_id) of all conversations and their (conv_id, pos, turn_id).
    """
    sizes = stage(numbered.groupBy("conv_id").agg(F.max("pos").alias("size")), "trie-sizes")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))
    plan = sizes.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    plan = plan.join(sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0).cast("long")))).drop("base_size")
    plan = stage(plan, "trie-plan")
    first = numbered.filter("pos <= 8").select(F.col("conv_id").alias("base"), "pos", "turn_id")
    heads = plan.join(first, "base").filter("pos <= taken").select("conv_id", "pos", "turn_id")
    tails = numbered.join(plan, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id")
    return sizes.select("conv_id"), heads.union(tails)


def _term(pos: Column, turn_id: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), pos, turn_id)


def _wrapped(*values: Column) -> Column:
    """Sum modulo 2^64 of longs, as a long: halves are added apart, so ANSI mode sees no overflow."""
    low = sum((v.bitwiseAND(F.lit(0xFFFFFFFF)) for v in values[1:]), values[0].bitwiseAND(F.lit(0xFFFFFFFF)))
    high = sum((F.shiftrightunsigned(v, 32) for v in values[1:]), F.shiftrightunsigned(values[0], 32)) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF)))


HALVES = ["al", "ah", "bl", "bh"]  # 32-bit halves of the two key hashes: their sums stay far below 2^63


def _halves(pos: Column, turn_id: Column) -> list[Column]:
    return [part for seed in (1, 2) for h in [_term(pos, turn_id, seed)]
            for part in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]


def _key(low: Column, high: Column) -> Column:
    """The 64-bit sum that two sums of halves stand for."""
    return _wrapped(low, F.shiftleft(high.bitwiseAND(F.lit(0xFFFFFFFF)), 32))


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, block, a, b, t1 .. t8, len): rows of positional turn ids and the key of the prior block's node.

    Conversations without turns have block 0 with null columns.
    """
    pos = F.col("pos")
    spot = ((pos - 1) % BLOCK + 1).cast("int")
    cells = turns.withColumn("block", F.expr(f"(pos - 1) div {BLOCK}")).withColumn("spot", spot)
    for name, value in zip(HALVES, _halves(pos, F.col("turn_id"))):
        cells = cells.withColumn(name, value)
    rows = cells.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("spot") == i, F.col("turn_id"))).alias(f"t{i}") for i in range(1, BLOCK + 1)],
        F.max("spot").alias("len"), *[F.sum(h).alias(h) for h in HALVES])
    summed = running(rows, "conv_id", ["block"], {f"s{h}": h for h in HALVES}, "trie-blocks")
    prior = [F.col(f"s{h}") - F.col(h) for h in HALVES]
    cols = [f"t{i}" for i in range(1, BLOCK + 1)]
    full = summed.select("conv_id", "block", _key(prior[0], prior[1]).alias("a"), _key(prior[2], prior[3]).alias("b"), *cols, "len",
                         _key(F.col("sal"), F.col("sah")).alias("end_a"), _key(F.col("sbl"), F.col("sbh")).alias("end_b"))
    none = F.lit(0).cast("long")
    without = convs.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", none.alias("block"), none.alias("a"), none.alias("b"), *[F.lit(None).cast("string").alias(c) for c in cols],
        F.lit(0).alias("len"), none.alias("end_a"), none.alias("end_b"))
    return stage(full.union(without), "trie-rows")


def prefixes(rows: DataFrame) -> DataFrame:
    """One row per node: (a, b, depth, up_a, up_b, conv_id, n_convs, bytes) from one ROLLUP per set of blocks."""
    spark = rows.sparkSession
    cols = [f"t{i}" for i in range(1, BLOCK + 1)]
    rolled = spark.sql(f"""
        SELECT block, a, b, {', '.join(cols)}, {BLOCK} - bit_count(grouping_id()) AS level,
               min(conv_id) AS conv_id, count(*) AS n_convs
        FROM {{rows}} GROUP BY block, a, b, ROLLUP({', '.join(cols)})""", rows=rows)
    level, block = F.col("level"), F.col("block")
    last = F.element_at(F.array(*cols), F.greatest(level, F.lit(1)))  # null beyond a conversation's end: not a node
    real = ((level == 0) & (block == 0)) | ((level > 0) & last.isNotNull())
    place = lambda i: block * BLOCK + i
    terms = lambda seed, upto: [F.when(upto >= i, _term(place(F.lit(i)), F.col(c), seed)).otherwise(F.lit(0).cast("long")) for i, c in enumerate(cols, 1)]
    nodes = rolled.filter(real)
    return nodes.select(
        _wrapped(F.col("a"), *terms(1, level)).alias("a"), _wrapped(F.col("b"), *terms(2, level)).alias("b"), place(level).alias("depth"),
        _wrapped(F.col("a"), *terms(1, level - 1)).alias("up_a"), _wrapped(F.col("b"), *terms(2, level - 1)).alias("up_b"), "conv_id", "n_convs",
        F.when(level > 0, F.substring_index(last, ":", 1).cast("long")).otherwise(F.lit(0).cast("long")).alias("bytes"))


# ---- subtrees -------------------------------------------------------------

def _chain_totals(chains: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over each chain (conv_id, parent) and all that hang off it, directly or not."""
    up = chains.select("conv_id", "parent")
    now = stage(chains.select("conv_id", *values), "trie-up")
    found = now
    while True:
        # what a chain passes on goes to the chain it hangs off, summed there before the next round
        now = stage(now.join(up, "conv_id").filter("parent is not null").groupBy(F.col("parent").alias("conv_id"))
                    .agg(*[F.sum(v).alias(v) for v in values]), "trie-up")
        if now.isEmpty():
            break
        found = found.union(now)
    return found.groupBy("conv_id").agg(*[F.sum(v).alias(v) for v in values])


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, depth, member) rows as texts of up to ``CHUNK_IDS`` comma-joined members of one node."""
    now, held = None, []

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([held[0]], pa.int64()),
                                pa.array([",".join(map(str, held))])], names=["conv_id", "depth", "first", "ids"])

    for batch in batches:
        for conv, depth, member in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "member"))):
            if held and (now != (conv, depth) or len(held) >= CHUNK_IDS):
                yield row()
                held = []
            now = (conv, depth)
            held.append(member)
    if held:
        yield row()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its texts in the order of ``first``, as a stream."""
    now, state, out = None, None, []
    for batch in batches:
        for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if now == (conv, depth):
                state.update(b"," + ids.encode())
            else:
                if state is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (conv, depth), hashlib.sha256(ids.encode())
        if len(out) >= 1000:
            yield _table(out)
            out = []
    if state is not None:
        out.append((*now, state.hexdigest()))
    if out:
        yield _table(out)


def _table(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "sha"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, sha): SHA-256 of the comma-joined ascending members of each (conv_id, depth).

    Members become texts in sampled ranges, so what meets in one task for a node is
    a ``CHUNK_IDS``-th of its members in rows, read as a stream.
    """
    n = max(ends.sparkSession.sparkContext.defaultParallelism, -(-ends.count() // 1_000_000))
    ranged = ends.repartitionByRange(n, "conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member")
    texts = stage(ranged.mapInArrow(_id_texts, "conv_id long, depth long, first long, ids string"), "trie-ids")
    return (texts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
            .mapInArrow(_digests, "conv_id long, depth long, sha string"))


# ---- operator -------------------------------------------------------------

def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the conversations ``convs`` (conv_id) with turns (conv_id, pos from 1, turn_id).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    rows = blocks(convs, turns)
    nodes = stage(prefixes(rows), "trie-nodes")
    # a node under its own smallest member continues that chain; other nodes start one, and need their parent's
    long0 = F.lit(0).cast("long")
    tops = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"), F.min_by(F.struct("up_a", "up_b"), "depth").alias("up"))
    at = nodes.select(F.col("a").alias("at_a"), F.col("b").alias("at_b"), F.col("depth").alias("at_depth"), F.col("conv_id").alias("parent"))
    chains = stage(tops.join(at, (F.col("up.up_a") == F.col("at_a")) & (F.col("up.up_b") == F.col("at_b")) & (F.col("depth") - 1 == F.col("at_depth")), "left")
                   .select("conv_id", "depth", "parent"), "trie-chains")
    length = nodes.groupBy("conv_id").agg(F.max("depth").alias("end"))
    hung = chains.filter("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("hung"))
    own = (nodes.select("conv_id", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
           .join(length, "conv_id").join(hung, ["conv_id", "depth"], "left")
           .withColumn("n_children", F.coalesce("hung", long0) + F.when(F.col("depth") < F.col("end"), 1).otherwise(0)))
    own = stage(own.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "trie-own")
    values = ["leaf", "saved"]
    sums = own.groupBy("conv_id").agg(*[F.sum(v).alias(v) for v in values])
    totals = stage(_chain_totals(chains.join(sums, "conv_id"), values), "trie-totals")
    added = (chains.filter("parent is not null").join(totals, "conv_id").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
             .agg(*[F.sum(v).alias(f"add_{v}") for v in values]))
    full = own.join(added, ["conv_id", "depth"], "left")
    for v in values:
        full = full.withColumn(v, F.col(v) + F.coalesce(f"add_{v}", long0))
    full = full.select("conv_id", "depth", (-F.col("depth")).alias("up"), "n_convs", "n_children", *values)
    summed = running(full, "conv_id", ["up"], {"n_leaves": "leaf", "saved_tokens": "saved"}, "trie-sums")
    # the conversations that end in a node, found by the key of their last block
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("end_a", "end_b", (F.col("block") * BLOCK + F.col("len")).alias("at")), "block").alias("e"))
    where = nodes.select("a", "b", F.col("depth"), F.col("conv_id").alias("node"))
    ends = last.join(where, (F.col("e.end_a") == F.col("a")) & (F.col("e.end_b") == F.col("b")) & (F.col("e.at") == F.col("depth"))).select(
        F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    digests = end_digests(stage(ends, "trie-ends"))
    up = chains.select("conv_id", F.col("depth").alias("top"), "parent")
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent"))
    out = summed.join(up, "conv_id").join(digests, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.col("n_children").cast("long").alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
