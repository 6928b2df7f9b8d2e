"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard s bids ``-ln(u) / weight`` for a record, u being a uniform number
hashed from the record's key and s; the smallest bid takes the record. A bid
doesn't depend on the other shards, so one more shard takes rows only into
itself: about its share of the weights. Only the key and the shard list decide.

Defined cases: a null key is a key of its own (all such rows go to one shard);
a null text has no bytes and the CRC of none; equal keys share a shard; repeated
rows stay and get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.llm.common import running_totals, stage


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to len(weights) - 1) of a key column of any type; as text, so 7 and '7' are equal keys."""
    text = key.cast("string")
    bids = []
    for shard, weight in enumerate(weights):
        uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(shard), text), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        bids.append(F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard")))
    return bids[0]["shard"] if len(bids) == 1 else F.least(*bids)["shard"]


def assign(docs: DataFrame, id_col: str, text_col: str, weights: list[float], added: float = 1.0) -> DataFrame:
    """(id, size, crc, shard, grown_shard, slot): slots count from 0 in each shard, without gaps.

    ``size``: UTF-8 bytes plus 1; ``grown_shard``: with one more shard of weight ``added``.
    Slots follow the hash of the key; they come from range-partitioned running counts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"), rendezvous(F.col(id_col), weights).alias("shard"),
        rendezvous(F.col(id_col), [*weights, added]).alias("grown_shard")), "shards")
    counts = dict(rows.groupBy("shard").count().collect())  # one row per shard of the list
    before, total = [], 0
    for shard in range(len(weights)):
        before.append(F.lit(total).cast("long"))
        total += counts.get(shard, 0)
    order = F.struct("shard", F.xxhash64(F.col("id").cast("string")), "id", "crc", "size")
    ranked = running_totals(rows.withColumn("order", order).withColumn("one", F.lit(1).cast("long")), "order", "one", "rank", "slots")
    slot = F.col("rank") - 1 - F.element_at(F.array(*before), F.col("shard") + 1)
    return ranked.select("id", "size", "crc", "shard", "grown_shard", slot.alias("slot"))
