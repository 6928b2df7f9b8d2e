"""Connected groups of company records (a check beside G6 in M1).

G6 takes its three keys in a fixed order, once each, so records that only a
chain of keys connects may keep different identities. Here the key graph is
closed to the fixed point, and groups that the ordered passes leave split are reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaiji.operators.digest import row_digest
from kaiji.session import checkpoint_dir

IDENTITY_KEYS = ("jcn", "edinet_code", "code")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); ``root`` is the smallest node of its component.

    Large-star and small-star rounds in turn: each hangs a node's neighbours on the smallest of them. The
    number of rounds grows with the logarithm of the longest chain, a star's neighbours are never gathered
    (one aggregate and one join a round), and every round is a checkpoint."""
    checkpoint_dir(edges.sparkSession)

    def least(rows: DataFrame) -> DataFrame:  # rows (node, near)
        return rows.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("root"))

    def state(rows: DataFrame):  # equal states have equal edges
        return rows.agg(*row_digest("u", "v")).first()

    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    while True:
        both = e.select(F.col("u").alias("node"), F.col("v").alias("near")).union(e.select("v", "u"))
        large = both.join(least(both), "node").filter("near > node").select(F.col("near").alias("u"), F.col("root").alias("v"))
        large = large.distinct().checkpoint()
        down = large.select(F.col("u").alias("node"), F.col("v").alias("near"))
        roots = least(down)
        small = down.join(roots, "node").filter("near <> root").select(F.col("near").alias("u"), F.col("root").alias("v"))
        new = small.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))).distinct().checkpoint()
        done, e = state(new) == state(e), new
        if done:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def split_identities(keyed: DataFrame) -> DataFrame:
    """Identities of groups of connected records that hold several: (group_key, identity_key, n_records, n_identities).

    ``keyed`` are the rows of ``identity_keys``. A record connects its key values, each tagged with its kind;
    ``group_key`` is the smallest tagged value of the group, ``n_identities`` the group's number of identities."""
    tagged = [F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(k))) for i, k in enumerate(IDENTITY_KEYS)]
    rows = keyed.select("identity_key", F.array_compact(F.array(*tagged)).alias("_keys")).filter(F.size("_keys") > 0)
    rows = rows.groupBy("identity_key", "_keys").agg(F.count(F.lit(1)).alias("n"))  # equal records once
    roots = connected(rows.select(F.col("_keys")[0].alias("u"), F.explode("_keys").alias("v")))
    first = rows.select("identity_key", "n", F.col("_keys")[0].alias("_first"))
    grouped = first.join(roots, F.col("_first") == F.col("node"), "left").withColumn("group_key", F.coalesce("root", "_first"))
    per_id = grouped.groupBy("group_key", "identity_key").agg(F.sum("n").alias("n_records"))
    split = per_id.groupBy("group_key").agg(F.count(F.lit(1)).alias("n_identities")).filter("n_identities > 1")
    return per_id.join(split, "group_key")
