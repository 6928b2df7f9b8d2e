"""Order-free digests of row groups: compare two sides group by group before any row is joined.

A digest holds the number of rows, the exclusive or and the exact sum of their
64-bit hashes. It is one partial aggregate, so no row moves for it, whatever
the size of a group. Sides with the same digest hold the same rows (up to two
colliding in all of it); only groups that differ need a join of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.operators.audit import DRIFT_FIELDS, bin_audit, drift
from kaiji.session import work_dir
from kaiji.sinks.tables import write_table

LOW = 0xFFFFFFFF


def row_digest(*cols: str | Column) -> list[Column]:
    """Aggregates (n, mixed, low, high) over the hashes of ``cols``; nulls count as a value, repeats count each.

    The sum is kept in two halves, so it is exact up to 2^31 rows a group and raises beyond instead of wrapping."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    # a null hashes as if it weren't there, so its place is hashed as well
    h = F.xxhash64(*cols, *[c.isNull() for c in cols])
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("mixed"), F.sum(h.bitwiseAND(F.lit(LOW))).alias("low"),
            F.sum(F.shiftrightunsigned(h, 32)).alias("high")]


def differing_groups(left: DataFrame, right: DataFrame, group: str, *cols: str | Column, always: Column | None = None) -> DataFrame:
    """Values of ``group`` whose rows of ``cols`` differ between two sides, those of one side alone included,
    and those with a row that ``always`` holds for.

    Written to the shared folder: Spark then knows the size of the list, which decides how it is joined."""
    odd = F.bool_or(F.lit(False) if always is None else always)
    a, b = (d.groupBy(F.col(group).alias(f"_{side}")).agg(odd.alias(f"_odd_{side}"), F.struct(*row_digest(*cols)).alias(f"_rows_{side}"))
            for d, side in ((left, "a"), (right, "b")))
    both = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
    differs = ~F.col("_rows_a").eqNullSafe(F.col("_rows_b")) | F.coalesce("_odd_a", F.lit(False)) | F.coalesce("_odd_b", F.lit(False))
    out = both.filter(differs).select(F.coalesce("_a", "_b").alias(group))
    path = work_dir(left.sparkSession, "differing")
    write_table(out, path)
    return left.sparkSession.read.schema(out.schema).parquet(path)


def _within(df: DataFrame, group: str, groups: DataFrame) -> DataFrame:
    listed = groups.select(F.col(group).alias("_group"))
    return df.join(listed, df[group].eqNullSafe(listed["_group"]), "left_semi")


def bin_audit_by_digest(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """M8 / J11 as ``bin_audit``, but only bins whose digests differ are joined document by document.

    Repeated rows make a bin differ, which costs its join and changes no result. A document without
    a bin or an id matches nothing there, so its bin is joined whatever its digests."""
    sides = [d.select("bin_id", "doc_id") for d in (expected, actual)]
    groups = differing_groups(*sides, "bin_id", "doc_id", always=F.col("bin_id").isNull() | F.col("doc_id").isNull())
    return bin_audit(*[_within(d, "bin_id", groups) for d in sides])


def drift_by_digest(catalog: DataFrame, api: DataFrame, day: str, fields=DRIFT_FIELDS, id_col: str = "doc_id") -> DataFrame:
    """M9 / J10 as ``drift`` for tables of one row an id: only days whose digests differ are joined.

    A filing whose day itself drifted stands in two days, both of which differ. Fields are digested as
    ``drift`` compares them, so blanks that it takes for equal don't make a day differ."""
    texts = [F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) for f in fields]
    texts = [F.when(t.isin("", "0", "None"), "").otherwise(t) if f == "withdrawal_status" else t for f, t in zip(fields, texts)]
    keep = [id_col, *fields]
    sides = [d.select(F.col(day).cast("string").alias("_day"), *keep) for d in (catalog, api)]
    groups = differing_groups(*sides, "_day", id_col, *texts)
    return drift(*[_within(d, "_day", groups).select(*keep) for d in sides], fields, id_col)
