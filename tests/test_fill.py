"""The forward fill samples its rows once and finds ranges by single comparisons."""

import bisect

from pyspark.sql import functions as F

from conftest import SF_SMALL
from kaiji.operators import facts as FT


def test_a_bucket_is_the_number_of_borders_at_or_before(spark):
    cuts = [sorted([3 * i, "x"] for i in range(n)) for n in (0, 1, 2, 7, 8, 100)]
    data = [(at, t, i) for at in range(-1, 310, 4) for t in ("w", "x", None) for i in range(len(cuts))]
    rows = spark.createDataFrame(data, "a int, t string, i int").join(
        spark.createDataFrame([*enumerate(cuts), (9, None)], "i int, cuts array<struct<a:int,t:string>>"), "i")
    rows = rows.withColumn("at", F.struct("a", "t"))
    got = rows.select("a", "t", "i", FT.bucket_of("at", "cuts", 100).alias("most"), FT.bucket_of("at", "cuts").alias("any")).collect()
    assert len(got) == len(data)
    for r in got:
        want = bisect.bisect_right([(a, t) for a, t in cuts[r["i"]]], (r["a"], r["t"] or ""))  # a null comes first
        assert r["most"] == r["any"] == want
    none = rows.limit(1).withColumn("nothing", F.lit(None).cast("array<struct<a:int,t:string>>"))
    assert none.select(FT.bucket_of("at", "nothing").alias("b")).first()["b"] == 0


def test_both_fills_share_one_sample(spark, monkeypatch):
    from kaiji.plans import facts as P
    taken, sample = [], FT.range_sample
    monkeypatch.setattr(FT, "range_sample", lambda *a: taken.append(1) or sample(*a))
    P.q_fact_ffill(spark, SF_SMALL)
    assert len(taken) == 1
