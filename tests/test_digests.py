"""Digests before joins, connected records and registered index readers against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from kaiji.operators import audit as AU
from kaiji.operators import digest as D
from kaiji.operators import graph as G
from kaiji.session import work_dir
from kaiji.sources import indices as X

SIDE = "bin_id string, doc_id string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_digests_tell_nulls_repeats_and_moved_rows_apart(spark):
    def digest(rows):
        return spark.createDataFrame(rows, "a string, b string").agg(*D.row_digest("a", "b")).first()

    base = digest([("x", None), ("y", "z")])
    assert base == digest([("y", "z"), ("x", None)])
    for other in ([("x", ""), ("y", "z")], [(None, "x"), ("y", "z")], [("x", None)], [("x", None), ("y", "z"), ("y", "z")],
                  [("x", "z"), ("y", None)], [("x", None), ("x", None)], []):
        assert digest(other) != base


def test_bin_audit_by_digest_gives_the_rows_of_the_full_join(spark):
    rng = random.Random(7)
    expected = [(f"b{i % 40}", f"d{i}") for i in range(400)] + [(None, "n"), ("b1", None), ("No", "q"), ("gone", "g"), ("b2", "d2")]
    actual = [r for r in expected if rng.random() > 0.02 and r[0] not in ("No", "gone")] + [("b3", "foreign"), ("new", "o"), (None, "n")]
    e, a = spark.createDataFrame(expected, SIDE), spark.createDataFrame(actual, SIDE)
    assert _rows(D.bin_audit_by_digest(e, a)) == _rows(AU.bin_audit(e, a))
    empty = spark.createDataFrame([], SIDE)
    for x, y in ((e, empty), (empty, a), (empty, empty)):
        assert _rows(D.bin_audit_by_digest(x, y)) == _rows(AU.bin_audit(x, y))


def test_only_the_bin_that_differs_is_joined(spark):
    e = spark.range(50_000).select(F.concat(F.lit("b"), F.col("id") % 10_000).alias("bin_id"), F.col("id").cast("string").alias("doc_id"))
    a = e.filter("doc_id <> '4711'")
    groups = D.differing_groups(e, a, "bin_id", "doc_id")
    assert [r[0] for r in groups.collect()] == ["b4711"]
    assert D._within(e, "bin_id", groups).count() == 5
    assert _rows(D.bin_audit_by_digest(e, a)) == [("b4711", "4711", "missing")]


def test_drift_by_digest_finds_days_that_moved_and_skips_equal_ones(spark):
    schema = "doc_id string, submit_at string, doc_type string, ordinance_code string, form_code string, withdrawal_status string"
    rows = [(f"s{i}", f"2024-01-{i % 28 + 1:02d}", "120", None, " f ", "0") for i in range(200)]
    api = [(d, t, k, o, "f", None) for d, t, k, o, _, _ in rows]
    api[5] = ("s5", "2024-02-01", "120", None, "f", "1")
    api[9] = ("s9", api[9][1], "999", "o", "f", "")
    c, p = spark.createDataFrame(rows, schema), spark.createDataFrame(api + [("only", None, None, None, None, None)], schema)
    got = _rows(D.drift_by_digest(c.withColumn("day", F.col("submit_at")), p.withColumn("day", F.col("submit_at")), "day"))
    assert got == _rows(AU.drift(c, p)) and {r[0] for r in got} == {"s5", "s9"}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 80)] + [(200, 201), (201, 202), (5, 5)],
    [(random.Random(i).randrange(120), random.Random(-i - 1).randrange(120)) for i in range(70)],
    []], ids=["chain", "star", "random", "none"])
def test_connected_gives_the_smallest_node_of_each_component(spark, edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            if u != v and root[u] != root[v]:
                root[u] = root[v] = min(root[u], root[v])
                changed = True
    got = G.connected(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, got.collect())) == sorted(root.items())


def test_split_identities_reports_what_a_chain_of_keys_connects(spark):
    rows = [("1000000000001", "E1", None, "a"), (None, "E1", "JP:1", "a"), (None, None, "JP:1", "b"), (None, "E9", None, "c"),
            (None, "E9", None, "c"), (None, None, None, "none")]
    got = G.split_identities(spark.createDataFrame(rows, "jcn string, edinet_code string, code string, identity_key string"))
    assert sorted(tuple(r[c] for c in ("group_key", "identity_key", "n_records", "n_identities")) for r in got.collect()) == [
        ("0:1000000000001", "a", 2, 2), ("0:1000000000001", "b", 1, 2)]


def _write(path, text):
    with X.fs.open_output(path) as f:
        f.write(text.encode("cp932"))


def test_index_reader_finds_columns_and_drops_footnotes(spark):
    root = work_dir(spark, "test-index")
    _write(f"{root}/snap_key=2024-06-03/a.csv", "日付,銘柄名,Code,業種,ウェイト\r\nd,\"極洋, 水産\",1301.0,x,1.25%\r\nd,b, 1332 ,x,%\r\nd,c,,x,2%\r\nd,d,1333,x,\r\n※ 注記\r\n")
    _write(f"{root}/b.csv", "コード,ウエイト\n1414,3\n")
    _write(f"{root}/empty.csv", "")
    got = _rows(X.read_index(spark, "Nikkei225", root))
    assert got == sorted([("Nikkei225", "2024-06-03", "JP:13010", 1.25), ("Nikkei225", "2024-06-03", "JP:13320", 0.0),
                          ("Nikkei225", None, "JP:14140", 3.0)], key=repr)
    assert X.read_index(spark, "TOPIX", f"{root}/absent").count() == 0


def test_index_reader_refuses_what_it_does_not_know(spark):
    root = work_dir(spark, "test-index")
    _write(f"{root}/a.csv", "日付,ウエイト\nd,1%\n")
    _write(f"{root}-b/a.csv", "コード,ウエイト\n1301,none\n")
    with pytest.raises(Exception, match="no column"):
        X.read_index(spark, "TOPIX", root).count()
    with pytest.raises(Exception, match="weight in"):
        X.read_index(spark, "TOPIX", f"{root}-b").collect()
    with pytest.raises(Exception, match="isn't one of"):
        X.read_index(spark, "Dow", root).count()


def test_small_files_share_a_partition():
    mb = 1 << 20
    assert X.packed([]) == []
    assert X.packed([("a", mb), ("b", 100 * mb), ("c", 0), ("d", mb)]) == [["a"], ["b"], ["c", "d"]]
