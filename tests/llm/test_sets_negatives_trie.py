"""Size-aware join, hard negatives and conversation trie against plain Python versions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import lower_ascii, words

from kaiji.llm import convtrie, negatives, setjoin
from pyspark.sql import functions as F


# ---- set join -------------------------------------------------------------

def shingles(text, n=4):
    w = words(lower_ascii(text or ""))
    return frozenset(" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def near_texts(seed, n=160):
    """Texts with shared passages, edited copies of one hub, chains, short texts and odd rows."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 5)))
    passage = [word() for _ in range(30)]
    texts, hub = [], [word() for _ in range(60)]
    for k in range(n):
        kind = k % 5
        if kind == 0:
            w = [word() for _ in range(rnd.randint(1, 80))]
        elif kind == 1:  # edits of the hub, at its ends or inside
            w = list(hub)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = word()
        elif kind == 2:
            w = passage + [word() for _ in range(rnd.randint(0, 20))]
        elif kind == 3 and texts:
            w = texts[rnd.randrange(len(texts))].split(" ")
            w = w[:-1] if rnd.random() < 0.5 else w + [word()]
        else:
            w = [rnd.choice("ab") for _ in range(rnd.randint(1, 12))]
        texts.append(" ".join(w))
    rows = list(enumerate(texts, 3))
    rows += [(1, None), (2, ""), (900, " \t\n"), (901, "a b c"), (902, "A  B\tC"), (902, "A  B\tC"), (None, texts[0]), (None, "only here of all texts that are"),
             (903, "a b c d"), (904, "   ")]
    return rows


@pytest.mark.parametrize("upto", [0, 20, 10_000, None])
def test_set_join_against_all_pairs(spark, upto):
    rows = near_texts(5)
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, num int, key string, items int").repartition(3)
    out = setjoin.similar_sets(df, light_upto=upto)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_components(rows)


def test_set_join_splits_large_clusters(spark):
    rows = near_texts(6, 120)
    out = setjoin.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), unit_elements=300)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_components(rows)


def test_elements_of_the_same_sets_are_one_class(spark):
    """Each pair of near copies shares the 17 elements of its cut, which stand in the same two sets: one subset, not 136."""
    rows = [(2 * i + k, 2 * i + k, 200, [1000 * i + j for j in range(185)] + [1000 * i + 200 + 100 * k + j for j in range(15)])
            for i in range(5) for k in (0, 1)]
    alive = spark.createDataFrame([(i, str(i), n, items) for i, _, n, items in rows], "num long, key string, n int, items array<long>")
    ordered = setjoin._ordered(alive, 85).cache()
    members = setjoin._members(ordered, F.lit(False))
    assert members.count() <= 4 * len(rows) and members.select("num").distinct().count() == len(rows)
    edges = setjoin._checked(alive, ordered, 1000, 85, 100_000).collect()
    assert sorted(tuple(sorted(e)) for e in edges) == [(2 * i, 2 * i + 1) for i in range(5)]


def test_set_join_of_an_empty_table(spark):
    assert setjoin.similar_sets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_boundary_follows_the_cost(spark):
    wide = [(i, 10 * i, [(3, 1)] * i, [(3, 1)] * (i + 1)) for i in (3, 200)]
    df = spark.createDataFrame(wide, "num long, n int, one array<struct<df:long,h:long>>, two array<struct<df:long,h:long>>")
    assert setjoin.boundary(df) == 30  # 6 subsets against 9 list entries, 20,100 against 600
    dear = spark.createDataFrame([(1, 30, [(1000, 1)] * 3, [(1000, 1)] * 4)], df.schema)
    assert setjoin.boundary(dear) == 30
    assert setjoin.boundary(df.filter("n > 100")) == 0


def test_long_text_and_slices_give_the_same_sets(spark):
    text = " ".join(str(i * 7919 % 10_007) for i in range(200_000))
    sizes, items = setjoin.shingle_sets(pa.array([text, "x", None or ""], pa.large_string()), 4)
    assert sizes.tolist() == [len(shingles(text)), 1, 0] and len(items) == sizes.sum()


# ---- hard negatives -------------------------------------------------------

def brute_negatives(rows, anchors, low=80, high=100):
    out = []
    fit = [r for r in rows if r[0] is not None and r[1] is not None and r[2]]
    for a, la, va in sorted(set((i, l, tuple(v)) for i, l, v in anchors if i is not None and l is not None and v)):
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, l) for i, l, v in fit if i != a and len(v) == len(va))
        for s, i, _ in [x for x in scored if x[2] == la][:5]:
            inside = [x for x in scored if x[2] != la and low * -s <= 100 * -x[0] <= high * -s][:5]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(inside, 1)]
    return sorted(out)


def vector_rows(seed, n=700, dim=9):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        base = [40 * (i % 4 == c % 4) for c in range(dim)]
        rows.append((i, rnd.randrange(3), [b + rnd.randint(-9, 9) for b in base]))
    rows += [(n + i, i % 2, [40, -3] * 4 + [7]) for i in range(200)]  # one vector many times
    rows += [(5000, 1, [3, 4]), (5001, 1, [5, 4]), (5002, 0, [4, 4]), (5003, 1, [0] * dim), (5100, 1, [1]), (5101, 1, [2]), (5102, 0, [2])]
    return rows + [(None, 1, [1] * dim), (6000, None, [1] * dim), (6001, 1, None), (6002, 1, [])]


@pytest.mark.parametrize("codes", [1, 5])
def test_negatives_against_all_pairs(spark, monkeypatch, codes):
    monkeypatch.setattr(negatives, "STRIPE_MIN", 256)  # several stripes
    monkeypatch.setattr(negatives, "STRIPE_MAX", 256)
    rows = vector_rows(3)
    df = spark.createDataFrame(rows, "id long, label long, vec array<bigint>").withColumn("rank", F.lit("clash")).repartition(3)
    anchors = df.filter("id % 50 = 0 or id in (5001, 5003, 5101) or id is null or label is null")
    out = negatives.hard_negatives(df, anchors.union(anchors), codes=codes)
    want = brute_negatives(rows, [r for r in rows if r[0] is None or r[1] is None or r[0] % 50 == 0 or r[0] in (5001, 5003, 5101)])
    assert sorted(tuple(r) for r in out.collect()) == want
    assert len(want) > 50


def test_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, label long, vec array<bigint>")
    assert negatives.hard_negatives(df, df).collect() == []


def test_scores_beyond_64_bits_are_an_error():
    index = negatives.MultiIndex(np.array([1]), np.array([1]), np.array([[1 << 40, 1]]), np.zeros(2))
    with pytest.raises(ValueError):
        index.search(0, 1, np.array([1 << 40, 1]), 5, True, [(None, None)])


def test_cells_come_by_their_bounds_and_certify():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(0, 200, (8, 8))
    vectors = np.floor(centres[rnd.integers(0, 8, 4000)] + rnd.normal(0, 4, (4000, 8))).astype(np.int64)
    books = np.concatenate([negatives.codebook(vectors[:500, :4].astype(float), 8).ravel(), negatives.codebook(vectors[:500, 4:].astype(float), 8).ravel()])
    index = negatives.MultiIndex(np.arange(4000), np.zeros(4000, np.int64), vectors, books)
    query = vectors[17]
    found = list(index.cells(query))
    assert [f[0] for f in found] == sorted((f[0] for f in found), reverse=True)
    assert sorted(i for f in found for i in range(f[2], f[3])) == list(range(4000))
    for upper, lower, start, end in found:
        scores = index.vectors[start:end] @ query
        assert lower <= scores.min() and scores.max() <= upper
    best = index.search(17, 0, query, 5, True, [(None, None)])[0]
    want = sorted((-int(s), i) for i, s in enumerate(vectors @ query) if i != 17)[:5]
    assert best == [(-s, i) for s, i in want]
    assert index.read < 2000  # most cells are never read


# ---- conversation trie ----------------------------------------------------

def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    kids = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        gain = (len(members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += gain
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest())
                  for p, m in nodes.items()) if nodes else []


def trie_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(60):
        for turn in range(rnd.randint(1, 7)):
            rows.append((c, turn if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "ho", "é", "", None])))
    for c in (100, 101, 103, 110, 2000, 2001):  # long ones: shared for 20, 45 or all turns
        for turn in range(60):
            rows.append((c, turn, "user", f"t{turn}" if turn < {100: 60, 101: 60, 103: 20}.get(c, 45) else f"{c} {turn}"))
    rows += [(100, 5, "user", "t5"), (100, 5, "user", "t5"), (None, 1, "user", "lost"), (3001, 1, "user", "one"), (-4, 1, "user", "x"), (-4, 2, "user", "y")]
    return rows


def nodes_of(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, turn_id string")
    out = convtrie.trie(*convtrie.rebuilt(convtrie.positioned(df.repartition(4))))
    return sorted(tuple(r) for r in out.collect())


def key(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain_python(spark, seed):
    rows = [r for r in trie_rows(seed) if r[0] is None or r[0] >= 0]
    assert key(nodes_of(spark, rows)) == key(brute_trie(rows))


def test_trie_of_few_rows(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 1, "user", "x")]) == []
    for rows in ([(4, 1, None, None)], [(7, None, "user", "x"), (7, 1, "user", "x"), (5, 1, "user", "x")]):
        assert key(nodes_of(spark, rows)) == key(brute_trie(rows))


def test_ids_are_hashed_as_one_stream(spark, monkeypatch):
    ends = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.lit(2).cast("long").alias("depth"), F.col("id").alias("member"))
    (row,) = convtrie.end_digests(ends.repartition(5)).collect()
    assert row.sha == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()


def test_prefixes_come_from_a_rollup(spark):
    rows = convtrie.blocks(*convtrie.rebuilt(convtrie.positioned(spark.createDataFrame([(1, 1, "u", "x")], "conv_id long, turn long, role string, text string"))))
    plan = convtrie.prefixes(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "grouping" in plan
