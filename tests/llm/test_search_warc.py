"""Exact search and WARC archives against plain Python."""

import gzip
import hashlib
import math
import random
from collections import Counter

import brute
import numpy as np
from pyspark.sql import functions as F

from kaiji.llm import vafile, warc


# ---- search

def test_top_k_is_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(-30, 30) for _ in range(16)]) for i in range(900)]
    rows += [(1000 + i, rows[i][1]) for i in range(60)]  # ties across ids
    rows += [rows[20], rows[40], rows[7], rows[7]]  # repeated rows
    rows += [(2000 + i, [1] * 5) for i in range(7)] + [(3000, [2] * 3)]  # other dimensions
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    got = vafile.top_k(df, df.filter("id % 20 = 0"), k=20)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute.top_k(
        rows, [r for r in rows if r[0] % 20 == 0], 20)


def test_stripes_meet_in_one_ranking(spark, monkeypatch):
    monkeypatch.setattr(vafile, "STRIPE_MIN", 16)
    monkeypatch.setattr(vafile, "STRIPE_MAX", 40)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 3)
    rng = random.Random(7)
    rows = [(i, [rng.randrange(-5, 5) for _ in range(4)]) for i in range(400)] + [(9, [10**9, -10**9, 10**9, 1]), (11, [10**9, 10**9, 0, 7])]
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    got = vafile.top_k(df, df.filter("id % 20 = 0 or id in (9, 11)"), k=7, cells=4)
    assert sorted(map(tuple, got.collect())) == brute.top_k(rows, [r for r in rows if r[0] % 20 == 0 or r[0] in (9, 11)], 7)


def test_bounds_spare_exact_reads():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-32, 32, (4000, 8))
    low, width = vectors.min(0), np.full(8, 4)
    stripe = vafile.Stripe(np.arange(4000), vectors, (vectors - low) // width, low, width)
    for i, rows, scores in stripe.search(np.arange(40), vectors[:40], 10):
        want = sorted(((-int(vectors[i] @ v), j) for j, v in enumerate(vectors) if j != i))[:10]
        assert [(-int(s), int(r)) for s, r in zip(scores, rows)] == want
    assert stripe.read < 40 * 4000 * 0.2


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (1, [math.nan, 1.0]), (2, [math.inf, 1.0]), (3, [-math.inf, 0.0]), (4, [0.5, 0.25]),
            (5, [0.0, -0.01])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").filter(vafile.finite(F.col("embedding")))
    vec = df.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")).cast("long")).alias("vec"))
    assert sorted(map(tuple, vafile.top_k(vec, vec.filter("id % 20 = 0")).collect())) == [(0, 1, 4, 64 * 32 + 128 * 16), (0, 2, 5, -128)]
    assert vafile.top_k(vec.limit(0), vec).count() == 0
    assert vafile.top_k(vec, vec.limit(0)).count() == 0
    alone = vec.filter("id = 0")
    assert vafile.top_k(alone, alone).count() == 0


# ---- WARC

def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_id string")


def read_back(df, chunk=1 << 20):
    listed = warc.archive(df, "page_id", "url", F.encode("html", "UTF-8"))
    return listed, warc.read_archives(listed, chunk_bytes=chunk).collect()


BIG = "large payload é " * 9000
ROWS = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, "short"), (4, "http://c/\r\nX-Evil: 1", "short"), (5, "http://d/", None), (6, "http://e/", ""),
        (2, "http://b/", BIG), (None, "http://f/", "y" * 2000), (7, "http://g/", "y" * 2000), (8, "u", "z" * 999), (9, "u", "z" * 999),
        (10, "u", "WARC/1.1\r\n\r\nContent-Length: 7\r\n\r\n" * 100), (3, None, "short")]


def test_round_trip_in_chunks(spark):
    listed, chunks = read_back(pages(spark, ROWS), chunk=1000)
    records = {}
    for c in chunks:
        records.setdefault(c["record_id"], []).append(c)
    assert len(records) == len(ROWS) == sum(r["records"] for r in listed.collect())
    found = Counter()
    for parts in records.values():
        parts.sort(key=lambda c: c["chunk_no"])
        assert [c["chunk_no"] for c in parts] == list(range(len(parts))) and [c["is_last"] for c in parts].count(True) == 1
        data, digest = b"", hashlib.sha1()
        for c in parts:
            data += c["data"]
            digest.update(c["data"])
            assert len(c["data"]) <= 1000 and c["bytes_so_far"] == len(data) and c["digest_so_far"] == digest.hexdigest()
        if parts[0]["record_type"] == "response":
            assert parts[0]["stated_digest"] == digest.hexdigest()
            found[data] += 1
        else:
            assert data == b"" and records[parts[0]["refers_to"]][0]["record_type"] == "response"
            assert records[parts[0]["refers_to"]][0]["stated_digest"] == parts[0]["stated_digest"]
    want = Counter((r[2] or "").encode() for r in ROWS)
    assert found == Counter({p: 1 if len(p) >= 1000 else n for p, n in want.items()})
    assert not any("X-Evil" in (c["url"] or "") and "\n" in c["url"] for c in chunks)


def test_largest_id_is_the_response(spark):
    _, chunks = read_back(pages(spark, ROWS))
    key = spark.createDataFrame([(c["record_id"], c["record_type"], c["refers_to"]) for c in chunks if c["is_last"]], "r string, t string, f string")
    got = Counter(map(tuple, key.select(warc.key_of(F.col("r")).cast("long"), "t", warc.key_of(F.col("f")).cast("long")).collect()))
    assert got[(2, "response", None)] == 1 and got[(2, "revisit", 2)] == 1 and got[(1, "revisit", 2)] == 1
    assert got[(None, "revisit", 7)] == 1 and got[(7, "response", None)] == 1  # a null id is the smallest
    assert got[(8, "response", None)] == 1 and got[(9, "response", None)] == 1 and got[(3, "response", None)] == 2


def test_archives_are_plain_warc(spark):
    listed, _ = read_back(pages(spark, ROWS[:3]))
    text = b"".join(gzip.open(r["path"].removeprefix("file:"), "rb").read() for r in listed.collect())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and text.count(b"\r\n\r\n\r\n\r\n") >= 1
    assert BIG.encode() in text


def test_hot_group_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    rows = [(5, "http://a/", "w" * 1500)] * 50 + [(i, "http://b/", "v" * 1200) for i in range(40)]
    _, chunks = read_back(pages(spark, rows))
    kinds = Counter((c["record_type"]) for c in chunks)
    assert kinds == {"response": 2, "revisit": 88} and len({c["record_id"] for c in chunks}) == 90


def test_several_archives_per_task_and_empty_table(spark):
    df = pages(spark, ROWS).coalesce(1)
    one = df.select(F.concat_ws(":", "page_id", "url", F.monotonically_increasing_id()).alias("record_id"), F.lit("response").alias("record_type"),
                    F.lit(None).cast("string").alias("refers_to"), "url", F.length(F.encode("html", "UTF-8")).cast("long").alias("payload_bytes"),
                    F.sha1(F.encode("html", "UTF-8")).alias("payload_digest"), F.encode("html", "UTF-8").alias("payload")).filter("payload is not null")
    listed = warc.write_archives(warc.chunk_rows(one, "payload", 512), warc.shared_path(spark, "t"), archive_bytes=1)
    assert listed.count() == 12 and listed.agg(F.sum("records")).first()[0] == 12
    got = warc.read_archives(listed, 100).filter("is_last").select("stated_digest", "digest_so_far")
    assert got.count() == 12 and got.filter("stated_digest <> digest_so_far").count() == 0
    listed, chunks = read_back(pages(spark, []))
    assert listed.count() == 0 and chunks == []
