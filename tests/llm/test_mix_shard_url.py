"""Mixing, sharding and URL filters against plain Python."""

import random
import re
import zlib
from collections import Counter

import brute
from pyspark.sql import functions as F

from kaiji.llm import mixing, queries, sharding, urlrules


# ---- mixing

def mixed(spark, rows, **how):
    df = spark.createDataFrame(rows, "id long, source string, size long")
    return sorted(((r["id"], r["size"], r["taken"]) for r in mixing.mix(df, **how).collect()), key=repr)


def test_mix_matches_queue_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "Ä", "", "z", None]), rng.choice([0, 1, 7, 30, 400])) for i in range(400)]
    rows += [rows[0], rows[0], (None, "b", 12), (None, None, 5), (999, "tiny", 1)]
    want = brute.mix(rows)
    assert mixed(spark, rows) == want
    assert mixed(spark, rows, rows_per_range=3) == want  # however a source is split into ranges
    assert mixed(spark, rows) == mixed(spark, list(reversed(rows)))
    assert sum(t for *_, t in want) == sum(r[2] for r in rows) * 3 // 2
    assert all(t <= 2 * n for _, n, t in want)


def test_targets_share_the_excess(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 1000), ("d", 0), (None, 50)])]
    df = spark.createDataFrame(rows, "id long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.mix(df).collect()}
    want = brute.targets({s: n for _, s, n in rows})
    assert got.keys() == want.keys()
    for s in want:
        assert abs(got[s] - float(want[s])) < 1e-9 * max(1, float(want[s]))


def test_mix_of_nothing(spark):
    assert mixed(spark, []) == []
    assert mixed(spark, [(1, "a", 0), (2, None, 0)]) == [(1, 0, 0), (2, 0, 0)]


def test_mixed_documents_repeat_as_taken(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randrange(1, 40)), rng.choice(["a", "b", "c", None]), "x") for i in range(120)]
    rows += [rows[3], (None, "null id here", "a", None), (500, None, "a", "y"), (501, "", "b", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter((r["doc_id"], len((r["text"] or "").split())) for r in out.collect())
    want = Counter()
    for i, n, taken in brute.mix([(r[0], r[2], len((r[1] or "").split())) for r in rows]):
        if taken:
            want[(i, n)] += int(taken / n + 0.5)
    assert got == +want
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def test_many_parts_are_staged_as_few_files(spark, monkeypatch):
    files = {}

    def counted(df, name):
        out = stage(df, name)
        files[name] = len(out.inputFiles())
        return out

    stage = mixing.stage
    monkeypatch.setattr(mixing, "stage", counted)
    df = spark.range(400).selectExpr("id AS doc_id", "repeat('w ', 5) AS text", "'a' AS source").repartition(40)
    assert mixing.mixed_documents(df).count() == 600
    assert files["mix-rows"] <= 8  # 40 before: each file that a task makes on a local disk starts two chmod processes


# ---- sharding

def test_shards_slots_and_growth(spark):
    rows = [(i, f"text {i % 50} é") for i in range(2000)] + [(None, None), (None, "a"), (7, "text 7 é"), (-5, "")]
    df = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, shard string")
    got = sharding.assign(df, "doc_id", "text", [1.0] * 8).collect()
    assert Counter((r["id"], r["size"], r["crc"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for shard in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    assert 0.07 < sum(r["grown_shard"] == 8 for r in got) / len(got) < 0.16  # a ninth
    assert len({r["shard"] for r in got if r["id"] is None}) == 1
    again = sharding.assign(df.repartition(5), "doc_id", "text", [1.0] * 8).collect()
    assert Counter((r["id"], r["shard"], r["grown_shard"]) for r in got) == Counter((r["id"], r["shard"], r["grown_shard"]) for r in again)
    assert sharding.assign(df.limit(0), "doc_id", "text", [1.0] * 8).count() == 0


def test_weights_and_types(spark):
    df = spark.range(20_000).select("id", sharding.rendezvous(F.col("id"), [1.0, 3.0]).alias("s"),
                                    sharding.rendezvous(F.col("id").cast("string"), [1.0, 3.0]).alias("t"),
                                    sharding.rendezvous(F.col("id"), [1.0]).alias("one"))
    assert 0.73 < df.agg(F.avg("s")).first()[0] < 0.77
    assert df.filter("s <> t or one <> 0").count() == 0


# ---- URL filters

PATTERNS = [(1, "block", "||ads."), (2, "block", "/track^"), (3, "allow", "/track/ok"), (4, "block", "*popup*"), (5, "block", "|ftp:"),
            (6, "block", ".exe|"), (7, "block", "a.b+c"), (8, "block", "-banner-")]
HOSTS = [("com", "/", "allow"), ("ex.com", "/en/", "block"), ("www.ex.com", "/en/", "allow"), ("net", "/es/", "block")]


def by_hand(url):
    low = brute.lower_ascii(url or "")
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (brute.lower_ascii(m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), h + p, a) for h, p, a in HOSTS if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    tests = {1: r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?ads\.", 2: r"/track([^a-z0-9_.%-]|$)", 3: "/track/ok", 4: "popup", 5: "^ftp:", 6: r"\.exe$",
             7: r"a\.b\+c", 8: "-banner-"}
    hit = {i for i, x in tests.items() if re.search(x, low)} if url is not None else set()
    return host, path, None, "block" if hit - {3} and 3 not in hit else "allow"


def test_verdicts_match_every_rule_on_every_url(spark):
    rng = random.Random(6)
    parts = ["ads", "www", "ex", "com", "net", "org", "track", "ok", "popup", "popups", "banner", "EN", "en", "es", "a.b+c", "x.exe", "é", ""]
    urls = [None, "", "no scheme", "http://", "HTTP://EX.com/en/", "ftp://x.org/", "http://com", "http://com/", "x://y://z/en/", "http://a.com?q",
            "http://www.ex.com/en/#f", "http://b\nc.org/track", "http://ads.net/es/1", "http://bads.net/", "http://q.org/track"]
    for _ in range(500):
        host = ".".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
        urls.append(rng.choice(["http", "https", "ftp"]) + "://" + host + rng.choice(["", "/", "/-banner-", "?"]) +
                    rng.choice(["/", "-", "?", "#"]).join(rng.choice(parts) for _ in range(rng.randrange(4))))
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(3, urls[3], "h"), (None, urls[20], None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    judged = urlrules.judge_pages(df, urlrules.rules_frame(spark, HOSTS, ["host", "path", "action"]),
                                  urlrules.rules_frame(spark, PATTERNS, ["rule_id", "action", "pattern"]))
    got = Counter((r["page"]["page_id"], r["page"]["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judged.collect())
    want = Counter((i, u, *by_hand(u)) for i, u, _ in rows)
    assert got == want


def test_index_files_rules_under_rare_whole_tokens(spark):
    urls = spark.createDataFrame([(f"http://common.org/rare{i % 3 == 0}/common",) for i in range(9)], "url string")
    rules = urlrules.rules_frame(spark, [(1, "block", "//common.org/raretrue/"), (2, "block", "mon.org"), (3, "block", "*x*")], ["rule_id", "action", "pattern"])
    got = {r["rule_id"]: r["entry"] for r in urlrules.rule_index(rules, urls).collect()}
    assert got == {1: "raretrue", 2: urlrules.EVERY, 3: urlrules.EVERY}  # "mon" and "x" may be parts of tokens


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://ads.x/"), (2, None)], "page_id long, url string")
    hosts = urlrules.rules_frame(spark, HOSTS, ["host", "path", "action"])
    patterns = urlrules.rules_frame(spark, PATTERNS, ["rule_id", "action", "pattern"])
    none = urlrules.judge_pages(pages, hosts.limit(0), patterns.limit(0)).select("verdict").collect()
    assert [r[0] for r in none] == ["allow", "allow"]
    assert urlrules.judge_pages(pages.limit(0), hosts, patterns).count() == 0


def test_contract_rules():
    assert set(queries.HOST_RULES) == {("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                                       ("net", "/es/", "block"), ("net", "/fr/", "block")}
