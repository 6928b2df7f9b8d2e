"""Language ID, quality rules and pairwise ranking against plain Python and planted cases."""

import math
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kaiji.llm import langid, quality, ranking, textstats

VOICE = {
    "en": "the of and to in is that for it as was with house river green morning answer simple winter".split(),
    "de": "der die und in den von zu das mit sich haus fluss grün morgen antwort einfach winter zeit straße".split(),
    "fr": "de la le et les des en un du une maison fleuve vert matin réponse simple hiver temps être".split(),
    "es": "de la que el en y a los del las casa río verde mañana respuesta simple invierno tiempo niño".split(),
}


def prose(rng, lang, n):
    out = [rng.choice(VOICE[lang][:10]) if rng.random() < 0.55 else rng.choice(VOICE[lang]) + str(rng.randrange(9)) * (rng.random() < 0.05) for _ in range(n)]
    return " ".join(w + rng.choice(["", "", "", ".", ",", ".\n"]) for w in out)


# ---- language

def by_hand(rows, languages=langid.LANGUAGES, most=200, least=0.35, host_weight=20.0, domain_weight=50.0):
    """(id, language, posterior, kept) of rows (id, text, declared, host, domain, suffix)."""
    size = 1 << langid.BUCKET_BITS

    def grams(text):
        data, out = b" " + (text or "").lower().encode() + b" ", bytearray()
        for b in data:
            b = b if 97 <= b <= 122 or b >= 128 else 32
            if not (b == 32 and out and out[-1] == 32):
                out.append(b)
        return [(((out[i] << 16 | out[i + 1] << 8 | out[i + 2]) * 2654435769) % 2**32) >> 18 for i in range(len(out) - 2)]

    counts = {lang: {} for lang in languages}
    for r in rows:
        if r[2] in counts:
            for g in grams(r[1]):
                counts[r[2]][g] = counts[r[2]].get(g, 0) + 1
    classes = [*languages, "und"]

    def loglik(lang, g):
        if lang == "und":
            return -math.log(size)
        total = sum(counts[lang].values())
        return math.log((counts[lang].get(g, 0) + 0.5) / (total + 0.5 * size)) if total else -math.log(size) - 50

    evidence = []
    for r in rows:
        g = grams(r[1])
        found = [sum(loglik(c, x) for x in g) * min(len(g), most) / len(g) for c in classes] if g else None
        if g and len(g) < langid.NOISE_TRIGRAMS:
            found[-1] = min(found[:-1]) - 50
        evidence.append(found)
    said = [d if d in languages else "none" if d is None else "other" for d in (r[2] for r in rows)]
    choice = [e.index(max(e)) if e else None for e in evidence]
    n = len(classes)

    def tally(at):
        out = {}
        for r, c in zip(rows, choice):
            if c is not None and r[at] is not None:
                out.setdefault(r[at], [0] * n)[c] += 1
        return out

    per = [choice.count(i) for i in range(n)]
    corpus = [(x + 1) / (sum(per) + n) for x in per]
    smooth = lambda c, parent, w: [(x + w * p) / (sum(c) + w) for x, p in zip(c, parent)]
    domains = {d: smooth(c, corpus, domain_weight) for d, c in tally(4).items()}
    domain_of = {}
    for r in rows:
        if r[3] is not None and r[4] is not None:
            domain_of[r[3]] = max(r[4], domain_of.get(r[3], r[4]))
    hosts = {h: smooth(c, domains.get(domain_of.get(h), corpus), host_weight) for h, c in tally(3).items()}
    suffix = tally(5)
    values = [*languages, "none", "other"]

    def declared(v):
        ll = [math.log((sum(s == v and c == i for s, c in zip(said, choice)) + (5 if v == languages[i] else 1)) / (per[i] + len(values) + 4)) for i in range(n - 1)]
        return [*ll, sum(ll) / len(ll)]

    table, out = {v: declared(v) for v in values}, []
    for r, e, v in zip(rows, evidence, said):
        if e is None:
            out.append((r[0], "und", 0.0, False))
            continue
        s = [math.log((x + 1) / (p + len(suffix) + 1)) for x, p in zip(suffix[r[5]], per)] if r[5] in suffix else [0.0] * n
        joint = [a + b + c + math.log(d) for a, b, c, d in zip(e, table[v], s, hosts.get(r[3], corpus))]
        best = max(joint)
        post = 1 / sum(math.exp(x - best) for x in joint)
        lang = classes[joint.index(best)]
        out.append((r[0], lang, post, lang != "und" and post >= least))
    return out


def lang_rows():
    rng = random.Random(1)
    rows = []
    for i in range(160):
        lang = rng.choice(langid.LANGUAGES)
        said = rng.choice([lang] * 8 + [None, "xx", rng.choice(langid.LANGUAGES)])
        host = rng.choice([f"{lang}.site.org", "www.mix.com", None])
        rows.append((i, prose(rng, lang, rng.randrange(1, 60)), said, host, host and host.split(".", 1)[1], host and host[-3:]))
    rows += [(500, "", "en", "h", None, None), (501, None, None, None, None, None), (502, "12345 !!", "en", "www.mix.com", "mix.com", "com"),
             (503, "日本語のテキスト" * 40, None, "www.mix.com", "mix.com", "com"), (504, "a", "de", None, None, None), rows[0], (None, prose(rng, "fr", 30), "fr", "h", None, None)]
    return rows


SCHEMA = "id long, text string, declared string, host string, domain string, suffix string"


def test_posteriors_match_the_formula(spark):
    rows = lang_rows()
    got = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (repr(r[0]), r[1]))
    want = sorted(by_hand(rows), key=lambda r: (repr(r[0]), r[1]))
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], atol=1e-6)
    assert dict((r[0], r[3]) for r in got)[503] is False  # a script that no declared language has


def test_evidence_decides_where_text_is_thin(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, 60), lang, f"{lang}.host", None, lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 12)]
    thin = [(900, "de la", "es", "es.host", None, "es"), (901, "de la", "fr", "fr.host", None, "fr"), (902, "in den", "de", "de.host", None, "de")]
    got = {r["id"]: r["language"] for r in langid.identify(spark.createDataFrame(rows + thin, SCHEMA)).collect()}
    assert (got[900], got[901], got[902]) == ("es", "fr", "de")


def test_rows_pass_unchanged_and_edges(spark):
    rows = [(*r[:3], r[3], "v") for r in lang_rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, whole_row string")
    kept = langid.keep_identified(df, "text", "lang", "source")
    assert kept.columns == df.columns
    want = by_hand([(r[0], r[1], r[2], r[3], None, None) for r in rows])
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(r) for r, w in zip(rows, want) if w[3])
    assert langid.keep_identified(df.limit(0), "text", "lang", "source").count() == 0
    undeclared = df.withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(undeclared, "text", "lang", "source").count() == 0


def test_page_parts(spark):
    df = spark.createDataFrame([('<!DOCTYPE html><HTML class=x LANG="de-AT">', "https://u@Www.Ex.co.uk:80/x?y"), ("<p lang='fr'>", "nope"), (None, None),
                                ("<html>", "http://localhost/")], "html string, url string")
    got = df.select(langid.markup_language(F.col("html")), *langid.host_parts(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("de", "www.ex.co.uk", "co.uk", "uk"), (None, None, None, None), (None, None, None, None),
                                       (None, "localhost", "localhost", None)]


# ---- quality

def quality_rows():
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lang = rng.choice([*quality.LANGUAGES, "en", "en", None, "pl"])
        t = prose(rng, lang if lang in VOICE else "en", rng.choice([20, 60, 90, 400]))
        kind = i % 10
        if kind == 0:
            t = " ".join(w.upper() + "!!" for w in t.split())
        elif kind == 1:
            t = " | ".join(t.split())
        elif kind == 2:
            t = t + "\n" + "again and again\n" * 40
        rows.append((i, t, lang))
    return rows + [(900, None, "en"), (901, "", None), (902, "\n \n\t", "de"), (903, "a b c a b c", "en"), rows[3], (None, rows[4][1], "fr"), (904, "wörd " * 30_000, "de")]


def test_base_counts(spark):
    rows = quality_rows()[:-1]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, n_words int")
    got = quality.judge(df).select("id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "failed").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *brute.base_counts(r[1]))) for r in rows)


def test_verdicts_match_by_hand(spark):
    rows = quality_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(repr((r["id"], r["kept"])) for r in quality.judge(df).collect())
    rows_light = [(i, t if t is None or len(t) < 100_000 else "wörd " * 200, lang) for i, t, lang in rows]  # fails the base either way
    want = brute.quality(rows_light, quality.COMMON_WORDS, quality.CLASS_GUARDS, quality.WORD_GUARDS, quality.SCALE, quality.STEPS)
    assert got == sorted(repr((r[0], k)) for r, k in zip(rows, want))
    caps = [k for r, k in zip(rows[:120:10], want[:120:10]) if len(r[1]) > 450 and r[2] in ("en", "de")]
    assert caps and not any(caps)


def test_good_rows_pass_unchanged(spark):
    df = spark.createDataFrame([(*r, "z") for r in quality_rows()], "doc_id long, text string, lang string, stats string")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = [r["id"] for r in quality.judge(df).filter("kept").collect()]
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, want))
    assert quality.keep_good(df.limit(0)).count() == 0 and quality.judge(df.limit(0)).count() == 0


def test_distance_is_a_distance():
    p, q = np.array([[4, 0, 0], [1, 1, 2]]), np.array([[0, 0, 3], [1, 1, 2]])
    assert np.allclose(quality.js_distance(p, q), [1, 0])
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 9, (50, 7)), rng.integers(0, 9, (50, 7))
    assert np.allclose(quality.js_distance(a, b), [brute.js_distance(x, y) for x, y in zip(a.tolist(), b.tolist())])


def test_counts_dont_depend_on_slices(monkeypatch):
    rng = random.Random(5)
    texts = pa.array([prose(rng, "de", rng.randrange(80)) for _ in range(30)] + [None, "", "é|!"])
    whole = [textstats.Slice(t) for _, t in textstats.slices(texts)]
    monkeypatch.setattr(textstats, "SLICE_BYTES", 100)
    parts = [textstats.Slice(t) for _, t in textstats.slices(texts)]
    assert len(parts) > len(whole)
    for f in ("word_chars", "n_distinct", "repeat_words", "class_counts"):
        assert np.concatenate([getattr(s, f)() for s in whole]).tolist() == np.concatenate([getattr(s, f)() for s in parts]).tolist()


# ---- ranking

def ranking_rows():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(500):
        bad = rng.random() < 0.2
        t = prose(rng, rng.choice(list(VOICE)), rng.randrange(40, 120))
        rows.append((i, rng.choice([t.upper(), " | ".join(t.split())]) if bad else t))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_accuracy_and_range(spark):
    rows, labels = ranking_rows()
    rows += [(1000, None), (1001, ""), (None, "x"), rows[0], (1002, "word " * 40_000)]
    labels += [(None, 1, 0), (1000, None, 0), (5, 0, 1), (5, 1, 1)]  # contradictions and nulls teach nothing
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = ranking.rank_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["id"] is not None and zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)
    truth = {i: q for i, q, _ in labels if i not in (None, 5, 1000)}
    tested = [(truth[r["id"]], r["predicted"]) for r in got if r["held_out"] and r["id"] in truth]
    assert sum(a == b for a, b in tested) / len(tested) > 0.95
    again = ranking.rank_documents(docs.repartition(7), spark.createDataFrame(labels[::-1], "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, again)))


def test_labels_held_out_teach_nothing(spark):
    rows, labels = ranking_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (ranking.rank_documents(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect() for x in (labels, flipped))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for labels in ([], [(1, 1, 0), (2, 1, 0)]):
        got = ranking.rank_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len({r["score"] for r in got}) == 1 and len(got) == 2
    assert ranking.rank_documents(docs.limit(0), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).count() == 0


def test_sample_is_bounded(spark):
    known = spark.range(3000).select("id", F.array(*[F.col("id").cast("double")] * len(ranking.NAMES)).alias("x"))
    labels = spark.range(3000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    good, bad = ranking.training_tables(known, labels, most=100)
    assert len(good) <= 100 and len(bad) <= 100 and len(good) > 50 and (good[:, 0] % 2 == 1).all() and (bad[:, 0] % 2 == 0).all()


def test_newton_finds_the_minimum():
    rng = np.random.default_rng(4)
    k = len(ranking.NAMES)
    good, bad = rng.normal(0.3, 1, (80, k)), rng.normal(0, 1, (60, k))
    model = ranking.Ranking.fit(good, bad)
    g, b = (good - model.mean) / model.spread, (bad - model.mean) / model.spread
    n = ranking.PAIRS_EACH * 80
    at = np.arange(n)
    d = g[at % 80] - b[(at + at // 80 + at // 60) % 60]
    loss = lambda w: np.log1p(np.exp(-d @ w)).mean() + 5e-4 * w @ w
    assert all(loss(model.weights) <= loss(model.weights + 1e-3 * rng.normal(size=k)) for _ in range(50))


def test_copies_of_a_labelled_document_teach_once(spark):
    ids = spark.range(60).select("id", F.array(*[F.col("id").cast("double")] * len(ranking.NAMES)).alias("x"))
    labels = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias("label"))
    known = ids.unionAll(ids.join(spark.range(200).select(F.lit(0).alias("_c")), F.col("id") < 20).drop("_c"))
    good, bad = ranking.training_tables(known, labels, most=100)
    assert sorted(good[:, 0]) == list(range(1, 60, 2)) and sorted(bad[:, 0]) == list(range(0, 60, 2))
    spread = spark.range(5000).select((F.col("id") % 2).alias("id"), F.array(*[F.col("id").cast("double")] * len(ranking.NAMES)).alias("x"))
    assert [len(t) for t in ranking.training_tables(spread, labels, most=100)] == [100, 100]


def test_every_labelled_document_teaches(spark):
    """Sums of tables find the model of all rows, wherever the steps start, with ranges of documents and ties among strengths."""
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 3 == 0), rng.normal(0.4 * (i % 3 == 0), 1, len(ranking.NAMES)).round(2).tolist()) for i in range(900)]
    rows += [(900 + i, i % 2, rows[0][2]) for i in range(60)]
    known = spark.createDataFrame([(i, x) for i, _, x in rows + rows[:30]], "id long, x array<double>")
    labels = spark.createDataFrame([(i, q) for i, q, _ in rows], "id long, label int")
    want = ranking.Ranking.fit(*ranking.training_tables(known, labels))
    for most, group in ((20, 50), (5000, 10_000)):
        ranking.GROUP_ROWS, before = group, ranking.GROUP_ROWS
        try:
            got = ranking.Ranking.fit_all(known, labels, most=most)
        finally:
            ranking.GROUP_ROWS = before
        for a, b in ((got.mean, want.mean), (got.spread, want.spread), (got.weights, want.weights), (got.cut, want.cut)):
            assert np.allclose(a, b, rtol=1e-7, atol=1e-9)


def test_nth_smallest_is_exact(spark):
    values = [0.0] * 5 + [1e-300, 1.0, 1.0 + 2**-52, 3.0, 1e6, 1e6, -7.5]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert [ranking.nth(df, k) for k in range(1, len(values) + 1)] == sorted(values)
