"""The pipeline against a brute-force run of its stages, and the registered queries against SQL."""

import hashlib
import os
import sys
from collections import Counter

import brute
import pytest
import tiktoken
from conftest import SF_SMALL
from test_lang_quality_ranking import by_hand

import __spark_entry__ as E
import corpus_pipeline
from kaiji.llm import bpe, quality, queries

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from oracle_check import rows_of  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_pipeline(rows):
    """Counter of (doc_id, n_tokens, ids digest, bytes digest) of rows (doc_id, text, lang, source, n_chars)."""
    named = [(r[0], r[1], r[2], r[3], None, None) for r in rows]
    rows = [r for r, w in zip(rows, by_hand(named)) if w[3]]
    good = brute.quality([r[:3] for r in rows], quality.COMMON_WORDS, quality.CLASS_GUARDS, quality.WORD_GUARDS, quality.SCALE, quality.STEPS)
    rows = [r for r, ok in zip(rows, good) if ok]
    first = {i for i, _, c in brute.near_duplicates([r[:2] for r in rows]) if i == c}
    once = {r[0]: r for r in rows if r[0] in first}
    rows = list(once.values())
    tok = bpe.TreeTokenizer(queries.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), queries.public_tokenizers.PATTERN)
    assert isinstance(tok.bpe, tiktoken.Encoding)
    taken = {i: t for i, _, t in brute.mix([(r[0], r[3], len(brute.words(r[1]))) for r in rows])}
    out = Counter()
    for r in rows:
        copies = int(taken[r[0]] / len(brute.words(r[1])) + 0.5)
        ids = tok.bpe.encode_ordinary(r[1])
        if copies:
            out[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest())] = copies
    return out


def test_pipeline_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == brute_pipeline(rows)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert len(corpus_pipeline.STAGES) in (4, 5)
    for _, fn in corpus_pipeline.STAGES[:-1]:
        assert fn(spark, docs, SF_SMALL).columns == docs.columns


def test_stages_bear_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "x", "en", None, 1), (2, "x", "en", None, 1), (3, "a b c " * 50_000, "en", "a", 9)]
    odd = spark.createDataFrame([(*r, "k") for r in rows], COLUMNS + ", row_key string")
    for _, fn in corpus_pipeline.STAGES:
        assert fn(spark, odd, SF_SMALL).count() >= 0
        assert fn(spark, odd.limit(0), SF_SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, duck, name):
    got, want = rows_of(E.queries()[name](spark, SF_SMALL).toPandas()), rows_of(duck.execute(queries.ORACLE[name]).df())
    assert got == want


def test_one_query_per_operator():
    names = list(E.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
