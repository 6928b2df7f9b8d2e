"""SimHash groups against all pairs, and tree BPE against the library on whole texts."""

import base64
import hashlib
import itertools
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kaiji.llm import bpe, queries, simhash

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def near(df, **how):
    return sorted((tuple(r) for r in simhash.near_duplicates(df, **how).collect()), key=repr)


def texts(rng, n):
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randrange(40)) for _ in range(60))
            for _ in range(n)]
    near_copies = []
    for t in base[:n // 2]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        near_copies.append(" ".join(w))
    return base + near_copies + base[:3] + ["", None, "one", "one two", "  One\tTWO ", "\x0b\x0c"]


def test_groups_match_all_pairs(spark):
    rng = random.Random(4)
    rows = list(enumerate(texts(rng, 40)))
    rows += [rows[5], (None, rows[7][1]), (None, "alone in the world"), (10**9, "x " * 20_000)]
    assert near(frame(spark, rows)) == brute.near_duplicates(rows)


def test_links_survive_any_tree_size(spark):
    """A hot shard is split into several trees; chains and dense balls keep their components."""
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    walk = rng.getrandbits(64)
    for _ in range(60):
        walk ^= 7 << rng.randrange(60)
        fps.add(walk)
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {}
    for f, c in zip(signed, brute.components([f % 2**64 for f in signed])):
        want.setdefault(c, set()).add(f)
    for size in (2, 7, 4096):
        roots = dict(simhash.components(simhash.links(df, 3, size)).collect())
        got = {}
        for f in signed:
            got.setdefault(roots.get(f, f), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())), size


def test_bk_search_prunes_and_misses_nothing():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    unit = np.zeros(len(fps), np.int64)
    root, code, child = simhash.bk_forest(unit, fps)
    asked = fps[:50] ^ np.uint64(0b101)
    found, visited = set(), 0
    for q, node in simhash.bk_search(asked, root[:50], fps, code, child, 3):
        found |= set(zip(q.tolist(), node.tolist()))
    assert found == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(fps) if (int(a) ^ int(b)).bit_count() <= 3}
    assert len(child) == len(fps) - 1 and (np.diff(code) > 0).all()  # one child for each parent and distance


def test_fingerprint_is_the_contracts():
    for t in ("A b C d e", "ÀB c", "a\x0bb\x0cc", "x", "a b", "a  b\n\nc\td e f " * 30):
        assert simhash.text_fingerprint(t.encode(), 3) == brute.fingerprint(t)


def test_hash_equals_the_jvms(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b ç"))).first()[0]
    assert simhash.text_fingerprint("a b ç".encode(), 3) == got % 2**64


def test_empty_table_and_clashing_columns(spark):
    assert near(frame(spark, [])) == []
    rows = [(1, "same words here", "k", "f"), (2, "same words here", "k", "f"), (2, "same words here", "k", "f"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key string, fp string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[3]], key=repr)
    only_repeats = simhash.keep_one(df.filter("doc_id = 2"))
    assert only_repeats.count() == 1
    assert simhash.keep_one(df.limit(0)).count() == 0


# ---- BPE

PIECES = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'", "'s", "'ll", "1", "23", "é", "ñ", "日", "😀", " ", "　", "​", "!", "##",
          "\x85", "\x1c", "th", "ere", "\r\n", "İ", "‍"]


@pytest.fixture(scope="module")
def tokenizers():
    return [bpe.TreeTokenizer(RANKS, public_tokenizers.PATTERN, leaf) for leaf in (1, 2, 5, 32)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(PIECES), max_size=60).map("".join),
                 st.tuples(st.sampled_from(["a", "ab", " ", "\n", "é", "日", " \n", "the"]), st.integers(0, 120)).map(lambda x: x[0] * x[1])))
def test_tree_equals_whole(tokenizers, text):
    for tok in tokenizers:
        ids = tok.encode(text)
        assert ids.tolist() == tok.bpe.encode_ordinary(text)
        assert tok.decode(ids) == text.encode()


def test_long_runs_join_by_windows(tokenizers):
    rng = random.Random(2)
    for text in ("a" * 5000, "".join(rng.choice("acgt") for _ in range(4000)), " " * 3000, "日本" * 1500):
        assert tokenizers[3].encode(text).tolist() == tokenizers[3].bpe.encode_ordinary(text)


def test_joins_class_every_code_point_as_the_library_does(tmp_path):
    """Code points that the ``regex`` package and the library class differently, at joins of any offset."""
    classes = bpe.Classes(public_tokenizers.PATTERN)
    kind = {c: k for k, c in enumerate((*classes.STAND_INS.values(), classes.WHITE))}
    points = [c for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000]
    theirs = bytes(kind[classes[c]] for c in points)
    text = "".join(map(chr, points))
    ours = bytearray(b"\x02" * len(points))
    for k, p in ((0, r"\p{L}"), (1, r"\p{N}"), (3, r"\s")):
        for m in regex.finditer(p, text):
            ours[m.start()] = k
    odd = [chr(c) for c, a, b in zip(points, theirs, ours) if a != b]
    assert odd and theirs.count(0) > 100_000
    pairs = [bytes([i]) for i in range(256)] + [bytes([a, i]) for a in b"a1!" for i in range(256)]  # merges that show where a match ends
    path = tmp_path / "pairs"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(pairs)))
    rng = random.Random(8)
    for ranks, leaf in itertools.product((RANKS, str(path)), (1, 2, 3, 7, 16, 64)):
        tok = bpe.TreeTokenizer(ranks, public_tokenizers.PATTERN, leaf)
        for at in range(0, len(odd), 60):
            part = [rng.choice(("", "a", "1", "!", "é", "'s", " ", "")) + c for c in odd[at:at + 60]]
            text = "x" * rng.randrange(5) + "".join(part)
            assert tok.encode(text).tolist() == tok.bpe.encode_ordinary(text), (leaf, at)


def test_unreachable_tokens_stay_exact(tmp_path):
    """A vocabulary whose longest token no merge makes: only a whole match becomes it."""
    ranks = [bytes([i]) for i in range(256)] + [b"ab", b"xyz"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(ranks)))
    for leaf in (1, 2, 3):
        tok = bpe.TreeTokenizer(str(path), public_tokenizers.PATTERN, leaf)
        assert not tok.reachable(257) and tok.reachable(256)
        for text in ("xyz", "xyzxyz", "axyz xyz", "abab xyz ab", "abxyzab"):
            assert tok.encode(text).tolist() == tok.bpe.encode_ordinary(text), text


def test_digests_and_edge_rows(spark):
    rows = [(1, "Hello wörld"), (2, ""), (3, None), (None, "x"), (1, "Hello wörld"), (5, "z" * 50_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in queries.token_digests(df, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    tok = bpe.TreeTokenizer(RANKS, public_tokenizers.PATTERN)
    want = []
    for i, t in rows:
        ids = tok.bpe.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert queries.token_digests(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
