"""The thin ``opN_<name>`` queries over the driver tables, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kaiji.llm import (bpe, convtrie, langid, mixing, negatives, quality, ranking, setjoin, sharding, simhash, urlrules, vafile,
                       warc)
from kaiji.llm.common import read_table, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from its text, its declared language and its source as host."""
    no = F.lit(None).cast("string")
    rows = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"), no.alias("domain"), no.alias("suffix"))
    return langid.identify(rows).withColumnRenamed("id", "doc_id")


@register("page_language_id")
def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page: text of the markup, html lang attribute, address suffix, host and domain."""
    host, domain, suffix = langid.host_parts(F.col("url"))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    rows = read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), text.alias("text"), langid.markup_language(F.col("html")).alias("declared"),
        host.alias("host"), domain.alias("domain"), suffix.alias("suffix"))
    return langid.identify(rows).withColumnRenamed("id", "page_id")


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.vec) + 1), lambda i: c.vec[i] * q.vec[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.vec) = len(q.vec))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@register("op2_va_file_top_k", TOP_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every vector whose id 20 divides, among all others."""
    rows = read_table(spark, sf_dir, "embeddings").filter(vafile.finite(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").cast("long").alias("id"),
                          F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")).cast("long")).alias("vec"))
    return vafile.top_k(vectors, vectors.filter("id % 20 = 0"), k=20)


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 16) AS shuffle FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((rank - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS most FROM s),
fill(round, level) AS (
  SELECT 0, (SELECT (sum(source_size) * 3 / 2.0)::DOUBLE / sum(weight) FROM w)
  UNION ALL
  SELECT f.round + 1, ((SELECT (sum(source_size) * 3 / 2.0)::DOUBLE FROM w)
    - (SELECT coalesce(sum(most), 0)::DOUBLE FROM w WHERE most < f.level * weight))
    / (SELECT sum(weight) FROM w WHERE most >= f.level * weight)
  FROM fill f WHERE f.round < (SELECT count(*) FROM w)),
t AS (SELECT w.*, CASE WHEN most < level * weight THEN most::DOUBLE ELSE level * weight END AS target
      FROM w, (SELECT level FROM fill ORDER BY round DESC LIMIT 1)),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
             sum(d.size) OVER (PARTITION BY t.rank ORDER BY shuffle, doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (sent + copy * source_size) / target AS finish FROM q, (VALUES (0), (1)) v(copy) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, copy, sent ROWS UNBOUNDED PRECEDING) AS reached FROM c),
k AS (SELECT rank, sent, sum(greatest(0, least(size, (SELECT sum(size) * 3 // 2 FROM d) - (reached - size))))::BIGINT AS taken
      FROM r GROUP BY rank, sent)
SELECT q.doc_id, q.size, q.source_size, q.target, CASE WHEN q.size > 0 THEN coalesce(k.taken, 0) ELSE 0 END::BIGINT AS taken
FROM q LEFT JOIN k ON k.rank = q.rank AND k.sent = q.sent
"""


@register("op3_weighted_fair_mix", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document taken by a mix of 150 % of all words at weights 5, 2, 1."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("id"), "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every whole text, and the verdict by divergence from language references."""
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "stats.n_words", "stats.word_chars", "stats.n_symbols", "stats.n_dup_lines",
                         "stats.n_repeat_words", F.col("failed").alias("base_failed"), "kept")


@register("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests, derived from the ids of the whole text and the bytes decoded from them."""
    done = docs.select("doc_id", bpe.round_trip(F.col("text"), ranks_path, pattern).alias("bpe"))
    return done.select("doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("bpe.ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("bpe.decoded", 256).alias("decoded_sha256"))


@register("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text, and of the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_digests(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


#: Host rules of the contract: host, path, action.
HOST_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Pattern rules: advertising, gambling, adult and link-farm addresses.
URL_PATTERNS = [(1, "block", "||ads-track."), (2, "block", "/ads/*"), (3, "block", ".casino-win."), (4, "block", "||free-bets."),
                (5, "block", ".spam-farm."), (6, "block", "//spam-farm."), (7, "block", "||cheap-pills."), (8, "block", "//adult*.example."),
                (9, "block", ".adult*.example."), (10, "block", "//casino-win."), (11, "block", "^doubleclick^"),
                (12, "block", "/popunder.js|"), (13, "block", "-banner-ad"), (14, "allow", "/ads/transparency^")]

URL_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(host, path, action) AS (VALUES """ + ", ".join(map(str, HOST_RULES)) + r"""),
best AS (SELECT p.page_id, p.url, max({'n': length(r.host || r.path), 'rule': r.host || r.path, 'action': r.action}) AS b
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL),
u AS (SELECT *, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM p),
m AS (SELECT *, regexp_matches(low, '/ads/transparency([^a-z0-9_.%-]|$)') AS ok,
  regexp_matches(low, '^[a-z][a-z0-9+.-]*://([^/?#]*[.])?(ads-track|free-bets|cheap-pills)[.]') OR contains(low, '/ads/')
  OR regexp_matches(low, '(//|[.])(casino-win|spam-farm)[.]') OR regexp_matches(low, '(//|[.])adult.*[.]example[.]')
  OR regexp_matches(low, '([^a-z0-9_.%-]|$)doubleclick([^a-z0-9_.%-]|$)') OR regexp_matches(low, '/popunder[.]js$')
  OR contains(low, '-banner-ad') AS bad FROM u)
SELECT m.page_id, m.host, m.path, best.b.rule AS rule,
  coalesce(best.b.action, CASE WHEN m.bad AND NOT m.ok THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN best ON best.page_id = m.page_id AND best.url = m.url
"""


@register("op7_url_filters", URL_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the longest host rule's, else the pattern rules'."""
    judged = urlrules.judge_pages(read_table(spark, sf_dir, "pages"),
                                  urlrules.rules_frame(spark, HOST_RULES, ["host", "path", "action"]),
                                  urlrules.rules_frame(spark, URL_PATTERNS, ["rule_id", "action", "pattern"]))
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


@register("op8_rendezvous_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document over 8 equal shards, and its shard with a ninth."""
    done = sharding.assign(read_table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * 8)
    return done.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"),
                       "shard", F.col("slot").cast("long"), "grown_shard")


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS b, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, b, max(page_id) AS last FROM p WHERE b >= 1000 GROUP BY d, b)
SELECT p.page_id, p.b::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN g.last IS NULL OR g.last = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g ON g.d = p.d AND g.b = p.b
"""


@register("op9_warc_chunks", WARC_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the archives written of all pages."""
    listed = warc.archive(read_table(spark, sf_dir, "pages"), "page_id", "url", F.encode("html", "UTF-8"))
    chunks = warc.read_archives(listed, with_data=False).filter("is_last")
    back = stage(chunks.select("record_id", "record_type", "refers_to", "bytes_so_far", "digest_so_far"), "warc-back")
    found = back.filter("record_type = 'response'").select(F.col("record_id").alias("target"), F.col("bytes_so_far").alias("target_bytes"),
                                                           F.col("digest_so_far").alias("target_digest"))
    revisit = F.col("record_type") == "revisit"
    rows = back.join(found, F.col("refers_to") == F.col("target"), "left")  # a revisit's payload is that of its response
    return rows.select(warc.key_of(F.col("record_id")).cast("long").alias("page_id"),
                       F.when(revisit, F.col("target_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
                       F.when(revisit, F.col("target_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
                       "record_type", warc.key_of(F.col("refers_to")).cast("long").alias("refers_to"))


@register("op10_pairwise_ranking")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from preference pairs of labels that aren't held out."""
    scored = ranking.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


SET_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s FROM w),
c AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT c, n, unnest(s) AS e FROM c),
o AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.e = b.e AND a.c <> b.c GROUP BY a.c, b.c, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(a, b) AS (SELECT a, b FROM o UNION SELECT r.a, o.b FROM r JOIN o ON o.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(coalesce(c.c, s.doc_id), coalesce(m.b, c.c, s.doc_id)) AS component_id
FROM s LEFT JOIN c ON c.s = s.s LEFT JOIN m ON m.a = c.c
"""


@register("op11_size_aware_join", SET_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 4-word shingles, Jaccard similarity of 85 % or more."""
    return setjoin.similar_sets(read_table(spark, sf_dir, "documents"), words=4, percent=85)


NEGATIVE_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
    list_sum(list_transform(range(1, len(c.vec) + 1), lambda i: c.vec[i] * q.vec[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.vec) = len(q.vec)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@register("op12_hard_negatives", NEGATIVE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every vector whose id 100 divides."""
    rows = read_table(spark, sf_dir, "embeddings").filter(vafile.finite(F.col("embedding")) & F.col("label").isNotNull())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    vectors = rows.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"),
                          F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")).alias("vec"))
    return negatives.hard_negatives(vectors, vectors.filter("id % 100 = 0"), n_positives=5, n_negatives=5, low=80, high=100)


TRIE_SQL = """
WITH RECURSIVE o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS size, xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda d, z: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)), 4294967295) % 9 AS h FROM o GROUP BY conv_id),
p AS (SELECT c.conv_id, c.h, b.conv_id AS base, least(c.h, coalesce(b.size, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
t AS (SELECT p.conv_id, o.pos, o.role, o.text FROM p JOIN o ON o.conv_id = p.base AND o.pos <= p.h
  UNION ALL SELECT p.conv_id, o.pos - p.h + p.taken, o.role, o.text FROM p JOIN o ON o.conv_id = p.conv_id AND o.pos > p.h),
l AS (SELECT p.conv_id, coalesce(list({'role': t.role, 'text': t.text} ORDER BY t.pos) FILTER (t.pos IS NOT NULL), []) AS turns
  FROM p LEFT JOIN t ON t.conv_id = p.conv_id GROUP BY p.conv_id),
d AS (SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM l),
n AS (SELECT depth, turns[:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(turns[:depth][-1].text)) END AS bytes
  FROM d GROUP BY depth, turns[:depth]),
k AS (SELECT u.depth, u.conv_id, count(*) AS n_children FROM n u JOIN n v ON v.depth = u.depth + 1 AND v.path[:u.depth] = u.path GROUP BY ALL),
x AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, conv_id)),
y AS (SELECT u.depth, u.conv_id, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved_tokens
  FROM x u JOIN x v ON v.depth >= u.depth AND v.path[:u.depth] = u.path GROUP BY ALL)
SELECT x.conv_id, x.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, x.n_convs, x.n_children, y.n_leaves::BIGINT AS n_leaves,
  y.saved_tokens::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN y USING (depth, conv_id) LEFT JOIN n q ON q.depth = x.depth - 1 AND q.path = x.path[:x.depth - 1]
"""


@register("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt on shared heads."""
    return convtrie.trie(*convtrie.rebuilt(convtrie.positioned(read_table(spark, sf_dir, "conversations"))))
