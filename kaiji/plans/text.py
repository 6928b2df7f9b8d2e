"""Text queries over documents, pages, conversations and event payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from kaiji.operators import text as TX
from kaiji.plans.registry import register
from kaiji.plans.tables import table, view, with_views

_PUNCT_SQL = r"[!-/:-@\[-`{-~]"


@register("text_strip_html", "SELECT page_id, url, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages")
def q_text_strip_html(spark, sf_dir):
    """P22 over every raw page."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", TX.strip_html("html").alias("text"))


def _norm_sql(col: str, html: bool, number: bool, ret: bool) -> str:
    t = col
    if html:
        t = f"regexp_replace({t}, '<.*?>', '', 'g')"
    if number:
        t = f"regexp_replace({t}, '\\p{{Nd}}+', '', 'g')"
    t = f"regexp_replace({t}, '{_PUNCT_SQL}', '', 'g')"
    t = f"replace({t}, '。', chr(10))"
    t = f"regexp_replace({t}, '[◆■※]', '', 'g')"
    if ret:
        t = f"regexp_replace({t}, '\\n( ?\\n)+', chr(10), 'g')"
    return t


@register("text_normalize", f"""SELECT doc_id, lang, {_norm_sql('text', True, True, True)} AS text_norm
FROM documents""")
def q_text_normalize(spark, sf_dir):
    """P25 with every option (P22, P23, P24) over whole documents. The oracle
    has no NFKC; it is the identity on the fixture texts and unit-tested."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", TX.normalize_text("text", True, True, True).alias("text_norm"))


@register("text_normalize_plain", f"SELECT doc_id, {_norm_sql('text', False, False, False)} AS text_norm FROM documents")
def q_text_normalize_plain(spark, sf_dir):
    """P25 with the default options (NFKC and punctuation only)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", TX.normalize_text("text").alias("text_norm"))


PROMPT_ARGS = dict(instruction="Summarise the passage.", constraints=["Use the passage only.", "Answer in JSON."],
                   output_format='{"summary": "..."}', example='{"summary": "a short summary"}')


def _system_prompt_sql() -> str:
    a = PROMPT_ARGS
    cons = TX.H_CONSTRAINTS + "\n * " + "\n * ".join(a["constraints"])
    s = f"{a['instruction']}\n\n{cons}\n\n{a['output_format']}\n\n{TX.H_EXAMPLE}\n{a['example']}"
    return "'" + s.replace("'", "''") + "'"


@register("text_prompts", f"""SELECT conv_id, turn, {_system_prompt_sql()} AS system_prompt,
  '{TX.H_TEXT}' || chr(10) || text || chr(10) || chr(10) || '{TX.H_ANSWER}' || chr(10) AS user_prompt
FROM conversations WHERE role = 'user'""")
def q_text_prompts(spark, sf_dir):
    """Prompt pair for every user turn."""
    return q_text_prompts_all(spark, sf_dir).filter(F.col("role") == "user").drop("role")


@register("text_prompts_all", f"""SELECT conv_id, turn, role, {_system_prompt_sql()} AS system_prompt,
  '{TX.H_TEXT}' || chr(10) || text || chr(10) || chr(10) || '{TX.H_ANSWER}' || chr(10) AS user_prompt
FROM conversations""")
def q_text_prompts_all(spark, sf_dir):
    """Prompt pair for every turn, whatever its role."""
    c = table(spark, sf_dir, "conversations")
    return TX.prompts(c, "text", **PROMPT_ARGS).select("conv_id", "turn", "role", "system_prompt", "user_prompt")


@register("json_extract", r"""SELECT event_id, len(o) AS n_objects,
  coalesce(list_bool_and(list_transform(o, lambda x: json_valid(x) AND json_type(x) = 'OBJECT')), true) AS all_valid,
  TRY_CAST(json_extract_string(o[1], '$.k') AS BIGINT) AS k
FROM (SELECT event_id, regexp_extract_all(replace(props, chr(10), ''), '\{.*?\}') AS o FROM events)""")
def q_json_extract(spark, sf_dir):
    """P27 over every event payload."""
    e = table(spark, sf_dir, "events").select("event_id", TX.json_objects("props").alias("o"))
    return e.select("event_id", F.size("o").cast("bigint").alias("n_objects"), TX.json_objects_valid(F.col("o")).alias("all_valid"),
                    F.get_json_object(F.get("o", F.lit(0)), "$.k").try_cast("bigint").alias("k"))


@register("dimension_json", with_views("""SELECT docid, key, context_ref,
  CASE WHEN regexp_extract(context_ref, '_([A-Za-z]+Member)$', 1) <> '' THEN
  '[{"ja":["連結個別","' || m || '"],"en":["ConsolidatedOrNonConsolidatedAxis","' || m ||
  '"],"id":["jppfs_cor_ConsolidatedOrNonConsolidatedAxis","jppfs_cor_' || m || '"]}]' END AS scenario
FROM (SELECT *, regexp_extract(context_ref, '_([A-Za-z]+Member)$', 1) AS m FROM v_facts)""", "v_facts"))
def q_dimension_json(spark, sf_dir):
    """P20: scenario JSON of each fact's context member."""
    f = view(spark, sf_dir, "v_facts")
    m = F.nullif(F.regexp_extract("context_ref", "_([A-Za-z]+Member)$", 1), F.lit(""))
    js = TX.dimension_json(F.lit("連結個別"), m, F.lit("ConsolidatedOrNonConsolidatedAxis"), m,
                           F.lit("jppfs_cor_ConsolidatedOrNonConsolidatedAxis"), F.concat(F.lit("jppfs_cor_"), m))
    return f.select("docid", "key", "context_ref", js.alias("scenario"))


@register("dimension_members", with_views("""SELECT docid, key, context_ref, n AS dimension, CASE n WHEN 1 THEN '連結個別' ELSE '項目' END AS axis_ja,
  CASE n WHEN 1 THEN m ELSE 'Acct' END AS member_ja, CASE n WHEN 1 THEN 'ConsolidatedOrNonConsolidatedAxis' ELSE 'AccountAxis' END AS axis_en,
  CASE n WHEN 1 THEN m ELSE key END AS member_en, CASE n WHEN 1 THEN 'jppfs_cor_' || m ELSE key END AS member_id
FROM (SELECT docid, key, context_ref, regexp_extract(context_ref, '_([A-Za-z]+Member)$', 1) AS m FROM v_facts) f, (VALUES (1), (2)) d(n)
WHERE m <> ''""", "v_facts"))
def q_dimension_members(spark, sf_dir):
    """P20 both ways: scenario JSON of two dimensions for each fact's member, parsed back to a row per dimension."""
    f = view(spark, sf_dir, "v_facts").withColumn("m", F.regexp_extract("context_ref", "_([A-Za-z]+Member)$", 1)).filter("m <> ''")
    one = TX.dimension_item(F.lit("連結個別"), F.col("m"), F.lit("ConsolidatedOrNonConsolidatedAxis"), F.col("m"),
                            F.lit("jppfs_cor_ConsolidatedOrNonConsolidatedAxis"), F.concat(F.lit("jppfs_cor_"), F.col("m")))
    two = TX.dimension_item(F.lit("項目"), F.lit("Acct"), F.lit("AccountAxis"), F.col("key"), F.lit("AccountAxis"), F.col("key"))
    f = f.withColumn("scenario", F.to_json(F.array(one, two)))
    return f.select("docid", "key", "context_ref", F.inline(TX.dimension_members(F.col("scenario")))).select(
        "docid", "key", "context_ref", "dimension", "axis_ja", "member_ja", "axis_en", "member_en", "member_id")


def _entries(spark, sf_dir):
    """Archive listing per document from its line items (fixture)."""
    li = table(spark, sf_dir, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    ext = F.when(odd, F.when(F.col("l_returnflag") == "A", ".PDF").when(F.col("l_returnflag") == "N", ".htm")
                 .otherwise(".xml")).otherwise(F.when(F.col("l_linestatus") == "O", ".pdf").otherwise(".txt"))
    return li.select(F.concat(F.lit("S"), F.lpad(F.col("l_orderkey").cast("string"), 7, "0")).alias("doc_id"),
                     F.when(odd, "english").otherwise("attach").alias("kind"),
                     F.concat(F.lit("doc/"), F.col("l_linenumber").cast("string"), ext).alias("name"))


@register("anomaly_status", with_views("""WITH en AS (SELECT 'S' || lpad(CAST(l_orderkey AS VARCHAR), 7, '0') AS doc_id,
  CASE WHEN l_linenumber % 2 = 1 THEN 'english' ELSE 'attach' END AS kind,
  'doc/' || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linenumber % 2 = 1 THEN
    CASE l_returnflag WHEN 'A' THEN '.PDF' WHEN 'N' THEN '.htm' ELSE '.xml' END
    ELSE CASE WHEN l_linestatus = 'O' THEN '.pdf' ELSE '.txt' END END AS name FROM lineitem),
c AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'english' AND (suffix(lower(name), '.pdf')
  OR suffix(lower(name), '.htm') OR suffix(lower(name), '.html'))) AS n_english_usable,
  count(*) FILTER (WHERE kind = 'attach' AND suffix(lower(name), '.pdf')) AS n_attach_pdf FROM en GROUP BY doc_id),
d AS (SELECT doc_id, seq_number % 3 = 0 AS english_flag, seq_number % 4 = 0 AS attachment_flag FROM v_filings)
SELECT d.doc_id, english_flag, attachment_flag, coalesce(n_english_usable, 0) AS n_english_usable,
  coalesce(n_attach_pdf, 0) AS n_attach_pdf,
  CASE WHEN english_flag AND coalesce(n_english_usable, 0) = 0 THEN 'english_empty'
       WHEN attachment_flag AND coalesce(n_attach_pdf, 0) = 0 THEN 'attachment_empty' END AS anomaly_status
FROM d LEFT JOIN c ON d.doc_id = c.doc_id""", "v_filings"))
def q_anomaly_status(spark, sf_dir):
    """Empty English / attachment archives per filing."""
    docs = view(spark, sf_dir, "v_filings").select(
        "doc_id", (F.col("seq_number") % 3 == 0).alias("english_flag"),
        (F.col("seq_number") % 4 == 0).alias("attachment_flag"))
    return TX.anomaly_status(docs, _entries(spark, sf_dir))
