"""Text preparation and archive anomaly status.

All steps are built-in regex expressions except Unicode NFKC, which Spark
has no function for: it is one vectorised Arrow ``pandas_udf`` over whole
texts (``unicodedata`` on each value of the batch).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kaiji.functions.codes import col_

# Patterns and marks of the reference's text normaliser.
TAG_PATTERN = "(?d)<.*?>"              # '.' stops only at '\n', as in Python
DIGITS_PATTERN = r"\p{Nd}+"            # Python's \d on str: any Unicode decimal digit
ASCII_PUNCT_PATTERN = r"[!-/:-@\[-`{-~]"
SENTENCE_END, NEWLINE = "。", "\n"
DROP_MARKS_PATTERN = "[◆■※]"
BLANK_LINES_PATTERN = "\n( ?\n)+"
# Prompt headings (fixed values).
H_CONSTRAINTS, H_EXAMPLE, H_TEXT, H_ANSWER = "#### 注意事項", "#### 例", "#### 文章", "#### 回答"
# Archive entries that count as usable English documents / attachments.
ENGLISH_EXTS = (".pdf", ".htm", ".html")
ATTACH_EXTS = (".pdf",)


def _nfkc_batch(s: pd.Series) -> pd.Series:
    """Unicode NFKC normalisation of whole strings (one Arrow batch)."""
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else v)


_NFKC_UDF = None


def nfkc(c) -> Column:
    """NFKC as a vectorised pandas UDF (created on first use, once a session exists)."""
    global _NFKC_UDF
    if _NFKC_UDF is None:
        _NFKC_UDF = F.pandas_udf(_nfkc_batch, "string")
    return _NFKC_UDF(col_(c))


def strip_html(c) -> Column:
    """Drop ``<...>`` tags (a tag broken across lines survives)."""
    return F.regexp_replace(col_(c), TAG_PATTERN, "")


def drop_digits(c) -> Column:
    """Drop runs of decimal digits."""
    return F.regexp_replace(col_(c), DIGITS_PATTERN, "")


def collapse_blank_lines(c) -> Column:
    """Repeated blank lines (also `` `` space-only lines) become one newline."""
    return F.regexp_replace(col_(c), BLANK_LINES_PATTERN, NEWLINE)


def normalize_text(c, drop_html: bool = False, drop_number: bool = False, reduce_return: bool = False,
                   unicode_nfkc: bool = True) -> Column:
    """P25: fixed-order text normaliser."""
    t = col_(c)
    if drop_html:
        t = strip_html(t)
    if unicode_nfkc:
        t = nfkc(t)
    if drop_number:
        t = drop_digits(t)
    t = F.regexp_replace(t, ASCII_PUNCT_PATTERN, "")
    t = F.replace(t, F.lit(SENTENCE_END), F.lit(NEWLINE))
    t = F.regexp_replace(t, DROP_MARKS_PATTERN, "")
    if reduce_return:
        t = collapse_blank_lines(t)
    return t


def prompts(df: DataFrame, text: str, instruction: str, constraints: list[str], output_format: str,
            example: str) -> DataFrame:
    """(system, user) prompt pair per text row."""
    constraint = H_CONSTRAINTS + "\n * " + "\n * ".join(constraints)
    system = f"{instruction}\n\n{constraint}\n\n{output_format}\n\n{H_EXAMPLE}\n{example}"
    user = F.concat(F.lit(f"{H_TEXT}\n"), F.col(text), F.lit(f"\n\n{H_ANSWER}\n"))
    return df.withColumn("system_prompt", F.lit(system)).withColumn("user_prompt", user)


def json_objects(c) -> Column:
    """Every ``{...}`` (non-greedy) in the text with newlines removed."""
    return F.regexp_extract_all(F.regexp_replace(col_(c), "\n", ""), F.lit(r"(?s)\{.*?\}"), 0)


def json_objects_valid(objs: Column) -> Column:
    """All extracted objects parse as JSON objects."""
    return F.forall(objs, lambda x: F.from_json(x, "map<string,string>").isNotNull())


def dimension_item(dim_ja, mem_ja, dim_en, mem_en, dim_id, mem_id) -> Column:
    """One dimension of a scenario: its axis and member in Japanese, English and as ids."""
    return F.struct(F.array(col_(dim_ja), col_(mem_ja)).alias("ja"), F.array(col_(dim_en), col_(mem_en)).alias("en"),
                    F.array(col_(dim_id), col_(mem_id)).alias("id"))


def dimension_json(dim_ja, mem_ja, dim_en, mem_en, dim_id, mem_id) -> Column:
    """P20: one-dimension scenario as compact JSON ``[{"ja":[..],"en":[..],"id":[..]}]``;
    NULL when there is no member."""
    return F.when(col_(mem_id).isNotNull(), F.to_json(F.array(dimension_item(dim_ja, mem_ja, dim_en, mem_en, dim_id, mem_id))))


def dimension_members(scenario) -> Column:
    """P20 backwards: a scenario as an array of (dimension from 1, axis and member in each language and as id).

    Read through VARIANT, so an item may lack a language or hold other types (NULL there); a text that
    isn't a JSON array gives no dimension."""
    items = F.coalesce(F.try_variant_get(F.try_parse_json(col_(scenario)), "$", "array<variant>"), F.array().cast("array<variant>"))
    part = lambda x, name, at: F.try_variant_get(x, f"$.{name}[{at}]", "string").alias(f"{'member' if at else 'axis'}_{name}")
    return F.transform(items, lambda x, i: F.struct((i + 1).alias("dimension"), *[part(x, n, at) for n in ("ja", "en", "id") for at in (0, 1)]))


def anomaly_status(docs: DataFrame, entries: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Per document, counts of usable English entries and PDF attachments
    from the archive listing (kind, name); a flagged kind with no usable entry
    gives english_empty / attachment_empty, English first."""
    name = F.lower(F.col("name"))
    eng_ok = F.lit(False)
    for e in ENGLISH_EXTS:
        eng_ok = eng_ok | name.endswith(e)
    att_ok = F.lit(False)
    for e in ATTACH_EXTS:
        att_ok = att_ok | name.endswith(e)
    counts = entries.groupBy(doc).agg(
        F.count_if((F.col("kind") == "english") & eng_ok).alias("n_english_usable"),
        F.count_if((F.col("kind") == "attach") & att_ok).alias("n_attach_pdf"))
    out = docs.join(counts, doc, "left").fillna(0, ["n_english_usable", "n_attach_pdf"])
    status = (F.when(F.col("english_flag") & (F.col("n_english_usable") == 0), "english_empty")
              .when(F.col("attachment_flag") & (F.col("n_attach_pdf") == 0), "attachment_empty"))
    return out.withColumn("anomaly_status", status)
