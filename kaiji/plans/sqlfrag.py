"""DuckDB SQL fragments used to write the oracle statements.

These restate the scalar rules of ``kaiji.functions`` in plain SQL so the
oracle is an independent formulation, not the Spark plan printed as text.
DuckDB allows a select-list alias to be reused later in the same list,
which keeps the statements short.
"""

from __future__ import annotations


def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def norm_code_cols(x: str, p: str, nat: str | None = "JP") -> str:
    """Select-list items computing P1 of ``x`` into ``{p}_code`` (helpers ``{p}_*``)."""
    nat_else = f"'{nat}'" if nat else "NULL"
    return f"""{strip(x)} AS {p}_s,
  CASE WHEN strpos({p}_s, ':') > 0 THEN upper(split_part({p}_s, ':', 1)) ELSE {nat_else} END AS {p}_nat,
  CASE WHEN strpos({p}_s, ':') > 0 THEN {strip(f"substr({p}_s, strpos({p}_s, ':') + 1)")} ELSE {p}_s END AS {p}_c0,
  CASE WHEN suffix({p}_c0, '.0') THEN left({p}_c0, length({p}_c0) - 2) ELSE {p}_c0 END AS {p}_c1,
  CASE WHEN {p}_nat = 'JP' AND length({p}_c1) = 4 THEN {p}_c1 || '0' ELSE {p}_c1 END AS {p}_core,
  CASE WHEN {p}_s IS NULL OR {p}_s = '' OR lower({p}_s) IN ('none', 'nan') THEN NULL
       WHEN {p}_nat IS NOT NULL AND {p}_nat <> '' AND {p}_core <> '' THEN {p}_nat || ':' || {p}_core
       WHEN {p}_core <> '' THEN {p}_core END AS {p}_code"""


def bin_id(e: str, c: str, j: str) -> str:
    """P4 as one CASE expression."""
    es = strip(f"coalesce(CAST({e} AS VARCHAR), '')")
    cs = f"regexp_extract({strip(f'coalesce(CAST({c} AS VARCHAR), {chr(39)}{chr(39)})')}, '[^:]*$')"
    js = strip(f"coalesce(CAST({j} AS VARCHAR), '')")

    def ok(s):
        return f"(length({s}) >= 2 AND lower({s}) NOT IN ('none', 'nan', 'null'))"
    return (f"CASE WHEN {ok(es)} THEN 'E' || right({es}, 2) "
            f"WHEN {ok(cs)} THEN 'P' || CASE WHEN length({cs}) >= 3 THEN substr({cs}, length({cs}) - 2, 2) "
            f"ELSE substr({cs}, 1, 1) END "
            f"WHEN {ok(js)} THEN 'J' || right({js}, 2) ELSE 'No' END")


def counter_class(v: str = "verdict", r: str = "reason") -> str:
    return (f"CASE WHEN {v} = 'parse' THEN 'parse' WHEN {v} = 'save_raw' THEN 'save' "
            f"WHEN {v} = 'skip_already_processed' THEN 'processed' WHEN {v} = 'skip_withdrawn' THEN 'withdrawn' "
            f"WHEN {r} = 'invalid_code_length' THEN 'format_err' "
            f"WHEN {r} IN ('no_sec_code', 'has_sec_code') THEN 'no_code' "
            f"WHEN {r} = 'invalid_metadata' THEN 'invalid_meta' ELSE 'processed' END")


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def parse_dt(x: str) -> str:
    """P2 in DuckDB."""
    s = f"CAST({x} AS VARCHAR)"
    return (f"CASE WHEN length({s}) > 16 THEN try_strptime(substr({s}, 1, 19), '%Y-%m-%d %H:%M:%S') "
            f"ELSE try_strptime(substr({s}, 1, 16), '%Y-%m-%d %H:%M') END")


def repo_path(doc: str, sub: str, suffix: str = "zip") -> str:
    s = f"CAST({sub} AS VARCHAR)"
    d = f"substr({s}, 1, 10)"
    return (f"CASE WHEN {s} IS NOT NULL AND length({s}) >= 10 AND len(string_split({d}, '-')) = 3 "
            f"THEN 'raw/edinet/year=' || split_part({d}, '-', 1) || '/month=' || split_part({d}, '-', 2) "
            f"|| '/day=' || split_part({d}, '-', 3) || '/{suffix}/' || {doc} || '.{suffix}' "
            f"ELSE 'raw/edinet/unknown/{suffix}/' || {doc} || '.{suffix}' END")


def status_rank(x: str) -> str:
    return (f"CASE {x} WHEN 'retracted' THEN 1 WHEN 'failure' THEN 2 WHEN 'english_empty' THEN 3 "
            f"WHEN 'attachment_empty' THEN 4 WHEN 'parsed' THEN 5 WHEN 'success' THEN 6 ELSE 99 END")


MORE_TEXT = {"filer_name_en": "company_name_en", "filer_name_kana": "company_name_kana", "issuer_edinet_code": "issuer_x",
             "subject_edinet_code": "subject_x", "subsidiary_edinet_code": "subsidiary_x", "fund_code": "fund_x",
             "disclosure_status": "disclosure_x", "legal_status": "legal_x", "current_report_reason": "reason_x",
             "pdf_path": "pdf_path_x", "english_path": "english_path_x", "attach_path": "attach_path_x", "ope_date_time": "ope_x"}
MORE_FLAGS = {"pdf_flag": "pdf_flag_x", "csv_flag": "csv_flag_x", "english_flag": "english_flag_x", "attach_flag": "attachment_flag"}


def catalog_record_select(src: str = "v_filings") -> str:
    """P13 projection in DuckDB (columns as kaiji.operators.catalog.catalog_record)."""
    return f"""SELECT doc_id, {blank_null('jcn')} AS jcn,
  {norm_code_cols('sec_code', 'n')},
  n_code AS code,
  coalesce({blank_null('filer_name')}, 'Unknown') AS company_name,
  {blank_null('edinet_code')} AS edinet_code,
  {parse_dt('submit_at')} AS submit_at_ts,
  seq_number,
  CASE WHEN {strip('period_end')} <> '' THEN TRY_CAST(substr({strip('period_end')}, 1, 4) AS BIGINT) END AS fiscal_year,
  {blank_null('period_start')} AS period_start_s,
  {blank_null('period_end')} AS period_end_s,
  CAST(round((datediff('day', CAST(try_strptime({strip('period_start')}, '%Y-%m-%d') AS DATE),
        CAST(try_strptime({strip('period_end')}, '%Y-%m-%d') AS DATE)) + 1) / 30.4375) AS BIGINT) AS nm_raw,
  CASE WHEN nm_raw BETWEEN 1 AND 24 THEN nm_raw END AS num_months,
  coalesce(doc_type, '') AS doc_type_s,
  {blank_null('title')} AS title_s,
  {blank_null('form_code')} AS form_code_s,
  {blank_null('ordinance_code')} AS ordinance_code_s,
  (coalesce({strip('parent_doc_id')} <> '', false) OR coalesce(suffix(doc_type, '1'), false)
   OR coalesce(strpos(title, '訂正') > 0, false)) AS is_amendment,
  {blank_null('parent_doc_id')} AS parent_doc_id_s,
  {blank_null('withdrawal_status')} AS withdrawal_status_s,
  {blank_null('doc_info_edit_status')} AS doc_info_edit_status_s,
  coalesce(xbrl_flag = '1', false) AS xbrl_flag_b,
  {blank_null('raw_zip_path')} AS raw_zip_path_s,
  {repo_path('doc_id', 'submit_at')} AS zip_repo_path,
  {", ".join(f"{blank_null(c)} AS {o}" for c, o in MORE_TEXT.items())},
  {", ".join(f"coalesce({c} = '1', false) AS {o}" for c, o in MORE_FLAGS.items())},
  CAST(NULL AS VARCHAR) AS accounting_standard, CAST(NULL AS VARCHAR) AS processed_status,
  'EDINET' AS source
FROM {src}"""


CATALOG_COLS = ("doc_id, jcn, code, company_name, edinet_code, submit_at_ts AS submit_at, seq_number, fiscal_year, "
                "period_start_s AS period_start, period_end_s AS period_end, num_months, doc_type_s AS doc_type, "
                "title_s AS title, form_code_s AS form_code, ordinance_code_s AS ordinance_code, is_amendment, "
                "parent_doc_id_s AS parent_doc_id, withdrawal_status_s AS withdrawal_status, "
                "doc_info_edit_status_s AS doc_info_edit_status, xbrl_flag_b AS xbrl_flag, "
                "raw_zip_path_s AS raw_zip_path, zip_repo_path, source, accounting_standard, processed_status, "
                + ", ".join(o if not o.endswith("_x") else f"{o} AS {c}" for c, o in (MORE_TEXT | MORE_FLAGS).items()))
