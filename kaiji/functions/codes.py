"""Code, identifier and sentinel scalars.

All functions map Column -> Column using built-in expressions only, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's rules.
# Sentinel strings that mean "no value" (compared trimmed, lower-cased).
NULL_SENTINELS = ("nan", "none", "", "-")
# Strings that mean "no value" for code-like identifiers.
CODE_SENTINELS = ("none", "nan")
ID_SENTINELS = ("none", "nan", "null")
# Legal-form tokens removed from company names, in the reference's order.
LEGAL_FORMS = ("株式会社", "有限会社", "合同会社", "（株）", "(株)", "（有）", "(有)")
# Consolidation and listing words.
YES_MARK, NO_MARK = "有", "無"
LISTED_MARK, UNLISTED_MARK = "上場", "非上場"

# The characters Python's str.strip() removes, derived from str.isspace().
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode white space
    (set-based ``trim``, no regex engine)."""
    return F.trim(col_(c).cast("string"), F.lit(PY_WHITESPACE))


def _after(s: Column, sep: str) -> Column:
    """Substring after the first ``sep`` (whole string when absent)."""
    return s.substr(F.instr(s, sep) + F.lit(1), F.lit(1 << 30))


def normalize_code(c, nationality: str | None = None) -> Column:
    """Security code in ``NAT:core`` form.

    NULL for null/blank/none/nan. A prefix before the first ``:`` is upper-cased
    and wins over ``nationality``. A trailing ``.0`` is dropped; a 4-char JP
    core gets a trailing ``0``. An empty core gives NULL.

    Written as a linear chain of single-reference steps so the expression
    stays small inside generated code.
    """
    s = F.regexp_replace(strip(c), r"(?i)^(none|nan)$", "")
    if nationality:
        # No prefix given: use the default nationality.
        s = F.regexp_replace(s, r"(?s)^([^:]*)$", f"{nationality.upper()}:$1")
    parts = F.split(s, ":", 2)
    x = F.when(F.size(parts) == 2,
               F.concat(F.upper(parts[0]), F.lit(":"), F.regexp_replace(parts[1], r"(?U)^\s+", ""))) \
        .otherwise(parts[0])
    x = F.regexp_replace(x, r"\.0$", "")
    x = F.regexp_replace(x, r"(?s)^JP:(?<c>.{4})$", "JP:${c}0")
    x = F.regexp_replace(x, r"^:", "")
    # An empty core (``JP:``) or an empty string means no code.
    return F.nullif(F.regexp_replace(x, r"(?s)^[^:]*:$", ""), F.lit(""))


def code_core(norm: Column) -> Column:
    """Core part of a normalised code (after the first ``:``)."""
    return F.when(F.instr(norm, ":") > 0, _after(norm, ":")).otherwise(norm)


def parent_code(code) -> Column:
    """Parent share code; a core not ending in 0 maps to ``JP:`` + first 4 + ``0``."""
    core = code_core(col_(code))
    return F.when(col_(code).isNotNull() & (F.substring(core, -1, 1) != "0"),
                  F.concat(F.lit("JP:"), core.substr(1, 4), F.lit("0")))


# A usable identifier: at least two characters and not a sentinel word.
_ID_OK = r"(?s)^(?!(?i:none|nan|null)$)"


def bin_id(edinet, code, jcn) -> Column:
    """Immutable shard id. ``E``+last 2 of EDINET code, else ``P``+core[-3:-1],
    else ``J``+last 2 of the corporate number, else ``No``.

    Each identifier is referenced once (regex extracts inside a ``coalesce``),
    which keeps the generated code small."""
    e = strip(F.coalesce(col_(edinet).cast("string"), F.lit("")))
    c = F.substring_index(strip(F.coalesce(col_(code).cast("string"), F.lit(""))), ":", -1)
    j = strip(F.coalesce(col_(jcn).cast("string"), F.lit("")))
    last2 = _ID_OK + r".*(..)$"
    # Python's s[-3:-1]: the two characters before the last, or the first of two.
    mid = _ID_OK + r"(?:.*(..).|(.).)$"
    e2 = F.nullif(F.regexp_extract(e, last2, 1), F.lit(""))
    c2 = F.nullif(F.regexp_replace(c, mid, "$1$2"), F.lit(""))
    c2 = F.when(c.rlike(mid), c2)
    j2 = F.nullif(F.regexp_extract(j, last2, 1), F.lit(""))
    return F.coalesce(F.concat(F.lit("E"), e2), F.concat(F.lit("P"), c2), F.concat(F.lit("J"), j2), F.lit("No"))


def null_sentinel(c) -> Column:
    """P5: sentinel strings -> NULL, otherwise the trimmed string."""
    s = strip(c)
    return F.when(F.lower(s).isin(*NULL_SENTINELS), F.lit(None).cast("string")).otherwise(s)


def yes_no_flag(c) -> Column:
    """P5: 有 -> true, 無 -> false, sentinels -> NULL."""
    s = strip(c)
    return F.when(s == YES_MARK, F.lit(True)).when(s == NO_MARK, F.lit(False)) \
        .when(F.lower(s).isin(*NULL_SENTINELS) | s.isNull(), F.lit(None).cast("boolean"))


def listed_flag(c) -> Column:
    """P5: 上場 -> true, 非上場 and anything else -> false."""
    return F.coalesce(strip(c) == LISTED_MARK, F.lit(False))


def safe_int_str(c) -> Column:
    """``123.0`` -> ``123``; ``12.9`` -> ``12``; other text kept trimmed; blank -> NULL."""
    s = strip(c)
    d = s.try_cast("double")
    n = F.when(d.isNotNull() & ~F.isnan(d), d.try_cast("bigint").cast("string"))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(F.coalesce(n, s))


def percent_weight(c) -> Column:
    """Strip ``%``; empty -> 0.0; else float (bad text -> NULL)."""
    s = strip(F.regexp_replace(col_(c).cast("string"), "%", ""))
    return F.when(s == "", F.lit(0.0)).otherwise(s.try_cast("double"))


def company_name_core(c) -> Column:
    """Remove legal-form tokens, trim."""
    pattern = "|".join(_regex_quote(t) for t in LEGAL_FORMS)
    return F.when(col_(c).isNotNull() & (col_(c) != ""),
                  strip(F.regexp_replace(col_(c), pattern, ""))).otherwise(col_(c))


def taxonomy_key(c) -> Column:
    """Last ``_`` becomes ``:``; NULL when empty or without ``_`` (reject)."""
    s = col_(c)
    return F.when(F.instr(s, "_") > 0, F.regexp_replace(s, r"_([^_]*)$", ":$1"))


def _regex_quote(t: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in t)
