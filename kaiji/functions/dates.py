"""Date, period and path scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kaiji.functions.codes import col_, strip

# Average month length used for period months, and the valid range.
DAYS_PER_MONTH = 30.4375
MIN_MONTHS, MAX_MONTHS = 1, 24
# Amendment marker in titles.
AMENDMENT_MARK = "訂正"


def parse_datetime(c) -> Column:
    """More than 16 chars -> first 19 parsed with seconds, else first 16
    with minutes; failure (a bare date, blank) -> NULL. Returns timestamp_ntz."""
    s = col_(c).cast("string")
    with_sec = F.try_to_timestamp(s.substr(1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    with_min = F.try_to_timestamp(s.substr(1, 16), F.lit("yyyy-MM-dd HH:mm"))
    return F.when(F.length(s) > 16, with_sec).otherwise(with_min).cast("timestamp_ntz")


def lenient_date(c, fallback: Column | None = None) -> Column:
    """``yyyy-MM-dd``, ``yyyy/MM/dd`` or ``yyyyMMdd`` on the first 10 chars;
    otherwise the supplied fallback (the reference uses *now*; pass it in)."""
    if fallback is None:
        fallback = F.lit(None).cast("date")
    s = strip(c)
    head = s.substr(1, 10)
    parsed = F.coalesce(F.try_to_date(head, "yyyy-MM-dd"), F.try_to_date(head, "yyyy/MM/dd"),
                        F.try_to_date(head, "yyyyMMdd"))
    ok = s.isNotNull() & (s != "") & ~F.lower(s).isin("nan", "none")
    return F.when(ok, F.coalesce(parsed, fallback)).otherwise(fallback)


def repo_path(doc_id, submit_at, suffix: str = "zip") -> Column:
    """P10: ``raw/edinet/year=Y/month=M/day=D/<suffix>/<doc>.<suffix>`` from the
    first 10 chars of the submit time, else ``raw/edinet/unknown/...``."""
    s = col_(submit_at).cast("string")
    d = s.substr(1, 10)
    parts = F.split(d, "-")
    ok = s.isNotNull() & (F.length(s) >= 10) & (F.size(parts) == 3)
    tail = F.concat(F.lit(f"/{suffix}/"), col_(doc_id), F.lit(f".{suffix}"))
    return F.when(ok, F.concat(F.lit("raw/edinet/year="), parts[0], F.lit("/month="), parts[1],
                               F.lit("/day="), parts[2], tail)) \
        .otherwise(F.concat(F.lit("raw/edinet/unknown"), tail))


def fiscal_year(period_end) -> Column:
    """First 4 chars of the period end as a number."""
    pe = strip(period_end)
    return F.when(pe.isNotNull() & (pe != ""), pe.substr(1, 4).try_cast("bigint"))


def num_months(period_start, period_end) -> Column:
    """round((days + 1) / 30.4375), kept only in 1..24."""
    d1 = F.try_to_date(strip(period_start), "yyyy-MM-dd")
    d2 = F.try_to_date(strip(period_end), "yyyy-MM-dd")
    m = F.bround((F.datediff(d2, d1) + 1) / F.lit(DAYS_PER_MONTH), 0).cast("bigint")
    return F.when(m.between(MIN_MONTHS, MAX_MONTHS), m)


def is_amendment(parent_doc_id, doc_type, title) -> Column:
    """P12 (with D3 fixed): a non-blank parent id, a type ending in 1, or 訂正 in the title."""
    p = strip(parent_doc_id)
    return (F.coalesce(p != "", F.lit(False))
            | F.coalesce(col_(doc_type).endswith("1"), F.lit(False))
            | F.coalesce(F.instr(col_(title), AMENDMENT_MARK) > 0, F.lit(False)))
