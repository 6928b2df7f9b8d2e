"""Date ranges: consolidated fetch ranges (G8) and backfill window planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Backfill step, retry look-back, API history limit.
BACKFILL_DAYS = 7
RETRY_DAYS = 60
LIMIT_YEARS = 10
LIMIT_MARGIN_DAYS = 5


def date_islands(dates: DataFrame, col: str = "d") -> DataFrame:
    """Maximal runs of consecutive dates -> (range_start, range_end, n_days).

    Runs start where the previous day is absent and end where the next day is
    absent (two anti-joins, fully distributed). Starts and ends are then
    paired in order; both sides are distinct calendar days, so the pairing
    window works on a table bounded by the calendar (about 365 rows a year),
    not by the data volume.
    """
    d = dates.select(F.to_date(F.col(col)).alias("d")).filter(F.col("d").isNotNull()).distinct()
    prev = d.select(F.date_add("d", 1).alias("d"))
    nxt = d.select(F.date_sub("d", 1).alias("d"))
    starts = d.join(prev, "d", "left_anti").withColumnRenamed("d", "range_start")
    ends = d.join(nxt, "d", "left_anti").withColumnRenamed("d", "range_end")
    w1 = Window.orderBy("range_start")
    w2 = Window.orderBy("range_end")
    s = starts.withColumn("i", F.row_number().over(w1))
    e = ends.withColumn("i", F.row_number().over(w2))
    return (s.join(e, "i").select("range_start", "range_end",
                                  (F.datediff("range_end", "range_start") + 1).alias("n_days")))


def limit_date(as_of: Column) -> Column:
    """Oldest fetchable day: as-of minus 10 years (Feb 29 -> Feb 28), minus 5 days."""
    y, m, d = F.year(as_of) - LIMIT_YEARS, F.month(as_of), F.dayofmonth(as_of)
    base = F.coalesce(F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd"),
                      F.try_to_date(F.format_string("%04d-%02d-28", y, m), "yyyy-MM-dd"))
    return F.date_sub(base, LIMIT_MARGIN_DAYS)


def backfill_windows(cursors: DataFrame, as_of: str, col: str = "cursor") -> DataFrame:
    """From a cursor date (NULL = never run) and an as-of date, the next
    window [start, end] and the retry window; FINISHED once start >= yesterday."""
    asof = F.to_date(F.lit(as_of))
    lim = limit_date(asof)
    yesterday = F.date_sub(asof, 1)
    start = F.coalesce(F.to_date(F.col(col)), lim)
    end0 = F.date_add(start, BACKFILL_DAYS - 1)
    finished = start >= yesterday
    end = F.when(end0 >= yesterday, F.date_sub(yesterday, 1)).otherwise(end0)
    r_start = F.greatest(F.date_sub(start, RETRY_DAYS), lim)
    has_retry = ~finished & (r_start < start)
    return cursors.select(
        F.to_date(F.col(col)).alias("cursor"),
        F.when(finished, "FINISHED").otherwise("RUN").alias("state"),
        F.when(~finished, start).alias("start_date"),
        F.when(~finished, end).alias("end_date"),
        F.when(has_retry, r_start).alias("retry_start"),
        F.when(has_retry, F.date_sub(start, 1)).alias("retry_end"),
    )
