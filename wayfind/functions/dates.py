"""Dates and schedules as columns: windows, splits, cadence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_days(first: Column, last: Column, days: Column) -> Column:
    """Array of (label, after, before, content_from, content_to): consecutive runs of days, the last one clipped; after and before lie one day outside."""
    step = F.greatest(F.lit(1), days).cast("int")
    runs = F.floor(F.datediff(last, first) / step).cast("int")
    starts = F.when(last >= first, F.transform(F.sequence(F.lit(0), F.greatest(runs, F.lit(0))), lambda i: F.date_add(first, i * step)))

    def one(start: Column, i: Column) -> Column:
        end = F.least(F.date_add(start, step - 1), last)
        return F.struct(F.concat(F.lit("P"), (i + 1).cast("string")).alias("label"), F.date_sub(start, 1).alias("after"), F.date_add(end, 1).alias("before"), start.alias("content_from"), end.alias("content_to"))

    return F.transform(starts, one)


def split_overlapping(first: Column, last: Column, days: int) -> Column:
    """P20: array of (content_from, content_to), each window starting on the last day of the one before, until one reaches the end."""
    step = max(1, days - 1)
    count = F.when(F.datediff(last, first) <= days - 1, F.lit(0)).otherwise(F.ceil((F.datediff(last, first) - (days - 1)) / step))
    starts = F.transform(F.sequence(F.lit(0), count.cast("int")), lambda i: F.date_add(first, i * step))
    return F.when(last >= first, F.transform(starts, lambda s: F.struct(s.alias("content_from"), F.least(F.date_add(s, days - 1), last).alias("content_to"))))


def stable_hash(text: Column) -> Column:
    """The 31-polynomial over characters in 32 signed bits, as an absolute value."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    wrapped = F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + c, F.lit(1 << 32)))
    return F.abs(F.when(wrapped >= 1 << 31, wrapped - (1 << 32)).otherwise(wrapped))


def is_due(key: Column, cadence_days: Column, today: Column) -> Column:
    """Whether a chunk's turn falls on the day; a cadence of a day or less is always due."""
    days = F.greatest(cadence_days, F.lit(1))  # the division below is evaluated for every row
    return (cadence_days <= 1) | ((F.unix_date(today) - stable_hash(key) % days) % days == 0)


def run_type(job_type: Column) -> Column:
    """The type of run of a job: a manual job is a backfill."""
    return F.when(job_type == "manual", "backfill").otherwise(job_type)


def run_window(first: Column, last: Column) -> Column:
    """(start, end) in UTC, without zone, of a run over whole days at +07:00."""
    shift = F.make_dt_interval(F.lit(0), F.lit(7))
    start, end = first.cast("timestamp_ntz") - shift, F.date_add(last, 1).cast("timestamp_ntz") - shift - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    return F.struct(start.alias("start"), end.alias("end"))


def window_back(today: Column, window_days: Column) -> Column:
    """(date_from, date_to) of a window that ends today."""
    return F.struct(F.date_sub(today, window_days).alias("date_from"), today.alias("date_to"))
