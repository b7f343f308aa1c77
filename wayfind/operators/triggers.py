"""Trigger messages: validation with every error named, accepted jobs and rejects, query plans, done messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfind.functions.text import SPACE, canonical_site, trimmed
from wayfind.operators.results import once

# Allowed words of a message.
JOB_TYPES = ["daily", "backfill", "manual", "reconciliation"]
TIME_FILTERS = ["any", "past_hour", "past_24_hours", "past_week", "past_month", "custom"]
SCHEMA = "job_id string, job_type string, search_sites array<string>, date_from string, date_to string, search_profile string, time_filter string, keyword_ids array<double>, split_days double, max_pages double"


def _date(c: Column) -> Column:
    own = F.regexp_extract(c, rf"^{SPACE}*([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){SPACE}*$", 1)
    return F.when(own != "", own.try_cast("date"))


def parsed(messages: DataFrame, profiles: list[str], default_profile: str, value: str = "value") -> DataFrame:
    """Messages with the normalised fields of a job and `errors`, an array of the rules it breaks.

    A message that is no JSON object has the one error `payload`. Values of a wrong type are read as
    null by the schema and so break the rule of their field.
    """
    m = once(messages, "__m", F.from_json(F.col(value).cast("string"), SCHEMA))
    raw = lambda name: F.col(f"__m.{name}")
    blank = lambda c: c.isNull() | (c == "")
    word = lambda name: F.lower(trimmed(raw(name)))
    words = F.transform(raw("search_sites"), lambda s: trimmed(F.lower(s)))
    sites = F.array_distinct(F.filter(F.transform(words, canonical_site), lambda s: s != ""))
    named = {"job_id": trimmed(raw("job_id")), "job_type": word("job_type"), "sites": sites, "date_from": _date(raw("date_from")), "date_to": _date(raw("date_to")), "profile": word("search_profile"), "time_filter": word("time_filter")}
    m = once(m, "__n", F.struct(*(c.alias(name) for name, c in named.items())))
    n = lambda name: F.col(f"__n.{name}")
    whole = lambda c: c == F.floor(c)
    profile = F.when(blank(n("profile")), F.lit(default_profile)).otherwise(n("profile"))
    ids = raw("keyword_ids")
    rules = {
        "job_id": blank(n("job_id")),
        "job_type": ~F.coalesce(n("job_type").isin(JOB_TYPES), F.lit(False)),
        "search_sites": F.coalesce(F.size(n("sites")), F.lit(0)) <= 0,
        "date_from": n("date_from").isNull(),
        "date_to": n("date_to").isNull(),
        "search_profile": ~profile.isin(profiles),
        "date_order": F.coalesce(n("date_to") < n("date_from"), F.lit(False)),
        "time_filter": ~blank(n("time_filter")) & ~n("time_filter").isin(TIME_FILTERS),
        "keyword_ids": F.coalesce(F.exists(ids, lambda i: F.coalesce((i <= 0) | ~whole(i), F.lit(True))), F.lit(False)),
        "split_days": F.coalesce((raw("split_days") < 0) | ~whole(raw("split_days")), F.lit(False)),
        "max_pages": F.coalesce((raw("max_pages") < 1) | (raw("max_pages") > 10) | ~whole(raw("max_pages")), F.lit(False)),
    }
    told = F.concat_ws(",", *(F.when(rule, F.lit(name)) for name, rule in rules.items()))  # unlike a filtered array, compiled code
    broken = F.when(told == "", F.array().cast("array<string>")).otherwise(F.split(told, ","))
    object_ = F.trim(F.col(value).cast("string")).startswith("{") & F.col("__m").isNotNull()
    return m.select(
        *messages.columns, F.when(object_, broken).otherwise(F.array(F.lit("payload"))).alias("errors"), n("job_id").alias("job_id"), n("job_type").alias("job_type"), n("sites").alias("sites"), n("date_from").alias("date_from"), n("date_to").alias("date_to"), profile.alias("profile"),
        F.when(~blank(n("time_filter")), n("time_filter")).alias("time_filter"), F.when(F.size(ids) > 0, F.array_distinct(F.transform(ids, lambda i: i.cast("long")))).alias("keyword_ids"), raw("split_days").cast("int").alias("split_days"), raw("max_pages").cast("int").alias("max_pages"),
    )


def accepted(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.size("errors") == 0).drop("errors")


def rejected(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.size("errors") > 0)


def site_sets(requested: Column, supported: Column) -> tuple[Column, Column]:
    """Requested sites that are supported, in the order asked for, and those that are not."""
    return F.array_intersect(requested, supported), F.array_except(requested, supported)


def done_messages(jobs: DataFrame, source: str) -> DataFrame:
    """Key and JSON value of the done message of each job; null fields are left out."""
    return jobs.select(F.col("job_id").alias("key"), F.to_json(F.struct(F.lit(source).alias("source"), F.lit("done").alias("status"), *(c for c in jobs.columns if c != "job_id"))).alias("value"))


def summaries(jobs: DataFrame) -> DataFrame:
    """A job's log line as JSON: fixed keys, the arrays by their sizes."""
    return jobs.select("job_id", F.to_json(F.struct("job_id", "job_type", "profile", F.size("sites").alias("sites"), F.when(F.col("keyword_ids").isNotNull(), F.size("keyword_ids")).alias("keywords"), "split_days", "max_pages")).alias("summary"))
