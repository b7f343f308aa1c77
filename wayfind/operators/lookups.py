"""Joins of plans, results and runs with their dimensions; what a dimension lacks is an error, a reason or a default, as each rule says.

No side is broadcast by a hint: dimensions are small where their tables say so, and the optimizer reads
those sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _required(value: Column, message: str, key: Column) -> Column:
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit(message), F.coalesce(key.cast("string"), F.lit("null"))))).otherwise(value)


def with_platform(rows: DataFrame, platforms: DataFrame, site: str = "site") -> DataFrame:
    """Rows with platform_id, by platforms(platform_id, domain); an action fails on the first site without one."""
    known = platforms.select(F.col("domain").alias("__domain"), "platform_id")
    joined = rows.join(known, rows[site] == known["__domain"], "left")
    return joined.withColumn("platform_id", _required(F.col("platform_id"), "unknown platform: ", F.col(site))).drop("__domain")


def with_tier(keywords: DataFrame, provinces: DataFrame) -> DataFrame:
    """Keywords with the tier of their province, `C` where it is unknown."""
    return keywords.join(provinces.select("province", "tier"), "province", "left").withColumn("tier", F.coalesce("tier", F.lit("C")))


def without_province(keywords: DataFrame, provinces: DataFrame) -> DataFrame:
    """Keywords whose province is unknown."""
    return keywords.join(provinces.select("province"), "province", "left_anti")


def with_keyword(items: DataFrame, keywords: DataFrame) -> DataFrame:
    """Items with the lowest keyword_id of their province, or with the skip_reason that there is none."""
    first = keywords.groupBy("province").agg(F.min("keyword_id").alias("keyword_id"))
    missing = F.when(F.col("keyword_id").isNull(), F.concat(F.lit("province "), F.coalesce("province", F.lit("null")), F.lit(" has no keyword")))
    return items.join(first, "province", "left").withColumn("skip_reason", missing)


def with_run(items: DataFrame, runs: DataFrame, keys: tuple[str, str] = ("site", "window")) -> DataFrame:
    """Items with the run_id of their site and window; an action fails on the first without one."""
    joined = items.join(runs.select(*keys, "run_id"), list(keys), "left")
    return joined.withColumn("run_id", _required(F.col("run_id"), "missing run: ", F.concat_ws("|", *(F.col(k).cast("string") for k in keys))))


def with_query_site(rows: DataFrame, plan: DataFrame, order: str) -> DataFrame:
    """rows(query) with the site that plan(query, site, order) gives the query's text, the last one of several; null for an unknown text."""
    last = plan.groupBy("query").agg(F.max_by("site", order).alias("site"))
    return rows.join(last, "query", "left")


def failing_sites(outcomes: DataFrame, plan: DataFrame) -> DataFrame:
    """The sites of failed and of blocked queries, each once per keyword, from outcomes(keyword, query, outcome)."""
    bad = outcomes.filter(F.col("outcome").isin("failed", "blocked"))
    return bad.join(plan.select("query", "site").distinct(), "query").select("keyword", "site", "outcome").distinct()


def of_plan(rows: DataFrame, items: DataFrame, key: str = "item") -> DataFrame:
    """Rows of a log whose item belongs to the plan."""
    return rows.join(items.select(key), key, "left_semi")


def window_status(failed: DataFrame, skipped: DataFrame, items: DataFrame) -> DataFrame:
    """For each window of items(item, window): items that failed or were skipped, and whether the window is ok (there are none)."""
    bad = failed.select("item").unionByName(skipped.select("item")).distinct().withColumn("bad", F.lit(True))
    return items.join(bad, "item", "left").groupBy("window").agg(F.count("bad").alias("failures"), (F.count("bad") == 0).alias("ok"))
