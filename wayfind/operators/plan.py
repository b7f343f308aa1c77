"""Plan generation: places to chunks, due chunks, windows, query texts, page caps."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.functions import dates, text
from wayfind.operators.ordered import product

# Fixed value: page caps by tier where a profile has no depth table.
PAGES_BY_TIER = {"A": 10, "B": 3, "C": 1}


def chunk_places(places: DataFrame, per_query: int) -> DataFrame:
    """Key, province, cadence, idx, names: places of one province and cadence in list order, cut every per_query.

    The only rows that meet in a task are those of one province and cadence, a dimension.
    """
    if not isinstance(per_query, int) or per_query < 1:
        raise ValueError("per_query must be a positive integer")
    order = Window.partitionBy("province", "cadence").orderBy("ord", "name")
    numbered = places.select("province", "cadence", "ord", "name", F.floor((F.row_number().over(order) - 1) / per_query).cast("int").alias("idx"))
    grouped = numbered.groupBy("province", "cadence", "idx").agg(F.sort_array(F.collect_list(F.struct("ord", "name"))).alias("own"))
    return grouped.select(F.concat_ws("|", "province", "cadence", F.col("idx").cast("string")).alias("key"), "province", "cadence", "idx", F.transform("own", lambda p: p["name"]).alias("names"))


def due_chunks(chunks: DataFrame, cadence: DataFrame, today: Column) -> DataFrame:
    """Chunks whose turn it is, with date_from and date_to; cadence(cadence, cadence_days, window_days) is a dimension."""
    joined = chunks.join(cadence, "cadence")
    return joined.filter(dates.is_due(F.col("key"), F.col("cadence_days"), today)).withColumn("w", dates.window_back(today, F.col("window_days"))).select("key", "province", "cadence", "idx", "names", "w.date_from", "w.date_to")


def profile_plan(profiles: DataFrame, places: DataFrame, cadences: DataFrame, provinces: DataFrame, today: Column, requested: int, overall: int) -> DataFrame:
    """From tables of profiles, places and cadences the query bodies that are due: profile, key, province, cadence, tier, site, body, date_from, date_to, pages.

    A profile says how many places go into a query, which sites it covers, its intents and negative
    terms, overridden for single sites, and how many pages deep it goes by tier and cadence. Chunks
    whose bodies fit no budget give none; a place of an unknown province is an error.
    """
    size = F.col("places_per_query")
    order = Window.partitionBy("profile", "province", "cadence").orderBy("ord", "name")  # places of one province and cadence, a dimension
    numbered = places.join(profiles.select("profile", "places_per_query"), "profile").withColumn("idx", F.floor((F.row_number().over(order) - 1) / size).cast("int"))
    chunks = numbered.groupBy("profile", "province", "cadence", "idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda p: p["name"]).alias("names"))
    chunks = chunks.withColumn("key", F.concat_ws("|", "province", "cadence", F.col("idx").cast("string"))).join(cadences, ["profile", "cadence"])
    due = chunks.filter(dates.is_due(F.col("key"), F.col("cadence_days"), today)).withColumn("w", dates.window_back(today, F.col("window_days"))).select("profile", "province", "cadence", "key", "names", "w.date_from", "w.date_to")
    rows = place_provinces(due, provinces).join(profiles, "profile").withColumn("site", F.explode("sites"))
    rows = rows.withColumn("negatives", F.coalesce(F.try_element_at("negatives_by_site", F.col("site")), F.col("negatives")))
    made = text.fitted_groups(F.col("site"), F.col("names"), F.col("intents"), F.lit(None).cast("string"), F.col("negatives"), text.WORD_BUDGET)
    bodies = F.flatten(F.transform(made, lambda g: text.bodies(F.col("site"), g, F.col("intents"), F.lit(None).cast("string"), F.col("negatives"), text.WORD_BUDGET)))
    depth = F.try_element_at(F.try_element_at("page_depth", F.col("tier")), F.col("cadence"))
    return rows.select("profile", "key", "province", "cadence", "tier", "site", F.explode(bodies).alias("body"), "date_from", "date_to", page_cap(depth, F.col("tier"), F.lit(requested), F.lit(overall)).alias("pages"))


def page_cap(profile_cap: Column, tier: Column, requested: Column, overall: Column) -> Column:
    """The smallest of the profile's (or the tier's), the requested and the overall number of pages, at least 1."""
    return F.greatest(F.lit(1), F.least(F.coalesce(profile_cap, text.table(PAGES_BY_TIER)[tier]), requested, overall))


def split_for(job_type: Column, time_filter: Column, given: Column) -> Column:
    """P25: days per split that a job really uses; 0 for none."""
    return F.when(time_filter != "custom", 0).when(job_type.isin("backfill", "reconciliation"), 1).when(job_type == "daily", 0).otherwise(given)


def mode_for(job_type: Column) -> Column:
    return F.when(job_type == "daily", "rolling").otherwise("bounded")


def fan_out(jobs: DataFrame) -> DataFrame:
    """A query per site, text and date chunk of jobs(…, site, text, date_from, date_to, split, time_filter, mode).

    Adds label, after, before, content_from, content_to and query; every job row fans out by itself, without a shuffle.
    """
    first, last = F.col("date_from"), F.col("date_to")
    one = lambda label, after, before: F.array(F.struct(label.alias("label"), after.alias("after"), before.alias("before"), first.alias("content_from"), last.alias("content_to")))
    chunks = F.when(F.col("time_filter") != "custom", one(F.col("time_filter"), first, last)).when(F.col("mode") == "rolling", one(F.lit("ROLLING"), F.date_sub(first, 1), last)).when(F.col("split") > 0, dates.split_days(first, last, F.col("split"))).otherwise(one(F.lit("ALL"), F.date_sub(first, 1), F.date_add(last, 1)))
    out = jobs.withColumn("c", F.explode(chunks)).select(*jobs.columns, "c.*")
    return out.withColumn("query", text.compose(F.col("site"), F.col("text"), F.col("after"), F.col("before"), F.col("time_filter"), F.col("mode")))


def cross_plan(chunks: DataFrame, windows: DataFrame, intents: int) -> DataFrame:
    """Every chunk in every window with every intent, ordered by tier, window, key and intent, with a stable id.

    windows(content_from, content_to) is what dates.split_overlapping gives for one date range.
    """
    spans = windows.select("content_from", "content_to").distinct()
    crossed = product(chunks, spans).withColumn("intent", F.explode(F.sequence(F.lit(0), F.lit(intents - 1))))
    crossed = crossed.withColumn("item_id", F.concat_ws("|", "key", F.col("intent").cast("string"), F.date_format("content_from", "yyyy-MM-dd"), F.date_format("content_to", "yyyy-MM-dd")))
    return crossed.orderBy("tier", "content_from", "key", "intent")


def with_bodies(chunks: DataFrame, budget: int = text.WORD_BUDGET) -> DataFrame:
    """chunks(…, site, names, intents, literal, negatives) to query bodies, the reason where none fits."""
    groups = text.fitted_groups(F.col("site"), F.col("names"), F.col("intents"), F.col("literal"), F.col("negatives"), budget)
    made = F.flatten(F.transform(groups, lambda g: text.bodies(F.col("site"), g, F.col("intents"), F.col("literal"), F.col("negatives"), budget)))
    return chunks.withColumn("groups", groups).withColumn("bodies", made).withColumn("dropped", F.when(F.col("groups").isNull(), "over_budget"))


def query_bodies(rows: DataFrame, budget: int = text.WORD_BUDGET) -> DataFrame:
    """One row per query body of rows(..., site, use_legacy, tier, names, supported, intents, literal, negatives), with `branch`.

    Rows of a legacy profile get its one text (none on a site that it doesn't know); the others the
    bodies of their places, none on a site that the profile doesn't support or where none fits the budget.
    """
    legacy = F.array_compact(F.array(text.legacy_text(F.col("site"), F.col("tier"), F.col("names"))))
    groups = text.fitted_groups(F.col("site"), F.col("names"), F.col("intents"), F.col("literal"), F.col("negatives"), budget)
    own = F.flatten(F.transform(groups, lambda g: text.bodies(F.col("site"), g, F.col("intents"), F.col("literal"), F.col("negatives"), budget)))
    supported = F.array_contains("supported", F.col("site"))
    made = F.when(F.col("use_legacy"), legacy).when(supported, own)
    return rows.withColumn("branch", F.when(F.col("use_legacy"), "legacy").otherwise("chunk")).select("*", F.posexplode(made).alias("body_no", "text"))


def window_queries(windows: DataFrame, sites: list[str], job_type: Column, time_filter: Column, split_days: Column, budget: int = text.WORD_BUDGET) -> DataFrame:
    """Every query of every window, site, body and date chunk: windows(..., use_legacy, tier, names, supported, intents, literal, negatives, date_from, date_to).

    All fans out in place, so the only rows that move are those of the windows.
    """
    rows = windows.withColumn("site", F.explode(text.strings(sites)))
    rows = query_bodies(rows, budget).withColumn("time_filter", time_filter)
    return fan_out(rows.withColumn("split", split_for(job_type, F.col("time_filter"), split_days)).withColumn("mode", mode_for(job_type)))


def filtered(items: DataFrame, tiers: list[str] | None = None, provinces: list[str] | None = None, windows: list[int] | None = None) -> DataFrame:
    """Items of the given tiers, provinces and window indexes; None takes all, an empty list of windows is an error."""
    if windows is not None and not windows:
        raise ValueError("no windows")
    for name, wanted in (("tier", tiers), ("province", provinces), ("window", windows)):
        items = items if wanted is None else items.filter(F.col(name).isin(wanted))
    return items


def cut_off(queries: DataFrame, order: list[str], most: int, prefix: str = "probe-") -> DataFrame:
    """The first `most` queries in generation order, with an id by place. Spark keeps `most` rows per task before they meet."""
    first = queries.orderBy(*order).limit(most)
    return first.withColumn("id", F.concat(F.lit(prefix), F.row_number().over(Window.orderBy(*order)).cast("string")))


def samples(chunks: DataFrame, fallback: DataFrame, province: str) -> DataFrame:
    """The first chunk of the province in tier A, and the first of tier C, from the fallback where the plan has none; chunks(key, province, tier, ord)."""
    first = lambda rows, rank: rows.agg(F.min(F.struct(F.lit(rank).alias("rank"), "ord", "key", "province", "tier")).alias("s"))
    own = first(chunks.filter((F.col("province") == province) & (F.col("tier") == "A")), 0).filter("s is not null")
    last = first(chunks.filter("tier = 'C'"), 0).unionByName(first(fallback.filter("tier = 'C'"), 1)).agg(F.min("s").alias("s")).filter("s is not null")
    return own.unionByName(last).select("s.key", "s.province", "s.tier")


def coverage(chunks: DataFrame, cadence: DataFrame, today: Column, keys: list[str]) -> DataFrame:
    """Places, and those of chunks that are due today, by keys (none: one row)."""
    joined = chunks.join(cadence, "cadence")
    due = dates.is_due(F.col("key"), F.col("cadence_days"), today)
    return joined.groupBy(*keys).agg(F.coalesce(F.sum(F.size("names")), F.lit(0)).alias("places"), F.coalesce(F.sum(F.when(due, F.size("names")).otherwise(0)), F.lit(0)).alias("due"))


def credit_estimate(items: DataFrame) -> DataFrame:
    """Per tier the chunks, query groups and the most requests that paging may take, from items(tier, key)."""
    cap = text.table(PAGES_BY_TIER)[F.col("tier")]
    return items.groupBy("tier").agg(F.countDistinct("key").alias("chunks"), F.count(F.lit(1)).alias("query_groups"), F.sum(cap).cast("long").alias("request_max"))


def load_rollup(chunks: DataFrame, cadence: DataFrame, intents: int) -> DataFrame:
    """Chunks and queries per day by tier and cadence, with totals per tier and overall (null keys)."""
    joined = chunks.join(cadence, "cadence")
    return joined.rollup("tier", "cadence").agg(F.count(F.lit(1)).alias("chunks"), F.round(F.sum(F.lit(float(intents)) / F.col("cadence_days")), 6).alias("queries_per_day"))


def place_provinces(places: DataFrame, provinces: DataFrame, strict: bool = True) -> DataFrame:
    """Places with their province's columns; a place of an unknown province is an error, or dropped if not strict."""
    known = places.join(provinces, "province", "left" if strict else "inner")
    if not strict:
        return known
    missing = F.col("tier").isNull()
    return known.withColumn("tier", F.when(missing, F.raise_error(F.concat(F.lit("unknown province: "), F.col("province")))).otherwise(F.col("tier")))


def require_known(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Wanted as it is; an action fails on the first key that known lacks."""
    joined = wanted.join(known.select(key, F.lit(True).alias("__known")).distinct(), key, "left")
    return joined.withColumn(key, F.when(F.col("__known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit(f"unknown {key}: "), F.col(key).cast("string"))))).drop("__known")


def fingerprint(plan: DataFrame, fields: list[str]) -> DataFrame:
    """Plan with the SHA-256 of the JSON of fixed fields, in that order."""
    return plan.withColumn("fingerprint", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def resume_fingerprints(profile: str, date_from: str, date_to: str, window_days: int, places_per_query: int, tiers: list[str], sites: list[str], page_max: dict[str, int], full_page: int) -> list[str]:
    """The fingerprint of a backfill and the two older ones under which it may be resumed: with its paging limits, and with the usual caps by tier.

    SHA-256 of the compact JSON of fixed fields, in that order. The present one leaves paging limits
    out, so that a trial run can be resumed as a full one.
    """
    base = {"profile": profile, "range": {"from": date_from, "to": date_to}, "windowDays": window_days, "placesPerQuery": places_per_query, "tiers": tiers, "sites": sites}
    older = [base | {"pageMaxByTier": caps, "pageFullThreshold": full_page} for caps in (page_max, PAGES_BY_TIER)]
    return [hashlib.sha256(json.dumps(value, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest() for value in (base, *older)]
