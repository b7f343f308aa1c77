"""Run accounting: page statistics, resume state, credits, rates, failures, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.operators.ordered import previous

COUNTERS = ["requests", "credit", "raw", "eligible", "inserted", "duplicate"]


def sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A1-A3: the six counters by keys (none: one row of totals), zero where there is nothing."""
    return rows.groupBy(*keys).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS))


def sums_with_total(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A1-A3: the six counters by keys and in total, in one pass; the total has null keys, and an empty table gives no row."""
    return rows.groupingSets([keys, []], *keys).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS))


def rate(part: Column, whole: Column, digits: int = 6) -> Column:
    """Part of whole; null where whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole), digits)


def continuation(pages: DataFrame, threshold: int) -> DataFrame:
    """A4: full pages, pages and their rate among done pages(status, raw), one row."""
    done = pages.filter("status = 'done'").agg(F.count_if(F.col("raw") >= threshold).alias("full_pages"), F.count(F.lit(1)).alias("pages"))
    return done.select("*", rate(F.col("full_pages"), F.col("pages")).alias("rate"), F.lit(threshold).alias("threshold"))


def remaining(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Per tier the items still to do, the unstarted and the capped ones.

    items(item, tier, page_max), pages(item, page, status, has_next), one row per item and page. An
    item's done prefix ends before its first page that is missing or not done; it is finished if a
    page of the prefix has no next one, and capped if the prefix reaches page_max all the same.
    """
    done = pages.filter("status = 'done'").select("item", "page", "has_next")
    joined = items.join(done.withColumnRenamed("item", "__item"), (F.col("item") == F.col("__item")) & (F.col("page") <= F.col("page_max")), "left")
    order = Window.partitionBy("item").orderBy("page")
    run = joined.withColumn("prefix", F.coalesce(F.row_number().over(order) == F.col("page"), F.lit(False)))  # pages are distinct and from 1
    state = run.groupBy("item", "tier", "page_max").agg(F.count_if("prefix").alias("n"), F.coalesce(F.bool_or(F.col("prefix") & ~F.col("has_next")), F.lit(False)).alias("finished"))
    todo = ~F.col("finished")
    return state.groupBy("tier").agg(F.count_if(todo).alias("todo"), F.count_if(todo & (F.col("n") == 0)).alias("unstarted"), F.count_if(todo & (F.col("n") == F.col("page_max"))).alias("capped"))


def running_credit(requests: DataFrame, limit: int, per_key: int, days: list[str] = ["day"]) -> DataFrame:  # noqa: B006
    """requests(day, ts, key) with totals up to each, and whether it is within both limits.

    Credits are counted per day, the unit that a budget is set for. Days rank in parallel, and within a
    day its seconds: what came before a second is added to it as one row for the day and one for each
    key, so requests are shuffled once, by second, for both totals.
    """
    second = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    rows = requests.withColumn("__second", second)
    own = rows.groupBy(*days, "key", "__second").agg(F.count(F.lit(1)).alias("__n"))
    upto = lambda keys: F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__second").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # noqa: E731  at most 86,400 rows a day
    of_key = own.select(*days, "key", "__second", F.lit(0).alias("__all"), upto([*days, "key"]).alias("__own"), F.lit(1).alias("__first"))
    of_day = own.groupBy(*days, "__second").agg(F.sum("__n").alias("__n")).select(*days, "__second", upto(days).alias("__all"), F.lit(0).alias("__own"), F.lit(1).alias("__first"))
    both = rows.select("*", F.lit(1).alias("__all"), F.lit(1).alias("__own"), F.lit(0).alias("__first"))
    for before in (of_key, of_day):
        both = both.unionByName(before, allowMissingColumns=True)
    slices = Window.partitionBy(*days, "__second")
    total = F.sum("__all").over(slices.orderBy(F.desc("__first"), "ts", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    key_total = F.sum("__own").over(Window.partitionBy(*days, "__second", "key").orderBy(F.desc("__first"), "ts").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = both.withColumn("total", total).withColumn("key_total", key_total).filter("__first = 0").select(*requests.columns, "total", "key_total")
    return out.withColumn("allowed", (F.col("total") <= limit) & (F.col("key_total") <= per_key))


def credit_stop(requests: DataFrame, limit: int, per_key: int) -> DataFrame:
    """W3 over a whole run: requests(ts, key, request) with key_total, total, allowed and, on the first request beyond the limit, stop.

    A request of a key that has used per_key counts nowhere, as it isn't made; of the others the first
    `limit` in order of (ts, key, request) are allowed, and the run stops at the next one.
    """
    rows = requests.withColumn("__day", F.to_date("ts")).withColumn("__second", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")))
    rows = _over_days(rows, ["key"], ["ts", "request"], F.lit(1), "key_total")
    made = (F.col("key_total") <= per_key).cast("int")
    rows = _over_days(rows, [], ["ts", "key", "request"], made, "total")
    stop = rows.filter(f"key_total <= {per_key} and total = {limit + 1}").select(F.col("request").alias("__stop"))  # one row at most
    out = rows.join(stop, rows["request"] == stop["__stop"], "left")
    return out.select(*requests.columns, "key_total", "total", ((F.col("key_total") <= per_key) & (F.col("total") <= limit)).alias("allowed"), F.col("__stop").isNotNull().alias("stop"))


def _over_days(rows: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """rows(__day, __second, ...) with the sum of value up to each row of the group: by days, then seconds of a day, then rows of a second."""
    rows = rows.withColumn("__v", value)
    for keys, at in (([*group], "__day"), ([*group, "__day"], "__second")):
        counts = rows.groupBy(*keys, at).agg(F.sum("__v").alias("__n"))
        before = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)  # one row a day, and 86,400 a day
        counts = counts.select(*(F.col(c).alias(f"__of_{c}") for c in (*keys, at)), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(f"__before{at}"))
        rows = rows.join(counts, [rows[c].eqNullSafe(counts[f"__of_{c}"]) for c in (*keys, at)]).drop(*(f"__of_{c}" for c in (*keys, at)))
    within = Window.partitionBy(*group, "__second").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.sum("__v").over(within) + F.col("__before__day") + F.col("__before__second")).drop("__v", "__before__day", "__before__second")


def key_usage(requests: DataFrame, per_key: int) -> DataFrame:
    """Usage and status of each key; a key that ever answered 402 or 403 is exhausted."""
    used = requests.groupBy("key").agg(F.count(F.lit(1)).alias("usage"), F.bool_or(F.col("status").isin(402, 403)).alias("refused"))
    return used.select("key", "usage", F.when(F.col("refused"), "exhausted").when(F.col("usage") >= per_key, "limit").otherwise("alive").alias("status"))


def totals(queries: DataFrame) -> DataFrame:
    """By job and keyword with a total per job (null keyword): found, inserted, queries, and both counts of duplicates.

    not_inserted is found less inserted, at least 0; eligible_duplicates is eligible less inserted.
    """
    out = queries.rollup("job", "keyword").agg(F.sum("found").alias("found"), F.sum("eligible").alias("eligible"), F.sum("inserted").alias("inserted"), F.count(F.lit(1)).alias("queries"))
    out = out.filter("job is not null")
    return out.select("job", "keyword", "found", "inserted", "queries", F.greatest(F.col("found") - F.col("inserted"), F.lit(0)).alias("not_inserted"), (F.col("eligible") - F.col("inserted")).alias("eligible_duplicates"))


def inserted_by_site(posts: DataFrame, sites: DataFrame) -> DataFrame:
    """Posts inserted per site of sites(site), 0 where there are none."""
    counts = posts.groupBy("site").agg(F.count(F.lit(1)).alias("inserted"))
    return sites.select("site").distinct().join(counts, "site", "left").select("site", F.coalesce("inserted", F.lit(0)).alias("inserted"))


def with_exceptions(outcomes: DataFrame, exceptions: DataFrame, sites: list[str]) -> DataFrame:
    """A10: outcomes(site, keyword, outcome) and a failure of every site for each keyword of exceptions(keyword) that broke off as a whole."""
    lost = exceptions.select(F.explode(F.array(*map(F.lit, sites))).alias("site"), "keyword", F.lit("failed").alias("outcome"))
    return outcomes.select("site", "keyword", "outcome").unionByName(lost)


def site_failures(outcomes: DataFrame, limit: float = 0.15) -> DataFrame:
    """Per site: keywords that failed or were blocked at least once, queries, fail rate (0 without queries) and whether it is above the limit."""
    bad = F.col("outcome").isin("failed", "blocked")
    out = outcomes.groupBy("site").agg(F.countDistinct(F.when(F.col("outcome") == "failed", F.col("keyword"))).alias("failed"), F.countDistinct(F.when(F.col("outcome") == "blocked", F.col("keyword"))).alias("blocked"), F.count(F.lit(1)).alias("queries"), F.count_if(bad).alias("bad"))
    share = F.coalesce(rate(F.col("bad"), F.col("queries")), F.lit(0.0))
    return out.select("site", "failed", "blocked", "queries", share.alias("fail_rate"), (share > limit).alias("job_failed"))


def run_close(items: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """A13, backfills: closing row of each run of items(run_id, raw, inserted, status): all raw results against what was inserted.

    ok unless an item failed or was skipped, or the whole backfill was stopped: runs(run_id, stopped)
    tells that. A run of which no item is left has sums of 0. run_close_by_site() has the convention of jobs.
    """
    bad = F.coalesce(F.bool_or(F.col("status").isin("failed", "skipped")), F.lit(False))
    own = items.groupBy("run_id").agg(F.sum("raw").alias("discovered"), F.sum("inserted").alias("scraped"), bad.alias("bad"))
    if runs is not None:
        told = runs.groupBy("run_id").agg(F.coalesce(F.bool_or("stopped"), F.lit(False)).alias("stopped"))
        own = told.join(own, "run_id", "left").select("run_id", F.coalesce("discovered", F.lit(0)).alias("discovered"), F.coalesce("scraped", F.lit(0)).alias("scraped"), (F.coalesce("bad", F.lit(False)) | F.col("stopped")).alias("bad"))
    return own.select("run_id", "discovered", "scraped", (~F.col("bad")).alias("ok"), F.when(F.col("bad"), "failed").otherwise("completed").alias("status"))


def run_close_by_site(items: DataFrame, failures: DataFrame) -> DataFrame:
    """A13, jobs: closing row of each run of items(run_id, site, inserted): what was inserted counts as discovered, ok unless failures(site) names its site."""
    bad = failures.select("site").distinct().withColumn("bad", F.lit(True))
    own = items.groupBy("run_id", "site").agg(F.sum("inserted").alias("discovered")).join(bad, "site", "left")
    return own.select("run_id", "site", "discovered", F.col("bad").isNull().alias("ok"), F.when(F.col("bad").isNull(), "completed").otherwise("failed").alias("status"))


def closing_events(closed: DataFrame, at: Column) -> DataFrame:
    """The event that closes each run of run_close(), to be appended to the log of open_runs()."""
    return closed.select("run_id", "status", F.lit(1).cast("long").alias("seq"), "discovered", at.alias("completed_at"))


def report(rows: DataFrame) -> DataFrame:
    """A2, O2: the six counters by tier, province and window, in order of window, tier, province."""
    return sums(rows, ["window", "tier", "province"]).orderBy("window", "tier", "province")


def done_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Pages done by keys (none: one row), from the latest state of each page."""
    return pages.groupBy(*keys).agg(F.count_if(F.col("status") == "done").alias("completed_pages"))


def latest(events: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The current state of an append-only log: the event of highest seq of each key."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("now")).select(*keys, "now.*")


def resolved(attempts: DataFrame, cap: int) -> DataFrame:
    """Outcome of each query from attempts(query_id, attempt, outcome): the first success wins, else the last attempt within cap decides."""
    own = attempts.filter(F.col("attempt") <= cap).groupBy("query_id").agg(F.min(F.when(F.col("outcome") == "ok", F.col("attempt"))).alias("won"), F.max_by("outcome", "attempt").alias("last"), F.count(F.lit(1)).alias("attempts"))
    return own.select("query_id", F.when(F.col("won").isNotNull(), "ok").when(F.col("last") == "blocked", "blocked").otherwise("failed").alias("outcome"), F.coalesce("won", "attempts").cast("long").alias("used"))


def pacing(requests: DataFrame, group: str, at: str, least_ms: int, slice_ms: int = 3_600_000) -> DataFrame:
    """Gap in milliseconds to the request before of the same group, and whether it is too short; null where there is none before or no time."""
    told = previous(requests, [group], at, slice_ms, "__before")
    gap = (F.col(at) - F.col("__before")).alias("gap_ms")
    return told.select(*requests.columns, gap).withColumn("too_fast", F.coalesce(F.col("gap_ms") < least_ms, F.lit(False)))
