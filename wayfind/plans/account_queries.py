"""Queries of run accounting, ledgers, triggers and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfind.functions import text
from wayfind.operators import accounting, ledger, triggers
from wayfind.plans.registry import query
from wayfind.sources import catalogs, tables
from wayfind.sources.scratch import scratch_path


def _stats(t):
    return t("v_page").select("item", "page", "tier", "w", "status", "raw", "requests", F.col("requests").alias("credit"), (F.col("raw") * 2).alias("eligible"), F.col("raw").alias("inserted"), F.col("raw").alias("duplicate"), "key_no")


_SUMS = "sum(requests)::bigint as requests, sum(requests)::bigint as credit, sum(raw)::bigint as raw, sum(raw * 2)::bigint as eligible, sum(raw)::bigint as inserted, sum(raw)::bigint as duplicate"


@query("report_rows", f"select tier, w, {_SUMS} from v_page group by 1, 2 union all select null, null, {_SUMS} from v_page")
def _(t):
    return accounting.sums_with_total(_stats(t), ["tier", "w"])


@query("continuation", "select count(*) filter (where raw >= 8) as full_pages, count(*) as pages, round(count(*) filter (where raw >= 8) / count(*), 6) as rate, 8 as threshold from v_page where status = 'done'")
def _(t):
    return accounting.continuation(t("v_page"), 8)


_RESUME = """with d as (select item, page, has_next, row_number() over (partition by item order by page) as k from v_page join v_item using (item) where status = 'done' and page <= page_max),
    s as (select i.item, i.tier, page_max, count(*) filter (where k = page) as n, coalesce(bool_or(k = page and not has_next), false) as fin from v_item i left join d using (item) group by 1, 2, 3)"""


@query("resume", _RESUME + " select tier, count(*) filter (where not fin) as todo, count(*) filter (where not fin and n = 0) as unstarted, count(*) filter (where not fin and n = page_max) as capped from s group by 1")
def _(t):
    return accounting.remaining(t("v_item"), t("v_page"))


def _queries(t):
    return t("v_page").select((F.col("item") % 20).alias("job"), (F.col("item") % 7).alias("keyword"), F.col("raw").cast("long").alias("found"), (F.col("raw") - 1).cast("long").alias("eligible"), (F.col("raw") % 7).cast("long").alias("inserted"))


@query("job_totals", "select job, keyword, found, inserted, queries, greatest(found - inserted, 0) as not_inserted, eligible - inserted as eligible_duplicates from (select item % 20 as job, item % 7 as keyword, sum(raw)::bigint as found, sum(raw - 1)::bigint as eligible, sum(raw % 7)::bigint as inserted, count(*) as queries from v_page group by grouping sets ((item % 20, item % 7), (item % 20)))")
def _(t):
    return accounting.totals(_queries(t))


_OUT = "select {} as site, keyword, case when raw % 11 = 0 then 'failed' when raw % 11 = 1 then 'blocked' else 'ok' end as outcome from (select *, item % 7 as keyword from v_page)".format("case item % 4 when 0 then 'facebook.com' when 1 then 'instagram.com' when 2 then 'tiktok.com' else 'x.com' end")


@query("site_failures", f"select site, failed, blocked, queries, round(bad / queries, 6) as fail_rate, bad / queries > 0.15 as job_failed from (select site, count(distinct case when outcome = 'failed' then keyword end) as failed, count(distinct case when outcome = 'blocked' then keyword end) as blocked, count(*) as queries, count(*) filter (where outcome <> 'ok') as bad from ({_OUT}) group by 1)")
def _(t):
    from wayfind.plans.plan_queries import site_of

    k = F.col("raw") % 11
    return accounting.site_failures(t("v_page").select(site_of("item").alias("site"), (F.col("item") % 7).alias("keyword"), F.when(k == 0, "failed").when(k == 1, "blocked").otherwise("ok").alias("outcome")))


@query("run_close", "select item % 50 as run_id, sum(raw)::bigint as discovered, sum(raw % 7)::bigint as scraped, not bool_or(status = 'failed') as ok, case when bool_or(status = 'failed') then 'failed' else 'completed' end as status from v_page group by 1")
def _(t):
    return accounting.run_close(t("v_page").select((F.col("item") % 50).alias("run_id"), "raw", (F.col("raw") % 7).alias("inserted"), "status"))


@query("run_close_stopped", "with i as (select item % 50 as run_id, raw, raw % 7 as inserted, case when status = 'done' and item % 29 = 0 then 'skipped' else status end as status from v_page where item % 3 <> 0) select run_id, coalesce(sum(raw), 0)::bigint as discovered, coalesce(sum(inserted), 0)::bigint as scraped, not (bool_or(r.run_id % 7 = 0) or coalesce(bool_or(i.status in ('failed', 'skipped')), false)) as ok, case when bool_or(r.run_id % 7 = 0) or coalesce(bool_or(i.status in ('failed', 'skipped')), false) then 'failed' else 'completed' end as status from (select distinct item % 50 as run_id from v_page) r left join i using (run_id) group by 1")
def _(t):
    """A13 with stopped backfills and skipped items."""
    status = F.when((F.col("status") == "done") & (F.col("item") % 29 == 0), "skipped").otherwise(F.col("status"))
    items = t("v_page").filter("item % 3 <> 0").select((F.col("item") % 50).alias("run_id"), "raw", (F.col("raw") % 7).alias("inserted"), status.alias("status"))
    runs = t("v_page").select((F.col("item") % 50).alias("run_id")).distinct()
    return accounting.run_close(items, runs.withColumn("stopped", F.col("run_id") % 7 == 0))


@query("run_state", "select item % 50 as run_id, arg_max(status, item * 10 + page) as status, max(item * 10 + page) as seq from v_page group by 1")
def _(t):
    events = t("v_page").select((F.col("item") % 50).alias("run_id"), "status", (F.col("item") * 10 + F.col("page")).alias("seq"))
    return accounting.latest(events, ["run_id"], "seq")


@query("run_lookup", "select distinct tier, w, 'running' as status, true as known from v_page")
def _(t):
    runs = tables.open_runs(t("v_page"), ["tier", "w"])
    joined = t("v_page").join(runs.select("tier", "w", "run_id", F.col("status").alias("run_status")), ["tier", "w"], "left")
    return joined.select("tier", "w", F.col("run_status").alias("status"), F.col("run_id").isNotNull().alias("known")).distinct()


@query("telemetry_join", "select tier, w, count(*) as pages, sum(case when status = 'failed' then 1 else 0 end)::bigint as failed from v_page where item in (select item from v_item where tier <> 'C') group by 1, 2")
def _(t):
    plan_items = t("v_item").filter("tier <> 'C'").select("item")
    return t("v_page").join(plan_items, "item", "left_semi").groupBy("tier", "w").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("status") == "failed").alias("failed"))


@query("window_failures", "select w, bool_or(status = 'failed') as any_failed, count(*) filter (where status = 'failed') as failed from v_page group by 1")
def _(t):
    return t("v_page").groupBy("w").agg(F.bool_or(F.col("status") == "failed").alias("any_failed"), F.count_if(F.col("status") == "failed").alias("failed"))


_REQ = "r as (select concat('key_', user_id % 4) as key, ts, event_id, cast(ts as date) as day, case when event_id % 997 = 0 then 402 else 200 end as status from events)"


def _requests(t):
    return t("events").select(F.concat(F.lit("key_"), (F.col("user_id") % 4).cast("string")).alias("key"), "ts", "event_id", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 997 == 0, 402).otherwise(200).alias("status"))


@query("running_credit", f"with {_REQ}, t as (select event_id, key, count(*) over (partition by day order by ts, key rows unbounded preceding) as total, count(*) over (partition by day, key order by ts rows unbounded preceding) as key_total from r) select *, total <= 100 and key_total <= 20 as allowed from t")
def _(t):
    return accounting.running_credit(_requests(t), 100, 20).select("event_id", "key", "total", "key_total", "allowed")


@query("key_usage", f"with {_REQ} select key, count(*) as usage, case when bool_or(status = 402) then 'exhausted' when count(*) >= 2400 then 'limit' else 'alive' end as status from r group by 1")
def _(t):
    return accounting.key_usage(_requests(t), 2400)


@query("pacing_audit", "select event_id, gap_ms, coalesce(gap_ms < 400, false) as too_fast from (select event_id, epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) over (partition by user_id order by ts) as gap_ms from events)")
def _(t):
    rows = t("events").select("event_id", "user_id", F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")) / 1000).alias("ms"))
    return accounting.pacing(rows, "user_id", "ms", 400).select("event_id", "gap_ms", "too_fast")


@query("retry_resolution", "with a as (select query_id, attempt, case when status in ('solved', 'success') then 'ok' when status = 'proxy_blocked' then 'blocked' else 'failed' end as outcome from v_ledger where attempt <= 5), s as (select query_id, min(case when outcome = 'ok' then attempt end) as won, arg_max(outcome, attempt) as l, count(*) as n from a group by 1) select query_id, case when won is not null then 'ok' when l = 'blocked' then 'blocked' else 'failed' end as outcome, coalesce(won, n) as used from s")
def _(t):
    kind = F.when(F.col("status").isin("solved", "success"), "ok").when(F.col("status") == "proxy_blocked", "blocked").otherwise("failed")
    return accounting.resolved(t("v_ledger").select("query_id", "attempt", kind.alias("outcome")), 5)


_KNOWN = ", ".join(f"'{x}'" for x in ledger.KNOWN)
_CAPTURE = ", ".join(f"'{x}'" for x in ledger.CAPTURE_REASONS)
_CLS = f"l as (select *, class <> 'solved' and case when stage <> '' then stage = 'capture' else class in ({_CAPTURE}) end as at_capture from (select *, case when status in ('success', 'solved') then 'solved' when status in ({_KNOWN}) then status when reason_code in ({_KNOWN}) then reason_code else 'unknown' end as class from v_ledger))"
_DUR = "case when event = 'result' and not at_capture and duration_ms >= 0 then duration_ms end"


def _classified(t):
    return ledger.classify(t("v_ledger"))


@query("classify_ledger", f"with {_CLS} select event_id, class, at_capture from l")
def _(t):
    return _classified(t).select("event_id", "class", "at_capture")


_COUNTS = f"""count(*) filter (where event = 'offered') as offered, count(*) filter (where event = 'attempt') as attempted, count(*) filter (where event = 'result' and class = 'solved') as solved, count(*) filter (where event = 'result' and class <> 'solved' and not at_capture) as failed, count(*) filter (where event = 'result' and at_capture) as capture_failed,
    count(*) filter (where event = 'paid') as paid, count(*) filter (where event = 'hard_block') as hard_blocks, count({_DUR}) as timed, count(distinct case when event = 'offered' then label end) as offered_labels, count(distinct label) as labels, round(count(*) filter (where event = 'result' and class = 'solved') / nullif(count(*) filter (where event = 'offered'), 0), 6) as solve_rate"""


@query("ledger_counts", f"with {_CLS} select kind, {_COUNTS} from l group by 1")
def _(t):
    return ledger.counters(_classified(t), ["kind"]).drop("p50", "p95")


@query("percentiles", f"with {_CLS} select label, quantile_disc({_DUR}, 0.5) as p50, quantile_disc({_DUR}, 0.95) as p95 from l group by 1")
def _(t):
    return ledger.counters(_classified(t), ["label"]).select("label", "p50", "p95")


@query("outcome_hist", f"with {_CLS} select kind, class, count(*) as n from l where event = 'result' group by 1, 2")
def _(t):
    return ledger.histogram(_classified(t).filter("event = 'result'"), ["kind"], "class")


@query("outcome_maps", f"""with {_CLS}, c as (select kind, class, count(*) as n from l where event = 'result' group by 1, 2) select kind, concat('{{', string_agg(concat('"', class, '":', n), ',' order by class), '}}') as counts from c group by 1""")
def _(t):
    maps = ledger.histogram_map(_classified(t).filter("event = 'result'"), ["kind"], "class")
    return maps.select("kind", F.to_json("counts").alias("counts"))


@query("gate", f"with {_CLS}, c as (select kind, {_COUNTS}, quantile_disc({_DUR}, 0.95) as p95 from l group by 1) select kind, offered, solve_rate, case when paid > 0 or (offered >= 20 and offered_labels >= 3 and (solve_rate < 0.6 or coalesce(p95 > 60000, true))) then 'failed' when offered >= 20 and offered_labels >= 3 then 'ready' else 'inconclusive' end as gate from c")
def _(t):
    return ledger.gate(ledger.counters(_classified(t), ["kind"]), 20).select("kind", "offered", "solve_rate", "gate")


_OUTCOMES = ", ".join(f"'{x}'" for x in ledger.LABEL_OUTCOMES)


def _outcomes(t):
    own = F.element_at(text.strings(ledger.LABEL_OUTCOMES), (F.col("event_id") % 7 + 1).cast("int"))
    return t("v_ledger").select("label", "kind", own.alias("outcome"))


@query("zero_fill", f"with o as (select kind, list_extract([{_OUTCOMES}], cast(event_id % 7 + 1 as integer)) as outcome from v_ledger), g as (select kind, outcome from (select distinct kind from v_ledger), (select unnest([{_OUTCOMES}]) as outcome)) select g.kind, g.outcome, count(o.kind) as n from g left join o on o.kind = g.kind and o.outcome = g.outcome group by 1, 2")
def _(t):
    rows = _outcomes(t)
    categories = t("v_ledger").sparkSession.range(1).select(F.explode(text.strings(ledger.LABEL_OUTCOMES)).alias("outcome"))
    return ledger.zero_filled(rows, categories, rows, "kind", "outcome")


@query("safe_label", f"select label, count(*) filter (where event_id % 7 = 0) as enabled, case when count(*) filter (where event_id % 7 = 0) >= 3 then 'audio_reachable' when count(*) filter (where event_id % 7 <> 6) > 0 and count(*) filter (where event_id % 7 = 0) = 0 then 'audio_blocked' else 'inconclusive' end as verdict from v_ledger group by 1")
def _(t):
    return ledger.label_verdict(_outcomes(t), "label")


@query("outcome_kind", "select event_id, case when status = 'proxy_blocked' then 'blocked' when status = 'timeout' then 'failed' else 'ok' end as outcome from v_ledger")
def _(t):
    return t("v_ledger").select("event_id", F.when(F.col("status") == "proxy_blocked", "blocked").when(F.col("status") == "timeout", "failed").otherwise("ok").alias("outcome"))


@query("resource_rank", "with u as (select kind, label, count(*) filter (where ts::date = (select max(ts)::date from events)) as uses, max(ts) as last_used from v_ledger group by 1, 2) select kind, label, uses, row_number() over (partition by kind order by uses, last_used, label) as rank from u")
def _(t):
    day = t("v_ledger").agg(F.max(F.to_date("ts")).alias("day")).first()["day"]
    return ledger.ranked(t("v_ledger"), F.lit(day)).select("kind", "label", "uses", F.col("rank").cast("long").alias("rank"))


@query("cooldown", "with u as (select label, arg_max(status, event_id) as outcome, max(ts) as ts from (select *, row_number() over (partition by label order by ts desc) as k from v_ledger) where k = 1 group by 1) select label, outcome, cast(floor(epoch(ts)) as bigint) + case outcome when 'timeout' then 600 when 'proxy_blocked' then 3600 else 0 end as blocked_until from u")
def _(t):
    return ledger.cooldown(t("v_ledger").withColumn("outcome", F.col("status")), F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"), {"timeout": 600, "proxy_blocked": 3600}).select("label", "outcome", "blocked_until")


@query("daily_use", "select label, ts::date as day, count(*) as uses from v_ledger group by 1, 2")
def _(t):
    return ledger.daily_use(t("v_ledger"))


@query("stop_point", "with r as (select label, ts, event_id, sum(case when event = 'offered' then 1 else 0 end) over (partition by label order by ts, event_id rows unbounded preceding) as n, floor(epoch(ts)) - floor(epoch(min(ts) over (partition by label))) as e from v_ledger), s as (select *, case when n >= 5 then 'target_reached' when e >= 864000 then 'time_limit' end as why from r), f as (select *, row_number() over (partition by label order by ts, event_id) as k from s where why is not null) select label, event_id, why as stop_reason from f where k = 1")
def _(t):
    return ledger.stop_point(t("v_ledger"), "label", 5, 864000)


@query("heartbeat", "with recursive h as (select label, min(ts) as ts from v_ledger group by 1 union all select h.label, min(v.ts) from h join v_ledger v on v.label = h.label and v.ts >= h.ts + interval 6 hour group by h.label, h.ts) select label, ts from h")
def _(t):
    return ledger.heartbeats(t("v_ledger"), "label", 6 * 3600)


@query("local_time", "select event_id, strftime(ts + interval 7 hour, '%Y-%m-%dT%H:%M:%S.%g+07:00') as local from events")
def _(t):
    return t("events").select("event_id", text.local_time(F.col("ts")).alias("local"))


PROFILES, DEFAULT = ["vi_legacy", "vi", "en"], "vi_legacy"
_ERR = """select o_orderkey, list_filter([case when o_orderkey % 17 = 3 then 'job_id' end, case when o_orderkey % 6 = 5 then 'job_type' end, case when o_orderkey % 5 = 2 then 'search_sites' end, case when o_orderkey % 7 in (0, 1) then 'date_from' end, case when o_orderkey % 4 = 1 then 'search_profile' end,
    case when o_orderkey % 7 > 1 and o_orderkey % 11 = 0 then 'date_order' end, case when o_orderkey % 3 = 1 then 'keyword_ids' end, case when o_orderkey % 19 = 0 then 'split_days' end, case when o_orderkey % 13 = 0 then 'max_pages' end], lambda x: x is not null) as errors from orders"""


def _parsed(t):
    return triggers.parsed(t("v_trigger"), PROFILES, DEFAULT)


@query("validate_trigger", f"select o_orderkey, array_to_string(errors, ',') as errors, len(errors) = 0 as accepted from ({_ERR})")
def _(t):
    return _parsed(t).select("o_orderkey", F.array_join("errors", ",").alias("errors"), (F.size("errors") == 0).alias("accepted"))


@query("site_sets", f"select o_orderkey, array_to_string(case o_orderkey % 5 when 0 then ['facebook.com'] when 1 then ['instagram.com'] when 3 then ['tiktok.com'] else [] end, ',') as used, array_to_string(case o_orderkey % 5 when 0 then ['x.com'] when 3 then ['threads.com'] when 4 then ['x.com'] else [] end, ',') as unsupported from ({_ERR}) where len(errors) = 0")
def _(t):
    used, not_used = triggers.site_sets(F.col("sites"), text.strings(text.LEGACY_SITES))
    return triggers.accepted(_parsed(t)).select("o_orderkey", F.array_join(used, ",").alias("used"), F.array_join(not_used, ",").alias("unsupported"))


@query("log_scan", """select event_id, case event_type when 'error' then 'ERROR' when 'signup' then 'WARN' end as level, concat('user ', user_id) as msg from events where event_type in ('error', 'signup')""")
def _(t):
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN").otherwise("INFO")
    line = F.to_json(F.struct(F.col("ts").cast("string").alias("ts"), level.alias("level"), F.lit("events").alias("context"), F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("msg"), "event_id"))
    rows = catalogs.log_lines(t("events").select(line.alias("value")), "WARN")
    return rows.select(F.get_json_object("fields", "$.event_id").cast("long").alias("event_id"), "level", "msg")


_SECTIONS = """with l as (select s_nationkey as nk, s_suppkey as k, concat('h', s_suppkey % 37, ':80') as v from supplier), d as (select nk, v, min(k) as k from l group by 1, 2) select concat('f', nk) as file, concat(case nk % 2 when 0 then 'private' else 'public' end, '_', row_number() over (partition by nk order by k)) as label, concat('http', '://', v) as url, case nk % 2 when 0 then concat('r', nk) end as attribute from d"""
_KINDS = {"list private": "private", "list_public": "public"}


def _catalog(t):
    s = t("supplier")
    file = F.concat(F.lit("f"), F.col("s_nationkey").cast("string"))
    head = s.select(file.alias("file"), F.lit(-1).cast("long").alias("line_no"), F.when(F.col("s_nationkey") % 2 == 0, "### List Private").otherwise("### list_public").alias("value")).distinct()
    note = s.select(file.alias("file"), F.col("s_suppkey").alias("line_no"), F.concat(F.lit("h"), (F.col("s_suppkey") % 37).cast("string"), F.lit(":80\n# a note")).alias("value"))
    reset = s.groupBy(file.alias("file"), F.col("s_nationkey").cast("string").alias("nk")).agg((F.max("s_suppkey") + 1).alias("line_no")).select("file", "line_no", F.concat(F.lit("Link reset = r"), "nk").alias("value"))
    return head.unionByName(note).unionByName(reset)


def _sectioned(lines, file):
    return catalogs.sectioned(lines, _KINDS, ("link reset", "private")).select(file.alias("file"), "label", F.concat(F.lit("http://"), "value").alias("url"), "attribute")


@query("catalog_sections", _SECTIONS)
def _(t):
    lines = _catalog(t).withColumn("value", F.explode(F.split("value", "\n")))
    return _sectioned(lines, F.col("file"))


@query("catalog_files", _SECTIONS)
def _(t):
    """The same lines written as a text file for each catalog and scanned."""
    spark = t("supplier").sparkSession
    path = scratch_path(spark, "catalogs")
    _catalog(t).repartition("file").sortWithinPartitions("file", "line_no").select("file", "value").write.partitionBy("file").text(path)
    return _sectioned(catalogs.read_lines(spark, path), F.regexp_extract("file", "file=([^/]+)/", 1))


@query("csv_registry", """select concat('p', n_nationkey) as province, case n_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier, concat(n_name, ';', 'Old ', n_name) as places, 'tag' || n_nationkey as hashtags from nation""")
def _(t):
    tier = F.when(F.col("n_nationkey") % 3 == 0, "A").when(F.col("n_nationkey") % 3 == 1, "B").otherwise("C")
    packed = F.concat(F.lit("tier "), tier, F.lit(" | places: "), "n_name", F.lit("; Old "), "n_name", F.lit(" | hashtags: #tag"), F.col("n_nationkey").cast("string"))
    rows = t("nation").select(F.concat(F.lit("﻿p"), F.col("n_nationkey").cast("string")).alias("a"), packed.alias("b"))
    return catalogs.packed_registry(rows, "a", "b").select("province", "tier", F.array_join("places", ";").alias("places"), F.array_join("hashtags", ";").alias("hashtags"))


@query("report_json", f"""select concat('{{"tier":"', tier, '","counters":{{"requests":', requests, ',"credit":', credit, ',"raw":', raw, ',"eligible":', eligible, ',"inserted":', inserted, ',"duplicate":', duplicate, '}}}}') as report from (select tier, {_SUMS} from v_page group by 1)""")
def _(t):
    totals = accounting.sums(_stats(t), ["tier"])
    return totals.select(F.to_json(F.struct("tier", F.struct(*accounting.COUNTERS).alias("counters"))).alias("report"))
