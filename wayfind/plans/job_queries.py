"""Queries of lookups, runs, plans of whole jobs, and of tables and files that are written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfind.functions import dates, text
from wayfind.operators import accounting, ledger, lookups, plan, quality, triggers
from wayfind.plans.account_queries import _ERR, DEFAULT, PROFILES
from wayfind.plans.plan_queries import _CHUNKS, _NEG, _NEG_TT, site_of, today
from wayfind.plans.registry import query
from wayfind.sources import catalogs, tables
from wayfind.sources.scratch import scratch_path

SITES = ["facebook.com", "instagram.com", "tiktok.com", "x.com"]
_SITES = ", ".join(f"'{s}'" for s in SITES)


def _stored(rows: DataFrame, tag: str, schema: str) -> DataFrame:
    """rows written as a dimension table and read with its schema."""
    path = scratch_path(rows.sparkSession, tag)
    rows.write.parquet(path)
    return tables.read_dimension(rows.sparkSession, path, schema)


@query("platform_lookup", "select doc_id, case site when 'facebook.com' then 1 when 'instagram.com' then 2 when 'x.com' then 3 when 'tiktok.com' then 4 else 5 end as platform_id from v_result")
def _(t):
    return lookups.with_platform(t("v_result"), _stored(t("v_platform"), "platforms", tables.PLATFORM_SCHEMA)).select("doc_id", "platform_id")


@query("dimension_scan", "select v.province, v.name, v.tier, count(p.name) as places, min(p.name) as first_place from v_province v left join v_place p using (province) group by 1, 2, 3")
def _(t):
    names = t("v_place").groupBy("province").agg(F.sort_array(F.collect_list("name")).alias("places"))
    none = F.array().cast("array<string>")
    rows = t("v_province").join(names, "province", "left").select("province", "name", "tier", F.coalesce("places", none).alias("places"), none.alias("hashtags"))
    read = _stored(rows, "provinces", tables.PROVINCE_SCHEMA)
    return read.select("province", "name", "tier", F.size("places").cast("long").alias("places"), F.get("places", F.lit(0)).alias("first_place"))


@query("keyword_load", "select keyword_id, keyword, 'listed' as scan from v_keyword where keyword_id in (1, 7, 14, 999) union all select keyword_id, keyword, 'all' from v_keyword where is_enabled")
def _(t):
    k = t("v_keyword")
    listed, all_ = tables.load_keywords(k, [1, 7, 14, 999]), tables.load_keywords(k, [])
    rows = listed.select("keyword_id", "keyword", F.lit("listed").alias("scan")).unionByName(all_.select("keyword_id", "keyword", F.lit("all").alias("scan")))
    return rows.unionByName(tables.keywords_by_ids(k, []).select("keyword_id", "keyword", F.lit("none").alias("scan")))


@query("run_window", "select o_orderkey, case o_orderkey % 3 when 0 then 'daily' else 'backfill' end as run_type, o_orderdate::date::timestamp - interval 7 hour as run_start, o_orderdate::date::timestamp + interval '16 hours 59 minutes 59 seconds' as run_end from orders")
def _(t):
    k, day = F.col("o_orderkey") % 3, F.col("o_orderdate").cast("date")
    job = F.when(k == 0, "daily").when(k == 1, "backfill").otherwise("manual")
    return t("orders").select("o_orderkey", dates.run_type(job).alias("run_type"), dates.run_window(day, day).alias("w")).select("o_orderkey", "run_type", F.col("w.start").alias("run_start"), F.col("w.end").alias("run_end"))


@query("keyword_tier", "select keyword_id, coalesce(tier, 'C') as tier, false as lost from v_keyword k left join v_province p using (province) union all select keyword_id, null, true from v_keyword where province not in (select province from v_province)")
def _(t):
    told = lookups.with_tier(t("v_keyword"), t("v_province")).select("keyword_id", "tier", F.lit(False).alias("lost"))
    return told.unionByName(lookups.without_province(t("v_keyword"), t("v_province")).select("keyword_id", F.lit(None).cast("string").alias("tier"), F.lit(True).alias("lost")))


@query("item_keyword", "with k as (select province, min(keyword_id) as keyword_id from v_keyword group by 1) select item, k.keyword_id, case when k.keyword_id is null then concat('province ', i.province, ' has no keyword') end as skip_reason from v_job_item i left join k using (province)")
def _(t):
    return lookups.with_keyword(t("v_job_item"), t("v_keyword")).select("item", "keyword_id", "skip_reason")


@query("item_run", """select item, sha256(concat('{"site":"', site, '","window":', w, '}')) as run_id from v_job_item""")
def _(t):
    items = t("v_job_item").withColumnRenamed("w", "window")
    return lookups.with_run(items, tables.open_runs(items, ["site", "window"])).select("item", "run_id")


@query("query_text_site", f"with p as (select p_brand as query, arg_max(case p_partkey % 4 {' '.join(f'when {k} then {chr(39)}{s}{chr(39)}' for k, s in enumerate(SITES))} end, p_partkey) as site from part group by 1) select p_partkey, p.site from (select p_partkey, case when p_partkey % 10 = 0 then 'no such query' else p_brand end as query from part) r left join p using (query)")
def _(t):
    planned = t("part").select(F.col("p_brand").alias("query"), site_of("p_partkey").alias("site"), "p_partkey")
    rows = t("part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, "no such query").otherwise(F.col("p_brand")).alias("query"))
    return lookups.with_query_site(rows, planned, "p_partkey").select("p_partkey", "site")


@query("failing_sites", "select distinct w as keyword, site, outcome from v_job_item where outcome in ('failed', 'blocked')")
def _(t):
    items = t("v_job_item").withColumn("query", F.col("item").cast("string"))
    return lookups.failing_sites(items.select(F.col("w").alias("keyword"), "query", "outcome"), items)


@query("plan_requests", "select tier, province, w, count(*) as requests from v_page_request join v_job_item using (item) where tier <> 'C' group by 1, 2, 3")
def _(t):
    log = t("v_page_request")
    path = scratch_path(log.sparkSession, "requests")
    tables.append_log(log.filter("request % 2 = 0"), path)
    tables.append_log(log.filter("request % 2 = 1"), path)
    items = plan.filtered(t("v_job_item"), tiers=["A", "B"])
    own = lookups.of_plan(log.sparkSession.read.schema(log.schema).parquet(path), items)
    return own.join(items.select("item", "tier", "province", "w"), "item").groupBy("tier", "province", "w").agg(F.count(F.lit(1)).alias("requests"))


@query("window_status", "select w, count(*) filter (where bad) as failures, count(*) filter (where bad) = 0 as ok from (select w, outcome = 'failed' or province not in (select province from v_keyword) as bad from v_job_item) group by 1")
def _(t):
    items = t("v_job_item").withColumnRenamed("w", "window")
    skipped = lookups.with_keyword(items, t("v_keyword")).filter("skip_reason is not null")
    return lookups.window_status(items.filter("outcome = 'failed'"), skipped, items).withColumnRenamed("window", "w")


@query("plan_windows", "select w, tier, count(*) as n from v_job_item where tier in ('A', 'C') and province in ('p1', 'p2', 'p3') and w in (0, 2, 5) group by 1, 2")
def _(t):
    items = t("v_job_item").withColumnRenamed("w", "window")
    return plan.filtered(items, ["A", "C"], ["p1", "p2", "p3"], [0, 2, 5]).groupBy(F.col("window").alias("w"), "tier").agg(F.count(F.lit(1)).alias("n"))


@query("inserted_by_site", f"select s.site, count(i.item) as inserted from (select unnest([{_SITES}, 'threads.com']) as site) s left join (select * from v_job_item where inserted > 0) i using (site) group by 1")
def _(t):
    sites = t("region").sparkSession.range(1).select(F.explode(text.strings([*SITES, "threads.com"])).alias("site"))
    return accounting.inserted_by_site(t("v_job_item").filter("inserted > 0"), sites)


@query("site_exceptions", f"with o as (select site, w as keyword, outcome from v_job_item where w <> 3 union all select s, 3, 'failed' from (select unnest([{_SITES}]) as s)) select site, count(distinct case when outcome = 'failed' then keyword end) as failed, count(distinct case when outcome = 'blocked' then keyword end) as blocked from o group by 1")
def _(t):
    done = t("v_job_item").filter("w <> 3").select("site", F.col("w").alias("keyword"), "outcome")
    broken = t("v_job_item").filter("w = 3").select(F.col("w").alias("keyword")).distinct()
    return accounting.site_failures(accounting.with_exceptions(done, broken, SITES)).select("site", "failed", "blocked")


@query("run_close_sites", """select sha256(concat('{"site":"', site, '"}')) as run_id, site, sum(inserted)::bigint as discovered, case when site in (select site from v_job_item where outcome in ('failed', 'blocked') and w = 1) then 'failed' else 'completed' end as status from v_job_item group by 2""")
def _(t):
    items = t("v_job_item")
    runs = tables.open_runs(items, ["site"])
    joined = items.join(runs.select("site", "run_id"), "site")
    closed = accounting.run_close_by_site(joined, items.filter(F.col("outcome").isin("failed", "blocked") & (F.col("w") == 1)))
    path = scratch_path(items.sparkSession, "runs")
    tables.append_log(runs.select("run_id", "status", "seq", F.lit(None).cast("long").alias("discovered"), F.lit(None).cast("timestamp_ntz").alias("completed_at")), path)
    tables.append_log(accounting.closing_events(closed, F.lit("2026-08-18 00:00:00").cast("timestamp_ntz")), path)
    now = accounting.latest(items.sparkSession.read.parquet(path), ["run_id"], "seq")
    return now.join(runs.select("run_id", "site"), "run_id").select("run_id", "site", "discovered", "status")


@query("report_order", "select w as \"window\", tier, province, count(*) as requests, count(*) as credit, sum(raw)::bigint as raw, sum(raw)::bigint as eligible, sum(inserted)::bigint as inserted, sum(raw - inserted)::bigint as duplicate from v_job_item group by 1, 2, 3")
def _(t):
    one = F.lit(1)
    return accounting.report(t("v_job_item").select(F.col("w").alias("window"), "tier", "province", one.alias("requests"), one.alias("credit"), "raw", F.col("raw").alias("eligible"), "inserted", (F.col("raw") - F.col("inserted")).alias("duplicate")))


@query("done_pages", "select tier, count(*) filter (where status = 'done') as completed_pages from v_page group by 1")
def _(t):
    return accounting.done_pages(t("v_page"), ["tier"])


_CREDIT = """with r as (select event_id as request, concat('key_', user_id % 4) as key, ts from events), k as (select *, count(*) over (partition by key order by ts, request rows unbounded preceding) as key_total from r),
    t as (select *, sum(case when key_total <= 2000 then 1 else 0 end) over (order by ts, key, request rows unbounded preceding)::bigint as total from k)"""


@query("credit_stop", _CREDIT + " select request, key_total, total, key_total <= 2000 and total <= 6000 as allowed, key_total <= 2000 and total = 6001 as stop from t")
def _(t):
    rows = t("events").select(F.col("event_id").alias("request"), F.concat(F.lit("key_"), (F.col("user_id") % 4).cast("string")).alias("key"), "ts")
    return accounting.credit_stop(rows, 6000, 2000).select("request", "key_total", "total", "allowed", "stop")


@query("failure_kinds", "select event_id, case when event_id % 5 = 0 then 'ok' when event_id % 5 = 1 then 'blocked' else 'failed' end as outcome from events")
def _(t):
    k = F.col("event_id") % 5
    kind = F.when(k == 1, "captcha").when(k == 2, "timeout").when(k > 2, "no_proxy")
    return t("events").select("event_id", ledger.failure_outcome(kind).alias("outcome"))


_ENTRIES = "e as (select event_id as ord, case when event_id % 6 = 0 then concat('http:', user_id) else concat('label_', user_id) end as label, case event_id % 3 when 0 then 'rotating' when 1 then 'private' else 'public' end as kind from events)"


def _entries(t):
    k = F.col("event_id")
    return t("events").select(k.alias("ord"), F.when(k % 6 == 0, F.concat(F.lit("http:"), F.col("user_id").cast("string"))).otherwise(F.concat(F.lit("label_"), F.col("user_id").cast("string"))).alias("label"), F.when(k % 3 == 0, "rotating").when(k % 3 == 1, "private").otherwise("public").alias("kind"))


@query("labels_selected", f"with {_ENTRIES} select label, arg_min(kind, ord) as kind, min(ord) as ord from e where kind <> 'rotating' and label like 'label_%' group by 1 order by 3 limit 20")
def _(t):
    return ledger.selected_labels(_entries(t), 20)


@query("labels_required", f"with {_ENTRIES} select ord, label, kind from e where kind <> 'rotating' and label in ('label_1', 'label_2', 'label_3')")
def _(t):
    """The entries of three labels that there are."""
    return ledger.require_labels(_entries(t).filter("kind <> 'rotating'"), ["label_1", "label_2", "label_3"])


@query("resource_snapshot", """with l as (select * from v_ledger where ts <= timestamp '2024-01-20 00:00:00'), x as (select label, kind, count(*) filter (where event = 'attempt' and ts::date = date '2024-01-20') as uses_today, arg_max(event, struct_pack(a := ts, b := event)) as e, max(ts) filter (where event = 'result') as r, arg_max(status, struct_pack(a := ts, b := status)) filter (where event = 'result') as o from l group by 1, 2)
    select label, kind, uses_today, e = 'attempt' as active, coalesce(case o when 'timeout' then floor(epoch(r)) + 600000 when 'proxy_blocked' then floor(epoch(r)) + 3600000 else 0 end > 1705708800, false) as blocked from x""")
def _(t):
    attempts = t("v_ledger").withColumn("outcome", F.col("status"))
    return ledger.snapshot(attempts, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), {"timeout": 600_000, "proxy_blocked": 3_600_000})


def _windows(t) -> DataFrame:
    """Due chunks, and a legacy window of each province with all of its places as names."""
    chunks = plan.due_chunks(plan.chunk_places(t("v_place"), 3), t("v_cadence"), today())
    intents = F.array(text.strings(["I stayed", "we stayed"]), text.strings(["worth it"]))
    none = F.lit(None).cast("array<array<string>>")
    own = chunks.select("key", F.lit(False).alias("use_legacy"), "names", intents.alias("intents"), "date_from", "date_to")
    names = t("v_place").groupBy("province").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda p: p["name"]).alias("names"))  # a dimension
    legacy = names.select(F.concat(F.lit("legacy|"), "province").alias("key"), F.lit(True).alias("use_legacy"), "names", none.alias("intents"), F.lit("2026-05-01").cast("date").alias("date_from"), F.lit("2026-05-02").cast("date").alias("date_to"))
    return own.unionByName(legacy).withColumn("tier", F.lit("A")).withColumn("supported", text.strings(SITES[:3])).withColumn("literal", F.lit(None).cast("string")).withColumn("negatives", text.strings(["tour"]))


_DUE = """d as (select * from (select *, list_reduce(list_prepend(0::bigint, list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)), lambda h, c: (h * 31 + c) % 4294967296) as h from c join v_cadence using (cadence)) where (date '2026-08-18' - date '1970-01-01' - abs(cast(case when h >= 2147483648 then h - 4294967296 else h end as bigint)) % cadence_days) % cadence_days = 0)"""
_ORED = """concat('("', array_to_string({}, '" OR "'), '")')"""
_BODIES = f"""with c as ({_CHUNKS}), {_DUE}, f as (select province, list(name order by ord, name) as names from v_place group by 1),
    s as (select unnest([{_SITES}]) as site),
    b as (select key, site, 'chunk' as branch, unnest([concat({_ORED.format('names')}, ' ("I stayed" OR "we stayed") -tour'), concat({_ORED.format('names')}, ' ("worth it") -tour')]) as body, date '2026-08-18' - window_days as f, date '2026-08-18' as l from d, s where site <> 'x.com'
        union all select concat('legacy|', province), site, 'legacy', concat({_ORED.format('names[1:4]')}, ' "du lịch" {_NEG}'), date '2026-05-01', date '2026-05-02' from f, s where site <> 'x.com')"""


@query("plan_texts", _BODIES + " select key, site, branch, body from b")
def _(t):
    rows = _windows(t).withColumn("site", F.explode(text.strings(SITES)))
    return plan.query_bodies(rows).select("key", "site", "branch", F.col("text").alias("body"))


_EXTRA = "case site when 'facebook.com' then ' -inurl:photo -inurl:photos' when 'instagram.com' then ' -inurl:explore -inurl:stories -inurl:accounts' when 'tiktok.com' then ' -inurl:tag -inurl:discover -inurl:search -site:shop.tiktok.com' else '' end"
_PRODUCT = _BODIES + f", q as (select key, site, branch, body, concat('P', i + 1) as label, f + i - 1 as a, f + i + 1 as b, i from (select *, unnest(range(0, (l - f)::integer + 1))::integer as i from b)), p as (select *, concat('site:', site, ' ', body, {_EXTRA}, ' after:', a, ' before:', b) as query from q)"


def _product(t) -> DataFrame:
    return plan.window_queries(_windows(t), SITES, F.lit("backfill"), F.lit("custom"), F.lit(4))


@query("query_product", _PRODUCT + " select key, site, branch, label, query from p")
def _(t):
    return _product(t).select("key", "site", "branch", "label", "query")


@query("probe_queries", _PRODUCT + " select concat('probe-', row_number() over (order by key, site, body, i)) as id, query from p qualify row_number() over (order by key, site, body, i) <= 100")
def _(t):
    rows = _product(t).withColumn("day", F.col("content_from"))
    return plan.cut_off(rows, ["key", "site", "text", "day"], 100).select("id", "query")


@query("sample_chunks", f"with c as ({_CHUNKS}), v as (select key, province, tier from c join v_province using (province)) select min(key) as key, 'p3' as province, 'A' as tier from v where province = 'p3' union all select min(key), arg_min(province, key), 'C' from v where tier = 'C'")
def _(t):
    """The plan has no chunk of tier C, so that one comes from the fallback."""
    chunks = plan.place_provinces(plan.chunk_places(t("v_place"), 3), t("v_province").select("province", "tier")).withColumn("ord", F.col("key"))
    return plan.samples(plan.filtered(chunks, ["A", "B"]), chunks, "p3")


@query("place_coverage", f"with c as ({_CHUNKS}), {_DUE} select (select sum(len(names)) from c)::bigint as places, (select sum(len(names)) from d)::bigint as due")
def _(t):
    return plan.coverage(plan.chunk_places(t("v_place"), 3), t("v_cadence"), today(), [])


@query("job_summaries", f"select concat('job-', o_orderkey) as job_id, case o_orderkey % 5 when 0 then 2 when 3 then 2 else 1 end as sites, case o_orderkey % 3 when 0 then 2 end as keywords from ({_ERR}) where len(errors) = 0")
def _(t):
    rows = triggers.summaries(triggers.accepted(triggers.parsed(t("v_trigger"), PROFILES, DEFAULT)))
    field = lambda name: F.get_json_object("summary", f"$.{name}")
    return rows.select("job_id", field("sites").cast("int").alias("sites"), field("keywords").cast("int").alias("keywords"))


@query("report_sink", "select tier, count(*) as requests, sum(raw)::bigint as raw from v_job_item group by 1")
def _(t):
    rows = t("v_job_item").groupBy("tier").agg(F.count(F.lit(1)).alias("requests"), F.sum("raw").alias("raw"))
    path = scratch_path(rows.sparkSession, "report")
    tables.write_report(rows, path)
    return rows.sparkSession.read.schema("tier string, requests bigint, raw bigint").json(path)


@query("registry_file", "select concat('p', n_nationkey) as province, case n_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier, n_name as places, '' as hashtags from nation")
def _(t):
    tier = F.when(F.col("n_nationkey") % 3 == 0, "A").when(F.col("n_nationkey") % 3 == 1, "B").otherwise("C")
    path = scratch_path(t("nation").sparkSession, "registry")
    t("nation").select(F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("province"), F.concat(F.lit("tier "), tier, F.lit(" | places: "), "n_name", F.lit(" | hashtags: ")).alias("packed")).coalesce(1).write.option("header", True).csv(path)
    return catalogs.read_registry(t("nation").sparkSession, path).select("province", "tier", F.array_join("places", ";").alias("places"), F.array_join("hashtags", ";").alias("hashtags"))


@query("fingerprint_text", f"""with c as ({_CHUNKS}) select key, sha256(concat('{{"key":"', key, '","province":"', province, '","idx":', idx, '}}')) as fingerprint from c""")
def _(t):
    return plan.fingerprint(plan.chunk_places(t("v_place"), 3), ["key", "province", "idx"]).select("key", "fingerprint")


@query("known_slugs", "select province, count(*) as n from v_job_item where province in (select province from v_province) group by 1")
def _(t):
    known = quality.orphans(t("v_job_item"), t("v_province"), "province").select("province").distinct()
    return plan.require_known(t("v_job_item").join(known, "province", "left_anti"), t("v_province"), "province").groupBy("province").agg(F.count(F.lit(1)).alias("n"))


_PROFILE = f"""with c as ({_CHUNKS}), {_DUE}, s as (select unnest(['facebook.com', 'instagram.com']) as site)
    select 'p_' || case when key like 'p1%' then 'one' else 'rest' end as profile, key, site, unnest([concat({_ORED.format('names')}, ' ("I stayed" OR "we stayed")', case site when 'instagram.com' then ' -ib' else ' -tour' end), concat({_ORED.format('names')}, ' ("worth it")', case site when 'instagram.com' then ' -ib' else ' -tour' end)]) as body, date '2026-08-18' - window_days as date_from, case split_part(key, '|', 2) when 'core' then 5 else least(case tier when 'A' then 10 when 'B' then 3 else 1 end, 6) end as pages from d join v_province v using (province), s"""


@query("profile_plan", _PROFILE)
def _(t):
    """Tables of profiles, places and cadences written, read with their schemas and made a plan of two profiles: due chunks, bodies and page caps."""
    spark = t("region").sparkSession
    root = scratch_path(spark, "dimensions")
    profiles = spark.range(2).select(F.when(F.col("id") == 0, "p_one").otherwise("p_rest").alias("profile"), F.lit(3).alias("places_per_query"), text.strings(SITES[:2]).alias("sites"), F.array(text.strings(["I stayed", "we stayed"]), text.strings(["worth it"])).alias("intents"), text.strings(["tour"]).alias("negatives"), text.table({"instagram.com": ["ib"]}).alias("negatives_by_site"), F.create_map(F.lit("A"), F.create_map(F.lit("core"), F.lit(5)), F.lit("B"), F.create_map(F.lit("core"), F.lit(5)), F.lit("C"), F.create_map(F.lit("core"), F.lit(5))).alias("page_depth"))
    own = F.when(F.col("province").startswith("p1"), "p_one").otherwise("p_rest")
    profiles.write.parquet(f"{root}/profiles")
    t("v_place").select(own.alias("profile"), F.col("ord").cast("int").alias("ord"), "name", "province", "cadence").write.parquet(f"{root}/places")
    t("v_cadence").crossJoin(profiles.select("profile")).select("profile", "cadence", "cadence_days", "window_days").write.parquet(f"{root}/cadences")
    read = lambda name, schema: tables.read_dimension(spark, f"{root}/{name}", schema)
    rows = plan.profile_plan(read("profiles", tables.PROFILE_SCHEMA), read("places", tables.PLACE_SCHEMA), read("cadences", tables.CADENCE_SCHEMA), t("v_province").select("province", "tier"), today(), requested=10, overall=6)
    return rows.select("profile", "key", "site", "body", "date_from", "pages")
