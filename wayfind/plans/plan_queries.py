"""Queries of plan generation: sites, terms, budgets, dates, chunks, fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfind.functions import dates, text, urls
from wayfind.operators import plan, quality
from wayfind.operators.results import first_per_run
from wayfind.plans.registry import query
from wayfind.sources import tables


def today():
    return F.lit("2026-08-18").cast("date")


_ALIAS = "case lower(trim(s)) " + " ".join(f"when '{k}' then '{v}'" for k, v in text.SITE_ALIASES.items()) + " else lower(trim(s)) end"
_SITE = "case {0} % 4 when 0 then 'facebook.com' when 1 then 'instagram.com' when 2 then 'tiktok.com' else 'x.com' end"
_EXTRA = "case site when 'facebook.com' then ' -inurl:photo -inurl:photos' when 'instagram.com' then ' -inurl:explore -inurl:stories -inurl:accounts' when 'tiktok.com' then ' -inurl:tag -inurl:discover -inurl:search -site:shop.tiktok.com' else '' end"
_OVER = "case site when 'facebook.com' then 5 when 'instagram.com' then 6 when 'tiktok.com' then 7 else 3 end"
_HASH = "abs(cast(case when h >= 2147483648 then h - 4294967296 else h end as bigint))"
_HASHED = "list_reduce(list_prepend(0::bigint, list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)), lambda h, c: (h * 31 + c) % 4294967296)"
_CHUNKS = "select concat(province, '|', cadence, '|', cast(idx as varchar)) as key, province, cadence, idx, list(name order by ord, name) as names from (select *, cast(floor((row_number() over (partition by province, cadence order by ord, name) - 1) / 3) as integer) as idx from v_place) group by province, cadence, idx"
_NEG = " ".join(f'-"{t}"' if " " in t else f"-{t}" for t in text.NEGATIVES)
_NEG_TT = " ".join(f'-"{t}"' if " " in t else f"-{t}" for t in text.NEGATIVES_BY_SITE["tiktok.com"])


def site_of(key: str):
    k = F.col(key) % 4
    return F.when(k == 0, "facebook.com").when(k == 1, "instagram.com").when(k == 2, "tiktok.com").otherwise("x.com")


@query("site_normalize", f"select s as raw, {_ALIAS} as site, count(*) as n from (select case o_orderkey % 6 when 0 then ' FB ' when 1 then 'Twitter' when 2 then 'tt' when 3 then 'Threads' when 4 then 'example.org' else 'IG' end as s from orders) group by 1, 2")
def _(t):
    k = F.col("o_orderkey") % 6
    raw = F.when(k == 0, " FB ").when(k == 1, "Twitter").when(k == 2, "tt").when(k == 3, "Threads").when(k == 4, "example.org").otherwise("IG")
    return t("orders").select(raw.alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n")).withColumn("site", text.normalize_site(F.col("raw")))


@query("term_unique", """select p_partkey, string_agg(w, '|' order by i) as terms from (select p_partkey, w, min(i) as i from (select p_partkey, unnest(string_split(concat(p_name, ' ', p_type, ' ', p_name), ' ')) as w, generate_subscripts(string_split(concat(p_name, ' ', p_type, ' ', p_name), ' '), 1) as i from part) where w <> '' group by 1, 2) group by 1""")
def _(t):
    return t("part").select("p_partkey", F.array_join(text.unique_terms(F.split(F.concat_ws(" ", "p_name", "p_type", "p_name"), " ")), "|").alias("terms"))


@query("nfc", "select doc_id, nfc_normalize(concat('e', chr(769), text)) as t from documents")
def _(t):
    return t("documents").select("doc_id", text.nfc(F.concat(F.lit("é"), F.coalesce("text", F.lit("")))).alias("t"))


@query("or_group", """select p_partkey, concat('("', replace(p_name, '"', '\\"'), '" OR "a\\"b")') as grp, concat(case when contains(p_type, ' ') then concat('-"', p_type, '"') else concat('-', p_type) end, ' -', p_brand, ' -given') as minus from part""")
def _(t):
    return t("part").select("p_partkey", text.or_group(F.array("p_name", F.lit('a"b'))).alias("grp"), text.negative_terms(F.array("p_type", "p_brand", F.lit("-given"))).alias("minus"))


_WORDS = r"""case when trim(regexp_replace(q, '[()"]', '', 'g')) = '' then 0 else len(regexp_split_to_array(trim(regexp_replace(q, '[()"]', '', 'g')), '\s+')) end"""


@query("word_budget", f"""select p_partkey, site, {_WORDS} as words, {_WORDS} + {_OVER} <= 12 as fits from (select p_partkey, {_SITE.format('p_partkey')} as site, case when p_partkey % 9 = 0 then ' () ' else concat('("', p_name, '" OR "', p_type, '")') end as q from part)""")
def _(t):
    q = F.when(F.col("p_partkey") % 9 == 0, " () ").otherwise(F.concat(F.lit('("'), "p_name", F.lit('" OR "'), "p_type", F.lit('")')))
    return t("part").select("p_partkey", site_of("p_partkey").alias("site"), q.alias("q")).select("p_partkey", "site", text.word_count(F.col("q")).alias("words"), text.fits_budget(F.col("q"), F.col("site"), 12).alias("fits"))


@query("negatives_by_site", f"""select n_nationkey, site, case site when 'tiktok.com' then '{_NEG_TT}' else '{_NEG}' end as minus from (select n_nationkey, {_SITE.format('n_nationkey')} as site from nation)""")
def _(t):
    return t("nation").select("n_nationkey", site_of("n_nationkey").alias("site")).withColumn("minus", text.negative_terms(text.negatives_for(F.col("site"), text.strings(text.NEGATIVES), text.table(text.NEGATIVES_BY_SITE))))


def _bodies(t, per_query: int, budget: int):
    chunks = plan.chunk_places(t("v_place"), per_query).withColumn("site", F.lit("facebook.com"))
    intents = F.array(text.strings(["I stayed", "we stayed"]), text.strings(["worth it"]))
    return plan.with_bodies(chunks.withColumn("intents", intents).withColumn("literal", F.lit(None).cast("string")).withColumn("negatives", text.strings(["tour"])), budget)


def _group_sql(names: str) -> str:
    return f"""concat('("', array_to_string({names}, '" OR "'), '")')"""


@query("bodies", f"""with c as ({_CHUNKS}) select key, unnest([concat({_group_sql('names')}, ' ("I stayed" OR "we stayed") -tour'), concat({_group_sql('names')}, ' ("worth it") -tour')]) as body from c""")
def _(t):
    return _bodies(t, 3, 32).select("key", F.explode("bodies").alias("body"))


# a name is one word: 2n - 1 words for n names, 5 for the longer intent, 1 negative, 5 of overhead
@query("budget_fit", f"""with c as ({_CHUNKS}), f as (select key, names, len(names) as n from c) select key, n, case when n >= 3 then case when 2 * 3 - 1 + 11 <= 14 then 1 when 2 * 2 - 1 + 11 <= 14 then 2 end else 1 end as grps, case when 2 * least(n, 2) - 1 + 11 <= 14 then null else 'over_budget' end as dropped from f""")
def _(t):
    return _bodies(t, 3, 14).select("key", F.size("names").cast("long").alias("n"), F.when(F.col("groups").isNotNull(), F.size("groups")).alias("grps"), "dropped")


_LEGACY = f"""concat('("', array_to_string(list_slice(names, 1, case tier when 'A' then 4 when 'B' then 3 else 2 end), '" OR "'), '") "du lịch" {_NEG}')"""


@query("legacy_text", f"""with c as (select n_nationkey, tier, {_SITE.format('n_nationkey')} as site, list(name order by ord) as names from (select c_nationkey as n_nationkey, tier, name, ord, row_number() over (partition by c_nationkey order by ord) as r from (select *, cast(replace(province, 'p', '') as bigint) as c_nationkey from v_place)) group by 1, 2) select n_nationkey, site, {_LEGACY} as body from c where site <> 'x.com'""")
def _(t):
    return _aliases(t).withColumn("site", site_of("n_nationkey")).select("n_nationkey", "site", text.legacy_text(F.col("site"), F.col("tier"), F.col("names")).alias("body")).filter("body is not null")


def _aliases(t):
    rows = t("v_place").withColumn("n_nationkey", F.replace(F.col("province"), F.lit("p"), F.lit("")).cast("long"))
    own = rows.groupBy("n_nationkey", "tier").agg(F.sort_array(F.collect_list(F.struct("ord", "name"))).alias("x"))
    return own.select("n_nationkey", "tier", F.concat(F.transform("x", lambda p: p["name"]), text.strings(["Bà Nà Hills"])).alias("names"))


@query("alias_limit", """select n_nationkey, least(n, case tier when 'A' then 4 when 'B' then 3 else 2 end) as aliases from (select cast(replace(province, 'p', '') as bigint) as n_nationkey, tier, count(*) as n from v_place group by 1, 2)""")
def _(t):
    return _aliases(t).select("n_nationkey", F.size(F.slice(F.array_except("names", text.strings(text.NOISY_ALIASES)), F.lit(1), text.table(text.ALIASES_BY_TIER)[F.col("tier")])).cast("long").alias("aliases"))


_COMPOSED = f"concat('site:', site, ' ', p_name, {_EXTRA}"


@query("compose_query", f"""select p_partkey, {_COMPOSED}, case p_partkey % 3 when 0 then '' when 1 then ' after:2026-06-23' else ' after:2026-06-23 before:2026-06-26' end) as query from (select p_partkey, trim(p_name) as p_name, {_SITE.format('p_partkey')} as site from part)""")
def _(t):
    k = F.col("p_partkey") % 3
    return t("part").select("p_partkey", text.compose(site_of("p_partkey"), F.col("p_name"), F.lit("2026-06-23").cast("date"), F.lit("2026-06-26").cast("date"), F.when(k == 0, "past_week").otherwise("custom"), F.when(k == 1, "rolling").otherwise("bounded")).alias("query"))


_JOBS = "select o_orderkey, o_orderdate::date as f, (o_orderdate::date + cast(o_orderkey % 10 as integer)) as l, cast(o_orderkey % 4 as integer) as split, case o_orderkey % 5 when 0 then 'past_day' else 'custom' end as tf, case o_orderkey % 3 when 0 then 'rolling' else 'bounded' end as mode from orders"


def _jobs(t):
    k = F.col("o_orderkey")
    first = F.col("o_orderdate").cast("date")
    return t("orders").select("o_orderkey", first.alias("date_from"), F.date_add(first, (k % 10).cast("int")).alias("date_to"), (k % 4).cast("int").alias("split"), F.when(k % 5 == 0, "past_day").otherwise("custom").alias("time_filter"), F.when(k % 3 == 0, "rolling").otherwise("bounded").alias("mode"), F.lit("x.com").alias("site"), F.lit("w").alias("text"))


_FAN = f"""with j as ({_JOBS}), c as (
    select o_orderkey, tf as label, f as a, l as b, f as cf, l as ct, tf, mode from j where tf <> 'custom'
    union all select o_orderkey, 'ROLLING', f - 1, l, f, l, tf, mode from j where tf = 'custom' and mode = 'rolling'
    union all select o_orderkey, 'ALL', f - 1, l + 1, f, l, tf, mode from j where tf = 'custom' and mode = 'bounded' and split = 0
    union all select o_orderkey, concat('P', i + 1), f + i * split - 1, least(f + i * split + split - 1, l) + 1, f + i * split, least(f + i * split + split - 1, l), tf, mode from (select *, unnest(range(0, cast(floor((l - f) / split) as integer) + 1))::integer as i from j where tf = 'custom' and mode = 'bounded' and split > 0))"""


@query("query_fanout", _FAN + """ select o_orderkey, label, a as "after", b as "before", cf as content_from, ct as content_to, concat('site:x.com w', case when tf <> 'custom' then '' when mode = 'rolling' then concat(' after:', a) else concat(' after:', a, ' before:', b) end) as query from c""")
def _(t):
    return plan.fan_out(_jobs(t)).select("o_orderkey", "label", "after", "before", "content_from", "content_to", "query")


@query("date_split", """select o_orderkey, concat('P', i + 1) as label, f + i * n as content_from, least(f + i * n + n - 1, l) as content_to from (select *, unnest(range(0, cast(floor((l - f) / n) as integer) + 1))::integer as i from (select o_orderkey, o_orderdate::date as f, o_orderdate::date + cast(o_orderkey % 20 as integer) as l, cast(o_orderkey % 5 + 1 as integer) as n from orders))""")
def _(t):
    first, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    chunks = dates.split_days(first, F.date_add(first, (k % 20).cast("int")), k % 5 + 1)
    return t("orders").select("o_orderkey", F.explode(chunks).alias("c")).select("o_orderkey", "c.label", "c.content_from", "c.content_to")


@query("date_labels", """select label, count(*) as n from (select concat('P', unnest(range(1, cast(floor(cast(o_orderkey % 20 as integer) / cast(o_orderkey % 5 + 1 as integer)) as integer) + 2))) as label from orders) group by 1""")
def _(t):
    first, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    return t("orders").select(F.explode(dates.split_days(first, F.date_add(first, (k % 20).cast("int")), k % 5 + 1)).alias("c")).groupBy("c.label").agg(F.count(F.lit(1)).alias("n"))


@query("date_overlap", """with recursive w as (select o_orderkey, f, l, f as s from (select o_orderkey, o_orderdate::date as f, o_orderdate::date + cast(o_orderkey % 60 as integer) as l from orders) union all select o_orderkey, f, l, s + 13 from w where least(s + 13, l) < l) select o_orderkey, s as content_from, least(s + 13, l) as content_to from w""")
def _(t):
    first = F.col("o_orderdate").cast("date")
    return t("orders").select("o_orderkey", F.explode(dates.split_overlapping(first, F.date_add(first, (F.col("o_orderkey") % 60).cast("int")), 14)).alias("w")).select("o_orderkey", "w.*")


@query("chunk_places", f"with c as ({_CHUNKS}) select key, province, cadence, idx, array_to_string(names, ';') as places from c")
def _(t):
    return plan.chunk_places(t("v_place"), 3).select("key", "province", "cadence", "idx", F.array_join("names", ";").alias("places"))


@query("due_chunks", f"""with c as ({_CHUNKS}), d as (select *, {_HASHED} as h from c join v_cadence using (cadence)) select key, {_HASH} as hash, date '2026-08-18' - window_days as date_from, date '2026-08-18' as date_to from d where (date '2026-08-18' - date '1970-01-01' - {_HASH} % cadence_days) % cadence_days = 0""")
def _(t):
    return plan.due_chunks(plan.chunk_places(t("v_place"), 3), t("v_cadence"), today()).select("key", dates.stable_hash(F.col("key")).alias("hash"), "date_from", "date_to")


@query("page_cap", """select item, page, greatest(1, least(coalesce(case when raw % 3 = 0 then raw end, case tier when 'A' then 10 when 'B' then 3 else 1 end), page, 5)) as cap, case when raw % 4 = 0 then 0 when raw % 4 = 1 then 1 when raw % 4 = 2 then 0 else page end as split from v_page""")
def _(t):
    job = F.when(F.col("raw") % 4 == 1, "backfill").when(F.col("raw") % 4 == 2, "daily").otherwise("manual")
    return t("v_page").select("item", "page", plan.page_cap(F.when(F.col("raw") % 3 == 0, F.col("raw")), F.col("tier"), F.col("page"), F.lit(5)).alias("cap"), plan.split_for(job, F.when(F.col("raw") % 4 == 0, "past_week").otherwise("custom"), F.col("page")).alias("split"))


@query("request_url", """select p_partkey, concat('https://www.google.com/search?q=', replace(replace(url_encode(p_name), '%20', '+'), '~', '%7E'), '&hl=vi&gl=vn&pws=0&filter=0&num=10&start=', p_size, case p_partkey % 3 when 0 then '&tbs=qdr%3Aw' when 1 then '&tbs=qdr%3Ah' else '' end) as u from part""")
def _(t):
    k = F.col("p_partkey") % 3
    return t("part").select("p_partkey", urls.request_url(F.col("p_name"), F.col("p_size"), F.when(k == 0, "past_week").when(k == 1, "past_hour").otherwise("custom")).alias("u"))


@query("keyword_scan", "select keyword_id, keyword, 'enabled' as scan from v_keyword where is_enabled union all select keyword_id, keyword, 'listed' from v_keyword where keyword_id in (0, 3, 7, 999)")
def _(t):
    k = t("v_keyword")
    return tables.keywords(k).select("keyword_id", "keyword", F.lit("enabled").alias("scan")).unionByName(tables.keywords(k, [0, 3, 7, 999]).select("keyword_id", "keyword", F.lit("listed").alias("scan")))


@query("keyword_join", "select keyword_id, coalesce(tier, 'C') as tier, p.province is null as unknown, min(keyword_id) over (partition by k.province) as first_id from v_keyword k left join v_province p on k.province = p.province")
def _(t):
    first = t("v_keyword").groupBy("province").agg(F.min("keyword_id").alias("first_id"))
    return t("v_keyword").join(t("v_province").select("province", "tier"), "province", "left").join(first, "province").select("keyword_id", F.coalesce("tier", F.lit("C")).alias("tier"), F.col("tier").isNull().alias("unknown"), "first_id")


@query("place_province", "select p.ord, v.name as province_name, v.tier from v_place p join v_province v using (province) union all select -1, province, null from v_province where province not in (select province from v_keyword)")
def _(t):
    rows = plan.place_provinces(t("v_place").drop("tier"), t("v_province").withColumnRenamed("name", "province_name")).select("ord", "province_name", "tier")
    absent = quality.orphans(t("v_province"), t("v_keyword"), "province").select(F.lit(-1).cast("long").alias("ord"), F.col("province").alias("province_name"), F.lit(None).cast("string").alias("tier"))
    return rows.unionByName(absent)


def _windows(t):
    return t("region").sparkSession.range(1).select(F.explode(dates.split_overlapping(F.lit("2026-05-01").cast("date"), F.lit("2026-07-31").cast("date"), 14)).alias("w")).select("w.*")


_WIN = "w as (select date '2026-05-01' + 13 * i::integer as content_from, least(date '2026-05-01' + 13 * i::integer + 13, date '2026-07-31') as content_to from range(0, 7) r(i))"
_PLAN = f"""with c as ({_CHUNKS}), {_WIN}, p as (select c.key, v.tier, content_from, content_to, intent, concat(c.key, '|', intent, '|', content_from, '|', content_to) as item_id from c join v_province v using (province), w, (select unnest(range(0, 3)) as intent))"""


def _plan(t):
    return plan.cross_plan(plan.place_provinces(plan.chunk_places(t("v_place"), 3), t("v_province")), _windows(t), 3)


@query("plan_cross", _PLAN + " select key, tier, content_from, content_to, intent, item_id from p")
def _(t):
    return _plan(t).select("key", "tier", "content_from", "content_to", F.col("intent").cast("long").alias("intent"), "item_id")


@query("plan_filter", _PLAN + " select tier, content_from, count(*) as n from p where tier in ('A', 'B') and key like 'p1%' and content_from < date '2026-06-01' group by 1, 2")
def _(t):
    return _plan(t).filter(F.col("tier").isin("A", "B") & F.col("key").startswith("p1") & (F.col("content_from") < "2026-06-01")).groupBy("tier", "content_from").agg(F.count(F.lit(1)).alias("n"))


@query("credit_estimate", _PLAN + " select tier, count(distinct key) as chunks, count(*) as query_groups, cast(sum(case tier when 'A' then 10 when 'B' then 3 else 1 end) as bigint) as request_max from p group by 1")
def _(t):
    return plan.credit_estimate(_plan(t))


@query("load_rollup", f"with c as ({_CHUNKS}) select tier, cadence, count(*) as chunks, round(sum(3.0::double / cadence_days), 6) as queries_per_day from c join v_cadence using (cadence) join v_province using (province) group by rollup (tier, cadence)")
def _(t):
    return plan.load_rollup(plan.place_provinces(plan.chunk_places(t("v_place"), 3), t("v_province")), t("v_cadence"), 3)


@query("plan_dispatch", f"""with c as ({_CHUNKS}) select key, 'chunk' as branch from c union all select n_name, 'legacy' from nation where n_nationkey % 4 <> 3 and n_nationkey in (select distinct c_nationkey from customer)""")
def _(t):
    legacy = _aliases(t).withColumn("site", site_of("n_nationkey")).filter(text.legacy_text(F.col("site"), F.col("tier"), F.col("names")).isNotNull())
    named = legacy.join(t("nation"), "n_nationkey").select(F.col("n_name").alias("key"), F.lit("legacy").alias("branch"))
    return plan.chunk_places(t("v_place"), 3).select("key", F.lit("chunk").alias("branch")).unionByName(named)


@query("plan_cutoff", _PLAN + " select item_id, concat('probe-', r) as probe from (select item_id, row_number() over (partition by tier order by item_id) as r from p) where r <= 25")
def _(t):
    return first_per_run(_plan(t), "tier", ["item_id"], 25).select("item_id", F.concat(F.lit("probe-"), F.col("place").cast("string")).alias("probe"))


@query("samples", _PLAN + " select tier, intent, first(item_id order by item_id) as sample from p group by 1, 2")
def _(t):
    return _plan(t).groupBy("tier", F.col("intent").cast("long").alias("intent")).agg(F.min("item_id").alias("sample"))


@query("intent_by_tier", "select tier, province, case tier when 'A' then 12 when 'B' then 7 else 5 end as phrases, case tier when 'A' then 'chuyến đi' when 'B' then 'có nên' else 'lịch trình' end as last_phrase from v_province")
def _(t):
    return t("v_province").select("tier", "province", F.size(text.phrases(F.col("tier"))).alias("phrases"), F.element_at(text.phrases(F.col("tier")), -1).alias("last_phrase"))


@query("fingerprint", _PLAN + """ select item_id, sha256(concat('{"tier":"', tier, '","key":"', key, '","content_from":"', content_from, '","content_to":"', content_to, '","intent":', intent, '}')) as fingerprint from p""")
def _(t):
    return plan.fingerprint(_plan(t), ["tier", "key", "content_from", "content_to", "intent"]).select("item_id", "fingerprint")


@query("coverage", f"with c as ({_CHUNKS}), d as (select c.*, {_HASHED} as h, cadence_days from c join v_cadence using (cadence)) select cadence, cast(sum(len(names)) as bigint) as places, cast(sum(case when (date '2026-08-18' - date '1970-01-01' - {_HASH} % cadence_days) % cadence_days = 0 then len(names) else 0 end) as bigint) as due from d group by 1")
def _(t):
    return plan.coverage(plan.chunk_places(t("v_place"), 3), t("v_cadence"), today(), ["cadence"])


@query("quality_checks", """select 'tier' as rule, tier as key, count(*) as n from v_province group by 2 union all select 'duplicate', concat(province, '|', cadence), count(*) from v_place group by 2 having count(*) > 1 union all select 'orphan', province, count(*) from v_keyword where province not in (select province from v_province) group by 2""")
def _(t):
    tiers = quality.tier_distribution(t("v_province")).select(F.lit("tier").alias("rule"), F.col("tier").alias("key"), "n")
    dup = quality.duplicates(t("v_place"), ["province", "cadence"]).select(F.lit("duplicate").alias("rule"), F.concat_ws("|", "province", "cadence").alias("key"), "n")
    lost = quality.orphans(t("v_keyword"), t("v_province"), "province").groupBy(F.lit("orphan").alias("rule"), F.col("province").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return tiers.unionByName(dup).unionByName(lost)

