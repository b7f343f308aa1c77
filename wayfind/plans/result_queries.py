"""Queries of result cleaning: URLs, ids, ads, reasons, dedup, pages, responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfind.functions import text, urls
from wayfind.operators import accounting, results
from wayfind.plans.registry import query
from wayfind.sources import posts, tables
from wayfind.sources.html import landed, result_blocks
from wayfind.sources.scratch import scratch_path

_CLEAN = "case when doc_id % 16 = 15 then concat('https://www.facebook.com/groups/x/posts/', pid) else regexp_replace(url, '#.*$', '') end"
_ID = "case doc_id % 16 when 5 then concat('pfbid', pid, 'abc') when 8 then concat('C', pid) when 9 then concat('C', pid) when 10 then null when 13 then null when 14 then concat('D', pid) else pid end"
_OK = "doc_id % 16 in (0, 1, 3, 4, 5, 6, 8, 9, 11, 12, 14, 15)"
_TEXT = "concat(title, ' ', snippet)"
_WORDS = "voucher|combo|khuyến mãi|khuyến mại|inbox|booking|đặt phòng|đặt tour|liên hệ|ưu đãi|giảm giá|đặt ngay|\\bdeal\\b|\\bsale\\b|pass phòng|còn phòng|nhận đặt|hotline|giá rẻ|zalo|sđt|ib\\b|báo giá"
_AD = rf"""(regexp_matches({_TEXT}, '[\x{{1D400}}-\x{{1D7FF}}]') or regexp_matches({_TEXT}, '(?i)[0-9]{{2,}}\s?(k|tr|đ|vnđ|vnd|nghìn|triệu|ngàn)\b') or regexp_matches({_TEXT}, '(^|[^0-9])0[0-9]{{8,10}}([^0-9]|$)') or regexp_matches({_TEXT}, '(?i)({_WORDS})'))"""
_REASON = f"case when {_AD} then 'ad' when {_ID} is null then 'no_post_id' when not ({_OK}) then 'bad_pattern' end"
_RES = f"r as (select *, {_CLEAN} as clean_url, {_ID} as post_id, {_REASON} as reason from v_result)"


def _reasoned(t):
    return results.with_reason(t("v_result"))


def _cleaned(t):
    return results.once(t("v_result").select("doc_id", "url", "site"), "clean_url", urls.unwrap(F.col("url")))


@query("unwrap_url", f"select doc_id, {_CLEAN} as clean_url from v_result")
def _(t):
    return t("v_result").select("doc_id", urls.unwrap(F.col("url")).alias("clean_url"))


@query("post_id", f"select doc_id, {_ID} as post_id from v_result")
def _(t):
    return _cleaned(t).select("doc_id", urls.post_id(F.col("clean_url"), F.col("site")).alias("post_id"))


@query("eligible", f"select doc_id, {_OK} as eligible from v_result")
def _(t):
    return _cleaned(t).select("doc_id", urls.eligible(F.col("clean_url"), F.col("site")).alias("eligible"))


@query("ad_flag", f"select doc_id, {_AD} as ad from v_result")
def _(t):
    return t("v_result").select("doc_id", text.ad_flag(F.col("title"), F.col("snippet")).alias("ad"))


@query("accessible", f"select doc_id, case when {_REASON} is null and doc_id % 5 = 0 then 'inaccessible' else {_REASON} end as reject_reason from v_result")
def _(t):
    status = F.when(F.col("doc_id") % 5 == 0, "deleted").otherwise("accessible")
    return results.with_reason(t("v_result"), status).select("doc_id", "reject_reason")


@query("reject_reasons", f"with {_RES} select site, coalesce(reason, 'kept') as reason, count(*) as n from r group by 1, 2")
def _(t):
    return results.reason_counts(_reasoned(t))


@query("flagship", f"with {_RES} select site, count(*) as posts, count(distinct clean_url) as urls from (select *, row_number() over (partition by post_id order by doc_id) as k from r where reason is null) where k = 1 group by 1")
def _(t):
    kept = results.first_wins(_reasoned(t).filter("reject_reason is null").select("doc_id", "site", "clean_url", "post_id"), "post_id", ["doc_id"])
    return kept.groupBy("site").agg(F.count(F.lit(1)).alias("posts"), F.countDistinct("clean_url").alias("urls"))


@query("first_wins", f"with {_RES} select doc_id, post_id, clean_url from (select *, row_number() over (partition by post_id order by doc_id) as k from r where post_id is not null) where k = 1")
def _(t):
    return results.first_wins(results.with_link(t("v_result").select("doc_id", "url", "site")).select("doc_id", "post_id", "clean_url"), "post_id", ["doc_id"])


_NEW = f"with {_RES} select doc_id, post_id from (select *, row_number() over (partition by post_id order by doc_id) as k from r where reason is null and doc_id % 3 <> 0) where k = 1 and post_id not in (select post_id from r where reason is null and doc_id % 3 = 0)"


@query("insert_new", _NEW)
def _(t):
    kept = _reasoned(t).filter("reject_reason is null").select("doc_id", "post_id")
    return results.new_posts(kept.filter("doc_id % 3 <> 0"), kept.filter("doc_id % 3 = 0"), ["doc_id"])


@query("insert_posts", _NEW)
def _(t):
    """A table that holds the posts of every third document already gets those of the others."""
    kept = _reasoned(t).filter("reject_reason is null").select("doc_id", "post_id")
    spark = kept.sparkSession
    target = scratch_path(spark, "posts")
    posts.insert(kept.filter("doc_id % 3 = 0"), target, 0, ["doc_id"])
    posts.insert(kept.filter("doc_id % 3 <> 0"), target, 1, ["doc_id"])
    return posts.read_posts(spark, target, "doc_id bigint, post_id string").filter("batch = 1").select("doc_id", "post_id")


@query("top3", f"with {_RES} select site, doc_id, k as place from (select site, doc_id, row_number() over (partition by site order by doc_id) as k from r where reason is null) where k <= 3")
def _(t):
    return results.first_per_run(_reasoned(t).filter("reject_reason is null").select("site", "doc_id"), "site", ["doc_id"]).withColumn("place", F.col("place").cast("long"))


@query("eligibility_rate", f"with {_RES} select site, round(count(*) filter (where reason is null) / count(*), 6) as rate from r group by 1")
def _(t):
    return _reasoned(t).groupBy("site").agg(accounting.rate(F.count_if(F.col("reject_reason").isNull()), F.count(F.lit(1))).alias("rate"))


# Pages of made-up runs: four pages to a query, each with result blocks, headings, links and phrases by its number.
_HAS = "case when k in (2, 3, 8, 10) then 10 when k = 9 then 7 when k in (0, 1, 4) then 3 else 0 end"
_PAGES = f"""pg as (select page_id, page_id // 4 as query_id, page_id % 4 + 1 as page, page_id % 11 as k, {_HAS.replace("k ", "page_id % 11 ")} as n, page_id % 11 <> 10 as has_next from pages),
    li as (select *, unnest(range(n)) as i from pg), lk as (select query_id, page, concat('https://x.com/u/status/', (query_id * 10 + case when k = 8 then page - 1 else page end) * 100 + i) as link from li),
    fr as (select query_id, page, count(*)::integer as fresh from (select query_id, link, min(page) as page from lk group by 1, 2) group by 1, 2),
    ou as (select pg.*, coalesce(fresh, 0) as fresh, case when k = 0 then 'blocked' when k in (1, 4) then 'challenge' when coalesce(fresh, 0) > 0 then 'ordinary' when k = 5 then 'no_results' when page = 1 and (k = 6 or n > 0) then 'drift' else 'empty' end as outcome from pg left join fr using (query_id, page))"""


def _landed(t):
    """The pages with their own markup, and before its end result blocks (one of them an advertisement, one link wrapped) and what makes for each outcome."""
    k = F.col("page_id") % 11
    query_id, page = F.floor(F.col("page_id") / 4), (F.col("page_id") % 4 + 1).cast("int")
    number = lambda i: ((query_id * 10 + F.when(k == 8, page - 1).otherwise(page)) * 100 + i).cast("string")
    link = lambda i: F.when(i == 1, F.concat(F.lit("/url?q=https%3A%2F%2Fx.com%2Fu%2Fstatus%2F"), number(i))).otherwise(F.concat(F.lit("https://x.com/u/status/"), number(i)))
    n = F.when(k.isin(2, 3, 8, 10), 10).when(k == 9, 7).when(k.isin(0, 1, 4), 3).otherwise(0)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.concat(F.lit("<div class='g tF2Cxc'><span><a href='"), link(i), F.lit("'><h3>T <b>"), i.cast("string"), F.lit("</b></h3></a></span><div class=VwiC3b>S<br>"), F.coalesce("url", F.lit("")), F.lit("</div></div>")))
    ad = F.lit("<div class='tF2Cxc' data-text-ad='1'><a href='https://ad.example/1'><h3>Ad</h3></a></div>")
    extra = F.when(k == 0, "<p>Please TRY again\n later</p>").when(k == 1, "<div data-sitekey='x'></div>").when(k == 2, "<p>they said: try again later</p>").when(k == 3, "<script>'unusual traffic'</script><p hidden>did not match any documents</p>").when(k == 4, "Unusual <i>TRAFFIC</i>").when(k == 5, "<h3>None</h3>It did not <b>match</b> any documents").when(k == 6, "<h3>Bare</h3>").otherwise("")
    more = F.when(k == 10, "").when(k % 2 == 0, "<a id='pnnext' href='#'>&gt;</a>").otherwise("<a aria-label='Tiếp' href='#'>&gt;</a>")
    own = F.concat(F.when(n > 0, F.concat(F.array_join(blocks, ""), ad)).otherwise(""), extra, more, F.lit("</body>"))
    html = F.concat(F.split_part(F.coalesce("html", F.lit("")), F.lit("</body>"), F.lit(1)), own)
    url = F.when(k == 0, "https://www.google.com/sorry/index").otherwise(F.col("url"))
    return t("pages").select("page_id", query_id.alias("query_id"), page.alias("page"), url.alias("url"), html.alias("html"))


@query("page_outcome", f"with {_PAGES} select query_id, page, outcome, n as extracted, fresh, has_next from ou")
def _(t):
    return landed(_landed(t)).select("query_id", "page", "outcome", "extracted", "fresh", "has_next")


@query("landed_pages", f"""with recursive {_PAGES}, run as (select query_id, page, outcome, n, fresh, has_next, true as open from ou where page = (select min(page) from ou o where o.query_id = ou.query_id)
        union all select o.query_id, o.page, o.outcome, o.n, o.fresh, o.has_next, true from run r join ou o on o.query_id = r.query_id and o.page = r.page + 1 where r.fresh > 0 and r.outcome = 'ordinary' and r.has_next and r.n >= 10),
    er as (select query_id, max(case when outcome in ('blocked', 'challenge') then 'captcha' when outcome = 'drift' then 'parse' end) as error from run group by 1)
    select ou.query_id, ou.page, error, (error is null and run.open is not null and run.fresh > 0) as taken from ou left join run using (query_id, page) join er on er.query_id = ou.query_id""")
def _(t):
    return landed(_landed(t)).select("query_id", "page", "error", "taken")


@query("take_while", """with p as (select item, page, raw % 5 as fresh, raw as extracted, has_next from v_page), s as (select item, min(case when fresh = 0 then page end) as b, min(case when not has_next or extracted < 10 then page end) as a from p group by 1) select item, page from p join s using (item) where (b is null or page < b) and (a is null or page <= a)""")
def _(t):
    pages = t("v_page").select(F.col("item").alias("query_id"), "page", (F.col("raw") % 5).alias("fresh"), F.col("raw").alias("extracted"), "has_next")
    return results.pages_taken(pages).select(F.col("query_id").alias("item"), "page")


@query("continue_flag", "select item, page, raw >= 8 and page < case tier when 'A' then 7 when 'B' then 3 else 1 end as more from v_page")
def _(t):
    cap = F.when(F.col("tier") == "A", 7).when(F.col("tier") == "B", 3).otherwise(1)
    return t("v_page").select("item", "page", results.has_next(F.col("raw"), F.col("page"), cap, F.lit(8)).alias("more"))


@query("json_results", """select doc_id, 0::bigint as pos, concat('https://x.com/a/status/', doc_id) as link, 'T' as title, case when doc_id % 8 = 4 then '' else 'S' end as snippet from documents where doc_id % 8 >= 4 union all select doc_id, 1, 'https://x.com/b', '', '' from documents where doc_id % 8 >= 5""")
def _(t):
    return results.json_items(t("v_response")).select("doc_id", F.col("pos").cast("long").alias("pos"), "link", "title", "snippet")


@query("shape_drift", """select doc_id, case when doc_id % 8 < 2 then 'missing_or_non_array_organic' when doc_id % 8 = 3 then 'organic_item_not_object' when doc_id % 8 = 4 then 'unexpected_organic_fields:rank,odd' end as drift from documents""")
def _(t):
    return results.shape_drift(t("v_response")).select("doc_id", "drift")


@query("mask_urls", r"select doc_id, concat('to http://***@h:1/p via ', site) as line from v_result")
def _(t):
    return t("v_result").select("doc_id", text.mask_credentials(F.concat(F.lit("to http://u:p"), "pid", F.lit("@h:1/p via "), "site")).alias("line"))


@query("query_site", f"with {_RES}, q as (select doc_id as query_id, site from v_result where doc_id % 2 = 0) select r.doc_id, coalesce(q.site, 'unknown') as plan_site from r left join q on q.query_id = r.doc_id union all select -1, s from (select distinct site as s from r where reason = 'ad')")
def _(t):
    rows = _reasoned(t)
    known = t("v_result").filter("doc_id % 2 = 0").select("doc_id", F.col("site").alias("plan_site"))
    failed = rows.filter("reject_reason = 'ad'").select(F.lit(-1).cast("long").alias("doc_id"), F.col("site").alias("plan_site")).distinct()
    return rows.select("doc_id").join(known, "doc_id", "left").select("doc_id", F.coalesce("plan_site", F.lit("unknown")).alias("plan_site")).unionByName(failed)


@query("html_results", f"with {_PAGES} select page_id, (i)::integer as pos, concat('T ', i) as title, link as url, concat('S ', trim(regexp_replace(coalesce(url, ''), '\\s+', ' ', 'g'))) as snippet from (select li.page_id, i, li.query_id, li.page, concat('https://x.com/u/status/', (li.query_id * 10 + case when k = 8 then page - 1 else page end) * 100 + i) as link, case when k = 0 then 'https://www.google.com/sorry/index' else p.url end as url from li join pages p using (page_id))")
def _(t):
    """Landed pages with result blocks in each page's own markup."""
    return result_blocks(_landed(t))


_CKPT = "with p as (select item, cast(page as integer) as page, status, requests as seq from v_page) select item, page, case when item % 2 = 0 then 'done' else status end as status, case when item % 2 = 0 then seq + 1 else seq end as seq from p"


def _states(t, **names):
    return t("v_page").select(F.when(F.col("item") % 3 == 0, names.get("old", "f1")).otherwise("f1").alias("fingerprint"), "item", F.col("page").cast("int").alias("page"), "status", F.col("requests").alias("seq"))


_CKPT_SCHEMA = "fingerprint string, item bigint, page int, status string, seq bigint"


@query("ckpt_io", _CKPT)
def _(t):
    """Page states written to a checkpoint table twice and read back as the latest state per page."""
    rows = _states(t)
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "ckpt")
    tables.write_checkpoint(rows, path)
    tables.write_checkpoint(rows.filter("item % 2 = 0").withColumn("status", F.lit("done")).withColumn("seq", F.col("seq") + 1), path)
    return tables.read_checkpoint(spark, path, "f1", _CKPT_SCHEMA).select("item", "page", "status", "seq")


@query("ckpt_compacted", _CKPT)
def _(t):
    """The same with compactions in between, and a third of the states under an older fingerprint of the plan."""
    rows = _states(t, old="f0")
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "ckpt")
    tables.write_checkpoint(rows, path)
    for later in (rows.filter("item % 4 = 0"), rows.filter("item % 4 = 2"), None):
        tables.compact_checkpoint(spark, path, _CKPT_SCHEMA)
        if later is not None:
            tables.write_checkpoint(later.withColumn("status", F.lit("done")).withColumn("seq", F.col("seq") + 1), path)
    return tables.read_checkpoint(spark, path, "f1", _CKPT_SCHEMA, accepted=["f0"]).select("item", "page", "status", "seq")
