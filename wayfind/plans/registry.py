"""Queries by name, and the views that bind the test tables to the library's inputs.

A view is SQL that Spark and DuckDB read alike; a query's Spark side builds on the library's
operators, its SQL side is written independently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_URL = "case doc_id % 16 " + " ".join(
    f"when {k} then concat({', '.join(repr(x) if x != '#' else 'pid' for x in parts)})"
    for k, parts in enumerate([
        ["https://www.facebook.com/groups/x/posts/", "#"], ["https://www.facebook.com/groups/x/permalink/", "#", "/"], ["https://www.facebook.com/story.php?fbid=", "#", "&id=42"], ["https://www.facebook.com/permalink.php?story_fbid=", "#", "&id=42"],
        ["https://www.facebook.com/watch/?v=", "#"], ["https://www.facebook.com/user/posts/pfbid", "#", "abc"], ["https://www.facebook.com/reel/", "#"], ["https://www.facebook.com/user/photos/", "#"],
        ["https://www.instagram.com/p/C", "#", "/"], ["https://www.instagram.com/tv/C", "#", "/?x=1"], ["https://www.instagram.com/explore/tags/", "#"], ["https://x.com/u/status/", "#"],
        ["https://www.tiktok.com/@u/video/", "#"], ["https://www.tiktok.com/tag/", "#"], ["https://www.threads.com/@u/post/D", "#", "#frag"], ["/url?q=https%3A%2F%2Fwww.facebook.com%2Fgroups%2Fx%2Fposts%2F", "#", "&sa=U"],
    ])
) + " end"

VIEWS = {
    "v_result": f"""select doc_id, pid, doc_id % 8 as page, {_URL} as url, case when doc_id % 16 in (8, 9, 10) then 'instagram.com' when doc_id % 16 = 11 then 'x.com' when doc_id % 16 in (12, 13) then 'tiktok.com' when doc_id % 16 = 14 then 'threads.com' else 'facebook.com' end as site,
        split_part(text, chr(10), 1) as title, concat(substring(text, length(split_part(text, chr(10), 1)) + 1), case doc_id % 7 when 0 then ' giá rẻ 500k' when 1 then ' tel 0912345678.' when 2 then ' 500đ ' when 3 then ' 𝐀𝐁' when 4 then ' ĐẶT TOUR' else '' end) as snippet
        from (select doc_id, coalesce(text, '') as text, cast(10000000000 + doc_id % 16 + 16 * cast(floor(doc_id / 32) as bigint) as varchar(20)) as pid from documents) d""",
    "v_place": """select c_custkey as ord, c_name as name, concat('p', cast(c_nationkey as varchar(4))) as province, case c_mktsegment when 'AUTOMOBILE' then 'mid' when 'FURNITURE' then 'mid' when 'MACHINERY' then 'long' else 'core' end as cadence, case c_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier from customer""",
    "v_province": """select concat('p', cast(n_nationkey as varchar(4))) as province, n_name as name, case n_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier from nation""",
    "v_keyword": """select n_nationkey as keyword_id, n_name as keyword, concat('p', cast(n_nationkey + n_regionkey as varchar(4))) as province, n_nationkey % 7 <> 0 as is_enabled from nation""",
    "v_cadence": """select 'core' as cadence, 4 as cadence_days, 8 as window_days union all select 'mid', 8, 12 union all select 'long', 14, 18""",
    "v_platform": """select cast(r_regionkey + 1 as integer) as platform_id, case r_regionkey when 0 then 'facebook.com' when 1 then 'instagram.com' when 2 then 'x.com' when 3 then 'tiktok.com' else 'threads.com' end as domain from region""",
    "v_job_item": """select o_orderkey as item, concat('p', cast(o_custkey % 35 as varchar(4))) as province, cast(o_orderkey % 7 as integer) as w, case o_orderkey % 4 when 0 then 'facebook.com' when 1 then 'instagram.com' when 2 then 'tiktok.com' else 'x.com' end as site, case o_orderkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier,
        case when o_orderkey % 5 = 2 and o_orderkey % 7 <> 4 then case when o_custkey % 11 = 0 then 'failed' else 'ok' end when o_custkey % 13 = 0 then 'blocked' else 'ok' end as outcome, cast(o_custkey % 10 as bigint) as raw, cast(case when o_custkey % 10 > 3 then 3 else o_custkey % 10 end as bigint) as inserted from orders""",
    "v_page_request": """select l_orderkey as item, cast(l_linenumber as integer) as page, cast(l_orderkey * 10 + l_linenumber as bigint) as request from lineitem""",
    "v_page": """select l_orderkey as item, l_linenumber as page, case min(l_returnflag) when 'A' then 'failed' else 'done' end as status, cast(max(l_quantity) as integer) % 13 as raw, count(*) as requests, max(l_quantity) < 40 as has_next, case l_orderkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tier,
        cast(min(l_suppkey) % 4 as integer) as key_no, cast(min(l_partkey) % 5 as integer) as w from lineitem group by l_orderkey, l_linenumber""",
    "v_item": """select item, tier, case tier when 'A' then 7 when 'B' then 3 else 1 end as page_max from (select distinct item, tier from v_page) i""",
    "v_ledger": """select event_id, ts, concat('label_', cast(user_id % 50 as varchar(4))) as label, concat('kind_', cast(user_id % 3 as varchar(4))) as kind, case event_type when 'view' then 'offered' when 'click' then 'attempt' when 'purchase' then 'result' when 'signup' then 'result' else 'hard_block' end as event,
        case event_id % 5 when 0 then 'solved' when 1 then 'timeout' when 2 then 'proxy_blocked' when 3 then 'success' else '' end as status, case event_id % 4 when 0 then 'answer_fill_failed' when 1 then 'audio_unavailable' else 'odd' end as reason_code, case event_id % 11 when 0 then 'capture' when 1 then 'solve' else '' end as stage,
        cast(floor(value * 1000) as bigint) as duration_ms, event_id % 9 as attempt, cast(floor(event_id / 9) as bigint) as query_id from events""",
    "v_trigger": """select o_orderkey, concat('{"job_id":"', case when o_orderkey % 17 = 3 then ' ' else concat('job-', cast(o_orderkey as varchar(12))) end, '","job_type":"', case o_orderkey % 6 when 0 then 'Daily' when 1 then 'backfill' when 2 then 'manual' when 3 then 'reconciliation' when 4 then ' daily ' else 'other' end,
        '","search_sites":', case o_orderkey % 5 when 0 then '["facebook","x.com","facebook.com"]' when 1 then '["ig"]' when 2 then '[]' when 3 then '["tt"," TH "]' else '["twitter"]' end, ',"date_from":"', case o_orderkey % 7 when 0 then '2026-02-30' when 1 then '2026-2-3' else '2026-05-01' end, '","date_to":"', case o_orderkey % 11 when 0 then '2026-04-30' else '2026-05-20' end, '"',
        case o_orderkey % 4 when 0 then ',"search_profile":"EN"' when 1 then ',"search_profile":"xx"' when 2 then ',"search_profile":null' else '' end, case o_orderkey % 3 when 0 then ',"keyword_ids":[1,2,2]' when 1 then ',"keyword_ids":[1,-2]' else '' end, case o_orderkey % 13 when 0 then ',"max_pages":11' when 1 then ',"max_pages":3' else '' end,
        case o_orderkey % 19 when 0 then ',"split_days":-1' when 1 then ',"split_days":7' else '' end, '}') as value from orders""",
    "v_response": """select doc_id, case doc_id % 8 when 0 then '{}' when 1 then '{"organic":"x"}' when 2 then '{"organic":[]}' when 3 then '{"organic":[{"title":"no link"},{"link":" "},7]}' when 4 then concat('{"organic":[{"link":" https://x.com/a/status/', cast(doc_id as varchar(12)), ' ","title":"T","rank":1,"odd":2}]}')
        else concat('{"organic":[{"position":1,"title":"T","link":"https://x.com/a/status/', cast(doc_id as varchar(12)), '","snippet":"S"},{"title":5,"link":"https://x.com/b"}]}') end as body from documents""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or a view over test tables and views."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    inputs = {x: load(spark, sf_dir, x) for x in [*TABLES, *VIEWS] if re.search(rf"\b{x}\b", text) and x != name}
    return spark.sql(re.sub(rf"\b({'|'.join(inputs) or '$^'})\b", r"{\1}", text), **inputs)


def _needed(sql: str) -> list[str]:
    """Views that a text reads, those they read first."""
    out: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            out += [x for x in [*_needed(VIEWS[name]), name] if x not in out]
    return out


def query(name: str, sql: str | None = None):
    """Register a function of a table loader under a name; sql may read the views by name."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda table: load(spark, sf_dir, table))
        if sql:
            views = ", ".join(f"{v} as ({VIEWS[v]})" for v in _needed(sql))
            body = sql.strip()
            start = next((x for x in ("with recursive ", "with ") if body.startswith(x)), "")
            SQL[name] = f"{start or 'with '}{views}{', ' if start else ' '}{body[len(start):]}" if views else body
        return f

    return add
