"""Queries that run as streams over the test tables, with the batch result as their SQL."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfind.functions import text
from wayfind.operators import results
from wayfind.operators.ordered import micros
from wayfind.plans.account_queries import _ERR, DEFAULT, PROFILES
from wayfind.plans.registry import QUERIES, SQL, VIEWS, load
from wayfind.plans.result_queries import _RES
from wayfind.sources import posts
from wayfind.sources.scratch import scratch_path
from wayfind.streaming import streams


def _stream(spark: SparkSession, rows: DataFrame, batches: int = 4) -> DataFrame:
    """rows written as files of at most streams.FILE_ROWS and read as a stream of `batches` micro-batches, so that every core has a file and no task gets more of a larger table."""
    path = scratch_path(spark, "source")
    rows.write.option("maxRecordsPerFile", streams.FILE_ROWS).parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    files, least = len(written.inputFiles()), batches * spark.sparkContext.defaultParallelism
    if files < least:  # a small table, dealt anew
        path, files = scratch_path(spark, "source"), least
        written.repartition(files).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", math.ceil(files / batches)).parquet(path)


def stream_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "jobs")
    streams.job_tables(_stream(spark, load(spark, sf_dir, "v_trigger")), PROFILES, DEFAULT, target, scratch_path(spark, "state")).awaitTermination()
    jobs, rejects = spark.read.parquet(f"{target}/jobs"), spark.read.parquet(f"{target}/rejects")
    return jobs.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(rejects.select("o_orderkey", F.lit(False).alias("accepted")))


def stream_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "jobs")
    streams.job_tables(_stream(spark, load(spark, sf_dir, "v_trigger")), PROFILES, DEFAULT, target, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(f"{target}/done").select("key", F.get_json_object("value", "$.status").alias("status"), F.get_json_object("value", "$.job_type").alias("job_type"))


def _in_order(spark: SparkSession, rows: DataFrame, at: str, part, parts: int = 4) -> DataFrame:
    """rows as a stream of `parts` micro-batches in the order of part, written one after the other."""
    path = scratch_path(spark, "source")
    rows = rows.withColumn("part", part)
    for k in range(parts):
        rows.filter(F.col("part") == k).drop("part").repartition(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(path)


def _quarter(rows: DataFrame, at: str, parts: int = 4):
    """In which of `parts` equal spans of the table's time a row lies."""
    ends = rows.agg(F.min(micros(F.col(at))).alias("a"), F.max(micros(F.col(at))).alias("b")).first()
    return F.floor((micros(F.col(at)) - F.lit(ends["a"])) * parts / F.lit(ends["b"] - ends["a"] + 1)).cast("int")


def stream_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of a post comes first depends on the micro-batches, so the posts are compared, each once, with the number that was told."""
    rows = results.with_reason(load(spark, sf_dir, "v_result")).select("doc_id", "post_id", "reject_reason")
    target, told = scratch_path(spark, "posts"), []
    streams.post_table(_stream(spark, rows), ["doc_id"], target, scratch_path(spark, "state"), tell=told.append).awaitTermination()
    total = {name: sum(x[name] for x in told) for name in ("found", "rejected", "inserted")}
    table = posts.read_posts(spark, target, "post_id string").groupBy("post_id").agg(F.count(F.lit(1)).alias("n"))
    return table.unionByName(spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(name).alias("post_id"), F.lit(n).cast("long").alias("n")) for name, n in total.items()))).alias("x")).select("x.*"))


def _counted(name: str, keys: list[str], length: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = scratch_path(spark, name)
        rows = _stream(spark, load(spark, sf_dir, "v_ledger").select("ts", "event", "duration_ms", "label", "kind"))
        streams.counted_table(streams.windowed(rows, "ts", "3650 days", length, keys), target, scratch_path(spark, "state")).awaitTermination()
        return streams.read_counted(spark, target, keys)

    return run


def stream_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that close while the stream goes on, and rows that come after theirs has: together what a batch counts."""
    rows = load(spark, sf_dir, "v_ledger").select("event_id", "ts", "event", "duration_ms", "kind")
    part = F.when(F.col("event_id") % 29 == 0, 3).otherwise(_quarter(rows, "ts"))  # some rows of all times come with the last ones
    target = scratch_path(spark, "closing")
    streams.closing_table(_in_order(spark, rows, "ts", part), "ts", 3600, 86_400, ["kind"], target, scratch_path(spark, "state")).awaitTermination()
    closed, still, late = streams.read_closed(spark, target)
    late = late.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("start"), "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event") == "result").alias("results"), F.sum("duration_ms").alias("duration_ms"))
    return closed.unionByName(still).unionByName(late).groupBy("start", "kind").agg(*(F.sum(c).alias(c) for c in ("n", "results", "duration_ms")))


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def stream_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "v_ledger").select("label", "ts")
    source = _in_order(spark, rows, "ts", _quarter(rows, "ts"))
    target = scratch_path(spark, "beats")
    with _rocksdb(spark):
        beats = streams.throttled(source, "label", 6 * 3600)
        beats.writeStream.format("parquet").option("path", target).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("label string, ts timestamp").parquet(target).select("label", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = text.strings(sorted(set(text.SITE_ALIASES.values())))
    return load(spark, sf_dir, "region").select(F.explode(text.strings(PROFILES)).alias("profile"), F.concat(F.lit("w"), F.col("r_regionkey").cast("string")).alias("text")).withColumn("site", F.explode(sites))


def _planned(spark: SparkSession, target: str) -> DataFrame:
    """A row per query of a plan. The least text needs sorted rows, so they are dealt by job first, into tasks of a few files' rows."""
    rows = spark.read.parquet(target)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / (4 * streams.FILE_ROWS)))
    return rows.repartition(tasks, "job_id").groupBy("job_id", "site", "text", "label").agg(F.count(F.lit(1)).alias("n"), F.min("query").alias("query"))


def stream_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of the accepted jobs, a text per region, profile and site."""
    target = scratch_path(spark, "plan")
    streams.plan_table(_stream(spark, load(spark, sf_dir, "v_trigger")), PROFILES, DEFAULT, lambda s: _texts(s, sf_dir), target, scratch_path(spark, "state")).awaitTermination()
    return _planned(spark, target)


def stream_plan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a dimension whose first version has the even regions and whose second all of them, and messages that came before, between and after."""
    target = scratch_path(spark, "plan")
    at = lambda day: F.concat(F.lit("2026-01-0"), day.cast("string")).cast("timestamp_ntz")
    messages = load(spark, sf_dir, "v_trigger").withColumn("received", at(F.col("o_orderkey") % 3 + 1))

    def versions(s: SparkSession) -> DataFrame:
        texts = _texts(s, sf_dir)
        return texts.filter("text in ('w0', 'w2', 'w4')").withColumn("since", at(F.lit(2))).unionByName(texts.withColumn("since", at(F.lit(3))))

    streams.plan_table(_stream(spark, messages), PROFILES, DEFAULT, versions, target, scratch_path(spark, "state"), received="received").awaitTermination()
    return _planned(spark, target)


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of a stream, each once as far as the allowed lateness reaches, which here is all of it."""
    rows = results.with_reason(load(spark, sf_dir, "v_result")).filter("reject_reason is null").select("post_id", F.lit("2026-01-01 00:00:00").cast("timestamp").alias("found_at"))
    target = scratch_path(spark, "bounded")
    kept = streams.bounded_posts(_stream(spark, rows), "found_at", "1 day")
    kept.writeStream.format("parquet").option("path", target).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("post_id string").parquet(target).groupBy("post_id").agg(F.count(F.lit(1)).alias("n"))


QUERIES |= {"stream_triggers": stream_triggers, "stream_done": stream_done, "stream_posts": stream_posts, "stream_plan": stream_plan, "stream_bounded": stream_bounded, "stream_closing": stream_closing, "stream_heartbeat": stream_heartbeat, "stream_plan_versions": stream_plan_versions, "stream_progress": _counted("progress", [], "1 hour"), "stream_ledger": _counted("ledger", ["kind"], "1 day")}
_LEDGER = f"with v_ledger as ({VIEWS['v_ledger']})"
_AGG = "count(*) as n, count(*) filter (where event = 'result') as results, sum(duration_ms)::bigint as duration_ms from v_ledger group by all"


def _planned_sql(regions: str) -> str:
    """SQL of the queries that jobs give; regions are those whose texts a job (k) gets."""
    return f"""with j as (select o_orderkey as k from ({_ERR}) where len(errors) = 0), s as (select k, unnest(case k % 5 when 0 then ['facebook.com', 'x.com'] when 1 then ['instagram.com'] when 3 then ['tiktok.com', 'threads.com'] else ['x.com'] end) as site from j), x as (select k, site, concat('w', region) as text from s, lateral ({regions} as region)),
        d as (select *, case when k % 6 in (0, 4) then 'ROLLING' else 'SPLIT' end as mode, case when k % 6 in (1, 3) then 1 when k % 19 = 1 then 7 else 4 end as step, 20 as days from x),
        q as (select k, site, text, 'ROLLING' as label, date '2026-04-30' as a, null::date as b from d where mode = 'ROLLING'
            union all select k, site, text, concat('P', i + 1), date '2026-05-01' + i * step - 1, least(date '2026-05-01' + i * step + step - 1, date '2026-05-20') + 1 from (select *, unnest(range(0, cast(floor(19 / step) as integer) + 1))::integer as i from d where mode = 'SPLIT'))
        select concat('job-', k) as job_id, site, text, label, 1::bigint as n, concat('site:', site, ' ', text, case site when 'facebook.com' then ' -inurl:photo -inurl:photos' when 'instagram.com' then ' -inurl:explore -inurl:stories -inurl:accounts' when 'tiktok.com' then ' -inurl:tag -inurl:discover -inurl:search -site:shop.tiktok.com' else '' end, ' after:', a, case when b is null then '' else concat(' before:', b) end) as query from q"""


SQL |= {
    "stream_triggers": f"select o_orderkey, len(errors) = 0 as accepted from ({_ERR})",
    "stream_done": f"select concat('job-', o_orderkey) as key, 'done' as status, case o_orderkey % 6 when 0 then 'daily' when 1 then 'backfill' when 2 then 'manual' when 3 then 'reconciliation' else 'daily' end as job_type from ({_ERR}) where len(errors) = 0",
    "stream_plan": _planned_sql("select unnest(range(5))"),
    "stream_plan_versions": _planned_sql("select unnest(case k % 3 when 0 then [] when 1 then [0, 2, 4] else range(5) end)"),
    "stream_heartbeat": SQL["heartbeat"],
    "stream_closing": f"{_LEDGER} select date_trunc('day', ts) as start, kind, {_AGG}",
    "stream_bounded": f"with v_result as ({VIEWS['v_result']}), {_RES} select post_id, 1::bigint as n from r where reason is null group by 1",
    "stream_posts": f"with v_result as ({VIEWS['v_result']}), {_RES} select post_id, 1::bigint as n from r where reason is null group by 1 union all select 'found', count(*) from r union all select 'rejected', count(*) from r where reason is not null union all select 'inserted', count(distinct post_id) from r where reason is null",
    "stream_progress": f"{_LEDGER} select date_trunc('hour', ts) as start, {_AGG}",
    "stream_ledger": f"{_LEDGER} select date_trunc('day', ts) as start, kind, {_AGG}",
}
