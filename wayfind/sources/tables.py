"""Dimension scans, append logs, checkpoint tables, report sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfind.operators.accounting import latest
from wayfind.sources.scratch import discard

PLACE_SCHEMA = "profile string, ord int, name string, province string, cadence string"
PROVINCE_SCHEMA = "province string, name string, tier string, places array<string>, hashtags array<string>"
PLATFORM_SCHEMA = "platform_id int, domain string"
CADENCE_SCHEMA = "profile string, cadence string, cadence_days int, window_days int"
PROFILE_SCHEMA = "profile string, places_per_query int, sites array<string>, intents array<array<string>>, negatives array<string>, negatives_by_site map<string,array<string>>, page_depth map<string,map<string,int>>"


def read_dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dimension table with a fixed schema; tables of places and profiles are the user's data."""
    return spark.read.schema(schema).parquet(path)


def keywords_by_ids(table: DataFrame, ids: list[int]) -> DataFrame:
    """S3, O3: the listed keywords, enabled or not, by id; an empty list gives none."""
    return table.filter(F.col("keyword_id").isin(ids)).orderBy("keyword_id")


def keywords(table: DataFrame, ids: list[int] | None = None) -> DataFrame:
    """The listed keywords, enabled or not, or without a list (or with an empty one) all enabled ones, by id."""
    return keywords_by_ids(table, ids) if ids else table.filter("is_enabled").orderBy("keyword_id")


def load_keywords(table: DataFrame, ids: list[int] | None = None) -> DataFrame:
    """As keywords(), an error if there are none."""
    rows = keywords(table, ids)
    if rows.isEmpty():
        raise ValueError("no keywords")
    return rows


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the parts of a checkpoint table, rising; none if there is no table."""
    target, fs = _files(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch="))


def write_checkpoint(rows: DataFrame, path: str) -> None:
    """Append page states (fingerprint, item, page, status, seq, …) to the newest part of the table."""
    now = (_epochs(rows.sparkSession, path) or [1])[-1]
    rows.withColumn("epoch", F.lit(max(now, 1))).write.mode("append").partitionBy("epoch", "fingerprint").parquet(path)


def compact_checkpoint(spark: SparkSession, path: str, schema: str) -> None:
    """Rewrite the states of parts that nothing is appended to any more as the latest one of each page.

    A call begins a new part for appends and rewrites those that the call before closed, so an append
    that began meanwhile is never rewritten from under its writer, if it ends before the next call. The
    rewritten states are part 0, overwritten by partitions, which Spark moves there when all of them
    are written, so the old part 0 is read meanwhile; only then the parts they came from are deleted. A call that breaks off leaves states twice, of which readers take the latest.
    """
    epochs = _epochs(spark, path)
    if not epochs:
        return
    closed = [e for e in epochs if e < epochs[-1]]
    target, fs = _files(spark, f"{path}/epoch={epochs[-1] + 1}")
    fs.mkdirs(target)
    if not [e for e in closed if e > 0]:
        return
    rows = spark.read.schema(f"{schema}, epoch int").parquet(path).filter(F.col("epoch").isin(closed)).drop("epoch")
    kept = latest(rows.repartition("fingerprint", "item", "page"), ["fingerprint", "item", "page"], "seq")  # states of a page are few, so they are sorted once, after the shuffle
    kept.withColumn("epoch", F.lit(0)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "fingerprint").parquet(path)
    for e in closed:
        if e > 0:
            discard(spark, f"{path}/epoch={e}")


def read_checkpoint(spark: SparkSession, path: str, fingerprint: str, schema: str, accepted: list[str] | None = None) -> DataFrame:
    """The latest state of each page of a plan, also under the older fingerprints `accepted`. Rows of other plans only are an error, a missing table is empty."""
    if not _epochs(spark, path):
        return latest(spark.createDataFrame([], schema), ["item", "page"], "seq")
    rows = spark.read.schema(f"{schema}, epoch int").parquet(path).drop("epoch")
    own = rows.filter(F.col("fingerprint").isin([fingerprint, *(accepted or [])]))
    if own.isEmpty() and not rows.isEmpty():
        raise ValueError("the checkpoint belongs to another plan")
    return latest(own, ["item", "page"], "seq")


def append_log(rows: DataFrame, path: str) -> None:
    """Append events or request telemetry to a log table; readers take the latest of a key, so a repeated append does no harm there."""
    rows.write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report row per line as JSON, one file."""
    report.select(F.to_json(F.struct(*report.columns))).coalesce(1).write.text(path)


def open_runs(plan: DataFrame, keys: list[str]) -> DataFrame:
    """Opening events of the runs of a plan, with an id that a replay repeats."""
    return plan.select(*keys).distinct().withColumn("run_id", F.sha2(F.to_json(F.struct(*keys)), 256)).withColumn("status", F.lit("running")).withColumn("seq", F.lit(0).cast("long"))
