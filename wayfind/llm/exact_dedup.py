"""Exact dedup in three combining steps, DataFrame functions only.

Rows are deduplicated inside each task (map-side combining), merged per (digest, salt), and the few
salt winners of a digest are combined globally. Content is a grouping key beside the digest at every
step, so two texts that share a digest never merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.llm.common import SPACE, columns_of, text_or_empty, with_key
from wayfind.sources.scratch import materialise

SALTS = 16


def without_space(text: Column) -> Column:
    """The content that is compared: text without white space."""
    return F.translate(text, SPACE, "")


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def _order() -> list[Column]:
    """Of equal contents the most code points win, then the smallest id, null last."""
    return [(-F.col("points")).alias("longest"), F.col("id").isNull().alias("unnamed"), F.col("id").alias("id")]


def _combined(rows: DataFrame, order: list[Column]) -> DataFrame:
    """digest, content, best (the least of order), n of rows(digest, salt, content, ...): in each task, per salt, then globally."""
    local = rows.groupBy("digest", "salt", "content").agg(F.min(F.struct(*order)).alias("best"), F.count(F.lit(1)).alias("n"))
    return local.repartition(F.col("digest")).groupBy("digest", "content").agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = without_space, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept.

    Of equal contents the row with the most code points stays, then the smallest id; a null id loses
    every tie. Null text counts as empty. Rows repeating one id with equal content count in
    group_size and share their mark. Other columns of docs are ignored, whatever their names; an
    empty table gives no rows. Hot contents: a task sends one row per content and at most `salts`
    rows of a content meet in the last step; the join back is a plain equi-join that AQE splits.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("id", F.length("text").alias("points"), normalise(F.col("text")).alias("content")).withColumn("digest", digest(F.col("content")))
    merged = _combined(rows.withColumn("salt", F.spark_partition_id() % salts), _order())
    winners, _ = materialise(
        merged.withColumn("variants", F.count(F.lit(1)).over(Window.partitionBy("digest"))).select("digest", F.when(F.col("variants") > 1, F.col("content")).alias("content"), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size")),
        "winners",
    )
    single, shared = winners.filter("content is null").drop("content"), winners.filter("content is not null")
    found = rows.select("id", "digest").join(single, "digest")
    if not shared.isEmpty():  # digests that stand for several contents: compare the contents here too
        found = found.unionByName(rows.select("id", "digest", "content").join(shared, ["digest", "content"]).drop("content"))
    return found.select("id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = without_space, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """docs less all but one row of each group of equal contents, with all columns: the row that exact_dedup keeps.

    Rows are told apart by their place in the table, so rows that share an id, or have none, go or
    stay each by itself.
    """
    keyed = with_key(docs)
    rows = keyed.select(F.col("d").getField(id_col).alias("id"), F.coalesce(F.col("d").getField(text_col), F.lit("")).alias("text"), "key.f", "key.r")
    rows = rows.select("id", "f", "r", F.length("text").alias("points"), normalise(F.col("text")).alias("content")).withColumn("digest", digest(F.col("content")))
    kept, _ = materialise(_combined(rows.withColumn("salt", F.spark_partition_id() % salts), [*_order(), F.col("f"), F.col("r")]).select("best.f", "best.r"), "kept")
    return columns_of(keyed.select("d", "key.f", "key.r").join(kept.hint("merge"), ["f", "r"], "left_semi"), docs.columns)
