"""What the operators of this subpackage share: white space, ids, connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfind.sources.scratch import discard, materialise

#: The six characters that separate words and that comparisons ignore.
SPACE = " \t\n\x0b\x0c\r"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def with_key(docs: DataFrame) -> DataFrame:
    """d, a struct of all columns of docs, and key (f, r), which tells rows apart whatever their ids.

    The key is the place of the row in its Parquet file, so a retried task finds the same; a docs
    that isn't a plain scan of such files is written to the shared folder first.
    """
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("d")
    if "_metadata" not in docs.columns:
        try:
            return docs.select(whole, _place())
        except AnalysisException:  # no plain scan
            pass
    written, _ = materialise(docs.select(whole), "rows")
    return written.select("d", _place())


def _place() -> Column:
    return F.struct(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")).alias("key")


def columns_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns that with_key() packed."""
    return rows.select(*(F.col("d").getField(c).alias(c) for c in names))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(u, v), component being the smallest node reachable.

    Alternating large-star and small-star rounds until the edge set stays as it is; each round is
    two aggregations with map-side combining and two joins against one row per node, which AQE can
    split when a hub is hot. Nodes may be of any type with an order. Self loops, repeated and reversed edges and nulls are ignored; nodes
    that only had those are absent. Only one row of totals per round reaches the driver.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).filter("u is not null and v is not null and hi <> lo").distinct()
    now, path = materialise(pairs, "edges")
    seen = _totals(now)
    while seen[0]:
        ways = now.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(now.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = now.join(least, now["lo"] == least["k"]).select("hi", F.col("m").alias("lo")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("k"), "m")
        small = large.join(down, large["hi"] == down["k"]).select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").filter("hi <> lo").distinct()
        after, path_after = materialise(small, "edges")
        totals = _totals(after)
        discard(spark, path)
        now, path = after, path_after
        if totals == seen:
            break
        seen = totals
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _totals(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
