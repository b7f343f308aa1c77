"""The table of posts and the sketches beside it: posts that it doesn't hold yet are added, most of it unread.

A batch has a folder of its own, below it a folder for each bucket of a hash of post_id; beside them lie
Bloom sketches of the ids of each batch and bucket. Before a batch is added its ids are asked of the
sketches, a few bytes a post. Only folders whose sketch may hold one are read, and of them only the ids
whose hash was asked for go on, so that Spark broadcasts them where they are few and no earlier post is
shuffled. A sketch never denies an id that is there; one that it wrongly may hold costs a read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayfind.operators.results import first_wins
from wayfind.sources.scratch import discard, materialise

#: Bits of a sketch for each id and how many of them an id sets: about 1 in 25,000 other ids is taken for held.
BITS, SETS = 24, 8
#: Ids of one sketch, and of one list of ids that is asked.
MOST = 1 << 20
SKETCHES = "batch bigint, post_bucket int, pieces int, piece int, bits binary"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash, a row each."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return (h[:, None] + np.arange(SETS, dtype=np.uint64)[None, :] * step[:, None]) % np.uint64(size)


def sketch(hashes: np.ndarray) -> bytes:
    """A Bloom sketch of 64-bit hashes."""
    size = max(64, -(-BITS * len(hashes) // 8) * 8)
    bits = np.zeros(size, np.uint8)
    bits[_places(hashes, size).reshape(-1).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes a sketch may hold: all that it was made of, and few others."""
    own = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(own) * 8).astype(np.int64)
    return ((own[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def post_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("post_id"), F.lit(buckets)).cast("int")


def post_hash() -> Column:
    """The hash that sketches hold, another one than that of buckets."""
    return F.xxhash64(F.lit(1), "post_id")


def _piece(pieces: int | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), "post_id"), F.lit(pieces) if isinstance(pieces, int) else pieces).cast("int")


def _write_sketches(posts: DataFrame, n: int, buckets: int, path: str) -> None:
    """Sketches of posts(post_id, post_bucket), several to a bucket where it is large."""
    pieces = max(1, -(-n // (buckets * MOST // 2)))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"post_bucket": [own["post_bucket"].iloc[0]], "pieces": pieces, "piece": own["piece"].iloc[0], "bits": [sketch(own["h"].to_numpy())]})

    hashes = posts.select("post_bucket", _piece(pieces).alias("piece"), post_hash().alias("h"))
    made = hashes.groupBy("post_bucket", "piece").applyInPandas(run, "post_bucket int, pieces int, piece int, bits binary")
    made.write.mode("overwrite").partitionBy("post_bucket").parquet(path)


def _asked(sketches: DataFrame, rows: DataFrame, n: int, buckets: int) -> DataFrame:
    """batch, post_bucket, h of the hashes of rows that a sketch may hold."""

    def run(bits: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([h[may_hold(b, h)] if len(h) else h for b, h in zip(bits, hashes, strict=True)])

    lists = max(1, -(-n // (buckets * MOST // 2)))
    packed = rows.groupBy("post_bucket", F.pmod(post_hash(), F.lit(lists)).alias("list")).agg(F.collect_list(post_hash()).alias("hashes")).drop("list")
    held = F.pandas_udf(run, "array<bigint>")
    return sketches.join(packed, "post_bucket").select("batch", "post_bucket", F.explode(held("bits", "hashes")).alias("h"))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def held_posts(rows: DataFrame, target: str, batch: int, n: int, buckets: int) -> DataFrame | None:
    """post_id of the posts of batches before this one that rows(post_id, post_bucket), n of them, may have as well; None if there are none."""
    spark = rows.sparkSession
    if not _exists(spark, f"{target}/sketches"):
        return None
    own = [r["post_bucket"] for r in rows.select("post_bucket").distinct().collect()]  # at most `buckets`
    sketches = spark.read.schema(SKETCHES).parquet(f"{target}/sketches").filter((F.col("batch") < batch) & F.col("post_bucket").isin(own))
    hits, _ = materialise(_asked(sketches, rows, n, buckets), "asked")
    folders = [f"{target}/posts/batch={r['batch']}/post_bucket={r['post_bucket']}" for r in hits.select("batch", "post_bucket").distinct().collect()]  # folders to read, as many as Spark would list
    if not folders:
        return None
    earlier = spark.read.schema("post_id string").parquet(*folders)
    return earlier.withColumn("h", post_hash()).join(hits.select("h").distinct(), "h", "left_semi").select("post_id")


def insert(posts: DataFrame, target: str, batch: int, order: list[str], buckets: int = 32) -> int:
    """Add posts(post_id, ...) that batches before this one don't hold; how many were added.

    The first of equal ids in `order` stays, null ids are left out. A batch that is added again replaces
    itself and gives the same. `buckets` is for the life of the table. read_posts() has the table.
    """
    spark = posts.sparkSession
    offered = Observation()
    rows, path = materialise(first_wins(posts, "post_id", order).withColumn("post_bucket", post_bucket(buckets)).observe(offered, F.count(F.lit(1)).alias("n")), "offered")
    known = held_posts(rows, target, batch, offered.get["n"], buckets)
    new = rows if known is None else rows.join(known, "post_id", "left_anti")
    added = Observation()
    own = f"{target}/posts/batch={batch}"
    new.repartition("post_bucket").observe(added, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("post_bucket").parquet(own)
    n = added.get["n"]
    _write_sketches(spark.read.schema("post_id string, post_bucket int").parquet(own), n, buckets, f"{target}/sketches/batch={batch}")
    discard(spark, path)
    return n


def read_posts(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The posts of all batches, with batch and post_bucket; schema names the columns of a post."""
    return spark.read.schema(f"{schema}, batch bigint, post_bucket int").parquet(f"{target}/posts")
