"""Near copies by word-shingle similarity: SimHash fingerprints linked by the Gray-ordered index, minimum hashes for pairs further apart, shingle sets decide.

All documents' fingerprints go through the index of `simhash`, which misses no link of CLOSE_BITS
differing bits; what such links connect is a bucket. But a similarity of 0.8 of five-word shingles
leaves about 10 of 64 fingerprint bits different, and up to 20, and no index of 64-bit fingerprints
finds all such pairs without comparing most of all pairs. So there are further buckets beside those, by
tables of combined minimum hashes, one of which documents of that similarity share with a probability
of 0.995. Each link is decided by the sets of shingles themselves.

A bucket is never paired with itself. Its first document leads it, and all others are compared with
the leader; those that are not similar to it, and only those, are compared with the rest of the
bucket, in blocks, through the Gray-ordered index of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfind.llm.common import columns_of, connected_components, with_key
from wayfind.llm.simhash import fingerprint, gray_rank, link_edges, near_links, shingle_hashes, whole_groups
from wayfind.sources.scratch import materialise, step

#: Tables of buckets, and minimum hashes that name a bucket: a pair of similarity s shares a bucket with a probability of 1 - (1 - s**HASHES)**TABLES.
TABLES, HASHES = 10, 4
#: Fingerprints of so many differing bits are linked by the index, all of them.
CLOSE_BITS = 3
#: Pairs of more differing fingerprint bits aren't looked at. A bit is a majority of the shingles' bits; that of two sets of similarity 0.8 differs most often where one
#: has five shingles and the other four of them: with a probability of 3/16 (a test tries all sizes). More than 24 of 64 such bits differ in less than 1 pair in 5,000,
#: 25 times fewer than the 1 in 200 that share no bucket.
FAR_BITS = 24
#: Rows of a block of a bucket.
BLOCK = 2048

#: A document in the order in which one stands for others: by id, null last, then by its place in the table.
NODE = {"unnamed": "boolean", "id": "bigint", "f": "bigint", "r": "bigint"}


def _mixers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(seed)
    return rnd.integers(0, 1 << 64, TABLES * HASHES, np.uint64), rnd.integers(0, 1 << 64, TABLES * HASHES, np.uint64) | np.uint64(1)


def sketches(hashes: list[np.ndarray], seed: int) -> np.ndarray:
    """The bucket of each non-empty set of hashes in every table: (sets, TABLES), signed."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat, starts = np.concatenate(hashes), np.cumsum(sizes) - sizes
    out = np.zeros((len(hashes), TABLES), np.uint64)
    for j, (x, m) in enumerate(zip(*_mixers(seed), strict=True)):
        least = np.minimum.reduceat((flat ^ x) * m, starts)
        t = j // HASHES
        out[:, t] = (out[:, t] ^ least ^ np.uint64(t + 1)) * np.uint64(0x9E3779B97F4A7C15)
        out[:, t] ^= out[:, t] >> np.uint64(29)
    return out.view(np.int64)


def similar(a: bytes, b: bytes, similarity: float) -> bool:
    """Whether two sorted sets of 32-bit hashes have this Jaccard similarity or more."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared >= similarity * (len(both) - shared)


def _marked(rows: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                sets = [np.unique(shingle_hashes(t, shingle, seed)) for t in part["text"]]
                some = np.flatnonzero([len(s) > 0 for s in sets])  # a text without words is like no other
                if len(some):
                    own = [sets[k] for k in some]
                    fp = np.array([fingerprint(s) for s in own], np.uint64).view(np.int64)
                    yield part.iloc[some][["unnamed", "id", "f", "r"]].assign(fp=fp, buckets=list(sketches(own, seed)), shingles=[np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in own])

    name = F.col("d").getField(id_col).cast("long")
    texts = rows.select(name.isNull().alias("unnamed"), F.coalesce(name, F.lit(0)).alias("id"), "key.f", "key.r", F.coalesce(F.col("d").getField(text_col), F.lit("")).alias("text"))
    out = texts.mapInPandas(run, "unnamed boolean, id bigint, f bigint, r bigint, fp bigint, buckets array<bigint>, shingles binary")
    return out.select(F.struct("unnamed", "id", "f", "r").alias("node"), "fp", "buckets", "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """pairs(node, leader) with `ok`: whether their sets are similar enough."""

    @F.pandas_udf("boolean")
    def ok(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(x, y, similarity) for x, y in zip(a, b, strict=True)], dtype=bool)

    one = pairs.join(sets.select("node", F.col("shingles").alias("a")).hint("merge"), "node")
    both = one.join(sets.select(F.col("node").alias("leader"), F.col("shingles").alias("b")).hint("merge"), "leader")
    return both.select("node", "leader", ok("a", "b").alias("ok"))


def _by_fingerprint(marked: DataFrame) -> DataFrame:
    """node, bucket of every document: the smallest fingerprint that links of CLOSE_BITS reach from its own."""
    reps, _ = materialise(marked.select("fp", F.col("fp").alias("rep")).distinct(), "fingerprints")
    joined = connected_components(link_edges(reps, CLOSE_BITS)).withColumnsRenamed({"node": "fp", "component": "bucket"})
    return marked.select("node", "fp").join(joined.hint("merge"), "fp", "left").select("node", F.coalesce("bucket", "fp").alias("bucket"))


def links(marked: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) that connect all documents of marked(node, fp, buckets, shingles) that are similar and share a bucket or are linked by their fingerprints."""
    members = marked.select("node", F.explode("buckets").alias("bucket")).unionByName(_by_fingerprint(marked))
    leaders, _ = materialise(members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "leaders")
    members, _ = materialise(members.join(leaders.hint("merge"), "bucket"), "members")
    pairs, _ = materialise(members.filter("node <> leader").select("node", "leader").distinct(), "candidates")
    involved = pairs.select("node").union(pairs.select("leader")).distinct()
    sets, _ = materialise(marked.drop("buckets").join(involved.hint("merge"), "node", "left_semi"), "sets")
    told, _ = materialise(_verified(pairs, sets, similarity), "verified")
    led = told.filter("ok").select(F.col("node").alias("u"), F.col("leader").alias("v"))
    strangers, _ = materialise(members.join(told.filter("not ok"), ["node", "leader"]).select("bucket", "node"), "strangers")
    if strangers.isEmpty():
        return led
    return led.unionByName(_among(members, strangers, sets, similarity, block))


def _among(members: DataFrame, strangers: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """Edges between documents unlike the leader of their bucket and the bucket's others, block by block."""
    rare = strangers.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))
    whole = members.join(rare, "bucket").join(strangers.withColumn("odd", F.lit(True)), ["bucket", "node"], "left")
    whole = whole.select("bucket", "node", F.coalesce("odd", F.lit(False)).alias("odd"), F.ceil(F.col("m") / block).cast("int").alias("rows"), F.ceil(F.col("n") / block).cast("long").alias("columns")).join(sets, "node")
    every = whole.select("bucket", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(F.xxhash64("node"), "columns").alias("j"), F.lit(False).alias("asks"), "odd", "node", "fp", "shingles")
    asking = whole.filter("odd").select("bucket", F.pmod(F.xxhash64("node"), "rows").cast("int").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("j"), F.lit(True).alias("asks"), "odd", "node", "fp", "shingles")

    def compare(own: pd.DataFrame) -> pd.DataFrame:
        keys = own[["bucket", "i", "j"]].to_numpy()
        group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)])
        fp = own["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(fp), group))
        own, fp, group = own.iloc[order], fp[order], group[order]
        sets, asks, odd = own["shingles"].to_numpy(), own["asks"].to_numpy(), own["odd"].to_numpy()
        tame = np.flatnonzero(~odd)  # linked with the leader of their bucket, and so with each other
        parent = np.arange(len(own))
        first = np.r_[True, group[tame][1:] != group[tame][:-1]]
        parent[tame] = tame[np.maximum.accumulate(np.where(first, np.arange(len(tame)), 0))]

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.array([bool(asks[x] | asks[y]) and similar(sets[x], sets[y], similarity) for x, y in zip(a.tolist(), b.tolist(), strict=True)], bool)

        root = near_links(fp, group, FAR_BITS, parent, linked)
        new = np.flatnonzero((root != np.arange(len(root))) & (odd | odd[root]))
        return pd.DataFrame({f"{end}_{c}": own[c].to_numpy()[at] for end, at in (("u", new), ("v", root[new])) for c in NODE})

    groups = ["bucket", "i", "j"]
    flat = every.unionByName(asking).select(*groups, "asks", "odd", "node.*", "fp", "shingles").repartition(*groups).sortWithinPartitions(*groups)
    found = flat.mapInPandas(whole_groups(groups, compare), ", ".join(f"{end}_{c} {kind}" for end in "uv" for c, kind in NODE.items()))
    return found.select(*(F.struct(*(F.col(f"{end}_{c}").alias(c) for c in NODE)).alias(end) for end in "uv"))


def drop_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, block: int = BLOCK) -> DataFrame:
    """docs less the documents that a smaller id stands for: of each group of similar documents the row of smallest id stays, with all its columns.

    Two documents are linked if their sets of word shingles (words as in op4, lower-cased) have the
    Jaccard similarity or more; groups are what links reach. Rows without an id stand behind those
    with one; of rows that share an id or have none, one stays like any other, so exactly one row of
    a group is left. Texts without words, null ones too, are like no other and stay; texts of fewer
    words than a shingle are one shingle. An empty table gives no rows.
    """
    rows = with_key(docs)
    with step(docs.sparkSession) as keep:  # candidates and sets of shingles go once it is known which rows do
        marked, _ = materialise(_marked(rows, id_col, text_col, shingle, seed), "shingles")
        joined = connected_components(links(marked, similarity, block))
        gone, path = materialise(joined.filter("node <> component").select("node.f", "node.r"), "gone")
        keep(path)
    left = rows.select("d", "key.f", "key.r").join(gone.hint("merge"), ["f", "r"], "left_anti")
    return columns_of(left, docs.columns)
