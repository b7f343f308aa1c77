"""SimHash near-dedup: fingerprints, and all links of few differing bits by a Gray-ordered hierarchical index.

Distinct fingerprints are dealt into buckets that share a block of bits (with k differences allowed,
one of k + 1 blocks is equal). Inside a bucket they are sorted by Gray rank; runs of eight become a
node that keeps the bit pattern its members share, runs of eight nodes an upper node, and so on.
Pairs of nodes whose shared patterns already differ in more than k bits are pruned with all below
them. A bucket too large for one task is dealt again by the bits still free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfind.llm.common import columns_of, connected_components, text_or_empty, union_all
from wayfind.llm.forest import join_rows, settle
from wayfind.sources.scratch import materialise

FANOUT = 8
#: Buckets of more fingerprints than this are dealt again by further bits; nothing is dropped.
BUCKET_ROWS = 4096
#: Pairs of nodes opened at a time.
FRONTIER = 1 << 15


def shingle_hashes(text: str, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each of the text's word shingles, repeats included; the whole sequence if it has fewer words, nothing if it has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each 1 if set in over half the hashes; zero for none."""
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long). Null text counts as empty, whose fingerprint is zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(shingle_hashes(t, shingle, seed)) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": fp})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(run, "doc_id bigint, fp bigint")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the binary reflected Gray code."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def near_links(fp: np.ndarray, bucket: np.ndarray, k: int, parent: np.ndarray | None = None, linked: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """For rows ordered by (bucket, Gray rank): the smallest row reachable in the bucket by links of at most k differing bits.

    parent holds links known before; linked(a, b), asked of rows that nothing joins yet, may refuse some.
    """
    n = len(fp)
    levels = [(fp, fp, np.arange(n), np.arange(n))]  # AND, OR, first child, last child + 1 (of the level below)
    owner = bucket
    while True:
        first = np.r_[True, owner[1:] != owner[:-1]]
        if first.all():
            break
        place = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
        begin = np.flatnonzero(first | (place % FANOUT == 0))
        ands, ors = levels[-1][0], levels[-1][1]
        levels.append((np.bitwise_and.reduceat(ands, begin), np.bitwise_or.reduceat(ors, begin), begin, np.r_[begin[1:], len(owner)]))
        owner = owner[begin]
    parent = np.arange(n) if parent is None else parent
    roots = np.arange(len(owner))
    todo = [(len(levels) - 1, roots[at : at + FRONTIER], roots[at : at + FRONTIER]) for at in range(0, len(roots), FRONTIER)]
    while todo:
        level, a, b = todo.pop()
        if level == 0:
            if linked is not None:
                settle(parent)
                apart = parent[a] != parent[b]
                a, b = a[apart], b[apart]
                sure = linked(a, b)
                a, b = a[sure], b[sure]
            join_rows(parent, a, b)
            continue
        begin, end = levels[level][2:]
        below_and, below_or = levels[level - 1][:2]
        na, nb = end[a] - begin[a], end[b] - begin[b]
        each = na * nb
        total = int(each.sum())
        within = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
        nb_each = np.repeat(nb, each)
        x, y = np.repeat(begin[a], each) + within // nb_each, np.repeat(begin[b], each) + within % nb_each
        keep = x < y if level == 1 else x <= y
        x, y = x[keep], y[keep]
        shared = ~(below_and[x] ^ below_or[x]) & ~(below_and[y] ^ below_or[y])  # bits fixed in both nodes
        near = np.bitwise_count((below_and[x] ^ below_and[y]) & shared) <= k
        x, y = x[near], y[near]
        todo += [(level - 1, x[at : at + FRONTIER], y[at : at + FRONTIER]) for at in range(0, len(x), FRONTIER)]
    return settle(parent)


def _blocks(free: int, parts: int) -> list[int]:
    """The bits of a mask cut into so many masks of neighbouring bits."""
    bits = [1 << i for i in range(64) if free >> i & 1]
    cut = np.array_split(np.arange(len(bits)), parts)
    return [sum(bits[i] for i in c) for c in cut if len(c)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _deal(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each row of (mask, fp, rep) once for every finer mask of its own; value holds the bits under the mask."""
    finer = F.create_map(*(x for m, fine in masks.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(f)) for f in fine)))))
    dealt = rows.select(F.explode(finer[F.col("mask")]).alias("mask"), "fp", "rep")
    return dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp", "rep")


def link_edges(reps: DataFrame, k: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (u, v) that connect the reps of all distinct fingerprints (fp, rep) linked at k or fewer differing bits.

    A bucket gives a spanning forest, at most one edge per fingerprint, never all its pairs.
    """
    full = (1 << 64) - 1
    masks = {0: _blocks(full, k + 1)}
    rows = _deal(reps.select(F.lit(0).cast("long").alias("mask"), "fp", "rep"), masks)
    edges = []
    while True:
        fine = [m for own in masks.values() for m in own]
        splittable = [m for m in fine if bin(m).count("1") < 64 - k]
        hot, _ = materialise(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > bucket_rows) & F.col("mask").isin([_signed(m) for m in splittable])), "hot")
        some = not hot.isEmpty()
        edges.append(_bucket_edges(rows.join(hot, ["mask", "value"], "left_anti") if some else rows, k))
        if not some:
            return union_all(edges)
        masks = {m: [m | b for b in _blocks(full & ~m, k + 1)] for m in splittable}
        rows, _ = materialise(_deal(rows.join(hot, ["mask", "value"], "left_semi"), masks), "dealt")


def whole_groups(keys: list[str], f: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over rows sorted by keys: f of many groups at a time, each of them whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:  # what follows the last change of keys waits for the next batch
            if not len(batch):
                continue
            key = batch[keys].to_numpy()
            change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            if held and (held[-1][keys].to_numpy()[-1] != key[0]).any():
                yield f(pd.concat(held))
                held = []
            if len(change):
                held.append(batch.iloc[: change[-1] + 1])
                yield f(pd.concat(held))
                held = [batch.iloc[change[-1] + 1 :]]
            else:
                held.append(batch)
        if held:
            yield f(pd.concat(held))

    return run


def _bucket_edges(rows: DataFrame, k: int) -> DataFrame:
    def edges_of(rows: pd.DataFrame) -> pd.DataFrame:
        mask, value, fp, rep = (rows[c].to_numpy() for c in ("mask", "value", "fp", "rep"))
        fp = fp.view(np.uint64)
        order = np.lexsort((gray_rank(fp & ~mask.view(np.uint64)), value, mask))
        mask, value, fp, rep = mask[order], value[order], fp[order], rep[order]
        bucket = np.cumsum(np.r_[False, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        root = near_links(fp, bucket, k)
        linked = root != np.arange(len(root))
        return pd.DataFrame({"u": rep[linked], "v": rep[root[linked]]})

    return rows.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInPandas(whole_groups(["mask", "value"], edges_of), "u bigint, v bigint")


def components_of(fps: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """fp, component_id of fps(doc_id, fp): the smallest doc_id that links reach from a fingerprint; rows with a null id name nothing."""
    reps, _ = materialise(fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    joined = connected_components(link_edges(reps, max_bits, bucket_rows))
    return reps.join(joined, reps["rep"] == joined["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable by links, itself included), one row per input row.

    Documents of equal fingerprint are one node, so copies are never paired. Rows with a null id get
    a fingerprint; their component is that of documents with the same fingerprint, else null. Rows
    that repeat an id are fingerprinted each. Other columns are ignored; an empty table gives no rows.
    """
    marked, _ = materialise(fingerprints(docs, id_col, text_col, shingle, seed), "fp")
    return marked.join(components_of(marked, max_bits, bucket_rows), "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of docs whose id is the smallest of their component, with all their columns.

    Each row goes by its own fingerprint, rows that share an id too. A row with a null id goes if a
    row with an id is in its component.
    """

    @F.pandas_udf("bigint")
    def mark(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(shingle_hashes(t, shingle, seed)) for t in text], np.uint64).view(np.int64))

    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"), mark(text_or_empty(text_col)).alias("fp"))
    components = components_of(fingerprints(docs, id_col, text_col, shingle, seed), max_bits, bucket_rows)
    kept = rows.join(components, "fp", "left").filter(F.col("d").getField(id_col).eqNullSafe(F.col("component_id")))
    return columns_of(kept, docs.columns)


def hex_of(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


