"""Exact top-k search by inner product: every query against every row, term at a time, in blocks.

Rows are packed into postings: for each dimension the places of a block's rows that have a weight there,
and the weights. Queries are packed the same way and read back as sparse rows. A block of queries meets
a block of rows in one task: each query scatters the postings of its terms, times its weights, into a
dense array of scores, of which a partition keeps the k best; those of all blocks are merged.

Every block of queries is sent to every block of rows, so what is shuffled is the number of blocks
times the queries, and rows once for a lane of blocks of queries: some thousandths of a byte per product.
They meet by a cogroup, a shuffle at every size: for a join Spark takes the repeated queries for as
small as their file and sends them all through the driver, and a block of rows goes to Python once
for each block of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.llm.common import with_key
from wayfind.sources.scratch import materialise

#: Rows of a block of candidates, and of one of queries.
ROWS, QUERIES = 8192, 512
#: Components of a block, where vectors are long.
COMPONENTS = 1 << 20
#: Blocks of queries that one task compares with a block of candidates, and their components, where vectors are long: a worker holds them all.
LANE, LANE_COMPONENTS = 64, 4 * COMPONENTS
#: Terms that one in so many of a block's rows has are added to all of them.
COMMON = 8
#: Components are cut at this size, so that they can be written as integers.
MOST = float(1 << 52)
PACKED = ["ids", "terms", "starts", "places", "weights"]


def usable(embedding: Column) -> Column:
    """A vector that is there and has finite components only."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def sparse(embedding: pd.Series, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, the dimension and the weight floor(scale * x) of every component whose weight isn't 0."""
    lengths = np.array([len(x) for x in embedding], np.int64)
    flat = np.concatenate([np.zeros(0), *(np.asarray(x, np.float64) for x in embedding)])
    w = np.clip(np.floor(flat * scale), -MOST, MOST).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    dim = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = w != 0
    return row[some], dim[some], w[some]


def packed(ids: np.ndarray, embedding: pd.Series, scale: int) -> tuple[bytes, ...]:
    """PACKED: ids, and the postings of all terms one after the other: which terms, where each begins, places and weights."""
    row, dim, w = sparse(embedding, scale)
    order = np.argsort(dim, kind="stable")
    terms, starts = np.unique(dim[order], return_index=True)
    return ids.astype(np.int64).tobytes(), terms.tobytes(), np.append(starts, len(order)).tobytes(), row[order].astype(np.int32).tobytes(), w[order].tobytes()


def unpacked(ids: bytes, terms: bytes, starts: bytes, places: bytes, weights: bytes) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The ids, and of each term its places and weights."""
    at, p, w = np.frombuffer(starts, np.int64), np.frombuffer(places, np.int32), np.frombuffer(weights, np.int64)
    return np.frombuffer(ids, np.int64), {int(t): (p[a:b], w[a:b]) for t, a, b in zip(np.frombuffer(terms, np.int64), at[:-1], at[1:], strict=True)}


def sparse_rows(postings: dict[int, tuple[np.ndarray, np.ndarray]], n: int) -> list[list[tuple[int, int]]]:
    """Postings the other way round: of each row its terms and weights."""
    rows: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for term, (places, w) in postings.items():
        for at, x in zip(places.tolist(), w.tolist(), strict=True):
            rows[at].append((term, x))
    return rows


def filled(postings: dict[int, tuple[np.ndarray, np.ndarray]], n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Postings, of terms that one in COMMON of the n rows has with the other rows too, at weight 0: adding to all rows in a line is faster than to picked ones."""
    every, out = np.arange(n, dtype=np.int32), {}
    for term, (places, w) in postings.items():
        if n > len(places) >= n / COMMON:
            full = np.zeros(n, np.int64)
            full[places] = w
            places, w = every, full
        out[term] = places, w
    return out


def scatter(query: list[tuple[int, int]], postings: dict[int, tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of all n rows of a block for one query, term at a time."""
    scores, product = np.zeros(n, np.int64), np.empty(n, np.int64)
    for term, x in query:
        if term in postings:
            places, w = postings[term]
            if len(places) == n:
                scores += np.multiply(w, x, out=product)
            else:
                scores[places] += w * x
    return scores


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores by a partition, ties to the smaller id; the query itself, by its id, left out."""
    may = np.flatnonzero(ids != own)
    s = scores[may]
    if len(s) > k:
        least = np.partition(s, len(s) - k)[len(s) - k]
        may = may[s >= least]  # with all ties of the last one, which their ids decide
    return may[np.lexsort((ids[may], -scores[may]))[:k]]


def _blocks(rows: DataFrame, key: Column, n: int, size: int, longest: int, scale: int) -> tuple[DataFrame, int]:
    """rows(vec_id, embedding) dealt by a hash of key into blocks of about `size` rows, fewer if vectors are long, each packed into one row; and how many there are."""
    count = max(1, -(-n // max(1, min(size, COMPONENTS // max(1, longest)))))

    def run(own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(own["block"].iloc[0], *packed(own["vec_id"].to_numpy(), own["embedding"], scale))], columns=["block", *PACKED])

    dealt = rows.select(F.pmod(F.xxhash64(key), F.lit(count)).cast("int").alias("block"), "vec_id", "embedding")
    blocks, _ = materialise(dealt.groupBy("block").applyInPandas(run, "block int, " + ", ".join(f"{c} binary" for c in PACKED)), "postings")
    return blocks, count


def top_k(vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score of vectors(vec_id, embedding): of each query the k rows of highest inner product.

    Queries are the rows whose vec_id `every` divides; candidates are all rows but those of the
    query's own id. Components are floor(scale * x), x in double precision, cut at 2^52 either way;
    scores are integers modulo 2^64, so exact where they fit. Equal scores go to the smaller vec_id,
    all candidates are given where there are fewer than k, and components that a shorter vector hasn't
    got count as 0. Rows whose vector is null or holds null or non-finite components take no part, nor
    do rows with a null vec_id. Rows that repeat an id are candidates each; as a query, the id has the
    least of its vectors. Other columns are ignored, an empty table gives no rows.
    """
    field = lambda c: F.col("d").getField(c)
    rows = with_key(vectors).select("key", field("vec_id").cast("long").alias("vec_id"), field("embedding").alias("embedding")).filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    own = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("asked"), F.max(F.size("embedding")).alias("longest")).first()
    longest = told["longest"] or 0
    blocks, n_blocks = _blocks(rows, F.col("key"), told["n"], ROWS, longest, scale)
    queries, n_queries = _blocks(own, F.col("vec_id"), told["asked"], QUERIES, longest, scale)
    lane = max(1, min(LANE, LANE_COMPONENTS // max(1, longest, min(QUERIES * longest, COMPONENTS))))
    sent = queries.withColumn("lane", F.floor(F.col("block") / lane).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    met = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit((n_queries - 1) // lane))))

    def compare(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64),) * 3]
        for block in own[PACKED].itertuples(index=False):
            ids, postings = unpacked(*block)
            postings = filled(postings, len(ids))
            for some in asked[PACKED].itertuples(index=False):
                queried, terms = unpacked(*some)
                for query, sparse_row in zip(queried.tolist(), sparse_rows(terms, len(queried)), strict=True):
                    scores = scatter(sparse_row, postings, len(ids))
                    top = best(scores, ids, query, k)
                    found.append((np.full(len(top), query), ids[top], scores[top]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), zip(*found, strict=True), strict=True)})

    found = sent.groupBy("block", "lane").cogroup(met.groupBy("block", "lane")).applyInPandas(compare, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows for each block; Spark keeps k in each task
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
