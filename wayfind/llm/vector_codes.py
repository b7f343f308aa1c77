"""Compression of vectors to codes: the parts of a vector are each replaced by the nearest entry of a codebook.

Codebooks are few entries, fitted by rounds over all vectors: every task finds the nearest entries of its
rows through a tree over the entries (`gnat`), sums what fell to each, and one small aggregation gives
the next codebook. All arithmetic is of integers, so the result doesn't depend on the order of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfind.llm.gnat import Gnat
from wayfind.llm.top_k import usable
from wayfind.sources.scratch import materialise

#: Components are cut at this size, so that squared distances fit into integers.
MOST = float(1 << 25)


def integers(embedding: pd.Series, parts: int, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of all components, by row, part and position; what a vector hasn't got is 0."""
    out = np.zeros((len(embedding), parts * width))
    for row, x in zip(out, embedding, strict=True):
        row[: len(x)] = x
    return np.clip(np.floor(out * scale), -MOST, MOST).astype(np.int64).reshape(len(embedding), parts, width)


def codebooks_text(books: np.ndarray) -> str:
    """All components of books(part, entry, position) as decimal text with commas."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def _sums(rows: DataFrame, books: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """By part and entry: how many parts are nearest to it, and their sum by position. As many numbers as the codebooks have reach the driver."""
    parts, size, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast([Gnat(b) for b in books])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for batch in batches:
            x = integers(batch["embedding"], parts, width, scale)
            for p, tree in enumerate(shared.value):
                at, _ = tree.nearest(x[:, p])
                count[p] += np.bincount(at, minlength=size)
                np.add.at(total[p], at, x[:, p])
        used = np.flatnonzero(count.reshape(-1))
        if len(used):
            yield pd.DataFrame({"entry": used, "n": count.reshape(-1)[used], "total": list(total.reshape(-1, width)[used])})

    found = rows.select("embedding").mapInPandas(run, "entry bigint, n bigint, total array<bigint>")
    told = found.select("entry", "n", F.posexplode("total").alias("at", "v")).groupBy("entry", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas()
    count, total = np.zeros((parts * size, width), np.int64), np.zeros((parts * size, width), np.int64)
    count[told["entry"], told["at"]], total[told["entry"], told["at"]] = told["n"], told["v"]
    return count.reshape(books.shape), total.reshape(books.shape)


def fit(rows: DataFrame, parts: int = 4, size: int = 256, scale: int = 1024, rounds: int = 4) -> np.ndarray:
    """Codebooks (part, entry, position) from rows(vec_id, embedding) of usable vectors, begun by those of the `size` smallest ids, or of all if there are fewer; an entry that nothing is nearest to stays."""
    longest = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    first = rows.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(size).toPandas()
    books = integers(first["embedding"], parts, max(1, -(-longest // parts)), scale).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        count, total = _sums(rows, books, scale)
        books = np.where(count > 0, total // np.maximum(count, 1), books)
    return books


def encode(rows: DataFrame, books: np.ndarray, scale: int = 1024) -> DataFrame:
    """rows with code and error for their embedding: two hex digits for each part, and the sum of its squared distances."""
    parts, _, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast([Gnat(b) for b in books])

    @F.pandas_udf("code string, error bigint")
    def run(embedding: pd.Series) -> pd.DataFrame:
        x = integers(embedding, parts, width, scale)
        found = [tree.nearest(x[:, p]) for p, tree in enumerate(shared.value)]
        codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
        return pd.DataFrame({"code": [c.tobytes().hex() for c in codes], "error": sum(d for _, d in found)})

    return rows.withColumn("__coded", run("embedding")).select("*", "__coded.code", "__coded.error").drop("__coded")


def decode(codes: DataFrame, books: np.ndarray, scale: int = 1024) -> DataFrame:
    """codes(code, ...) with embedding: the entries that the code names, over scale; filled up to a multiple of the parts."""
    parts, _, width = books.shape
    shared = codes.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("array<double>")
    def run(code: pd.Series) -> pd.Series:
        at = np.array([list(bytes.fromhex(c)) for c in code], np.int64).reshape(-1, parts)
        return pd.Series(list(shared.value[np.arange(parts)[None, :], at].reshape(len(at), parts * width) / scale))

    return codes.withColumn("embedding", run("code"))


def compressed(vectors: DataFrame, parts: int = 4, size: int = 256, scale: int = 1024, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows of vectors(vec_id, embedding, label) with a usable vector.

    Rows whose vector is null or holds null or non-finite components are left out. Components are
    floor(scale * x), x in double precision, cut at 2^25 either way. Vectors are cut into `parts` equal
    parts; where lengths differ or don't divide, all count as filled up with zeros to the longest. Of
    equal distances the lower entry is taken. label_error is the sum of error over rows of the same
    label, null labels together. Rows that repeat an id are coded each, null ids come last among those
    that begin the codebooks, ties by vector. Other columns are ignored, an empty table gives no rows.
    `size` is at most 256, the entries that two hex digits tell apart.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").filter(usable(F.col("embedding")))
    rows, _ = materialise(rows, "vectors")
    books = fit(rows, parts, size, scale, rounds)
    coded, _ = materialise(encode(rows, books, scale).drop("embedding"), "codes")
    sums, _ = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")  # a table of known size: no label is shuffled unless there are many
    out = coded.join(sums, coded["label"].eqNullSafe(sums["of"]))
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(codebooks_text(books).encode()).hexdigest()).alias("codebooks_sha256"))
