"""Token ids of documents as a binary dataset: frequency-ranked ids in variable-length blocks, and its reader.

A dataset is a folder with two Parquet tables, so that Spark's committer handles lost tasks and any
Hadoop file system will do: `ranks` (rank, id), and `blocks` (part, block, start, n_docs, n_tokens,
doc_ids, control, data). A block's payload holds, in the coding of streamvbyte, the token counts of
its documents followed by the ranks of all their ids; parts and blocks ascend with doc_id.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfind.llm import streamvbyte
from wayfind.llm.common import text_or_empty
from wayfind.sources.scratch import materialise

BLOCK_TOKENS = 1 << 20
#: Bounds the memory of a worker's table of words and pieces that it has seen, nothing else.
CACHE_WORDS = 1_300_000
#: Documents that are cut into words at a time.
SLICE = 500


class WordEncoder(dict):
    """encode() of the tokenizers library, each distinct word encoded once: the words seen, with their ids.

    Holds for tokenizers that drop white space and never join what it separates. Words of printable
    ASCII and Latin-1 letters, which no normalisation but lower-casing changes, are cut into pieces
    where the tokenizer's own pattern cuts; ASCII pieces, which byte-level spelling leaves as they
    are, go to the tokenizer's model itself. All else goes through the library.
    """

    #: Fixed value: the pattern in the tokenizer's file, for those characters.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would each hold memory of their own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab_size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        marks = {t["content"][0] for t in spec["added_tokens"]}
        self.simple = re.compile("[" + "".join(re.escape(chr(c)) for c in (*range(9, 14), *range(32, 127)) if chr(c) not in marks) + "À-ÖØ-öø-ÿ]*").fullmatch if self.by_pieces(spec) else lambda w: None

    def by_pieces(self, spec: dict) -> bool:
        """Whether the tokenizer cuts as PIECES does and spells ASCII as it is."""
        split = [x["pattern"]["Regex"] for x in spec["pre_tokenizer"].get("pretokenizers", []) if x["type"] == "Split"]
        return split == [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for t in texts:
            if len(self) > CACHE_WORDS:
                self.clear()
            out.append(b"".join(map(self.__getitem__, t.lower().split() if self.simple(t) else self._words(t))))
        return out

    def _words(self, text: str) -> list[str]:
        words = map(bytes.decode, text.encode().split())  # on ASCII white space only
        return [w.lower() if self.simple(w) else w for w in words]

    def __missing__(self, word: str) -> bytes:
        pieces = self.PIECES.findall(word) if self.simple(word) else [word]
        if len(pieces) > 1:
            ids = b"".join(map(self.__getitem__, pieces))
        elif word.isascii() and self.simple(word):
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(word)])
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_documents(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", kind: str = "<u4") -> DataFrame:
    """doc_id, ids: the ids of each whole text and end_id, as little-endian unsigned integers of a numpy kind in a binary. Null text counts as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = load(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                ids = [x + end for x in encoder.encode_batch(part["text"].tolist())]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "ids": ids if kind == "<u4" else [np.frombuffer(x, "<u4").astype(kind).tobytes() for x in ids]})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(run, "doc_id bigint, ids binary")


def count_ids(encoded: DataFrame, kind: str = "<u4") -> DataFrame:
    """(id, n) over all documents; each task sends one row per id at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(np.frombuffer(b"".join(batch["ids"]), kind), minlength=len(total))
            n[: len(total)] += total
            total = n
        there = np.flatnonzero(total)
        yield pd.DataFrame({"id": there, "n": total[there]})

    return encoded.select("ids").mapInPandas(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_dataset(docs: DataFrame, target: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode docs and write the dataset to the folder target.

    Documents are in ascending doc_id order, null first, rows that repeat an id by the first bytes of
    their ids and then by a hash of all, so that one id of many rows spreads over several tasks. The rank table reaches the driver and all tasks: it has one row per id of the vocabulary
    at most. An empty table gives an empty dataset; columns besides id and text are ignored.
    """
    spark = docs.sparkSession
    kind = "<u2" if max(end_id + 1, load(path).vocab_size) <= 1 << 16 else "<u4"
    encoded, _ = materialise(encode_documents(docs, path, end_id, id_col, text_col, kind), "ids", "zstd")
    counts = count_ids(encoded, kind).toPandas().sort_values(["n", "id"], ascending=[False, True])
    by_rank = counts["id"].to_numpy(np.uint32)
    spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(by_rank)), "id": by_rank.astype(np.int64)}), "rank bigint, id bigint").coalesce(1).write.parquet(f"{target}/ranks")
    ranks = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank))
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, start, held, names, held_tokens = 0, 0, [], [], 0

        def flush() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held), kind)
            counts = np.fromiter((len(x) // width for x in held), np.uint32, len(held))
            control, data = streamvbyte.encode(np.concatenate([counts, ranks[ids]]))
            return pd.DataFrame({"part": [TaskContext.get().partitionId()], "block": [block], "start": [start], "n_docs": [len(held)], "n_tokens": [len(ids)], "doc_ids": [names], "control": [control], "data": [data]})

        for batch in batches:
            for name, ids in zip(batch["doc_id"].astype("Int64"), batch["ids"], strict=True):
                held.append(ids)
                names.append(None if name is pd.NA else int(name))
                held_tokens += len(ids) // width
                if held_tokens >= BLOCK_TOKENS:
                    yield flush()
                    block, start, held, names, held_tokens = block + 1, start + held_tokens, [], [], 0
        if held:
            yield flush()

    keyed = encoded.select("doc_id", F.substring("ids", 1, 64).alias("head"), F.xxhash64("ids").alias("h"), F.spark_partition_id().alias("salt"), "ids")  # rows alike to the last byte may stand in any order
    order = ["doc_id", "head", "h", "salt"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInPandas(run, "part bigint, block bigint, start bigint, n_docs bigint, n_tokens bigint, doc_ids array<bigint>, control binary, data binary").write.option("compression", "zstd").parquet(f"{target}/blocks")


def _read(spark: SparkSession, target: str, columns: Callable[[list[bytes]], dict], schema: str) -> DataFrame:
    """doc_id, start and columns of the ids of each document, by way of the blocks' files alone."""
    blocks = spark.read.parquet(f"{target}/blocks")
    by_rank = spark.read.parquet(f"{target}/ranks").orderBy("rank").toPandas()["id"].to_numpy("<u4")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                values = streamvbyte.decode(b.control, b.data, b.n_docs + b.n_tokens)
                counts = values[: b.n_docs].astype(np.int64)
                raw, ends = by_rank[values[b.n_docs :]].tobytes(), np.cumsum(counts)
                ids = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": pd.array(list(b.doc_ids), "Int64"), "start": b.start + ends - counts, **columns(ids)})

    joined = blocks.join(F.broadcast(parts), "part")  # one row per partition of the writer
    placed = joined.select((F.col("start") + F.col("before")).alias("start"), "n_docs", "n_tokens", "doc_ids", "control", "data")
    return placed.mapInPandas(run, f"doc_id bigint, start bigint, {schema}")


def read_dataset(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary, little-endian unsigned 32-bit integers), read from the files alone; a dataset of an empty table gives no rows."""
    return _read(spark, target, lambda ids: {"ids": ids}, "ids binary")


def read_digests(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what read_dataset reads."""
    return _read(spark, target, lambda ids: {"n_tokens": [len(x) // 4 for x in ids], "ids_crc32": [zlib.crc32(x) for x in ids]}, "n_tokens bigint, ids_crc32 bigint")
