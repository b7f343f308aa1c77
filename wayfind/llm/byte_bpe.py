"""Byte-level BPE over padded matrices: every row merges its leftmost minimum-rank pair each round.

A row alone in a matrix of over LONG columns makes all the merges at once that this rule would make
in a row (see _merge_long), with the same result for every table of ranks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfind.llm.common import text_or_empty

NONE = np.int32(2**31 - 1)
#: Pieces of a batch are bucketed by these widths; longer ones get a matrix of their own.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 64)
LONG = 256
#: Bounds the memory of a worker's table of pieces that it has seen in a task, nothing else.
CACHE_PIECES = 600_000


class PairTable:
    """(left id, right id) to the id of their concatenation: open addressing in two numpy arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, int(len(pairs) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        while len(keys):  # each round every free slot takes one of the keys that want it
            slots, keys, values = (x[np.argsort(slots, kind="stable")] for x in (slots, keys, values))
            placed = (self.keys[slots] == -1) & np.r_[True, slots[1:] != slots[:-1]]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            slots, keys, values = (slots[~placed] + 1) & ((1 << self.bits) - 1), keys[~placed], values[~placed]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, NONE where there is no such pair; a negative id (padding) is in no pair."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        out = np.full(len(keys), NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slot(keys[todo])
        while len(todo):
            there = self.keys[slots]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slots[hit]]
            on = ~hit & (there != -1)
            todo, slots = todo[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)


class ByteBpe:
    """A vocabulary of ranks, where a token's rank is its id. Encodes pieces, decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = PairTable({(ranks[t[:k]], ranks[t[k:]]): i for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks})
        self.seen: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, whole."""
        pieces = [self.pattern.findall(t) for t in texts]
        new = set().union(*pieces)
        if len(self.seen) + len(new) > CACHE_PIECES:
            self.seen = {}
        new = [p for p in new if p not in self.seen]
        self.seen.update(zip(new, self._encode_pieces([p.encode() for p in new]), strict=True))
        return [np.frombuffer(b"".join(map(self.seen.__getitem__, p)), "<u4") for p in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = int(whole).to_bytes(4, "little")
            else:
                by_width.setdefault(next((w for w in WIDTHS if w >= len(p)), -len(p)), []).append(k)
        for width, own in by_width.items():
            step = max(1, 2_000_000 // abs(width))
            for at in range(0, len(own), step):
                part = own[at : at + step]
                for k, ids in zip(part, self._merge([pieces[k] for k in part], abs(width)), strict=True):
                    out[k] = ids
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((len(pieces), width + 1), -1, np.int32)  # one more column, always padding
        ids[np.arange(width + 1) < lengths[:, None]] = flat
        rank = np.full((len(pieces), width + 1), NONE, np.int32)
        rank[:, :-1] = self.pairs.find(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * len(pieces)
        rows, columns = np.arange(len(pieces)), np.arange(width)
        while len(rows):
            low = rank.min(axis=1)
            done = low == NONE
            if done.any():
                for r, x in zip(rows[done].tolist(), ids[done], strict=True):
                    out[r] = x[x >= 0].astype("<u4").tobytes()
                rows, ids, rank, low = rows[~done], ids[~done], rank[~done], low[~done]
                if not len(rows):
                    break
            if len(rows) == 1 and ids.shape[1] > LONG:
                ids, rank = self._merge_long(ids[0], rank[0], low[0])
                continue
            at = rank.argmin(axis=1)
            n = np.arange(len(rows))
            shift = columns[None, : ids.shape[1] - 1] + (columns[None, : ids.shape[1] - 1] > at[:, None])  # drops the column after the pair
            ids[n, at] = low
            ids = np.take_along_axis(ids, shift, 1)
            rank = np.take_along_axis(rank, shift, 1)
            rank[n, at] = self.pairs.find(ids[n, at], ids[n, np.minimum(at + 1, ids.shape[1] - 1)])
            rank[n[at == ids.shape[1] - 1], -1] = NONE
            before = np.maximum(at - 1, 0)
            rank[n, before] = np.where(at > 0, self.pairs.find(ids[n, before], ids[n, at]), rank[n, before])
        return out

    def _merge_long(self, ids: np.ndarray, rank: np.ndarray, low: np.int32) -> tuple[np.ndarray, np.ndarray]:
        """Several rounds of a long row at once: the merges that the rule makes one after another at the minimum rank.

        The rule merges the leftmost pair of the minimum rank `low`, so its next merges are the pairs
        of that rank from left to right, of overlapping ones every second, until a merge makes a pair
        of rank `low` or less. A merge makes two pairs: one with the token to its left, which is as it
        stands after the merges before, and one with the token to its right, which no merge has reached
        yet. Both are looked up for each merge, and the merges stop with the first that makes such a pair.
        """
        at = np.flatnonzero(rank == low)
        first = np.r_[True, np.diff(at) != 1]
        at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))) % 2 == 0]
        merged = np.full(len(at), low, np.int32)
        left = np.where(at > 0, ids[np.maximum(at - 1, 0)], -1)
        left[1:][at[1:] - at[:-1] == 2] = low  # the token to the left is itself the merge before
        made = np.minimum(self.pairs.find(left, merged), self.pairs.find(merged, ids[np.minimum(at + 2, len(ids) - 1)]))
        stop = np.flatnonzero(made <= low)
        at = at[: stop[0] + 1] if len(stop) else at
        out = ids.copy()
        out[at] = low
        out = np.delete(out, at + 1)
        return out[None], np.append(self.pairs.find(out[:-1], out[1:]), NONE)[None]


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    """A worker builds its tables once per vocabulary file."""
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}, pattern)


def _encoded(batches: Iterator[pd.DataFrame], path: str, pattern: str) -> Iterator[tuple[ByteBpe, pd.DataFrame, list[np.ndarray]]]:
    """Slices of the batches with the ids of their texts. The pieces seen are forgotten at the end: a worker goes on to tasks of other operators, whose memory they would take."""
    bpe = load(path, pattern)
    try:
        for batch in batches:
            for part in _slices(batch):
                yield bpe, part, bpe.encode_batch(part["text"].tolist())
    finally:
        bpe.seen = {}


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (array<int>), decoded (binary, the ids' bytes).

    Null text counts as empty and gives no ids; repeated rows and null ids are encoded like any
    other; other columns are ignored. No shuffle: rows stay where they were read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bpe, part, ids in _encoded(batches, path, pattern):
            yield pd.DataFrame({"doc_id": part["doc_id"], "ids": ids, "decoded": list(map(bpe.decode, ids))})

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256: encode_documents without moving the ids out of the worker. One row per input row, repeated ones too; null text is empty, an empty table gives no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bpe, part, ids in _encoded(batches, path, pattern):
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]})

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _slices(batch: pd.DataFrame, rows: int = 250) -> Iterator[pd.DataFrame]:
    """Bounds what is in memory as lists of pieces."""
    for at in range(0, len(batch), rows):
        yield batch.iloc[at : at + rows]
