"""Substring dedup by hashing units of text: the earliest ranked occurrence of a unit stays, the rest go, offsets kept.

A unit is a line, a paragraph or, by default, a sentence of a line: passages are often pasted into the
middle of a line, where no hash of a line or paragraph sees them. What goes can be set by the length of
a unit, or by that of the run of neighbouring repeated units in which it stands, so that a stock phrase
alone in its surroundings stays and a passage goes whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfind.llm.common import text_or_empty
from wayfind.sources.scratch import materialise

#: White space is the six ASCII characters. A sentence ends with its line, or with a mark that white space follows.
UNITS = {
    "sentence": re.compile(r"[.!?](?=[\x20\x09-\x0D])|[^\x20\x09-\x0D][^\n]*?(?:[.!?](?=[\x20\x09-\x0D])|(?=\n)|\Z)"),
    "line": re.compile(r"[^\x20\x09-\x0D][^\n]*"),
    "paragraph": re.compile(r"[^\x20\x09-\x0D](?:[^\n]|\n(?![\x20\x09-\x0D]*\n))*"),
}
BLANKS = " \t\n\x0b\x0c\r"

def units(docs: DataFrame, unit: str = "sentence", min_words: int = 5, lines: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, ordinal, start, end, words, chars, d1, d2: each unit of at least min_words words, offsets in code points of the original text.

    row tells input rows apart that share an id, ordinal numbers the units of a row that aren't blank.
    With sentences and `lines`, each line that has a sentence of fewer words is a unit as well.
    Normalised for the 128-bit digest (d1, d2): A-Z folded to lower case, runs of white space one
    space, ends stripped; chars counts the code points of that.
    """
    pattern = UNITS[unit]

    def told(start: int, own: str) -> tuple:
        words = own.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
        plain = b" ".join(words)
        return start, start + len(own), len(words), len(plain) if own.isascii() else len(plain.decode("utf-8", "surrogatepass")), plain

    def found(text: str) -> Iterator[tuple]:
        short = set()  # ends of lines that have a unit of too few words
        for n, m in enumerate(pattern.finditer(text)):
            one = told(m.start(), m.group().rstrip(BLANKS))
            if one[2] >= min_words:
                yield n, *one
            elif lines and unit == "sentence":
                end = text.find("\n", m.start())
                if end not in short:
                    short.add(end)
                    line = text[text.rfind("\n", 0, m.start()) + 1 : end if end >= 0 else len(text)]
                    start = m.start() - len(text[text.rfind("\n", 0, m.start()) + 1 : m.start()]) + len(line) - len(line.lstrip(BLANKS))
                    yield n, *told(start, line.strip(BLANKS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                rows = [(k, *x) for k, text in enumerate(part["text"]) for x in found(text)]
                owners, ordinals, starts, ends, words, chars, plain = zip(*rows, strict=True) if rows else ((),) * 7
                both = np.frombuffer(b"".join(map(digest, plain)), np.int64).reshape(-1, 2)
                names = part["doc_id"].astype("Int64").iloc[list(owners)].array
                longs = {c: np.array(v, np.int64) for c, v in (("start", starts), ("end", ends), ("words", words), ("chars", chars))}
                yield pd.DataFrame({"row": part["row"].to_numpy()[list(owners)], "doc_id": names, "ordinal": np.array(ordinals, np.int32), **longs, "d1": both[:, 0], "d2": both[:, 1]})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, "row bigint, doc_id bigint, ordinal int, start bigint, end bigint, words bigint, chars bigint, d1 bigint, d2 bigint")


def repeated_spans(docs: DataFrame, unit: str = "sentence", min_words: int = 5, min_run: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, end, words, chars, keep_doc_id, keep_start, copies: every unit to remove, and where its kept occurrence stands.

    Occurrences rank by (doc_id, start), null ids last; the first stays. With min_run, units of any
    length count, and a repeated one goes only where it stands in a run of neighbouring repeated units
    (first occurrences count as well) of that many code points; min_words is then 1. Null text counts
    as empty. Rows repeating an id count as further occurrences, of which one stays. Other columns are
    ignored; an empty table gives no rows. Digests are counted with map-side combining, the join back
    to the repeated ones is a plain equi-join that AQE splits where a unit is hot, and runs are found
    among the repeated units of one document.
    """
    found, _ = materialise(units(docs, unit, 1 if min_run else min_words, not min_run, id_col, text_col), "units")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "start", "row"))
    kept = found.groupBy("d1", "d2").agg(first.alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("d1", "d2", F.col("first.doc_id").alias("keep_doc_id"), F.col("first.start").alias("keep_start"), F.col("first.row").alias("keep_row"), "copies")
    kept, _ = materialise(kept, "repeated")  # AQE doesn't split a join that shares its stage with an aggregation
    again = found.join(kept, ["d1", "d2"])
    if min_run:
        again, _ = materialise(again, "again")  # nor one that shares it with a window
        again = again.withColumn("run", F.col("ordinal") - F.row_number().over(Window.partitionBy("row").orderBy("ordinal")))
        again = again.withColumn("held", F.sum("chars").over(Window.partitionBy("row", "run"))).filter(F.col("held") >= min_run)
    other = ~((F.col("row") == F.col("keep_row")) & (F.col("start") == F.col("keep_start")))
    return again.filter(other).select("doc_id", "start", "end", "words", "chars", "keep_doc_id", "keep_start", "copies")


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the spans cut out of their texts, all columns as they were.

    Rows without spans and null texts stay as they are. Spans are told to rows by id: of rows that
    share an id each loses all spans of that id, so give such rows ids of their own first.
    """
    by_doc = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cut"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for t, spans_of in zip(text, own, strict=True):
            if t is not None and spans_of is not None and len(spans_of):
                keep, at = [], 0
                for s in spans_of:
                    keep.append(t[at : max(at, s["start"])])
                    at = max(at, s["end"])
                t = "".join(keep) + t[at:]
            out.append(t)
        return pd.Series(out, dtype=object)

    whole = docs.select(F.struct(*docs.columns).alias("d"))  # no column of docs can clash
    joined = whole.join(by_doc, whole[f"d.{id_col}"] == by_doc["doc_id"], "left")
    text = F.col(f"d.{text_col}")
    return joined.select(*(F.when(F.col("cut").isNull(), text).otherwise(cut(text, F.col("cut"))).alias(c) if c == text_col else F.col(f"d.{c}").alias(c) for c in docs.columns))
