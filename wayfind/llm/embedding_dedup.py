"""Embedding near-dedup: all pairs of one label by PCA-ordered tiles, given up as soon as no cosine can reach the threshold.

Vectors are turned into the basis of their second moments, so that leading dimensions carry most of
every product. Tiles are runs along the first one. Tile pairs whose boxes lie too far apart are never
formed; in the others products are accumulated a few dimensions at a time, and a pair is dropped once
its sum so far plus the product of both suffix norms stays under the threshold. That happens twice:
first only the leading coordinates and the norm of the rest travel to the tile pairs, and whole
vectors follow only into tile pairs where they have a partner left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.llm.common import connected_components
from wayfind.llm.forest import join_rows, settle
from wayfind.sources.scratch import materialise

#: Vectors of a tile; a task holds two tiles and their products.
TILE = 1024
#: Slices of the first coordinate from which tiles are made.
SLICES = 4096
#: Leading coordinates of the boxes around tiles.
BOX = 8
#: Leading coordinates that travel to every tile pair, with the norm of the rest.
LEADING = 16
#: Dimensions after which products are bounded.
STEPS = (8, 16, 32, 64, 128, 256, 512)
#: Lengths of vectors that get a basis of their own, the most frequent ones; others are compared as they are, with the same result.
LENGTHS = 64
#: Covers rounding of the turned vectors; what passes is compared anew as given.
SLACK = 1e-9
#: Covers rounding of leads to single precision, as which they travel.
LEAD_SLACK = 1e-6


def _scaled(vectors: pd.Series) -> np.ndarray:
    """Each vector over a power of two near its largest component: its cosines stay as they are, to the bit, and no square overflows."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(vectors: pd.Series) -> np.ndarray:
    x = _scaled(vectors)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _identity(vector: str) -> list[Column]:
    """128 bits that stand for a vector in joins, so that vectors themselves stay where they are."""
    return [F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2")]


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """label, embedding, dim, rep, n of rows(vec_id, embedding, label): one row per label and vector that can link."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("embedding"))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each of the LENGTHS most frequent numbers of dimensions an orthogonal basis, strongest direction first, from sums over all its vectors; dim * dim numbers of each reach the driver."""
    often = classes.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS)
    classes = classes.join(often.select("dim"), "dim", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, own in batch.groupby("dim")["embedding"]:
                x = _unit(own)
                total[dim] = total.get(dim, 0) + x.T @ x
        for dim, m in total.items():
            yield pd.DataFrame({"dim": dim, "i": np.arange(dim * dim), "v": m.ravel()})

    sums = classes.select("dim", "embedding").mapInPandas(run, "dim int, i int, v double").groupBy("dim", "i").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for dim, own in sums.groupby("dim"):
        m = np.zeros(dim * dim)
        m[own["i"]] = own["v"]
        m = m.reshape(dim, dim)
        out[int(dim)] = np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()
    return out


def _turned(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors in the basis of their length."""
    own = axes.get(x.shape[1])
    return x if own is None else x @ own


def _tiled(classes: DataFrame, axes: dict[int, np.ndarray], tile: int) -> DataFrame:
    """classes with lead (LEADING coordinates, then the norm of the rest) and tile, numbered along the first coordinate within a label and dim.

    The product of two leads is the most that the product of their vectors can be.
    """
    shared = classes.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, own in batch.groupby("dim"):
                turned = _turned(_unit(own["embedding"]), shared.value)
                lead = np.zeros((len(own), LEADING + 1))
                lead[:, : min(LEADING, dim)] = turned[:, :LEADING]
                lead[:, LEADING] = np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))
                yield own.assign(lead=list(lead))

    kind = classes.schema["embedding"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    rows = classes.mapInPandas(run, f"label {label}, embedding {kind}, rep bigint, n bigint, dim int, lead array<double>")
    rows, _ = materialise(rows.withColumn("slice", F.floor((F.col("lead")[0] + 1) * (SLICES / 2))), "lead")
    counts = rows.groupBy("label", "dim", "slice").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("label", "dim").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("label", "dim", "slice", F.floor(before / tile).alias("at"), F.ceil(F.col("m") / tile).alias("parts"))
    placed = rows.join(counts, ["label", "dim", "slice"])
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("rep"), "parts")).otherwise(0)  # a slice of many vectors is dealt into several tiles
    placed = placed.withColumn("tile", F.concat_ws(".", "at", F.when(F.col("parts") > 1, F.col("slice")), part))
    return placed.select("label", "dim", "tile", "rep", "n", "embedding", "lead")


def _tile_pairs(tiled: DataFrame, threshold: float) -> DataFrame:
    """label, dim, a, b of tiles that may hold a pair of the threshold: their boxes are near enough.

    A band join along the first coordinate: a tile meets those that begin within reach of its own stretch.
    """
    boxes = tiled.groupBy("label", "dim", "tile").agg(*(f(F.col("lead")[k]).alias(f"{name}{k}") for name, f in (("lo", F.min), ("hi", F.max)) for k in range(BOX)))
    boxes, _ = materialise(boxes, "boxes")
    reach = (2 - 2 * threshold + SLACK) ** 0.5  # unit vectors of the threshold lie no farther apart
    bin_of = lambda x: F.floor(x / reach)
    left = boxes.select("label", "dim", F.col("tile").alias("a"), *(F.col(f"{x}{k}").alias(f"{x}a{k}") for x in ("lo", "hi") for k in range(BOX)))
    left = left.withColumn("bin", F.explode(F.sequence(bin_of(F.col("loa0")), bin_of(F.col("hia0") + reach))))
    right = boxes.select("label", "dim", F.col("tile").alias("b"), *(F.col(f"{x}{k}").alias(f"{x}b{k}") for x in ("lo", "hi") for k in range(BOX))).withColumn("bin", bin_of(F.col("lob0")))
    gap = lambda k: F.greatest(F.col(f"loa{k}") - F.col(f"hib{k}"), F.col(f"lob{k}") - F.col(f"hia{k}"), F.lit(0.0))
    apart = sum((gap(k) * gap(k) for k in range(BOX)), F.lit(0.0))
    ordered = (F.col("loa0") < F.col("lob0")) | ((F.col("loa0") == F.col("lob0")) & (F.col("a") <= F.col("b")))
    return left.join(right, ["label", "dim", "bin"]).filter(ordered & (apart <= 2 - 2 * threshold + SLACK)).select("label", "dim", "a", "b")


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of turned unit vectors whose product may reach the threshold."""
    dim = x.shape[1]
    steps = [s for s in STEPS if s < dim] + [dim]
    products = x[:, : steps[0]] @ y[:, : steps[0]].T
    rows = cols = None
    for k, end in enumerate(steps):
        if k:
            start = steps[k - 1]
            if rows is None:
                products += x[:, start:end] @ y[:, start:end].T
            else:
                products = products + np.concatenate([np.einsum("ij,ij->i", x[rows[i : i + 100_000], start:end], y[cols[i : i + 100_000], start:end]) for i in range(0, max(1, len(rows)), 100_000)])
        rest_x, rest_y = np.sqrt((x[:, end:] ** 2).sum(axis=1)), np.sqrt((y[:, end:] ** 2).sum(axis=1))
        if rows is None:
            may = products + rest_x[:, None] * rest_y[None, :] >= threshold - SLACK
            if end == dim or may.mean() < 0.05:  # few left: go on pair by pair
                rows, cols = np.nonzero(may)
                products = products[rows, cols]
        else:
            may = products + rest_x[rows] * rest_y[cols] >= threshold - SLACK
            rows, cols, products = rows[may], cols[may], products[may]
    return rows, cols


def _in_pairs(tiled: DataFrame, pairs: DataFrame, *columns: str) -> DataFrame:
    """The rows of both tiles of each pair; side tells which."""
    sides = [tiled.join(pairs.withColumn("tile", F.col(end)), ["label", "dim", "tile"]).select("label", "dim", "a", "b", *columns, F.lit(k).alias("side")) for k, end in enumerate("ab")]
    return sides[0].unionByName(sides[1].filter("a <> b"))


def _with_partner(tiled: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """label, dim, a, b, side, h1, h2 of vectors that, by their leads, may reach the threshold with one of the other tile."""

    def screen(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("side", ignore_index=True)
        lead = np.stack(own["lead"].to_numpy()).astype(np.float64)
        split = int((own["side"] == 0).sum())
        same = split == len(own)
        a, b = near_pairs(lead[:split], lead if same else lead[split:], threshold - LEAD_SLACK)
        a, b = (a[a != b], b[a != b]) if same else (a, b + split)
        return own.loc[np.union1d(a, b), ["label", "dim", "a", "b", "side", "h1", "h2"]]

    label = tiled.schema["label"].dataType.simpleString()
    leads = _in_pairs(tiled.withColumn("lead", F.col("lead").cast("array<float>")), pairs, "lead", *_identity("embedding"))
    return leads.groupBy("label", "dim", "a", "b").applyInPandas(screen, f"label {label}, dim int, a string, b string, side int, h1 bigint, h2 bigint")


def near_links(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept of vectors(vec_id, embedding, label), one row per input row.

    Links join vectors of equal, non-null label and equal length with cosine of at least threshold in
    double precision. A null, empty or zero vector, or one with null or non-finite components, links
    with nothing. n_links counts other rows; component_id is the smallest vec_id reachable; kept marks
    it. Rows of equal vectors are one node, so copies are never paired. Rows with a null id have no
    links and a null component; rows that share an id are one node of the components. Other columns
    are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    classes, _ = materialise(distinct_vectors(rows).select("label", "embedding", "rep", "n", "dim"), "vectors")
    axes = principal_axes(classes)
    tiled, _ = materialise(_tiled(classes, axes, tile), "tiles")
    pairs, _ = materialise(_tile_pairs(tiled, threshold), "tile-pairs")
    shared = classes.sparkSession.sparkContext.broadcast(axes)

    def compare(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["side", "rep"], ignore_index=True)
        raw = _scaled(own["embedding"])
        turned = _turned(_unit(own["embedding"]), shared.value)
        n, split = own["n"].to_numpy(), int((own["side"] == 0).sum())
        same = split == len(own)
        a, b = near_pairs(turned[:split], turned if same else turned[split:], threshold)
        b = b if same else b + split
        if same:
            a, b = a[a < b], b[a < b]
        norms = np.sqrt((raw * raw).sum(axis=1))
        hit = np.concatenate([np.einsum("ij,ij->i", raw[a[i : i + 50_000]], raw[b[i : i + 50_000]]) / (norms[a[i : i + 50_000]] * norms[b[i : i + 50_000]]) for i in range(0, max(1, len(a)), 50_000)]) >= threshold
        a, b = a[hit], b[hit]
        links = np.bincount(a, n[b], len(own)) + np.bincount(b, n[a], len(own))
        parent = np.arange(len(own))
        join_rows(parent, a, b)
        settle(parent)
        some = links > 0
        rep = own["rep"].to_numpy()
        return pd.DataFrame({"rep": rep[some], "links": links[some].astype(np.int64), "root": rep[parent[some]]})

    met, _ = materialise(_with_partner(tiled, pairs, threshold), "met")
    both = met.join(tiled.select("label", "dim", *_identity("embedding"), "rep", "n", "embedding"), ["label", "dim", "h1", "h2"])
    found, _ = materialise(both.groupBy("label", "dim", "a", "b").applyInPandas(compare, "rep bigint, links bigint, root bigint"), "links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    nodes = classes.select("label", "rep", "n", *_identity("embedding")).join(linked, "rep", "left").join(joined, F.col("rep") == joined["node"], "left").select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    rows = rows.select("vec_id", "label", *_identity("embedding"))
    named = rows.filter("vec_id is not null").join(nodes, ["label", "h1", "h2"], "left").unionByName(rows.filter("vec_id is null").select("*", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id")))
    out = named.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
