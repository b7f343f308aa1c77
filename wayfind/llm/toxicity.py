"""Toxicity by two class-conditional Kneser-Ney models that share their backoff counts.

The models are of characters after the characters before them within a word, so that spellings and
inflections of an expression share evidence. Absolute discounts are large: an expression too rare to
tell the classes apart leaves all its mass to the backoff, which is one Kneser-Ney model of both
classes' counts, and so weighs on neither side. How large is chosen in training, among DISCOUNTS, by
the loss on halves of the training rows that the models haven't seen. A text's score compares
its length-normalised log-likelihoods under the toxic and the ordinary model, over all its words and
over its most suspicious windows and words; a logistic curve fitted on held-apart halves of the
training rows turns both into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfind.llm.common import text_or_empty
from wayfind.sources.scratch import discard, materialise

WORD = re.compile(r"[^\W_]+")
#: Characters of context in the class models and in the shared one's lower order.
LONG, SHORT = 5, 2
#: Contexts and context-character pairs are hashed into so many buckets, which bounds the model; only those in use are stored.
BUCKETS = 1 << 24
#: Least share of a context's mass that goes to the backoff.
LEAST_LEFT = 0.02
DISCOUNT = 0.75
#: Discounts of a count n that training chooses from, as (a, b) of a + b * sqrt(n); none leaves anything of counts up to LEAST_COUNT.
DISCOUNTS = ((2.0, 0.0), (3.0, 0.0), (4.0, 0.0), (0.75, 1.5))
LEAST_COUNT = 2
#: Words of a window.
WINDOW = 12
FEATURES = 7
#: Bounds the memory of a worker's table of words that it has seen, nothing else.
CACHE_WORDS = 1_500_000
#: Sums over the training rows are of multiples of 1 / UNIT.
UNIT = float(1 << 24)
#: Models that training makes: of each half of the rows, and of all.
HALVES, ALL = (0, 1), 2


def discounted(counts: np.ndarray, discount: tuple[float, float] = DISCOUNTS[-1]) -> np.ndarray:
    """What an absolute discount leaves of each count."""
    return np.maximum(counts - discount[0] - discount[1] * np.sqrt(counts), 0)


def _bucket(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)


def grams(words: list[str]) -> dict[str, np.ndarray]:
    """For each character of each word, end mark included: buckets of its contexts and of context with character, and the word's index."""
    marked = [f"\x02{w}\x03" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    of, at = np.repeat(np.arange(len(words)), lengths), np.arange(len(points))
    own = at > starts  # all but the start marks
    code, out = np.zeros(len(points), np.uint64), {"word": of[own]}
    for n in range(1, LONG + 1):
        there = at - n >= starts
        code = np.where(there, (code ^ (points[np.maximum(at - n, 0)] + np.uint64(n << 32))) * np.uint64(0x100000001B3) + np.uint64(0x9E3779B97F4A7C15), code)
        if n in (SHORT, LONG):
            out["short" if n == SHORT else "long"] = _bucket(code)[own]
            out["short_next" if n == SHORT else "long_next"] = _bucket(code ^ (points + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))[own]
    out["next"] = _bucket(points)[own]
    return out


class Table:
    """Values of the buckets in use; `default` for the others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float = 0.0):
        self.keys, self.values, self.default = np.append(keys, BUCKETS), np.concatenate([values, np.full((1, *values.shape[1:]), default)]).astype(np.float64), default

    def rows(self, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, at, len(self.keys) - 1)

    def __getitem__(self, wanted: np.ndarray) -> np.ndarray:
        return self.values[self.rows(wanted)]


class Places:
    """Values of the buckets of grams in several tables; tables that hold the same array of keys are searched once."""

    def __init__(self, g: dict[str, np.ndarray]):
        self.g, self.found = g, {}

    def __call__(self, table: Table, kind: str) -> np.ndarray:
        key = id(table.keys), kind
        if key not in self.found:
            self.found[key] = table.rows(self.g[kind])
        return table.values[self.found[key]]


def features(ratios: np.ndarray) -> np.ndarray:
    """Of the ratios of a text's words: 1, their mean over the whole text, that of the worst window, of the worst 1, 2 and 4 words, and the log of their number."""
    n = len(ratios)
    if not n:
        return np.eye(FEATURES)[0]
    total = np.r_[0.0, np.cumsum(ratios)]
    w = min(WINDOW, n)
    worst = np.sort(np.partition(ratios, max(0, n - 4))[max(0, n - 4) :])[::-1]
    worst = np.r_[worst, np.zeros(4 - len(worst))]
    return np.array([1.0, total[-1] / n, (total[w:] - total[:-w]).max() / WINDOW, worst[0], worst[:2].mean(), worst.mean(), np.log1p(n)])


@dataclass
class ToxicityModel:
    """Tables by bucket, columns ordinary and toxic, and the weights of the logistic curve."""

    ready: bool = False
    mass: Table = None  # discounted counts of context and character
    context: Table = None  # counts of the context
    left: Table = None  # share of a context's mass that goes to the backoff
    shared: tuple = ()  # of the backoff: pair and context counts and kinds, by order
    discount: tuple = ()  # the one of DISCOUNTS that was chosen
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    most: int = CACHE_WORDS
    seen: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}}

    def backoff(self, of: Places) -> np.ndarray:
        pair, context, kinds, short_pair, short, short_kinds, single = self.shared
        p, n = of(single, "next"), of(short, "short")
        p = np.where(n > 0, (np.maximum(of(short_pair, "short_next") - DISCOUNT, 0) + DISCOUNT * of(short_kinds, "short") * p) / np.maximum(n, 1), p)
        n = of(context, "long")
        return np.where(n > 0, (np.maximum(of(pair, "long_next") - DISCOUNT, 0) + DISCOUNT * of(kinds, "long") * p) / np.maximum(n, 1), p)

    def compared(self, of: Places, backoff: np.ndarray, n: int) -> np.ndarray:
        """Toxic less ordinary log-probability of each of n words from their grams."""
        p = of(self.mass, "long_next") / np.maximum(of(self.context, "long"), 1) + of(self.left, "long") * backoff[:, None]
        logs = np.log(np.maximum(p, 1e-12))
        return np.bincount(of.g["word"], logs[:, 1] - logs[:, 0], n)

    def ratios(self, words: list[str]) -> np.ndarray:
        """Toxic less ordinary log-probability of each word of a text."""
        try:
            return np.fromiter(map(self.seen.__getitem__, words), np.float64, len(words))
        except KeyError:
            self.fresh(set(words))
            return np.fromiter(map(self.seen.__getitem__, words), np.float64, len(words))

    def fresh(self, words: set[str]) -> None:
        """Learn words, after forgetting all others if there are too many."""
        if len(self.seen) > self.most:
            self.seen = {}
        self.learn(words)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.seen]
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            of = Places(grams(part))
            self.seen.update(zip(part, self.compared(of, self.backoff(of), len(part)).tolist(), strict=True))

    def features(self, words: list[str]) -> np.ndarray:
        """1, the ratio per word of the whole text, of its worst window, of its worst 1, 2 and 4 words, and the log of its length."""
        return features(self.ratios(words))

    def scores(self, texts: list[str]) -> list[float]:
        if not self.ready:
            return [0.0] * len(texts)
        words = [WORD.findall(t.lower()) for t in texts]
        self.fresh(set().union(*words))
        x = np.array([self.features(w) for w in words]).reshape(-1, FEATURES) @ self.weights
        return (1 / (1 + np.exp(-np.clip(x, -30, 30)))).tolist()


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, half of every labelled row; half by the hash of doc_id. Whole texts count.

    A doc_id labelled twice is toxic if any label says so; null ids, labels other than 0 and 1 and
    labels without a document are left out.
    """
    marks = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    return docs.select("doc_id", text_or_empty().alias("text")).join(marks, "doc_id").select("text", "toxic", "half")


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on all rows of docs(doc_id, text) with labels(doc_id, toxic); without both classes the model scores 0.

    Each half of the rows is scored by models of the other half, for each of DISCOUNTS; the one
    whose logistic curve has the least loss, and that curve, are taken for the models of all of them.
    The driver gets sums per hash bucket, bounded by BUCKETS, and the sums of each round of the curves.
    """
    sample, path = materialise(labelled_rows(docs, labels), "toxic-rows")
    paths = [path]  # none is read once the model is there
    if sample.select("toxic").distinct().count() < 2:
        return ToxicityModel()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = ("long_next", "long", "short_next", "short", "next")
        for batch in batches:
            for (toxic, half), own in batch.groupby(["toxic", "half"])["text"]:
                for at in range(0, len(own), 500):
                    words = Counter(w for t in own.iloc[at : at + 500] for w in WORD.findall(t.lower()))
                    if words:
                        g = grams(list(words))
                        _, first, of = np.unique(g["long_next"], return_index=True, return_inverse=True)  # it determines the other keys
                        n = np.bincount(of, np.fromiter(words.values(), np.int64, len(words))[g["word"]]).astype(np.int64)
                        yield pd.DataFrame({k: g[k][first] for k in kinds}).assign(toxic=toxic, half=half, n=n)

    counts = sample.mapInPandas(count, "long_next bigint, long bigint, short_next bigint, short bigint, next bigint, toxic int, half int, n bigint")
    counts, path = materialise(counts.groupBy("long_next", "long", "short_next", "short", "next", "toxic", "half").agg(F.sum("n").cast("int").alias("n")), "toxic-counts")
    paths.append(path)
    cells = [(half, toxic) for half in HALVES for toxic in (0, 1)]
    cell = lambda half, toxic: F.coalesce(F.sum(F.when((F.col("half") == half) & (F.col("toxic") == toxic), F.col("n"))), F.lit(0)).cast("int").alias(f"n{half}{toxic}")
    pairs = counts.groupBy("long", "long_next").agg(*(cell(*c) for c in cells))
    # a context without a pair that is counted in some model weighs on neither side, and isn't needed
    strong = pairs.filter(f"n00 + n10 > {LEAST_COUNT} or n01 + n11 > {LEAST_COUNT}").select("long").distinct()
    pairs = pairs.join(strong, "long", "left_semi").select(F.col("long").cast("int").alias("long"), F.col("long_next").cast("int").alias("long_next"), *(f"n{h}{t}" for h, t in cells)).toPandas()
    of_class = {half: pairs[[f"n{half}0", f"n{half}1"]].to_numpy() for half in HALVES}
    of_class[ALL] = of_class[0] + of_class[1]
    counted = _Counts({key: pairs[key].to_numpy() for key in ("long", "long_next")}, of_class)

    def table(rows: pd.DataFrame, key: str, value: str = "n") -> Table:
        return Table(*_sorted(rows, key, value))

    pooled = counts
    lower_pairs = pooled.select("short_next", "long").distinct().groupBy("short_next").agg(F.count(F.lit(1)).alias("n")).toPandas()
    lower = pooled.select("short", "short_next", "long").distinct().groupBy("short").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("short_next").alias("kinds")).toPandas()
    single = pooled.select("next", "short").distinct().groupBy("next").agg(F.count(F.lit(1)).alias("n")).toPandas()
    single["n"] = single["n"] / (single["n"].sum() + 1)
    single = Table(*_sorted(single, "next", "n"), default=1e-6)
    both = of_class[ALL].sum(axis=1)
    counted.shared = (counted.summed("long_next", both), counted.summed("long", both), counted.summed("long", np.ones(len(pairs))), table(lower_pairs, "short_next"), table(lower, "short"), table(lower, "short", "kinds"), single)

    shipped = sample.sparkSession.sparkContext.broadcast(counted)
    told, path = _cross_fitted(sample, shipped)
    paths.append(path)
    shipped.destroy()
    losses, weights = _curves(told)
    best = int(np.argmin(losses))
    model = counted.fit(ALL, DISCOUNTS[best])
    model.weights = weights[best]
    for path in paths:
        discard(sample.sparkSession, path)
    return model


@dataclass
class _Counts:
    """What models are fitted from: keys of pairs, their counts by class for each half and for all rows, and the shared backoff. It is what workers get: a table of each model would be several times as large."""

    keys: dict[str, np.ndarray]
    of_class: dict[int, np.ndarray]
    shared: tuple = ()
    apart: list = field(default_factory=list, repr=False)
    places: dict = field(default_factory=dict, repr=False)
    seen: dict = field(default_factory=dict, repr=False)
    told: np.ndarray = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"apart": [], "places": {}, "seen": {}, "told": None}

    def summed(self, key: str, values: np.ndarray) -> Table:
        """All tables by one key hold the same array of keys, so that Places searches them once."""
        if key not in self.places:
            keys, at = np.unique(self.keys[key], return_inverse=True)
            self.places[key] = self.shared[("long_next", "long").index(key)].keys if self.shared else np.append(keys, BUCKETS), at
        keys, at = self.places[key]
        out = np.zeros((len(keys) - 1, *values.shape[1:]))
        np.add.at(out, at, values)
        table = Table(keys[:-1], out)
        table.keys = keys
        return table

    def fit(self, model: int, discount: tuple[float, float]) -> ToxicityModel:
        mass = discounted(self.of_class[model], discount)
        context, kept = self.summed("long", self.of_class[model]), self.summed("long", mass)
        left = np.clip(1 - kept.values[:-1] / np.maximum(context.values[:-1], 1), LEAST_LEFT, 1)
        rest = Table(context.keys[:-1], left, 1.0)
        rest.keys = context.keys
        return ToxicityModel(True, self.summed("long_next", mass), context, rest, self.shared, discount)

    def models(self) -> list[list[ToxicityModel]]:
        """For each half the models of the other one, one for each of DISCOUNTS, once per worker."""
        if not self.apart:
            self.apart = [[self.fit(1 - half, discount) for discount in DISCOUNTS] for half in HALVES]
        return self.apart

    def ratios(self, words: list[list[str]]) -> list[np.ndarray]:
        """Of each word of each text the ratios under all models(): (words, halves, discounts). The grams of a word and their places in the tables are found once for all of them."""
        fresh = set().union(*words) if words else set()
        if self.told is None or len(self.seen) + len(fresh) > len(self.told):
            self.seen, self.told = {}, np.empty((max(CACHE_WORDS // 3, len(fresh)), len(HALVES), len(DISCOUNTS)))
        new, models, row = [w for w in fresh if w not in self.seen], self.models(), len(self.seen)
        for at in range(0, len(new), 20_000):
            n = len(part := new[at : at + 20_000])
            of = Places(grams(part))
            backoff = models[0][0].backoff(of)
            for half in HALVES:
                for k, m in enumerate(models[half]):
                    self.told[row + at : row + at + n, half, k] = m.compared(of, backoff, n)
        self.seen.update(zip(new, range(row, row + len(new)), strict=True))
        find = self.seen.__getitem__
        return [self.told[np.fromiter(map(find, w), np.int64, len(w))] for w in words]


def _cross_fitted(sample: DataFrame, apart: Broadcast) -> tuple[DataFrame, str]:
    """x, the features of each row under the models of the other half, for each of DISCOUNTS in turn, and toxic."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 250):
                part = batch.iloc[at : at + 250]
                ratios = apart.value.ratios([WORD.findall(t.lower()) for t in part["text"]])
                x = [np.concatenate([features(np.ascontiguousarray(r[:, h, k])) for k in range(len(DISCOUNTS))]) for r, h in zip(ratios, part["half"], strict=True)]
                yield pd.DataFrame({"x": x, "toxic": part["toxic"].to_numpy()})

    return materialise(sample.mapInPandas(run, "x array<double>, toxic int"), "toxic-features")


def _sorted(rows: pd.DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.sort_values(key)
    return rows[key].to_numpy(), rows[value].to_numpy()


def _summed(rows: DataFrame, parts: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of parts(x, toxic), a matrix with a line per row. Each value is rounded to a multiple of 1 / UNIT first, so that reruns agree whatever the order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                values = parts(np.stack(batch["x"].to_numpy()).reshape(len(batch), len(DISCOUNTS), FEATURES), batch["toxic"].to_numpy())
                own = np.rint(values.reshape(len(batch), -1) * UNIT).astype(np.int64).sum(axis=0)
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"k": np.arange(len(total)), "n": total})

    found = rows.mapInPandas(run, "k int, n bigint").groupBy("k").agg(F.sum(F.col("n").cast("decimal(38,0)")).cast("double").alias("n")).toPandas().sort_values("k")
    return found["n"].to_numpy() / UNIT


def _curves(rows: DataFrame, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Of each of DISCOUNTS the mean loss of a logistic curve and its weights, by Newton's method with a small ridge on standardised columns: each round is one sum over the rows."""
    d, f = len(DISCOUNTS), FEATURES
    n, *moments = _summed(rows, lambda x, y: np.concatenate([np.ones((len(x), 1)), x.reshape(len(x), -1), (x * x).reshape(len(x), -1)], axis=1))
    middle, square = np.array(moments).reshape(2, d, f) / n
    spread = np.sqrt(np.maximum(square - middle**2, 0))
    middle[:, 0], spread[:, 0] = 0, 1
    spread[spread < 1e-3] = 1
    b = np.zeros((d, f))

    def parts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = (x - middle) / spread
        p = 1 / (1 + np.exp(-np.clip((z * b).sum(axis=2), -30, 30)))
        bent = (p * (1 - p))[:, :, None, None] * z[:, :, :, None] * z[:, :, None, :]
        q = np.clip(p, 1e-9, 1 - 1e-9)
        loss = -np.where(y[:, None] == 1, np.log(q), np.log(1 - q))
        return np.concatenate([loss, ((y[:, None] - p)[:, :, None] * z).reshape(len(x), -1), bent.reshape(len(x), -1)], axis=1)

    for _ in range(rounds):
        got = _summed(rows, parts)
        losses, slope, bend = got[:d] / n, got[d : d + d * f].reshape(d, f), got[d + d * f :].reshape(d, f, f)
        step = np.stack([np.linalg.solve(bend[k] + 1e-2 * np.eye(f), slope[k] - 1e-2 * b[k]) for k in range(d)])
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-5:
            break
    out = b / spread
    out[:, 0] -= (b[:, 1:] * middle[:, 1:] / spread[:, 1:]).sum(axis=1)
    return losses, out


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for every whole text; null text counts as empty, which has a score too. One row per input row, none for an empty table; very long texts are scored whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "score": shared.value.scores(part["text"].tolist())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(run, "doc_id bigint, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
