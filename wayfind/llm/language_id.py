"""Language ID: script ranges narrow the candidates of each word, Viterbi with a switching penalty labels spans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfind.llm.common import text_or_empty

#: First code points of Unicode ranges and the script of each; what no range has is "other".
SCRIPTS = ("other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul", "ethiopic", "kana", "han")
RANGES = (
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "latin"), (0x0300, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0F00, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0x4DC0, "other"), (0x4E00, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
STARTS = np.array([a for a, _ in RANGES])
SCRIPT_OF_RANGE = np.array([SCRIPTS.index(s) for _, s in RANGES])

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: A language is a candidate for a word if this share of its training letters has the word's script.
SCRIPT_SHARE = 0.01
EXCLUDED = -1e6
#: Bounds the memory of a worker's table of words that it has seen in a task, nothing else.
CACHE_WORDS = 500_000


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of each word between two marks, and the index of each gram's word."""
    marked = [f"\x02{w}\x03" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    of = np.repeat(np.arange(len(words)), lengths)
    at, buckets, owner = np.arange(len(points)), [], []
    code = np.zeros(len(points), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        nxt = np.zeros(len(points), np.uint64)
        nxt[: max(0, len(points) - n + 1)] = points[n - 1 :]
        code = (code ^ (nxt + np.uint64(n))) * np.uint64(0x100000001B3) + np.uint64(0x9E3779B97F4A7C15)
        if n in ORDERS:
            fits = at + n <= ends
            if n == 1:
                fits &= (points != 2) & (points != 3)
            buckets.append((((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(BUCKETS))[fits].astype(np.int64))
            owner.append(of[fits])
    return np.concatenate(buckets), np.concatenate(owner)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word and the script of most of them (the first in SCRIPTS of several)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    scripts = SCRIPT_OF_RANGE[np.searchsorted(STARTS, points, "right") - 1]
    of = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(of * len(SCRIPTS) + scripts, minlength=len(words) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.int64)
    return letters, counts.argmax(axis=1) if len(words) else np.zeros(0, np.int64)


@dataclass
class LanguageModel:
    """Log-probabilities of hashed character n-grams by language; its size is set by BUCKETS and the number of languages."""

    langs: list[str]
    log_p: np.ndarray  # (BUCKETS, languages)
    candidates: np.ndarray  # (scripts, languages), bool
    switch: float = 12.0
    seen: dict = field(default_factory=dict, repr=False)
    scores: np.ndarray = field(default=None, repr=False)
    letters: np.ndarray = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"seen": {}, "scores": None, "letters": None}

    def index(self, words: list[list[str]]) -> list[np.ndarray]:
        """Row of each word in self.scores and self.letters, new words scored once."""
        fresh = set().union(*words) if words else set()
        if self.scores is None or len(self.seen) + len(fresh) > CACHE_WORDS:
            self.seen, self.scores, self.letters = {}, np.zeros((0, len(self.langs)), np.float32), np.zeros(0, np.int64)
        new = [w for w in fresh if w not in self.seen]
        if new:
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new)), strict=True))
            scores, letters = zip(*(self._score(new[at : at + 50_000]) for at in range(0, len(new), 50_000)), strict=True)
            self.scores, self.letters = np.concatenate([self.scores, *scores]), np.concatenate([self.letters, *letters])
        find = self.seen.__getitem__
        return [np.fromiter(map(find, w), np.int64, len(w)) for w in words]

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        buckets, of = _grams(words)
        letters, script = _letters(words)
        if not self.langs:
            return np.zeros((len(words), 0), np.float32), letters
        total = np.stack([np.bincount(of, self.log_p[buckets, k], len(words)) for k in range(len(self.langs))], axis=1)
        open_to = self.candidates[script]
        open_to[~open_to.any(axis=1)] = True
        return np.where(open_to, total / len(ORDERS), EXCLUDED).astype(np.float32), letters

    def path(self, scores: np.ndarray) -> np.ndarray:
        """Best language of each word: the sum of word scores less switch for every change.

        Left early if no change can pay. Against the one language best for all words, a run of words
        elsewhere gains at most `most`. A path that visits that language at all pays a change for
        every other run; one that never does pays for all runs but one, and its first and last run
        gain no more than the best beginning and the best end. So with most <= switch and
        beginning + end <= switch no path is better, however many languages there are.
        """
        best = int(scores.sum(axis=0, dtype=np.float64).argmax())
        gain = np.vstack([np.zeros((1, scores.shape[1])), np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)])
        most = (gain - np.minimum.accumulate(gain, axis=0)).max()
        if most <= self.switch and gain.max() + (gain[-1] - gain).max() <= self.switch:
            return np.full(len(scores), best)
        n, k = scores.shape
        back = np.empty((n, k), np.int32)
        value, stay = scores[0].astype(np.float64), np.arange(k)
        for t in range(1, n):
            top = int(value.argmax())
            move = value[top] - self.switch > value
            back[t] = np.where(move, top, stay)
            value = np.where(move, value[top] - self.switch, value) + scores[t]
        out = np.empty(n, np.int64)
        out[-1] = int(value.argmax())
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    @property
    def step(self) -> int:
        """Documents whose words are scored together: fewer where each word has scores of many languages."""
        return max(1, 250 * 64 // max(64, len(self.langs)))

    def forget(self) -> None:
        """Let go of the words seen: a worker goes on to tasks of other operators, whose memory they would take."""
        self.seen, self.scores, self.letters = {}, None, None

    def predict(self, rows: np.ndarray) -> tuple[str, float]:
        letters = self.letters[rows]
        total = int(letters.sum())
        if not total or not self.langs:
            return "und", 0.0
        share = np.bincount(self.path(self.scores[rows]), letters, len(self.langs)) / total
        top = int(share.argmax())
        return self.langs[top], float(share[top])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order_by: Column | None = None, max_docs: int = 4000) -> LanguageModel:
    """Fit a model on at most about max_docs documents of each language, drawn by the hash of order_by (default: the text).

    max_docs is the only bound on what is learned from; whole texts count. Rows with null text or
    language are left out; with none left the model knows no language and predicts `und`. The driver
    gets at most BUCKETS + scripts rows per language, and the model that predict() broadcasts takes
    256 kB a language, however many there are; the scores of words are then held for fewer documents
    at a time.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(text_col) if order_by is None else order_by).alias("h")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    langs = sorted(sizes)
    model = LanguageModel(langs, np.zeros((BUCKETS, len(langs)), np.float32), np.zeros((len(SCRIPTS), len(langs)), bool))
    if not langs:
        return model
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, max_docs / n)))))
    sample = rows.filter((F.col("h") / F.lit(float(1 << 64)) + 0.5) < share[F.col("lang")]).select("text", "lang")
    number = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(langs), BUCKETS + len(SCRIPTS)), np.int64)
        for batch in batches:
            for lang, own in batch.groupby("lang")["text"]:
                for text in own:
                    words = WORD.findall(text.lower())
                    if words:
                        total[number[lang], :BUCKETS] += np.bincount(_grams(words)[0], minlength=BUCKETS)
                        letters, script = _letters(words)
                        total[number[lang], BUCKETS:] += np.bincount(script, letters, len(SCRIPTS)).astype(np.int64)
        k, b = np.nonzero(total)
        yield pd.DataFrame({"k": k, "b": b, "n": total[k, b]})

    got = sample.mapInPandas(run, "k bigint, b bigint, n bigint").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    counts[got["k"], got["b"]] = got["n"]
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    model.log_p = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32)
    model.candidates = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    return model


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every whole text: the language of most letters on the best path, and their share.

    `und` with score 0 if the text is null or has no letters. Ties go to the first language in order
    of code points. One row per input row, repeated ones too, none for an empty table; texts are taken
    whole, however long. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        try:
            for batch in batches:
                for at in range(0, len(batch), own.step):
                    part = batch.iloc[at : at + own.step]
                    found = [own.predict(x) for x in own.index([WORD.findall(t.lower()) for t in part["text"]])]
                    yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "lang_pred": [x for x, _ in found], "score": [x for _, x in found]})
        finally:
            own.forget()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(run, "doc_id bigint, lang_pred string, score double")


def _told(texts: Iterator[pd.Series], model: LanguageModel, least: float) -> Iterator[pd.Series]:
    """Whether each text has letters, this share of them in one language."""
    try:
        for text in texts:
            out = []
            for at in range(0, len(text), model.step):
                found = (model.predict(x) for x in model.index([WORD.findall(t.lower()) for t in text.iloc[at : at + model.step]]))
                out += [lang != "und" and share >= least for lang, share in found]
            yield pd.Series(out, dtype=bool)
    finally:
        model.forget()


def keep_languages(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text has letters, with at least this share of them in one language; all columns, null and repeated ids and repeated rows alike.

    The prediction is a column beside the text, so rows stay where they were read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def told(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return _told(texts, shared.value, least)

    return docs.filter(told(text_or_empty(text_col)))


def spans(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, end, lang: runs of words of one language, as offsets in code points of the text, in order. Null texts and texts without letters have none; rows that repeat an id have theirs each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            out = []
            for name, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                found = list(WORD.finditer(text))
                if found and own.langs:
                    rows = own.index([[m.group().lower() for m in found]])[0]
                    path = own.path(own.scores[rows])
                    begin = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
                    out += [(name, found[a].start(), found[b - 1].end(), own.langs[path[a]]) for a, b in zip(begin, np.r_[begin[1:], len(path)], strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", "start", "end", "lang"]).astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(run, "doc_id bigint, start bigint, end bigint, lang string")
