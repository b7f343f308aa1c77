"""The registered queries against their contracts by brute force, on the smallest tables."""

import base64
import hashlib
import pickle
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from wayfind.llm import byte_bpe, language_id, queries, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_with_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    expected = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(repr, map(tuple, got.select(*expected.columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_op2(spark, documents):
    got = queries.op2_mixing(spark, SF).collect()
    sizes = {r["doc_id"]: len([w for w in re.split(r"[\x20\x09-\x0D]+", r["text"] or "") if w]) for r in documents}
    assert {r["doc_id"]: r["size"] for r in got} == sizes
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)} and own[0]["target"] <= 2 * own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.01 * own[0]["target"] + max(r["size"] for r in own)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = {r["doc_id"]: r["taken"] for r in queries.op2_mixing(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_op3_and_op5(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents}
    got = queries.op3_language_id(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got) and len(got) == len(documents)
    told = [(r["lang_pred"], lang[r["doc_id"]]) for r in got if r["held_out"] and lang[r["doc_id"]] and r["lang_pred"] != "und"]
    assert np.mean([a == b for a, b in told]) > 0.95
    more = "/root/testdata/sf0.01"  # the smallest tables have too few labels to learn from
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{more}/labels.parquet").collect()}
    got = queries.op5_toxicity(spark, more).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    scores = [(r["score"], toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([x for x, y in scores if y]) > np.mean([x for x, y in scores if not y]) + 0.3


def test_op4(spark, documents):
    def fingerprint(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
        h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))

    fp = {r["doc_id"]: fingerprint(r["text"]) for r in documents}
    label = {i: i for i in fp}
    pairs = [(i, j) for i in fp for j in fp if i < j and (fp[i] ^ fp[j]).bit_count() <= 3]
    while any(label[i] != label[j] and not label.update(dict.fromkeys((i, j), min(label[i], label[j]))) for i, j in pairs):
        pass
    got = queries.op4_simhash(spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fp[i]:016x}", label[i]) for i in fp}


def test_op6_in_many_parts(spark, documents):
    tok, at, expected = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0, []
    for r in documents:
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = queries.op6_token_output(spark, SF)
        assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_op7(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    usable = [r["label"] is not None and r["embedding"] is not None and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"]) for r in rows]
    links = {i: set() for i in ids.tolist()}
    for label in {r["label"] for r in rows}:
        own = [k for k, r in enumerate(rows) if r["label"] == label and usable[k]]
        if own:
            x = np.array([rows[k]["embedding"] for k in own], float)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            for a, b in zip(*np.nonzero(x @ x.T >= 0.93), strict=True):
                if a != b:
                    links[rows[own[a]]["vec_id"]].add(rows[own[b]]["vec_id"])
    label = {i: i for i in links}
    while any(label[j] < label[i] and not label.update({i: label[j]}) for i in links for j in links[i]):
        pass
    got = queries.op7_embedding_dedup(spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (len(n), label[i], label[i] == i) for i, n in links.items()}


def test_op10(spark, documents):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for r in documents:
        ids = np.array(enc.encode_ordinary(r["text"] or ""), "<u4")
        expected[r["doc_id"]] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = queries.op10_byte_bpe(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == expected


def test_paths_of_many_languages():
    """The path search and its early exit against all paths."""
    rnd = np.random.default_rng(1)
    for k in (3, 4, 5):
        model = language_id.LanguageModel([f"l{x}" for x in range(k)], np.zeros((1, k), np.float32), np.ones((len(language_id.SCRIPTS), k), bool), switch=1.5)
        n = 6 if k > 3 else 8
        paths = np.stack(np.meshgrid(*[np.arange(k)] * n, indexing="ij"), -1).reshape(-1, n)
        changes = (paths[:, 1:] != paths[:, :-1]).sum(axis=1)
        early = 0
        for _ in range(300):
            scores = rnd.normal(size=(n, k)).astype(np.float32) * rnd.choice([0.2, 0.5, 1.0])
            value = scores.astype(np.float64)[np.arange(n), paths].sum(axis=1) - 1.5 * changes
            mine = model.path(scores)
            got = scores.astype(np.float64)[np.arange(n), mine].sum() - 1.5 * (mine[1:] != mine[:-1]).sum()
            assert abs(got - value.max()) < 1e-5
            early += len(set(mine.tolist())) == 1
        assert 20 < early < 290


def test_long_rows_of_any_table_of_ranks(monkeypatch):
    """Rows alone in a wide matrix against the plain rule, with ranks that no training would give."""

    def plain(ranks, piece):
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while True:
            rank, at = min(((ranks.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(1 << 30, 0))
            if rank == 1 << 30:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    monkeypatch.setattr(byte_bpe, "LONG", 4)
    rnd = random.Random(4)
    for _ in range(150):
        letters = "abc"[: rnd.choice([1, 2, 3])]
        tokens = list({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))).encode() for _ in range(rnd.randint(3, 40))})
        rnd.shuffle(tokens)
        if rnd.random() < 0.5:
            tokens.sort(key=len, reverse=rnd.random() < 0.5)
        order = [bytes([k]) for k in range(256)] + tokens if rnd.random() < 0.7 else tokens + [bytes([k]) for k in range(256)]
        ranks = {t: k for k, t in enumerate(order)}
        bpe = byte_bpe.ByteBpe(ranks, r"[a-z]+")
        text = "".join(rnd.choice(letters) for _ in range(200))
        if text.encode() not in ranks:
            assert bpe.encode_batch([text])[0].tolist() == plain(ranks, text.encode())


def test_substring_of_odd_rows(spark):
    passage = "This passage of many words stands in several documents. It has more than one sentence! Does it hold together? It does, and it is long enough to go."
    rows = [(1, f"Own start. {passage} Own end.", "x"), (2, passage, "x"), (2, passage, "x"), (None, f"And\n\n{passage}", "x"), (3, None, "x"), (4, "", "x"), (5, "No. No. No.", "x"), (6, "word " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    got = substring_dedup.repeated_spans(docs, min_run=120).collect()
    gone = {}
    for r in got:
        gone[r["doc_id"]] = gone.get(r["doc_id"], 0) + 1
        assert r["keep_doc_id"] == 1 and r["copies"] == 4
    assert gone == {2: 8, None: 4}  # four sentences each; a stock phrase repeated in one document stays
    cut = substring_dedup.remove_spans(docs, substring_dedup.repeated_spans(docs, min_run=120))
    assert cut.columns == docs.columns and {(r["doc_id"], (r["text"] or "").strip()) for r in cut.collect() if r["doc_id"] in (2, 3, 5)} == {(2, ""), (3, ""), (5, "No. No. No.")}


def test_op5_models_against_dictionaries(spark):
    """Log-probabilities of both class models and their shared backoff, by plain dictionaries of characters and contexts."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    texts = [" ".join(rnd.choice(vocabulary[20 * (k % 2) :]) for _ in range(30)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, toxic int"))

    def steps(word):
        marked = f"\x02{word}\x03"
        return [(marked[max(0, i - toxicity.LONG) : i], marked[max(0, i - toxicity.SHORT) : i], marked[i]) for i in range(1, len(marked))]

    pairs = [Counter(), Counter()]
    for k, text in enumerate(texts):
        for word in text.split():
            pairs[k % 2].update(steps(word))
    seen = set(pairs[0]) | set(pairs[1])
    by_class = [Counter({(long, c): n for (long, _, c), n in p.items()}) for p in pairs]
    strong = {long for long, c in by_class[0] | by_class[1] if max(p[long, c] for p in by_class) > toxicity.LEAST_COUNT}
    contexts = {(short, long, c) for long, short, c in seen}

    def single(c):
        kinds = {(short, x) for _, short, x in seen}
        return sum(x == c for _, x in kinds) / (len(kinds) + 1) or 1e-6

    def backoff(long, short, c):
        own, p = {(x, y) for s, x, y in contexts if s == short}, single(c)
        if own:
            p = (max(sum(y == c for _, y in own) - 0.75, 0) + 0.75 * len({y for _, y in own}) * p) / len(own)
        if long in strong:
            n = {y: by_class[0][x, y] + by_class[1][x, y] for x, y in by_class[0] | by_class[1] if x == long}
            p = (max(n.get(c, 0) - 0.75, 0) + 0.75 * len(n) * p) / sum(n.values())
        return p

    def likelihood(counts, long, short, c):
        n = {y: k for (x, y), k in counts.items() if x == long and long in strong}
        left = {y: max(0.0, k - model.discount[0] - model.discount[1] * k**0.5) for y, k in n.items()}  # the discount that training chose
        total = sum(n.values())
        share = min(1.0, max(toxicity.LEAST_LEFT, 1 - sum(left.values()) / max(1, total))) if long in strong else 1.0
        return left.get(c, 0.0) / max(1, total) + share * backoff(long, short, c)

    words = vocabulary[::3] + ["zzz", "ab", "é"]
    expected = [sum(np.log(likelihood(by_class[1], *s)) - np.log(likelihood(by_class[0], *s)) for s in steps(w)) for w in words]
    assert np.allclose(model.ratios(words), expected, atol=1e-9)
    assert max(map(abs, expected)) > 1


def test_op5_learns_from_every_labelled_row(spark):
    """More rows of a class than a sample held before."""
    texts = [(k, "calm river " + ("zork " * 4 if k in (11, 9_000) else "stone ")) for k in range(9_100)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", F.col("text").contains("zork").cast("int").alias("toxic"))
    rows = toxicity.labelled_rows(docs, labels.unionByName(labels.limit(3)))
    assert rows.count() == 9_100 and rows.agg(F.sum("toxic")).first()[0] == 2


def test_toxicity_words_are_searched_once_for_all_models():
    """Cross-fitting looks a word's grams up once, whatever the number of halves and discounts, with the values of each model alone."""
    words = [["awful", "beast", "calm", "river", "beasts"], [], ["calm", "unseen"]]
    g = toxicity.grams(["awful", "beast", "calm", "river"] * 3)
    at = np.unique(g["long_next"], return_index=True)[1]
    rnd = np.random.default_rng(5)
    of_class = {half: rnd.integers(0, 40, (len(at), 2)) for half in toxicity.HALVES}
    counts = toxicity._Counts({key: g[key][at] for key in ("long", "long_next")}, of_class | {toxicity.ALL: of_class[0] + of_class[1]})
    lower = [toxicity.Table(np.unique(g[key]), rnd.integers(1, 9, len(np.unique(g[key])))) for key in ("short_next", "short", "short", "next")]
    both = counts.of_class[toxicity.ALL].sum(axis=1)
    counts.shared = (counts.summed("long_next", both), counts.summed("long", both), counts.summed("long", np.ones(len(at))), *lower)
    shipped = pickle.loads(pickle.dumps(counts))
    got = shipped.ratios(words)
    assert [r.shape for r in got] == [(len(w), 2, len(toxicity.DISCOUNTS)) for w in words]
    for half in toxicity.HALVES:
        for k, discount in enumerate(toxicity.DISCOUNTS):
            alone = counts.fit(1 - half, discount)
            assert all((r[:, half, k] == alone.ratios(w)).all() for r, w in zip(got, words, strict=True))
    tables = [t for own in shipped.models() for m in own for t in (m.mass, m.context, m.left, *m.shared)]
    assert len({id(t.keys) for t in tables}) == 2 + len(lower)
