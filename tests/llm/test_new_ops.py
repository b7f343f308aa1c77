"""Manifest, exact search and vector codes against brute force; rows that no test table holds."""

import hashlib
import math
import random
import re
import zlib
from math import comb

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from wayfind.llm import byte_bpe, chat_format, language_id, merkle, mixing, near_copies, queries, top_k, toxicity, vector_codes
from wayfind.llm.gnat import Gnat, squared

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def manifest(rows, tampered):
    """Rows of (id, source, lang, n, text) as the contract has them; tampered(row) gives the text afterwards."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in groups[g]]) for g in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            fold, proof = leaf((*r[:4], tampered(r))), ""
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    run, own = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:own] + run[own + 1 :])
                    fold, at = sha("".join([*run[:own], fold, *run[own + 1 :]])), at // 8
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], sha(proof), fold, fold == top[-1][0]))
    return out


def low(text):
    return text if text is None else re.sub("[A-Z]", lambda m: m.group().lower(), text)


def told(frame, columns=("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")):
    return sorted(map(repr, map(tuple, frame.select(*columns).collect())))


def test_op11(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    expected = manifest(rows, lambda r: low(r[4]) if zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[4])
    assert told(queries.op11_merkle_manifest(spark, SF), ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) == sorted(map(repr, expected))
    assert any(r[-1] for r in expected) and not all(r[-1] for r in expected)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
ROWS = [
    *[(k, "s", "en", 1, f"T{k}") for k in range(4200)],  # several blocks of leaves, several levels
    *[(k, None, f"l{k % 70}", k, "ÀB ") for k in range(5000, 5100)],  # more groups than one level of the tree above takes
    (7, "x", "one", 3, "Alone"), (None, None, None, None, None), (None, "a", None, None, ""), (8, "s", "ü", 1, "x" * 300_000), (9, "s", "zz", 1, "same"), (9, "s", "zz", 1, "same"), (9, "t", "zz", 1, "same"),
]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:9], ROWS[:1], [ROWS[-6]], ROWS[-3:]])
def test_manifest(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("key", F.lit(2)).repartition(3)
    got = merkle.manifest(docs, changed={"text": F.lower(F.col("d.text"))}, where=F.col("d.doc_id") % 3 == 0)
    assert told(got) == sorted(map(repr, manifest(rows, lambda r: r[4].lower() if r[0] is not None and r[4] is not None and r[0] % 3 == 0 else r[4])))


def test_manifest_of_nothing_and_without_tampering(spark):
    docs = spark.createDataFrame(ROWS[:20], SCHEMA)
    assert merkle.manifest(docs.limit(0)).count() == 0
    assert {r["verified"] for r in merkle.manifest(docs).collect()} == {True}
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(docs)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def search(rows, k, scale, every):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in rows:
        if i is not None and i % every == 0 and v is not None and all(x is not None and math.isfinite(x) for x in v):
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, vector in asked.items():
        w = [math.floor(scale * x) for x in vector]
        scores = sorted((-sum(a * b for a, b in zip(w, c)), i) for i, c in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


def test_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, queries.op12_top_k(spark, SF).collect())) == sorted(search(rows, 5, 256, 50))


@pytest.mark.parametrize(("block", "asked"), [(8192, 512), (7, 3)])
def test_top_k_of_odd_rows(spark, monkeypatch, block, asked):
    monkeypatch.setattr(top_k, "ROWS", block)
    monkeypatch.setattr(top_k, "QUERIES", asked)
    monkeypatch.setattr(top_k, "LANE", 2)
    rnd = random.Random(2)
    rows = [(k, [rnd.choice([0.0, 0.0, rnd.uniform(-1, 1), 1.0]) for _ in range(6)]) for k in range(120)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (204, []), (205, [0.5]), (206, [1e300] * 2), (10, rows[10][1]), (11, rows[10][1]), (208, [0.25] * 300)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, score string, block int")
    expected = search([r for r in rows if r[0] != 206], 5, 256, 10)
    got = top_k.top_k(frame.filter("vec_id is null or vec_id <> 206"), every=10)
    assert sorted((r["query_id"], r["rank"], r["score"]) for r in got.collect()) == sorted((q, rank, s) for q, rank, _, s in expected)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert top_k.top_k(frame, every=10).count() == len(expected)  # huge components are cut, not lost
    assert top_k.top_k(frame.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in top_k.top_k(frame.filter("vec_id in (0, 1)"), every=10).collect()] == [(0, 1, 1)]


@pytest.mark.parametrize("most", [1 << 20, 16, 1])
def test_top_k_sends_no_queries_through_the_driver(spark, monkeypatch, most):
    monkeypatch.setattr(top_k, "ROWS", 9)
    monkeypatch.setattr(top_k, "COMPONENTS", most)
    monkeypatch.setattr(top_k, "LANE_COMPONENTS", 2 * most)
    rows = [(k, [k % 7 / 8, 0.5, -k / 64]) for k in range(100)]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), every=20)
    plan = got._jdf.queryExecution().executedPlan
    assert "Broadcast" not in plan().toString()  # five queries, but once for each block of rows
    assert sorted(map(tuple, got.collect())) == sorted(search(rows, 5, 256, 20))
    assert "Broadcast" not in plan().toString()


def test_filled_postings_score_alike():
    rng = np.random.default_rng(4)
    n, share = 200, [0, 0.01, 0.1, 0.125, 0.2, 0.9, 1]
    kept = {t: np.sort(rng.permutation(n)[: int(n * s)]).astype(np.int32) for t, s in enumerate(share)}
    postings = {t: (p, rng.integers(-(1 << 52), 1 << 52, len(p))) for t, p in kept.items()}
    query = [(t, int(x)) for t, x in enumerate(rng.integers(-(1 << 52), 1 << 52, len(share) + 1))]
    full = top_k.filled(postings, n)
    assert [len(full[t][0]) for t in range(len(share))] == [0, 2, 20, 200, 200, 200, 200]
    assert (top_k.scatter(query, full, n) == top_k.scatter(query, postings, n)).all()


POINTS = st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=90)


@settings(max_examples=150, deadline=None)
@given(entries=POINTS, points=POINTS)
def test_tree_finds_the_nearest_entry(entries, points):
    entries, points = np.array(entries), np.array(points)
    d = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    at, best = Gnat(entries).nearest(points)
    assert (best == d.min(axis=1)).all() and (at == d.argmin(axis=1)).all()


def test_tree_leaves_subtrees_out(monkeypatch):
    rnd = np.random.default_rng(0)
    centres = rnd.integers(-4000, 4000, (8, 16))
    entries = (centres[rnd.integers(0, 8, 256)] + rnd.integers(-60, 60, (256, 16))).astype(np.int64)
    points = (centres[rnd.integers(0, 8, 2000)] + rnd.integers(-60, 60, (2000, 16))).astype(np.int64)
    looked = []
    real = squared
    monkeypatch.setattr("wayfind.llm.gnat.squared", lambda x, y: looked.append(len(x) * len(y)) or real(x, y))
    tree_ = Gnat(entries)
    looked.clear()
    at, _ = tree_.nearest(points)
    assert (at == real(points, entries).argmin(axis=1)).all() and sum(looked) < 0.4 * len(points) * len(entries)
    assert (real(np.array([[1 << 25]]), np.array([[-(1 << 25)]])) == 1 << 52).all()


def codes(rows, scale=1024, rounds=4, parts=4):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    vectors = [np.array([math.floor(scale * x) for x in v] + [0] * (parts * width - len(v)), dtype=np.int64).reshape(parts, width) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:256]
    books = [[vectors[k][p] for k in order] for p in range(parts)]

    def nearest(x, book):
        d = [int(((x - e) ** 2).sum()) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            fell = {}
            for v in vectors:
                fell.setdefault(nearest(v[p], books[p])[0], []).append(v[p])
            books[p] = [np.array([sum(int(x[d]) for x in fell[j]) // len(fell[j]) for d in range(width)]) if j in fell else e for j, e in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in vectors]
    errors = [sum(d for _, d in f) for f in found]
    whole = sha(",".join(str(int(x)) for book in books for e in book for x in e))
    return [(i, "".join(f"{j:02x}" for j, _ in f), e, sum(o for o, (_, _, other) in zip(errors, kept) if other == label), whole) for (i, _, label), f, e in zip(kept, found, errors)]


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.op13_vector_codes(spark, SF).collect())) == sorted(codes(rows))


@pytest.mark.parametrize("length", [8, 7, 1])
def test_codes_of_odd_rows(spark, length):
    rnd = random.Random(3)
    rows = [(k, [rnd.choice([0.5, -0.5, rnd.uniform(-1, 1)]) for _ in range(length)], rnd.choice([None, 1, 2])) for k in range(330)]
    rows += [(400, None, 1), (401, [None] * length, 1), (402, [float("nan")] * length, 1), (403, [float("-inf")] * length, 1), (None, [0.25] * length, None), (404, [], 5), (405, [0.1], 5), (5, [0.75] * length, 2), (5, [0.75] * length, 2)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, code string, error int").repartition(3)
    got = vector_codes.compressed(frame)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, codes(rows)))
    assert vector_codes.compressed(frame.limit(0)).count() == 0
    assert vector_codes.compressed(frame.filter("vec_id = 400")).count() == 0
    assert vector_codes.compressed(spark.createDataFrame([(1, [1e300, -1e300], 1), (2, [1e300, 0.0], 1)], "vec_id bigint, embedding array<double>, label int")).count() == 2
    kept = frame.filter("vec_id < 330 and vec_id <> 5").select("vec_id", "label", "embedding")
    books = vector_codes.fit(kept)
    back = vector_codes.decode(vector_codes.encode(kept, books).drop("embedding"), books).join(kept.select("vec_id", F.col("embedding").alias("v")), "vec_id").collect()
    far = [sum((a - b) ** 2 for a, b in zip(r["v"], r["embedding"])) * 1024**2 for r in back]
    assert len(back) == 329 and all(abs(f - r["error"]) <= 2 * length * (1 + 2 * math.sqrt(r["error"] + 1)) for f, r in zip(far, back))


def test_far_bits_bound():
    """No sizes of two sets of similarity 0.8 make a majority bit differ more often than 3 in 16, and 25 of 64 bits differ in less than 1 pair in 5,000."""
    worst = 0.0
    for a in range(1, 41):
        for b in range(1, 41):
            both = min(a, b)
            while both and both < 0.8 * (a + b - both):
                both += 1
                if both > min(a, b):
                    both = 0
            if not both:
                continue
            for shared in range(both, min(a, b) + 1):
                if shared < 0.8 * (a + b - shared):
                    continue
                p = 0.0
                for s in range(shared + 1):
                    up = [sum(comb(n - shared, x) for x in range(n - shared + 1) if 2 * (s + x) > n) / 2 ** (n - shared) for n in (a, b)]
                    p += comb(shared, s) / 2**shared * (up[0] * (1 - up[1]) + up[1] * (1 - up[0]))
                worst = max(worst, p)
    assert worst <= 3 / 16 + 1e-12
    assert sum(comb(64, k) * worst**k * (1 - worst) ** (64 - k) for k in range(near_copies.FAR_BITS + 1, 65)) < 1 / 5000


def cheapest(tokens, quotas, copies):
    """Flow and cost of a minimum-cost maximum flow by Bellman and Ford, one unit at a time."""
    nodes = ["s", "t", *tokens, *quotas]
    arcs = []

    def arc(u, v, room, cost):
        arcs.extend(([u, v, room, cost], [v, u, 0, -cost]))

    for p, n in tokens.items():
        for k in range(1, copies + 1):
            arc("s", p, n, k)
        for s in p:
            if s in quotas:
                arc(p, s, 10**9, 0)
    for s, q in quotas.items():
        arc(s, "t", q, 0)
    flow = cost = 0
    while True:
        dist, came = {n: math.inf for n in nodes} | {"s": 0}, {}
        for _ in nodes:
            for k, (u, v, room, c) in enumerate(arcs):
                if room and dist[u] + c < dist[v]:
                    dist[v], came[v] = dist[u] + c, k
        if dist["t"] == math.inf:
            return flow, cost
        at = "t"
        while at != "s":
            k = came[at]
            arcs[k][2] -= 1
            arcs[k ^ 1][2] += 1
            at = arcs[k][0]
        flow, cost = flow + 1, cost + dist["t"]


def price(given_, tokens):
    return sum(min(n, tokens[p]) + 2 * max(0, n - tokens[p]) for p, n in given_.items())


def test_flow_costs_least():
    rnd = random.Random(8)
    for _ in range(25):
        names = ["a", "b", "c", "d"][: rnd.randint(1, 4)]
        tokens = {tuple(sorted(rnd.sample(names, rnd.randint(1, len(names))))): rnd.randint(1, 6) for _ in range(5)}
        quotas = {s: rnd.randint(0, 9) for s in names}
        got = mixing.route(tokens, quotas, 2)
        assert (sum(got.values()), price(got, tokens)) == cheapest(tokens, quotas, 2)


def test_op2_mixture_of_shared_texts(spark, tmp_path):
    """The registered query over texts that several sources hold: each pattern gives what a cheapest flow takes of it, to within one text."""
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randint(1, 4))) + f" t{k}" for k in range(300)]
    rows = [(None, texts[0] + " ", None), (None, None, "a"), (5000, "", "b")]
    for k, text in enumerate(texts):
        rows += [(len(rows), text if j == 0 else f" {text}\n", s) for j, s in enumerate(rnd.sample(["a", "b", "c", None], 1 if k % 3 else rnd.randint(2, 4)))]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    held, size, taken, serves = {}, {}, {}, {}
    for i, text, source in rows:
        key = re.sub(r"\s", "", text or "")
        held.setdefault(key, set()).add(source)
        size[key] = len((text or "").split())
    target = {r["source"]: r["target"] for r in got}
    name = lambda s: (s is None, s or "")
    by_id = {i: re.sub(r"\s", "", t or "") for i, t, _ in rows if i is not None}
    for r in got:
        key = by_id.get(r["doc_id"])
        if key is not None:
            assert r["sources"] == sorted(held[key], key=name)
            taken[key] = taken.get(key, 0) + r["mix_taken"]
        assert r["mix_source"] is None or r["mix_source"] in r["sources"]
        assert r["mix_taken"] in (0, r["size"], 2 * r["size"])
        serves[r["mix_source"]] = serves.get(r["mix_source"], 0) + r["mix_taken"]
    tokens = {}
    for key, sources in held.items():
        tokens[tuple(sorted(map(repr, sources)))] = tokens.get(tuple(sorted(map(repr, sources))), 0) + size[key]
    quotas = {repr(s): round(t) for s, t in target.items()}
    flow, cost = cheapest({p: n for p, n in tokens.items() if n}, quotas, 2)
    given_ = {}
    for key, n in taken.items():
        p = tuple(sorted(map(repr, held[key])))
        given_[p] = given_.get(p, 0) + n
    assert abs(sum(given_.values()) - flow) <= 6 * len(tokens) and abs(price(given_, tokens) - cost) <= 12 * len(tokens)
    assert all(serves.get(s, 0) <= t + 12 * len(tokens) for s, t in target.items())
    again = queries.op2_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_many_groups_of_sources_are_routed_in_tasks(spark):
    rows = [(k, 3, [f"s{k % 400}", f"s{k % 400 + (1 if k % 2 else 0)}"]) for k in range(2000)]
    docs = spark.createDataFrame(rows, "id bigint, size bigint, sources array<string>")
    quotas = {f"s{k}": 9 for k in range(401)}
    got = mixing.mix(docs, quotas).collect()
    served = {}
    for r in got:
        served[r["source"]] = served.get(r["source"], 0) + r["taken"]
    assert len(got) == 2000 and all(abs(served.get(f"s{k}", 0) - 9) <= 6 for k in range(400))


def test_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 200_000 + "ж" * 50_000), (1, "word " * 200_000 + "ж" * 50_000), (None, "a" * 300_000)], "doc_id bigint, text string")
    model = language_id.train(spark.createDataFrame([("word wording words", "en"), ("жжж жж", "ru")] * 5, "text string, lang string"))
    assert language_id.predict(docs.limit(0), model).count() == 0 and language_id.spans(docs.limit(0), model).count() == 0
    found = language_id.predict(docs, model).collect()
    assert [r["lang_pred"] for r in found if r["doc_id"] == 1] == ["en", "en"] and len(found) == 3
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    texts = spark.createDataFrame([(k, "awful beast " * 3 if k % 2 else "calm river " * 3) for k in range(40)], "doc_id bigint, text string")
    toxic = toxicity.train(texts, labels)
    assert toxicity.score(docs.limit(0), toxic).count() == 0 and len(toxicity.score(docs, toxic).collect()) == 3
    assert toxic.discount in toxicity.DISCOUNTS
    mixed = mixing.mix_by_source(docs.withColumn("source", F.lit(None).cast("string"))).collect()
    assert sorted(r["size"] for r in mixed) == [1, 200_001, 200_001] and {tuple(r["sources"]) for r in mixed} == {(None,)}


def test_language_stage_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(k, "the words of a text " * 5 if k % 2 else None, "en", "s", 9, 1.5, "x") for k in range(8)], "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, lang_pred string")
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 7]
    assert {(r["score"], r["lang_pred"]) for r in kept.collect()} == {(1.5, "x")}


def test_workers_forget_what_a_task_has_seen():
    """A Python worker serves tasks of other stages after this one, so tables of words and pieces must not outlive the task."""
    texts = pd.Series(["the words of a text", "12 34", "", "wörter eines textes"])
    model = language_id.LanguageModel(["de", "en"], np.zeros((language_id.BUCKETS, 2), np.float32), np.ones((len(language_id.SCRIPTS), 2), bool))
    told = language_id._told(iter([texts, texts[:0]]), model, 0.35)
    assert next(told).tolist() == [True, False, False, True] and model.seen
    assert [len(x) for x in told] == [0] and not model.seen and model.scores is None
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe._encoded(iter([pd.DataFrame({"doc_id": range(4), "text": texts})]), path, public_tokenizers.PATTERN)
    bpe, part, ids = next(found)
    assert bpe.seen and [bpe.decode(x).decode() for x in ids] == texts.tolist() and len(part) == 4
    assert not list(found) and not bpe.seen


def test_models_of_many_languages(spark):
    """More languages than any list of them: none is an error."""
    rows = [(f"{chr(0x4E00 + k)}{chr(0x4E00 + k + 1)} {chr(0x4E00 + k)}", f"l{k:03d}") for k in range(450)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.langs) == 450 and model.step < 1000
    got = language_id.predict(spark.createDataFrame([(k, rows[k][0]) for k in (0, 200, 449)], "doc_id bigint, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()} == {0: "l000", 200: "l200", 449: "l449"}


def test_conversations_with_clashing_columns_and_empty_roles(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 1, "", "b", "x"), (1, 2, "user", "c", "x"), (1, 3, "user", None, "x"), (2, 0, None, "", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string").withColumn("turns", F.lit(1))
    read = chat_format.read_back(chat_format.format_conversations(turns)).collect()
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in read} == {1: [("user", "a"), ("", "b"), ("user", "c"), ("user", "")], 2: [("", "")]}
