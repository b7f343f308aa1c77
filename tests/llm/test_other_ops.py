"""Mixing, embeddings and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wayfind.llm import embedding_dedup, exact_dedup, language_id, mixing, near_copies
from wayfind.llm.common import connected_components, id_crc

SF = "/root/testdata/sf0.001"


def test_components(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(1, k) for k in range(2, 50)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (3, 2), (None, 4), (80, 80)], "u bigint, v bigint")
    got = dict(map(tuple, connected_components(edges).collect()))
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 50)}}
    assert connected_components(edges.limit(0)).count() == 0


def fill(sizes, weights, share, cap):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while over := [s for s in open_ if left * w[s] / sum(w[x] for x in open_) > cap * sizes[s]]:
        for s in over:
            out[s] = cap * sizes[s]
            open_.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out | {s: left * w[s] / sum(w[x] for x in open_) for s in open_}


def test_targets_and_choice(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 40))) if k % 50 else None, [None, "a", "b", "c", "d"][int(rng.choice(5, p=[0.05, 0.6, 0.2, 0.1, 0.05]))], "x") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken string")
    got = mixing.mix_by_source(docs).toPandas()
    sizes = {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in {r[2] for r in rows}}
    aims = fill(sizes, (5, 2, 1), 1.5, 2.0)
    got["source"] = got["source"].where(got["source"].notna(), None)
    for s, own in got.groupby(got["source"].map(str)):
        s = None if s == "None" else s
        assert own["target"].iloc[0] == pytest.approx(aims[s]) and own["source_size"].iloc[0] == sizes[s]
        assert abs(own["taken"].sum() - aims[s]) < 40  # less than one document
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == len(rows)
    again = mixing.mix_by_source(docs.repartition(7)).toPandas()
    assert dict(zip(got["doc_id"], got["taken"])) == dict(zip(again["doc_id"], again["taken"]))
    taken = mixing.take(docs, mixing.mix_by_source(docs))
    assert taken.columns == docs.columns
    assert mixing.mix_by_source(docs.limit(0)).count() == 0


def test_repeated_ids_are_chosen_each_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k % 40), " ".join(["w"] * int(rng.integers(1, 30))), "ab"[k % 2]) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_by_source(docs).toPandas()
    for _, own in got.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) < 5
    again = mixing.mix_by_source(docs.repartition(5)).toPandas()
    key = ["doc_id", "size", "source", "taken"]
    assert sorted(got[key].itertuples(index=False)) == sorted(again[key].itertuples(index=False))


def test_mix_says_which_source_a_document_serves(spark):
    rows = [(k, 1 + k % 5, [["a"], ["a", "b"], ["c"], ["b", "a"], []][k % 5]) for k in range(500)]
    docs = spark.createDataFrame(rows, "id bigint, size bigint, sources array<string>")
    tokens = {}
    for _, n, s in rows:
        tokens[tuple(sorted(s))] = tokens.get(tuple(sorted(s)), 0) + n
    quotas = {"a": 600, "b": 400, "c": 250}
    given, served = mixing.route({p: n for p, n in tokens.items() if "a" in p or "b" in p}, quotas, 2), {}
    for r in mixing.mix(docs, quotas).collect():
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and (r["source"] is None) == (r["taken"] == 0)
        assert r["source"] is None or r["source"] in r["sources"]
        served[r["source"]] = served.get(r["source"], 0) + r["taken"]
    assert abs(served["a"] + served["b"] - sum(given.values())) < 20 and abs(served["a"] - 600) < 20 and abs(served["b"] - 400) < 20 and abs(served["c"] - 250) < 10


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(5)
    sizes = {f"s{k}": int(rng.integers(0, 5000)) for k in range(300)} | {None: 77}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    assert got == pytest.approx(fill(sizes, (5, 2, 1), 1.5, 2.0))


def test_flow_of_overlapping_sources():
    tokens = {("a",): 100, ("a", "b"): 100, ("b",): 50}
    given = mixing.route(tokens, {"a": 150, "b": 100}, 2)
    assert sum(given.values()) == 250 and given == tokens  # once each fills both quotas, though a's own comes first
    given = mixing.route(tokens, {"a": 100, "b": 300}, 2)
    assert given[("b",)] == 100 and given[("a", "b")] == 200 and sum(given.values()) == 400
    assert mixing.route({("a",): 10}, {"b": 5}, 2) == {("a",): 0}


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 24)) * np.r_[5, 3, 2, np.ones(21)]
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.1, 0.3, 0.6)] + [base[:5], base[:5] * 3])
    rows = [(k, v.tolist(), int(k % 3)) for k, v in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, [None] * 24, 1), (904, [], 1), (905, base[0].tolist(), None), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (None, base[0].tolist(), 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id bigint, embedding array<double>, label int, n_links string")
    ids = [r[0] for r in rows] + [906, 907]
    vec = [np.array(r[1]) for r in rows] + [np.array([1.0, 2.0]), np.array([2.0, 4.0])]
    lab = [r[2] for r in rows] + [1, 1]
    link = {a: [b for j, b in enumerate(ids) if j != i and lab[i] == lab[j] and len(vec[i]) == len(vec[j]) and vec[i] @ vec[j] / np.linalg.norm(vec[i]) / np.linalg.norm(vec[j]) >= 0.93] for i, a in enumerate(ids)}
    comp = {i: i for i in ids}
    while any(comp[j] < comp[i] and not comp.update({i: comp[j]}) for i in ids for j in link[i]):
        pass
    for tile in (8, 1024):
        got = {r["vec_id"]: r for r in embedding_dedup.near_links(frame, tile=tile).collect()}
        assert len(got) == len(rows) + len(odd)
        assert {i: got[i]["n_links"] for i in ids} == {i: len(v) for i, v in link.items()}
        assert {i: got[i]["component_id"] for i in ids} == comp and all(got[i]["kept"] == (comp[i] == i) for i in ids)
        assert all(got[i]["n_links"] == 0 for i in (900, 901, 902, 903, 904, 905, None)) and got[905]["component_id"] == 905 and not got[None]["kept"]
    assert embedding_dedup.near_links(frame.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [1e200, 2e200], 1), (2, [1e160, 2.1e160], 1), (3, [1e-200, 2e-200], 1), (4, [1e300, -1e300], 1)], "vec_id bigint, embedding array<double>, label int")
    assert {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_links(huge).collect()} == {1: 2, 2: 2, 3: 2, 4: 0}


def test_band_join_of_tiles(spark):
    """Tiles along the first coordinate: every pair of tiles that boxes allow, and each once."""
    rng = np.random.default_rng(2)
    rows = [("x", 2, f"t{k}", 2 * k + m, 1, [1.0, 2.0], [float(v), float(v) / 2] + [0.0] * 6) for k, x in enumerate(np.sort(rng.uniform(-1, 1, 60))) for m, v in enumerate((x, min(1.0, x + rng.uniform(0, 0.5))))]
    tiled = spark.createDataFrame(rows, "label string, dim int, tile string, rep bigint, n bigint, embedding array<double>, lead array<double>")
    box = {}
    for r in rows:
        box.setdefault(r[2], []).append(r[6][:2])
    box = {t: np.array(v) for t, v in box.items()}
    gap = lambda a, b: np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
    expected = {frozenset((s, t)) for s in box for t in box if (gap(box[s], box[t]) ** 2).sum() <= 2 - 2 * 0.93}
    got = [frozenset((r["a"], r["b"])) for r in embedding_dedup._tile_pairs(tiled, 0.93).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_leading_coordinates_lose_no_pair(spark):
    """Whole vectors follow only where a partner may be: few of a cloud without structure, and all that link, for pairs about the threshold and ids that repeat."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(400, 48))
    near = base[:120] + rng.normal(size=(120, 48)) * rng.uniform(0.2, 0.6, size=(120, 1))
    x = np.concatenate([base, near])
    rows = [(k % 500, v.tolist(), "c", 1) for k, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string, tile int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.93, 1))
    assert 20 < len(a) < 120
    classes = embedding_dedup.distinct_vectors(frame)
    axes = embedding_dedup.principal_axes(classes)
    tiled = embedding_dedup._tiled(classes, axes, 32).cache()
    pairs = embedding_dedup._tile_pairs(tiled, 0.93)
    sent = embedding_dedup._in_pairs(tiled, pairs, "rep").count()
    met = embedding_dedup._with_partner(tiled, pairs, 0.93).toPandas()
    assert not met.duplicated(["a", "b", "side", "h1", "h2"]).any() and len(met) < sent / 4
    numbered = spark.createDataFrame([(k, v.tolist(), "c") for k, v in enumerate(x)], "vec_id bigint, embedding array<double>, label string")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_links(numbered, tile=32).collect()}
    assert [got[k] for k in range(len(x))] == np.bincount(np.concatenate([a, b]), minlength=len(x)).tolist()
    repeated = embedding_dedup.near_links(frame, tile=32).collect()
    assert len(repeated) == len(rows) and all(r["component_id"] <= r["vec_id"] for r in repeated)


def shingles(text, n=5):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text).encode().split()
    return {b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def stays(texts, least=0.8):
    """Smallest ids of the groups that similarities of at least `least` link."""
    sets, label = {i: shingles(t or "") for i, t in texts.items()}, {i: i for i in texts}
    pairs = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) > 0]
    while any(label[i] != label[j] and not label.update(dict.fromkeys((i, j), min(label[i], label[j]))) for i, j in pairs):
        pass
    return sorted(set(label.values()))


def edited(rnd, words, times):
    words = list(words)
    for at in rnd.sample(range(len(words)), times):
        words[at] = f"new{rnd.random()}"
    return words


@pytest.mark.parametrize("block", [4, 2048])
def test_near_copies(spark, tmp_path, block):
    rnd = random.Random(9)
    texts = {}
    for k in range(25):
        base = [f"w{rnd.randrange(500)}" for _ in range(rnd.choice([6, 30, 120, 300]))]
        texts[10 * k] = " ".join(base)
        for m in range(1, rnd.randrange(2, 9)):
            base = base if rnd.random() < 0.5 else edited(rnd, base, max(1, len(base) // 60))  # chains drift away from their first document
            texts[10 * k + m] = " ".join(edited(rnd, base, max(1, len(base) // rnd.choice([60, 100, 200]))))
    texts |= {900: None, 901: "", 902: " \n", 903: "one two", 904: "ONE  two", 905: "three"}
    rows = [(i, t, "clash") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, node string")
    got = near_copies.drop_near_copies(docs, block=block)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == stays(texts)
    assert 10 < len(stays(texts)) < len(texts) - 20
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    assert sorted(r["doc_id"] for r in near_copies.drop_near_copies(read, block=block).collect()) == stays(texts)
    assert near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_near_links_through_fingerprints(spark):
    """Documents that share no bucket of minimum hashes are linked if the index links their fingerprints and their sets are similar."""
    alike, odd = np.arange(50, dtype=np.uint32), np.arange(100, 150, dtype=np.uint32)
    sets = [(1, 0b0, alike), (2, 0b11, alike[1:]), (3, 0b1111, alike[2:]), (4, 0b1, odd), (5, 0b10001111, odd), (6, 0b0, alike[3:]), (7, -1, alike)]
    rows = [((False, k, 0, k), fp, [1000 * k + t for t in range(near_copies.TABLES)], bytearray(s.tobytes())) for k, fp, s in sets]
    marked = spark.createDataFrame(rows, "node struct<unnamed:boolean,id:bigint,f:bigint,r:bigint>, fp bigint, buckets array<bigint>, shingles binary")
    joined = connected_components(near_copies.links(marked, 0.8)).collect()
    assert {r["node"]["id"]: r["component"]["id"] for r in joined} == {1: 1, 2: 1, 3: 1, 6: 1, 4: 4, 5: 4}  # 7 has a fingerprint like no other


def test_rows_without_ids_of_their_own(spark):
    """Null ids, repeated ids and repeated rows in every stage that drops or repeats rows."""
    text, other = "one two three four five six seven eight", "quite another text of some words here"
    rows = [(None, text, "s"), (None, text, "s"), (None, other, "s"), (7, "p q", "s"), (7, "r s t", "s"), (7, "p q", "s"), (None, None, None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    content = lambda frame: sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)
    once = exact_dedup.drop_exact_duplicates(docs)
    assert len(content(once)) == 5 and {(None, text), (None, other), (7, "p q"), (7, "r s t")} <= set(content(once))
    assert content(near_copies.drop_near_copies(docs)) == sorted([(None, text), (None, other), (7, "p q"), (7, "r s t"), (None, None), (None, "")], key=repr)
    taken = content(mixing.take_by_source(docs, weights=(1,), share=1.0))
    assert taken == sorted([(i, t) for i, t, s in rows if t], key=repr)  # the whole source, each row once


def test_registered_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    told = corpus_pipeline.language(spark, docs, SF)
    alone = corpus_pipeline.near(spark, corpus_pipeline.exact(spark, told, SF), SF)
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_by_source(alone).collect() if r["size"]}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i, n in times.items() for _ in range(n))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got.collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_001, "12 34", "en", "src0", 5), (10_002, None, None, None, None), (10_003, "", "en", "src0", 0)], docs.schema)
    docs = docs.unionByName(extra)
    ids = lambda frame: sorted(r["doc_id"] for r in frame.select("doc_id").collect())
    told = corpus_pipeline.language(spark, docs, SF)
    assert told.columns == docs.columns and set(ids(docs)) - set(ids(told)) == {10_001, 10_002, 10_003}
    model = language_id.train(docs.filter(id_crc() % 5 != 0), order_by=F.col("doc_id"))
    assert language_id.predict(told, model).filter(F.col("score") < corpus_pipeline.LEAST_SHARE).count() == 0
    once = corpus_pipeline.exact(spark, told, SF)
    assert ids(once) == sorted({r["keep_id"] for r in exact_dedup.exact_dedup(told).collect()})
    alone = corpus_pipeline.near(spark, once, SF)
    assert ids(alone) == stays({r["doc_id"]: r["text"] for r in once.collect()})
    mixed = corpus_pipeline.mixture(spark, alone, SF)
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_by_source(alone).collect() if r["size"]}
    assert mixed.columns == docs.columns and ids(mixed) == sorted(i for i, n in times.items() for _ in range(n))
    assert ids(corpus_pipeline.tokens(spark, mixed, SF)) == ids(mixed)
