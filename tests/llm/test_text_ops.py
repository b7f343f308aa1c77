"""Text operators against brute force, round trips and odd rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfind.llm import byte_bpe, chat_format, exact_dedup, language_id, simhash, streamvbyte, substring_dedup, token_output, toxicity

DOCS = "doc_id bigint, text string, digest string, keep_id int, id string"
TEXTS = ["", None, "a b c", "a  b\tc", "abc", "x" * 3000, "ab " * 2000, "Ünï çøde 日本語 🎉 'st I'll", "\x00\x1c odd\x85 text", "a b c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "other", 7, "clash") for k, t in enumerate(TEXTS)] + [(3, "a  b\tc", "other", 7, "clash"), (None, "abc", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def by_id(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|im_end|>", "\\<|im_next|>\\", "<", "|>", "", None, "a\nb", "<\\|im_sep|>"]
    rows = [(1, k, "user" if k % 3 == 0 else "assistant", t) for k, t in enumerate(odd)] + [(2, 0, None, "x"), (2, 0, None, "x"), (None, None, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for template in (chat_format.ChatTemplate(), chat_format.ChatTemplate("<s>", "[INST]", "[/INST]", "</s>", ())):
        formatted = chat_format.format_conversations(turns, template)
        got = {r["conv_id"]: r for r in chat_format.read_back(formatted, template).collect()}
        assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r[2], r[3] or "") for r in rows if r[0] == 1]
        assert got[1]["loss_texts"] == [r[3] or "" for r in rows if r[0] == 1 and r[2] == "assistant"]
        assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", "x")] * 2 and got[None]["loss_texts"] == ["y"]
        assert got[1]["formatted"].count(template.end) == 6  # adjacent turns of a role are one message
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


def test_exact(spark, docs):
    def brute(digest):
        rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
        out = []
        for i, t in rows:
            group = [r for r in rows if norm(r[1]) == norm(t)]
            keep = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))[0]
            out.append((i, digest(norm(t)), keep, len(group), i == keep))
        return sorted(out, key=repr)

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by_id(exact_dedup.exact_dedup(docs)) == brute(sha)
    weak = exact_dedup.exact_dedup(docs, digest=lambda c: F.lit("same"))  # all digests collide: contents decide
    assert by_id(weak) == brute(lambda t: "same")
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[2] for r in brute(sha)}


def fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark, docs):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(40):
        base = [rnd.choice(words) for _ in range(300)]
        texts += [" ".join(base)] + [" ".join(base[:k] + ["Zz"] + base[k + 1 :]) for k in rnd.sample(range(300), 4)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string"))
    known, got = [*enumerate(TEXTS), *((100 + k, t) for k, t in enumerate(texts))], {}
    for r in simhash.near_duplicates(rows, bucket_rows=8).collect():  # so few that hot buckets are dealt again
        if r["doc_id"] is not None:
            assert r["fp"] & (2**64 - 1) == fingerprint(dict(known)[r["doc_id"]])
        got[r["doc_id"]] = r
    nodes = {i: r["fp"] & (2**64 - 1) for i, r in got.items() if i is not None}
    label = {i: i for i in nodes}
    changed = True
    while changed:
        changed = False
        for i in nodes:
            low = min(label[j] for j in nodes if (nodes[i] ^ nodes[j]).bit_count() <= 3)
            if low < label[i]:
                label[i], changed = low, True
    assert {i: got[i]["component_id"] for i in nodes} == label and len(set(label.values())) < len(label)
    assert simhash.near_duplicates(rows.limit(0)).count() == 0
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(rows).collect()} == set(label.values())


def test_near_links_of_a_ball():
    fp = np.array([7 ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)], np.uint64)
    fp = fp[np.argsort(simhash.gray_rank(fp))]
    assert set(simhash.near_links(fp, np.zeros(len(fp), np.int64), 3)) == {0}
    assert set(simhash.near_links(fp, np.arange(len(fp)), 3)) == set(range(len(fp)))


def test_language(spark, docs):
    rnd = random.Random(1)
    say = lambda syllables, n: " ".join("".join(rnd.choice(syllables) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["ka", "ta", "no"], "bb": ["wur", "gen", "sch"], "ru": ["да", "не", "мо"]}
    train = spark.createDataFrame([(say(s, 60), k) for k, s in kinds.items() for _ in range(20)] + [(None, "aa"), ("x", None)], "text string, lang string")
    model = language_id.train(train)
    assert model.langs == ["aa", "bb", "ru"]
    mixed = f"{say(kinds['aa'], 30)}. {say(kinds['ru'], 50)}"
    tests = spark.createDataFrame([(k, say(s, 40)) for k, s in enumerate(kinds.values())] + [(3, mixed), (4, "12 ,.!"), (5, None), (6, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(tests, model).collect()}
    assert [got[k][0] for k in range(7)] == ["aa", "bb", "ru", "ru", "und", "und", "und"] and 0.5 < got[3][1] < 0.8 and got[5][1] == 0
    assert [r["lang"] for r in language_id.spans(tests.filter("doc_id = 3"), model).orderBy("start").collect()] == ["aa", "ru"]
    assert len(language_id.predict(docs, model).collect()) == docs.count()
    none = language_id.train(train.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}


def test_best_path_is_the_best():
    rnd = np.random.default_rng(0)
    model = language_id.LanguageModel(["a", "b"], np.zeros((language_id.BUCKETS, 2), np.float32), np.ones((len(language_id.SCRIPTS), 2), bool), switch=1.5)
    for _ in range(50):
        scores = rnd.normal(size=(8, 2)).astype(np.float32)
        value = lambda p: sum(scores[t, k] for t, k in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        best = max(value([m >> t & 1 for t in range(8)]) for m in range(256))
        assert abs(value(model.path(scores).tolist()) - best) < 1e-4


def test_toxicity(spark, docs):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    plain = lambda: [rnd.choice(words) for _ in range(80)]
    texts, marks = [], []
    for k in range(400):
        own = plain()
        if k % 4 == 0:
            for at in rnd.sample(range(80), 3):
                own[at] = rnd.choice(["zorkx", "zorkxes", "qwyzzt"])
        texts.append(" ".join(own))
        marks.append(int(k % 4 == 0))
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, m) for k, m in enumerate(marks) if k < 300] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(table, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(table, model).collect()}
    right = [got[k] == marks[k] for k in range(300, 400)]
    assert sum(right) >= 97
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in toxicity.score(docs, toxicity.train(table, labels.filter("toxic = 0"))).collect()} == {0.0}


def test_token_output(spark, docs, tmp_path):
    path = P.path("word_bpe_49k.json")
    token_output.write_dataset(docs, f"file://{tmp_path}/d", path, 1)
    ids = token_output.read_dataset(spark, f"file://{tmp_path}/d")
    read = token_output.read_digests(spark, f"file://{tmp_path}/d")
    assert {(r["start"], zlib.crc32(r["ids"])) for r in ids.collect()} == {(r["start"], r["ids_crc32"]) for r in read.collect()}
    tok, at = Tokenizer.from_file(path), 0
    expected = []
    for i, t in sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, np.array([*tok.encode(r[1], add_special_tokens=False).ids, 1], "<u4").tobytes())):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read.orderBy("start").collect()]
    assert got == expected
    token_output.write_dataset(docs.limit(0), f"file://{tmp_path}/e", path, 1)
    assert token_output.read_dataset(spark, f"file://{tmp_path}/e").count() == 0


def test_token_starts_across_parts(spark, tmp_path):
    path, key = P.path("word_bpe_49k.json"), "spark.sql.adaptive.coalescePartitions.enabled"
    texts = [" ".join(["word"] * (k % 7)) for k in range(60)]
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        token_output.write_dataset(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), f"file://{tmp_path}/p", path, 1)
    finally:
        spark.conf.set(key, before)
    assert spark.read.parquet(f"{tmp_path}/p/blocks").select("part").distinct().count() > 1
    tok, at, expected = Tokenizer.from_file(path), 0, []
    for k, t in enumerate(texts):
        expected.append((k, at))
        at += len(tok.encode(t, add_special_tokens=False).ids) + 1
    for read in (token_output.read_dataset, token_output.read_digests):
        assert sorted((r["doc_id"], r["start"]) for r in read(spark, f"file://{tmp_path}/p").collect()) == expected


def test_streamvbyte():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rnd.integers(0, 2**32, n, dtype=np.uint64) >> rnd.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = streamvbyte.encode(v)
        assert len(control) == -(-n // 4) and (streamvbyte.decode(control, data, n) == v).all()


def test_byte_bpe(spark, docs):
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in byte_bpe.encode_documents(docs.filter("doc_id is not null"), path, P.PATTERN).collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == enc.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab cd\né😀1'st ") for _ in range(rnd.randint(0, 400))) for _ in range(300)] + ["a" * 20000, "ab" * 3000]
    bpe = byte_bpe.load(path, P.PATTERN)
    assert [x.tolist() for x in bpe.encode_batch(texts)] == [enc.encode_ordinary(t) for t in texts]
    assert byte_bpe.digest_documents(docs, path, P.PATTERN).count() == docs.count()


def test_substring(spark):
    shared = "one two three four five six."
    rows = [(2, f"Own words stand in here first. {shared} And so on it goes now."), (1, f"Quite other words at the start {shared}\n{shared.upper()}"), (3, "Nothing that repeats stands in here."), (None, shared), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or -1, r["start"], r["end"], r["keep_doc_id"], r["keep_start"], r["copies"]) for r in substring_dedup.repeated_spans(docs).collect())
    start = rows[1][1].index(shared.upper())
    assert got == [(-1, 0, len(shared), 1, start, 3), (2, 31, 31 + len(shared), 1, start, 3)]
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.remove_spans(docs, substring_dedup.repeated_spans(docs)).collect()}
    assert cut[2] == "Own words stand in here first.  And so on it goes now." and cut[1] == rows[1][1] and cut[4] is None
    lines = spark.createDataFrame([(1, "a b c d e\nf"), (2, "f\nA  b c d e")], "doc_id bigint, text string")
    assert [(r["doc_id"], r["start"]) for r in substring_dedup.repeated_spans(lines, unit="line").collect()] == [(2, 2)]
    assert substring_dedup.repeated_spans(docs.limit(0)).count() == 0


def test_substring_short_lines(spark):
    rows = [(1, "Read more\n日本語の文です\nYes. No. Go on. Well then."), (2, "日本語の文です\nOwn text.\n read  MORE"), (3, "Yes. No.  Go on. Well then.\nNo.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"], rows[r["doc_id"] - 1][1][r["start"] : r["end"]], r["keep_doc_id"], r["keep_start"], r["copies"]) for r in substring_dedup.repeated_spans(docs).collect())
    assert got == [(2, "read  MORE", 1, 0, 2), (2, "日本語の文です", 1, 10, 2), (3, "Yes. No.  Go on. Well then.", 1, 18, 2)]
