import datetime
import logging
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfind.plans import stream_queries
from wayfind.sources import posts
from wayfind.sources.scratch import scratch_path, shared_dir
from wayfind.streaming import streams

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    yield
    spark.conf.set(name, before)


def files(spark, root, batches, schema):
    """A stream of one micro-batch for each list of rows, in order."""
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def at(s):
    return datetime.datetime(2026, 1, 1) + datetime.timedelta(seconds=s)


def test_throttle_over_batches_and_a_restart(spark, tmp_path, rocksdb):
    def beats(batches, name):
        stream = files(spark, tmp_path, [[(g, at(s)) for g, s in batch] for batch in batches], "g string, ts timestamp")
        streams.throttled(stream, "g", 10, "0 seconds").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        return sorted((r["g"] or "", int((r["ts"] - at(0)).total_seconds())) for r in spark.read.schema("g string, ts timestamp").parquet(f"{tmp_path}/out").collect())

    first = [("", 59), ("a", 0), ("a", 12), ("a", 30)]
    assert beats([[("a", 5), ("a", 0), ("a", 12)], [("a", 19), ("a", 30), (None, 59)]], "one") == first
    # state outlives the query: 65 is held back by 59; the timer of a has gone off, so only what it holds is gone
    assert beats([[(None, 65), ("a", 60)], [(None, 69), ("a", 200)]], "two") == [("", 59), ("", 69), *first[1:], ("a", 60), ("a", 200)]


def test_plan(spark):
    jobs = spark.createDataFrame([("j", "daily", "vi", ["x.com"], "2026-01-02", "2026-01-03")], "job_id string, job_type string, profile string, sites array<string>, a string, b string")
    jobs = jobs.select("job_id", "job_type", "profile", "sites", F.col("a").cast("date").alias("date_from"), F.col("b").cast("date").alias("date_to"), F.lit(None).cast("string").alias("time_filter"), F.lit(None).cast("int").alias("split_days"))
    texts = spark.createDataFrame([("vi", "x.com", "w")], "profile string, site string, text string")
    assert [r["query"] for r in streams.planned(jobs, texts).collect()] == ["site:x.com w after:2026-01-01"]


MESSAGE = '{"job_id":"%s","job_type":"manual","search_sites":["x.com"],"date_from":"2026-05-01","date_to":"2026-05-01"}'


def test_a_dimension_that_changes_between_two_batches(spark, tmp_path):
    now = ["old"]
    stream = files(spark, tmp_path, [[(MESSAGE % "a",)], [(MESSAGE % "b",)]], "value string")

    def texts(session):
        word = now[0]
        now[0] = "new"  # it changes once a batch has read it
        return session.createDataFrame([("vi", "x.com", word)], "profile string, site string, text string")

    streams.plan_table(stream, ["vi"], "vi", texts, f"{tmp_path}/plan", f"{tmp_path}/state").awaitTermination()
    assert sorted((r["job_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/plan").collect()) == [("a", "old"), ("b", "new")]


def test_as_of(spark):
    rows = spark.createDataFrame([("k", 0), ("k", 5), ("k", 9), ("k", 99), ("z", 9), (None, 9)], "k string, at int")
    versions = spark.createDataFrame([("k", 5, "a"), ("k", 5, "b"), ("k", 9, "c"), (None, 0, "n")], "k string, since int, v string")
    assert sorted((r["at"], r["v"]) for r in streams.as_of(rows, versions, ["k"], "at").collect()) == [(5, "a"), (5, "b"), (9, "c"), (99, "c")]


def test_topic_options():
    assert streams.message_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"}
    assert streams.done_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_windows_close_and_late_rows_are_kept(spark, tmp_path):
    batches = [[(5, "a"), (70, "a"), (65, "b")], [(130, "a"), (30, "a"), (None, "a")], [(61, "b"), (200, "a"), (100, "b")], [(1, "a"), (121, "a")]]
    rows = [[(None if s is None else at(s), k, "result" if (s or 0) % 2 else "view", s) for s, k in batch] for batch in batches]
    stream = files(spark, tmp_path, rows, "ts timestamp_ntz, kind string, event string, duration_ms bigint")
    sinks = []
    streams.run, real = lambda stream, sink, checkpoint: sinks.append(sink) or real(stream, sink, checkpoint), streams.run
    try:
        streams.closing_table(stream, "ts", 60, 60, ["kind"], f"{tmp_path}/t", f"{tmp_path}/state").awaitTermination()
    finally:
        streams.run = real
    told = lambda: [sorted(map(repr, map(tuple, x.collect()))) for x in streams.read_closed(spark, f"{tmp_path}/t")]
    before = told()
    sinks[0](spark.createDataFrame(rows[3], "ts timestamp_ntz, kind string, event string, duration_ms bigint"), 3)  # a replay gives the same
    assert told() == before
    closed, still, late = streams.read_closed(spark, f"{tmp_path}/t")
    n = lambda x: sum(r["n"] for r in x.collect())
    # watermarks before each batch: none, 10, 70, 140; 30 is in a window that ended at 60, after 10; 1 and 61 come too late
    assert sorted(int((r["ts"] - at(0)).total_seconds()) for r in late.collect() if r["ts"]) == [1] and late.filter("ts is null").count() == 1
    assert sorted((int((r["start"] - at(0)).total_seconds()), r["kind"], r["n"]) for r in closed.collect()) == [(0, "a", 2), (60, "a", 1), (60, "b", 3)]
    assert n(closed) + n(still) + late.count() == sum(map(len, batches))


def test_progress_is_told_and_its_errors_stop_nothing(spark, tmp_path, caplog):
    told = []
    listener = streams.Progress(told.append)
    broken = streams.Progress(lambda counts: 1 / 0)
    spark.streams.addListener(listener)
    spark.streams.addListener(broken)
    try:
        stream = files(spark, tmp_path, [[("a", at(0)), ("b", at(100))], [("a", at(1)), ("c", at(101))], [("d", at(2)), ("e", at(102))]], "post_id string, found_at timestamp")
        seen = stream.observe("results", F.count(F.lit(1)).alias("found"))
        streams.bounded_posts(seen, "found_at", "10 seconds").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
        spark.streams.removeListener(broken)
    found = [x for x in told if "results" in x]
    assert sum(x["results"]["found"] for x in found) == 6 and sum(x["late"] for x in found) == 1
    assert spark.read.schema("post_id string").parquet(f"{tmp_path}/out").count() == 4
    with caplog.at_level(logging.WARNING):
        streams.guarded(lambda counts: 1 / 0, {})
    assert "progress" in caplog.text


def test_counts_of_posts_equal_the_tables(spark, tmp_path):
    batches = [[("a", 1, None), ("a", 2, None), ("b", 3, "ad"), (None, 4, None)], [("a", 5, None), ("c", 6, None)], [("c", 7, "ad")]]
    told = []

    def tell(counts):
        told.append(counts)
        raise RuntimeError("monitoring fails")

    stream = files(spark, tmp_path, batches, "post_id string, ord int, reject_reason string")
    streams.post_table(stream, ["ord"], f"{tmp_path}/posts", f"{tmp_path}/state", tell=tell).awaitTermination()
    assert told == [{"batch": 0, "found": 4, "rejected": 1, "inserted": 1}, {"batch": 1, "found": 2, "rejected": 0, "inserted": 1}, {"batch": 2, "found": 1, "rejected": 1, "inserted": 0}]
    table = posts.read_posts(spark, f"{tmp_path}/posts", "post_id string, ord int")
    assert sorted((r["post_id"], r["ord"], r["batch"]) for r in table.collect()) == [("a", 1, 0), ("c", 6, 1)]


def test_posts_come_once_over_batches(spark, tmp_path):
    given = [[("a", 2), ("a", 1), ("b", 1), (None, 1)], [("b", 0), ("c", 5), ("a", 0)], [("c", 1)]]
    schema = "post_id string, ord int"
    for k, batch in enumerate(given):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{tmp_path}/in{k}")

    def source(k):
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/in{k}")

    for k in range(3):  # a source each, one batch after the other by the number that a checkpoint would give
        sinks = []
        streams.run, real = lambda stream, sink, checkpoint: sinks.append(sink), streams.run
        try:
            streams.post_table(source(k), ["ord"], f"{tmp_path}/posts", f"{tmp_path}/state{k}")
        finally:
            streams.run = real
        for _ in range(2):  # a replay gives the same
            sinks[0](spark.read.schema(schema).parquet(f"{tmp_path}/in{k}"), k)
    table = posts.read_posts(spark, f"{tmp_path}/posts", schema)
    assert sorted((r["post_id"], r["ord"], r["batch"]) for r in table.collect()) == [("a", 1, 0), ("b", 1, 0), ("c", 5, 1)]
    assert len({r["post_bucket"] for r in table.filter("post_id = 'a'").collect()}) == 1


@settings(max_examples=200, deadline=None)
@given(held=st.lists(st.integers(-(2**63), 2**63 - 1), max_size=300), asked=st.lists(st.integers(-(2**63), 2**63 - 1), max_size=50))
def test_a_sketch_loses_no_post(held, asked):
    bits = posts.sketch(np.array(held, np.int64))
    assert posts.may_hold(bits, np.array(held, np.int64)).all()
    both = np.array(held + asked, np.int64)
    assert posts.may_hold(bits, both)[: len(held)].all()


def test_a_sketch_holds_little_else():
    random = np.random.default_rng(1)
    held, asked = random.integers(-(2**63), 2**63 - 1, 20_000), random.integers(-(2**63), 2**63 - 1, 500_000)
    assert posts.may_hold(posts.sketch(held), asked).mean() < 2e-4


def test_most_posts_are_neither_read_nor_shuffled(spark, tmp_path, monkeypatch):
    """Of a history of three batches only the folders with posts of the new one are read, and none of their rows is exchanged."""
    target = f"{tmp_path}/posts"
    for k in range(3):
        posts.insert(spark.range(k * 3000, (k + 1) * 3000).select(F.concat(F.lit("p"), "id").alias("post_id"), F.col("id").alias("ord")), target, k, ["ord"], 8)
    new = spark.createDataFrame([("p100", 0), ("p3100", 0), ("fresh", 0)], "post_id string, ord bigint")
    plans = []
    real = posts.held_posts

    def watched(rows, *args):
        known = real(rows, *args)
        if known is not None:
            plans.append((known.inputFiles(), rows.join(known, "post_id", "left_anti")._jdf.queryExecution().executedPlan().toString()))
        return known

    monkeypatch.setattr(posts, "held_posts", watched)
    assert posts.insert(new, target, 3, ["ord"], 8) == 1
    read, plan = plans[0]
    read = [f for f in read if target in f]
    assert len({f.rsplit("/", 1)[0] for f in read}) == 2 and not any("batch=2" in f for f in read)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert posts.read_posts(spark, target, "post_id string").filter("batch = 3").collect()[0]["post_id"] == "fresh"
    monkeypatch.setattr(posts, "MOST", 4)  # several sketches and lists to a bucket
    assert posts.insert(spark.range(50).select(F.concat(F.lit("p"), F.col("id") * 400).alias("post_id"), F.col("id").alias("ord")), target, 4, ["ord"], 8) == 50 - 23
    assert posts.insert(spark.range(50).select(F.concat(F.lit("p"), F.col("id") * 400).alias("post_id"), F.col("id").alias("ord")), target, 5, ["ord"], 8) == 0
    assert posts.insert(new.limit(0), target, 6, ["ord"], 8) == 0


def test_files_of_a_stream_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 50)
    stream = stream_queries._stream(spark, spark.range(3000).coalesce(1), batches=2)
    seen = []
    streams.run(stream, lambda batch, number: seen.append([r["n"] for r in batch.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]), scratch_path(spark, "state")).awaitTermination()
    assert len(seen) == 2 and sum(map(sum, seen)) == 3000 and max(map(max, seen)) <= 50


def test_versions_of_a_small_dimension_are_broadcast(spark, tmp_path, monkeypatch):
    rows = [(MESSAGE % f"j{k}", datetime.datetime(2026, 1, 1 + k % 3)) for k in range(6)]
    stream = files(spark, tmp_path, [rows], "value string, received timestamp_ntz")
    versions = spark.createDataFrame([("vi", "x.com", "a", datetime.datetime(2026, 1, 2)), ("vi", "x.com", "b", datetime.datetime(2026, 1, 3))], "profile string, site string, text string, since timestamp_ntz")
    joined = []
    inner = streams._fanned
    monkeypatch.setattr(streams, "_fanned", lambda r: joined.append(r._jdf.queryExecution().executedPlan().toString()) or inner(r))
    streams.plan_table(stream, ["vi"], "vi", lambda s: versions, f"{tmp_path}/plan", f"{tmp_path}/state", received="received").awaitTermination()
    assert sorted((r["job_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/plan").collect()) == [("j1", "a"), ("j2", "b"), ("j4", "a"), ("j5", "b")]
    assert "BroadcastHashJoin" in joined[0] and "SortMergeJoin" not in joined[0]
    assert not [x for x in os.listdir(shared_dir(spark).removeprefix("file://")) if x.startswith("versions-")]
