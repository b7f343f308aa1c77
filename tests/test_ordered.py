"""Operators on groups that may be hot, against plain loops, with one group in several tasks."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfind.operators import accounting, ledger, ordered


@pytest.fixture
def spread(spark):
    """As on large tables: no partitions made one, no side of a join broadcast."""
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def throttled(times, least):
    out = []
    for t in sorted(times):
        if not out or t - out[-1] >= least:
            out.append(t)
    return out


TIMES = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 4000)), max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=TIMES, least=st.sampled_from([1, 7, 60, 1000]))
def test_spaced(spark, rows, least):
    got = ordered.spaced(spark.createDataFrame([*rows, ("c", None)], "g string, t bigint"), "g", "t", least).collect()
    expected = [(g, t) for g in ("a", "b", None) for t in throttled([x for h, x in rows if h == g], least)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_a_long_chain_of_one_group_in_many_tasks(spark, spread):
    random.seed(3)
    times = sorted(random.sample(range(200_000), 4_000))
    frame = spark.createDataFrame([("g", t) for t in times], "g string, t bigint")
    got = ordered.spaced(frame, "g", "t", 90).withColumn("part", F.spark_partition_id()).collect()
    assert sorted(r["t"] for r in got) == throttled(times, 90)
    assert len({r["part"] for r in got}) > 1


def test_two_events_a_second_apart_across_a_minute(spark):
    frame = spark.createDataFrame([("g", "2026-01-01 00:00:59"), ("g", "2026-01-01 00:01:00"), ("g", "2026-01-01 00:01:59"), ("g", "2026-01-01 00:02:00")], "g string, t string").select("g", F.col("t").cast("timestamp_ntz").alias("ts"))
    assert sorted(r["ts"].strftime("%M:%S") for r in ledger.heartbeats(frame, "g", 60).collect()) == ["00:59", "01:59"]


def test_pacing_of_a_hot_key(spark, spread):
    random.seed(5)
    given_rows = [(k, "hot" if k % 10 else None, random.randrange(40_000_000)) for k in range(500)] + [(1000, "hot", None), (1001, "hot", 7), (1002, "hot", 7)]
    told = accounting.pacing(spark.createDataFrame(given_rows, "id int, key string, ms bigint"), "key", "ms", 20_000).withColumn("part", F.spark_partition_id()).collect()
    assert len(told) == len(given_rows) and len({r["part"] for r in told if r["key"] == "hot"}) > 1
    for key in ("hot", None):
        times = sorted(t for _, k, t in given_rows if k == key and t is not None)
        gaps = sorted(b - a for a, b in zip(times, times[1:]))
        own = [r for r in told if r["key"] == key and r["ms"] is not None]
        assert sorted(r["gap_ms"] for r in own if r["gap_ms"] is not None) == gaps and sum(r["gap_ms"] is None for r in own) == 1
        assert all(r["too_fast"] == (r["gap_ms"] is not None and r["gap_ms"] < 20_000) for r in own)
    assert [(r["gap_ms"], r["too_fast"]) for r in told if r["id"] == 1000] == [(None, False)]


def test_stop_of_a_hot_label(spark, spread):
    random.seed(7)
    events = [(k, "hot" if k % 5 else None, random.choice(["offered", "attempt"]), random.randrange(300_000)) for k in range(600)]
    frame = spark.createDataFrame(events, "event_id int, label string, event string, s bigint").select("event_id", "label", "event", F.timestamp_add("SECOND", F.col("s"), F.lit("2026-01-01").cast("timestamp_ntz")).alias("ts"))
    for target, limit in ((5, 10**9), (200, 10**9), (10**6, 100_000), (100, 90_000), (10**6, 10**9)):
        got = {r["label"]: (r["event_id"], r["stop_reason"]) for r in ledger.stop_point(frame, "label", target, limit).collect()}
        expected = {}
        for label in ("hot", None):
            own = sorted((s, k, e) for k, x, e, s in events if x == label)
            n = 0
            for s, k, e in own:
                n += e == "offered"
                if n >= target or s - own[0][0] >= limit:
                    expected[label] = (k, "target_reached" if n >= target else "time_limit")
                    break
        assert got == expected


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", None, "b"]), st.one_of(st.none(), st.integers(-5, 5), st.integers(-(10**12), 10**12))), max_size=40))
def test_order_statistics(spark, rows):
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    frame = spark.createDataFrame(rows, "k string, v bigint")

    def exact(values):
        values = sorted(values)
        return tuple(values[max(0, math.ceil(len(values) * q) - 1)] if values else None for q in wanted.values())

    got = {r["k"]: tuple(r[x] for x in wanted) for r in ordered.order_statistics(frame, ["k"], "v", wanted).collect()}
    assert got == {k: exact([v for x, v in rows if x == k and v is not None]) for k in {k for k, v in rows if v is not None}}
    assert [tuple(r) for r in ordered.order_statistics(frame, [], "v", wanted).collect()] == [exact([v for _, v in rows if v is not None])]


def test_no_window_holds_all_values_of_a_group(spark, spread):
    """One group of many different values: ranks are found by counts of digits, at most 1,024 to a window."""
    frame = spark.range(50_000).select(F.lit("g").alias("k"), (F.col("id") * 7919 % 1_000_003).alias("v"))
    got = ordered.order_statistics(frame, ["k"], "v", {"p50": 0.5})
    assert got.first()["p50"] == sorted(k * 7919 % 1_000_003 for k in range(50_000))[24_999]


def test_product_is_dealt(spark, spread):
    got = ordered.product(spark.range(200), spark.range(3).select(F.col("id").alias("b"))).withColumn("part", F.spark_partition_id()).collect()
    assert sorted((r["id"], r["b"]) for r in got) == [(a, b) for a in range(200) for b in range(3)] and len({r["part"] for r in got}) > 1


def test_backfill_that_was_stopped(spark):
    items = spark.createDataFrame([("r", 5, 1, "ok"), ("s", 5, 1, "skipped"), ("t", 2, 2, "ok")], "run_id string, raw int, inserted int, status string")
    runs = spark.createDataFrame([("r", True), ("s", False), ("t", False), ("u", None)], "run_id string, stopped boolean")
    assert {r["run_id"]: (r["discovered"], r["ok"]) for r in accounting.run_close(items, runs).collect()} == {"r": (5, False), "s": (5, False), "t": (2, True), "u": (0, True)}
    assert {r["run_id"]: r["status"] for r in accounting.run_close(items).collect()} == {"r": "completed", "s": "failed", "t": "completed"}
