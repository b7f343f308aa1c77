"""Lookups, runs, labels, samples: the cases of errors, absences and ties that the test tables don't hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from wayfind.functions import dates, text
from wayfind.operators import accounting, ledger, lookups, plan, triggers
from wayfind.sources import scratch, tables


def rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_missing_platform_and_run_are_errors(spark):
    platforms = spark.createDataFrame([(1, "x.com")], "platform_id int, domain string")
    sites = spark.createDataFrame([("x.com", 1), ("x.com", 2)], "site string, window int")
    assert rows(lookups.with_platform(sites, platforms), "site", "platform_id") == [("x.com", 1)] * 2
    with pytest.raises(Exception, match="unknown platform: y.com"):
        lookups.with_platform(sites.withColumn("site", F.lit("y.com")), platforms).collect()
    runs = spark.createDataFrame([("x.com", 1, "r")], "site string, window int, run_id string")
    with pytest.raises(Exception, match=r"missing run: x.com\|2"):
        lookups.with_run(sites, runs).collect()
    assert rows(lookups.with_run(sites.filter("window = 1"), runs), "run_id") == [("r",)]


def test_keywords(spark, tmp_path):
    table = spark.createDataFrame([(2, "b", "p", True), (1, "a", "p", False), (3, "c", None, True)], "keyword_id int, keyword string, province string, is_enabled boolean")
    assert [r["keyword_id"] for r in tables.load_keywords(table).collect()] == [2, 3]
    assert [r["keyword_id"] for r in tables.load_keywords(table, [1, 2]).collect()] == [1, 2]
    assert tables.keywords_by_ids(table, []).count() == 0
    with pytest.raises(ValueError):
        tables.load_keywords(table, [99])
    items = spark.createDataFrame([("p",), ("q",), (None,)], "province string")
    assert rows(lookups.with_keyword(items, table), "province", "keyword_id", "skip_reason") == sorted([("p", 1, None), ("q", None, "province q has no keyword"), (None, None, "province null has no keyword")], key=repr)


def test_query_text_takes_the_last_site(spark):
    planned = spark.createDataFrame([("q", "a", 1), ("q", "b", 2)], "query string, site string, ord int")
    given = spark.createDataFrame([("q",), ("other",)], "query string")
    assert rows(lookups.with_query_site(given, planned, "ord"), "query", "site") == [("other", None), ("q", "b")]


def test_run_window(spark):
    d = lambda x: F.lit(x).cast("date")
    w = spark.range(1).select(dates.run_window(d("2026-05-01"), d("2026-05-02")).alias("w")).first()["w"]
    assert (w["start"], w["end"]) == (datetime.datetime(2026, 4, 30, 17), datetime.datetime(2026, 5, 2, 16, 59, 59))
    assert [spark.range(1).select(dates.run_type(F.lit(x)).alias("t")).first()["t"] for x in ("manual", "daily")] == ["backfill", "daily"]


def test_third_request_stops_a_run_of_two(spark):
    given = [(k, f"2026-01-0{1 + k // 3} 00:00:0{k % 3}", "ab"[k % 5 == 0]) for k in range(9)]
    frame = spark.createDataFrame(given, "request int, t string, key string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = {r["request"]: (r["total"], r["allowed"], r["stop"]) for r in accounting.credit_stop(frame, 2, 99).collect()}
    assert [k for k, x in got.items() if x[1]] == [0, 1] and [k for k, x in got.items() if x[2]] == [2]
    got = {r["request"]: (r["key_total"], r["total"], r["allowed"], r["stop"]) for r in accounting.credit_stop(frame, 4, 3).collect()}
    seen, used, expected = 0, {}, {}
    for k, _, key in given:
        used[key] = used.get(key, 0) + 1
        seen += used[key] <= 3
        expected[k] = (used[key], seen, used[key] <= 3 and seen <= 4, used[key] <= 3 and seen == 5)
    assert got == expected
    assert accounting.credit_stop(frame.limit(0), 2, 2).count() == 0


def test_labels(spark):
    entries = spark.createDataFrame([(1, "b", "private"), (2, "a", "rotating"), (3, "h:1", "public"), (4, "b", "public"), (5, "c", "public"), (6, "d", "public")], "ord int, label string, kind string")
    assert [tuple(r) for r in ledger.selected_labels(entries, 2).collect()] == [("b", "private", 1), ("c", "public", 5)]
    assert [r["label"] for r in ledger.selected_labels(entries, 9, ["d", "a"]).collect()] == ["d"]
    assert ledger.require_labels(entries, ["c", "d"]).count() == 2
    for wrong in (["c", "zz"], ["a"]):
        with pytest.raises(ValueError):
            ledger.require_labels(entries, wrong)


def test_snapshot(spark):
    t = lambda s: f"2026-01-02 00:00:{s:02d}"
    events = [("a", "p", "attempt", None, t(1)), ("b", "p", "attempt", None, t(1)), ("b", "p", "result", "blocked", t(5)), ("c", "p", "attempt", None, "2026-01-01 00:00:00"), ("c", "p", "result", "ok", t(2)), ("d", "p", "attempt", None, t(50))]
    frame = spark.createDataFrame(events, "label string, kind string, event string, outcome string, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    now = F.lit(t(30)).cast("timestamp_ntz")
    assert rows(ledger.snapshot(frame, now, {"blocked": 60}), "label", "uses_today", "active", "blocked") == [("a", 1, True, False), ("b", 1, False, True), ("c", 0, False, False)]
    assert rows(ledger.snapshot(frame, now, {"blocked": 20}), "label", "blocked")[1] == ("b", False)


def test_samples_fall_back(spark):
    chunks = spark.createDataFrame([("k2", "da", "A", 2), ("k1", "da", "A", 1), ("k3", "da", "B", 0)], "key string, province string, tier string, ord int")
    spare = spark.createDataFrame([("k9", "z", "C", 9), ("k8", "z", "C", 8)], "key string, province string, tier string, ord int")
    assert rows(plan.samples(chunks, spare, "da"), "key") == [("k1",), ("k8",)]
    assert rows(plan.samples(chunks.unionByName(spare.limit(1)), spare, "da"), "key") == [("k1",), ("k9",)]
    assert rows(plan.samples(chunks, spare.limit(0), "nowhere"), "key") == []


def test_plan_filter_and_report_order(spark):
    items = spark.createDataFrame([("A", "p", 1), ("B", "q", 0)], "tier string, province string, window int")
    assert plan.filtered(items, windows=[0]).count() == 1 and plan.filtered(items).count() == 2
    with pytest.raises(ValueError):
        plan.filtered(items, windows=[])
    stats = items.select("*", *(F.lit(1).alias(c) for c in accounting.COUNTERS))
    assert [(r["window"], r["tier"]) for r in accounting.report(stats).collect()] == [(0, "B"), (1, "A")]


def test_bodies_by_branch(spark):
    given = [("x.com", False, ["a"]), ("facebook.com", False, ["a"]), ("facebook.com", True, ["a"]), ("x.com", True, ["a"]), ("facebook.com", False, ["w " * 40])]
    frame = spark.createDataFrame(given, "site string, use_legacy boolean, names array<string>").withColumn("tier", F.lit("A")).withColumn("supported", text.strings(["facebook.com"]))
    frame = frame.withColumn("intents", F.array(text.strings(["i"]))).withColumn("literal", F.lit(None).cast("string")).withColumn("negatives", text.strings([]))
    got = plan.query_bodies(frame)
    assert [r[:2] for r in rows(got, "site", "branch")] == [("facebook.com", "chunk"), ("facebook.com", "legacy")]


def test_percentiles_of_counted_values(spark):
    values = [(k, v) for k, n in (("a", 7), ("b", 1), (None, 4)) for v in range(n)] + [("c", None)]
    got = {r["k"]: (r["p50"], r["p95"]) for r in ledger.percentiles(spark.createDataFrame(values, "k string, v bigint"), ["k"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    assert got == {"a": (3, 6), "b": (0, 0), None: (1, 3)}


def test_job_summary(spark):
    message = '{"job_id":"j","job_type":"daily","search_sites":["x.com"],"date_from":"2026-05-01","date_to":" 2026-05-02 ","keyword_ids":[3]}'
    jobs = triggers.accepted(triggers.parsed(spark.createDataFrame([(message,)], "value string"), ["vi"], "vi"))
    assert triggers.summaries(jobs).first()["summary"] == '{"job_id":"j","job_type":"daily","profile":"vi","sites":1,"keywords":1}'


def test_scratch(spark):
    told, path = scratch.materialise(spark.range(3), "t")
    assert told.count() == 3 and scratch.shared_dir(spark) in path
    scratch.discard(spark, path)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path)


def test_tables_of_a_step_go_at_its_end(spark):
    with scratch.step(spark) as keep:
        gone, _ = scratch.materialise(spark.range(2), "gone")
        with pytest.raises(RuntimeError), scratch.step(spark):
            broken, _ = scratch.materialise(spark.range(4), "broken")
            raise RuntimeError
        with scratch.step(spark) as keep_inner:
            inner, path = scratch.materialise(gone, "inner")
            keep_inner(path)
        kept, path = scratch.materialise(inner.unionByName(gone), "kept")
        keep(path)
    assert kept.count() == 4
    for table in (gone, inner, broken):
        with pytest.raises(Exception, match="(?i)path|exist"):
            table.withColumn("x", F.lit(1)).collect()
