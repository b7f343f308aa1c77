import pytest
from pyspark.sql import functions as F

from wayfind.operators import accounting, ledger, plan, results, triggers
from wayfind.sources import catalogs, tables
from wayfind.sources.html import result_blocks


def rows(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def test_chunks(spark):
    places = spark.createDataFrame([("A", "core", 1, "A1"), ("A", "core", 2, "A2"), ("A", "mid", 3, "A-mid"), ("A", "core", 4, "A3"), ("B", "core", 5, "B1")], "province string, cadence string, ord int, name string")
    got = rows(plan.chunk_places(places, 2), "key", "names")
    assert got == [("A|core|0", ["A1", "A2"]), ("A|core|1", ["A3"]), ("A|mid|0", ["A-mid"]), ("B|core|0", ["B1"])]
    with pytest.raises(ValueError):
        plan.chunk_places(places, 0)
    assert plan.chunk_places(places.limit(0), 2).count() == 0


def test_page_cap(spark):
    cap = lambda p, t, r, o: spark.range(1).select(plan.page_cap(F.lit(p).cast("int"), F.lit(t), F.lit(r), F.lit(o)).alias("x")).first()["x"]
    assert [cap(5, "A", 10, 10), cap(None, "B", 10, 10), cap(5, "A", 4, 10), cap(5, "A", 10, 3), cap(5, "A", 0, 3)] == [5, 3, 4, 3, 1]


def test_unknown_province_fails(spark):
    places = spark.createDataFrame([("x", 1)], "province string, ord int")
    provinces = spark.createDataFrame([("y", "A")], "province string, tier string")
    with pytest.raises(Exception, match="unknown province"):
        plan.place_provinces(places, provinces).collect()
    assert plan.place_provinces(places, provinces, strict=False).count() == 0
    with pytest.raises(Exception, match="unknown province"):
        plan.require_known(places, provinces, "province").collect()


def test_json_items_and_drift(spark):
    bodies = ["{}", '{"organic":[{"link":" https://a.example ","title":7},{"title":"x"},{"link":""}]}', "junk", None, '{"organic":[{"link":"l","rank":1}]}', '{"organic":[3]}']
    frame = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    assert rows(results.json_items(frame), "k", "link", "title", "snippet") == [(1, "https://a.example", "", ""), (4, "l", "", "")]
    assert [r[1] for r in rows(results.shape_drift(frame), "k", "drift")] == ["missing_or_non_array_organic", None, "missing_or_non_array_organic", "missing_or_non_array_organic", "unexpected_organic_fields:rank", "organic_item_not_object"]


def test_html_blocks(spark):
    html = "<div class='tF2Cxc' data-text-ad='1'><a href='https://ad/'><h3>Ad</h3></a></div><div class='tF2Cxc'><a href='https://a.example/1'><h3>One</h3></a><div class='VwiC3b'>Snip <b>pet</b></div></div><div class='tF2Cxc'><a href='/url?q=https%3A%2F%2Fb.example%2F2'><h3>Two</h3></a></div><div class='tF2Cxc'><a href='https://a.example/1'><h3>Again</h3></a></div>"
    got = rows(result_blocks(spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")), "page_id", "title", "url", "snippet")
    assert got == [(1, "One", "https://a.example/1", "Snip pet"), (1, "Two", "https://b.example/2", "")]


def test_remaining(spark):
    items = spark.createDataFrame([("a", "A", 3), ("b", "A", 3), ("c", "A", 3), ("d", "A", 1)], "item string, tier string, page_max int")
    pages = spark.createDataFrame([("a", 1, "done", False), ("b", 1, "done", True), ("b", 3, "done", True), ("d", 1, "done", True), ("d", 2, "done", False)], "item string, page int, status string, has_next boolean")
    assert rows(accounting.remaining(items, pages), "tier", "todo", "unstarted", "capped") == [("A", 3, 1, 1)]


def test_rates_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "status string, raw int")
    assert accounting.continuation(empty, 8).first()["rate"] is None


def test_ledger_report(spark):
    events = [("offered", f"label_{k % 3}", None, None, None, None) for k in range(20)] + [("result", "label_0", "solved", None, 30000, None)] + [("result", "label_1", "timeout", None, 59000, None)] * 19 + [("result", "label_2", "odd", "odd", None, None)]
    frame = spark.createDataFrame(events, "event string, label string, status string, reason_code string, duration_ms bigint, stage string")
    got = ledger.gate(ledger.counters(ledger.classify(frame), []), 20).first()
    assert (got["solved"], got["failed"], got["p50"], got["p95"], got["solve_rate"], got["gate"]) == (1, 20, 59000, 59000, 0.05, "failed")


def test_trigger(spark):
    good = '{"job_id":" j ","job_type":"Daily","search_sites":["facebook","x.com","facebook.com"],"date_from":"2026-05-01","date_to":"2026-05-02","keyword_ids":[1,2,2]}'
    bad = good.replace("2026-05-01", "2026-02-30").replace('"facebook","x.com","facebook.com"', "")
    jobs = triggers.parsed(spark.createDataFrame([(1, good), (2, bad), (3, "[]"), (4, None)], "k int, value string"), ["vi", "en"], "vi")
    first, second, third, fourth = jobs.orderBy("k").collect()
    assert (first["errors"], first["sites"], first["keyword_ids"], first["profile"], first["job_id"]) == ([], ["facebook.com", "x.com"], [1, 2], "vi", "j")
    assert second["errors"] == ["search_sites", "date_from"] and third["errors"] == ["payload"] and fourth["errors"] in (["payload"], None)


def test_catalog(spark):
    lines = ["### List private", "h:1:u:p", "h:1:u:p", "# no", "prose here", "## other", "h:9", "### unknown", "h:8", "### list public", "http://a:2"]
    got = catalogs.sectioned(spark.createDataFrame([("f", k, v) for k, v in enumerate(lines)], "file string, line_no int, value string"), {"list private": "private", "list public": "public"})
    assert rows(got, "label", "value") == [("private_1", "h:1:u:p"), ("public_1", "http://a:2")]


def test_checkpoint(spark, tmp_path):
    schema = "fingerprint string, item string, page int, status string, seq bigint"
    path = f"file://{tmp_path}/c"
    assert tables.read_checkpoint(spark, path, "f", schema).count() == 0
    tables.write_checkpoint(spark.createDataFrame([("f", "a", 1, "pending", 1), ("f", "a", 1, "done", 2)], schema), path)
    assert rows(tables.read_checkpoint(spark, path, "f", schema), "item", "status") == [("a", "done")]
    with pytest.raises(ValueError):
        tables.read_checkpoint(spark, path, "g", schema)


def test_running_credit_of_a_hot_day(spark):
    given = [(k, "d" if k % 9 else None, None if k % 50 == 0 else k // 3, None if k % 11 == 0 else "k") for k in range(300)]
    frame = spark.createDataFrame(given, "id int, day string, s int, key string").selectExpr("id", "day", "timestampadd(SECOND, s, timestamp_ntz '2026-01-01 00:00:00') + make_dt_interval(0, 0, 0, id / 1000) as ts", "key")
    # as for large tables: no partitions made one, and no side of a join broadcast, which one depends on what ends first
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        got = accounting.running_credit(frame, 100, 50).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r["part"] for r in got if r["day"] == "d" and r["key"] == "k"}) > 1
    named = {(r["id"]): (r["total"], r["key_total"], r["allowed"]) for r in got if r["ts"] is not None}
    for i, day, s, key in given:
        if s is not None:
            upto = [x for x in given if x[1] == day and (x[2] is None or x[0] <= i)]
            own = sum(x[3] == key for x in upto)
            assert named[i] == (len(upto), own, len(upto) <= 100 and own <= 50)
    assert len(got) == len(given)


def test_catalog_of_a_file_in_several_tasks(spark, tmp_path):
    lines = ["prose", "### list private"] + [f"h{k % 700}:1" for k in range(2000)] + ["## end"] + ["hidden:1"] * 300 + ["### list public"] + [f"g{k}:2" for k in range(500)] + ["link reset = a=b", "### unknown", "link reset=zz", "x:9"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c.txt").write_text("\n".join(lines))
    (tmp_path / "in" / "empty.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        read = catalogs.read_lines(spark, f"{tmp_path}/in")
        assert read.rdd.getNumPartitions() > 5 and read.select("split").distinct().count() > 5
        got = rows(catalogs.sectioned(read, {"list private": "private", "list public": "public"}, ("link reset", "public")), "label", "value", "attribute")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [(f"private_{k + 1}", f"h{k}:1", None) for k in range(700)] + [(f"public_{k + 1}", f"g{k}:2", "a=b") for k in range(500)]
    assert got == sorted(expected, key=repr)


def test_checkpoint_compaction(spark, tmp_path):
    schema = "fingerprint string, item string, page int, status string, seq bigint"
    path = f"file://{tmp_path}/c"
    now = lambda accepted=None: rows(tables.read_checkpoint(spark, path, "f", schema, accepted), "item", "page", "status")
    state = lambda *r: tables.write_checkpoint(spark.createDataFrame(list(r), schema), path)
    tables.compact_checkpoint(spark, path, schema)  # nothing to do
    state(("f", "a", 1, "pending", 1), ("g", "z", 1, "done", 1))
    state(("f", "a", 1, "done", 2), ("f", "b", 1, "pending", 1))
    told = [("a", 1, "done"), ("b", 1, "pending")]
    for _ in range(4):
        assert now() == told
        tables.compact_checkpoint(spark, path, schema)
    assert now() == told and now(["g"]) == [*told, ("z", 1, "done")]
    state(("f", "b", 1, "failed", 2), ("h", "y", 1, "done", 1))
    for _ in range(3):
        assert now() == [("a", 1, "done"), ("b", 1, "failed")]
        tables.compact_checkpoint(spark, path, schema)
    kept = spark.read.schema(schema).parquet(path)
    assert kept.count() == 4  # one row a page, of all plans
    with pytest.raises(ValueError):
        tables.read_checkpoint(spark, path, "other", schema)
    assert rows(tables.read_checkpoint(spark, path, "other", schema, ["h"]), "item") == [("y",)]


def test_compaction_writes_states_once(spark, tmp_path, monkeypatch):
    schema, path, written = "fingerprint string, item string, page int, status string, seq bigint", f"file://{tmp_path}/once", []
    for seq in (1, 2):
        tables.write_checkpoint(spark.createDataFrame([("f", "a", 1, f"s{seq}", seq), ("g", f"b{seq}", 1, "done", 1)], schema), path)
        tables.compact_checkpoint(spark, path, schema)
    kind = type(spark.range(0).write)
    monkeypatch.setattr(kind, "parquet", lambda self, to, *a, f=kind.parquet, **b: written.append(to) or f(self, to, *a, **b))
    tables.compact_checkpoint(spark, path, schema)
    assert written == [path]
    assert rows(spark.read.schema(schema).parquet(path), "fingerprint", "item", "page", "status", "seq") == [("f", "a", 1, "s2", 2), ("g", "b1", 1, "done", 1), ("g", "b2", 1, "done", 1)]


def test_resume_fingerprints():
    own = lambda **more: plan.resume_fingerprints(**({"profile": "en", "date_from": "2026-05-01", "date_to": "2026-07-31", "window_days": 14, "places_per_query": 3, "tiers": ["A"], "sites": ["x.com"], "page_max": {"A": 2}, "full_page": 8} | more))
    first = own()
    assert len(set(first)) == 3 and first[0] == own(page_max={"A": 9}, full_page=1)[0] and first[1] != own(page_max={"A": 9})[1]
    assert first[2] == own(page_max={"A": 9})[2] != own(full_page=1)[2] and first[0] != own(sites=["tiktok.com"])[0]
    usual = own(page_max={"A": 10, "B": 3, "C": 1})
    assert usual[1] == usual[2]


def test_plan_order(spark):
    chunks = spark.createDataFrame([("b", "A"), ("a", "B"), ("a", "A"), ("c", "C")], "key string, tier string").repartition(3)
    windows = spark.createDataFrame([("2026-05-15", "2026-05-28"), ("2026-05-01", "2026-05-14")], "f string, t string").selectExpr("date(f) as content_from", "date(t) as content_to")
    got = [(r["tier"], str(r["content_from"]), r["key"], r["intent"]) for r in plan.cross_plan(chunks, windows, 2).collect()]
    assert got == sorted(got) and len(got) == len(set(got)) == 16


def test_ranks_of_a_kind_in_several_tasks(spark):
    attempts = spark.createDataFrame([("k" if k % 9 else None, f"l{k % 400:03d}", k) for k in range(900)], "kind string, label string, s bigint").select("kind", "label", F.timestamp_add("SECOND", "s", F.lit("2026-01-01").cast("timestamp_ntz")).alias("ts"))
    got = ledger.ranked(attempts, F.lit("2026-01-01").cast("date")).collect()
    for kind in ("k", None):
        own = [(r["uses"], r["last_used"], r["label"], r["rank"]) for r in got if r["kind"] == kind]
        assert [r[3] for r in sorted(own)] == list(range(1, len(own) + 1)) and len(own) > 50
