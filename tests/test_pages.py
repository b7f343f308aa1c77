"""Landed pages: what the one pass over the markup finds, and the outcomes of pages and runs."""

from pyspark.sql import functions as F

from wayfind.sources.html import landed, parsed_pages, result_blocks

NEXT = "<a id='pnnext' href='/search?start=10'>&gt;</a>"


def block(n, tag="h3"):
    return f"<div class='g tF2Cxc'><a href='https://x.com/u/status/{n}'><{tag}>T {n}</{tag}></a><div class='VwiC3b'>S</div></div>"


def ten(start):
    return "".join(block(start + k) for k in range(10))


def outcomes(spark, *pages, url="https://www.google.com/search"):
    rows = [("q", k + 1, p[0] if isinstance(p, tuple) else url, p[1] if isinstance(p, tuple) else p) for k, p in enumerate(pages)]
    got = landed(spark.createDataFrame(rows, "query_id string, page int, url string, html string")).orderBy("page").collect()
    return [(r["outcome"], r["fresh"], r["taken"]) for r in got], got[0]["error"]


def test_quoted_phrases_are_ordinary(spark):
    page = ten(0) + "<p>they said: Try again later, no results</p><script>'unusual traffic'</script><!-- g-recaptcha -->" + NEXT
    assert outcomes(spark, page) == ([("ordinary", 10, True)], None)


def test_challenge_then_block(spark):
    assert outcomes(spark, "<div data-sitekey='k'></div>") == ([("challenge", 0, False)], "captcha")
    assert outcomes(spark, "<form id='captcha-form'></form>Vui lòng thử lại sau") == ([("blocked", 0, False)], "captcha")
    assert outcomes(spark, "Our systems have detected unusual traffic. Please <b>try</b>\nagain later.") == ([("blocked", 0, False)], "captcha")
    assert outcomes(spark, ("https://www.google.com/sorry/index?x", ten(0))) == ([("challenge", 10, False)], "captcha")
    assert outcomes(spark, "Lưu lượng truy cập bất thường")[1] == "captcha"
    assert outcomes(spark, "<iframe src='https://www.google.com/recaptcha/api2'></iframe>")[1] == "captcha"


def test_headings_without_results(spark):
    assert outcomes(spark, "<h3>A</h3><h3>B</h3>") == ([("drift", 0, False)], "parse")
    assert outcomes(spark, "<h1>A</h1>") == ([("empty", 0, False)], None)
    assert outcomes(spark, "<h3>A</h3>Your search did not match any documents") == ([("no_results", 0, False)], None)
    assert outcomes(spark, ten(0) + NEXT, "<h3>A</h3>") == ([("ordinary", 10, True), ("empty", 0, False)], None)


def test_pages_that_a_run_takes(spark):
    assert outcomes(spark, ten(0) + NEXT, ten(5) + NEXT, ten(5) + NEXT, ten(30) + NEXT)[0] == [("ordinary", 10, True), ("ordinary", 5, True), ("empty", 0, False), ("ordinary", 10, False)]
    assert outcomes(spark, ten(0) + NEXT, ten(10), ten(20) + NEXT)[0] == [("ordinary", 10, True), ("ordinary", 10, True), ("ordinary", 10, False)]
    assert outcomes(spark, block(1) + block(2) + NEXT, ten(20) + NEXT)[0] == [("ordinary", 2, True), ("ordinary", 10, False)]
    pages, error = outcomes(spark, ten(0) + NEXT, "<div data-sitekey='k'></div>", ten(20))
    assert error == "captcha" and not any(taken for _, _, taken in pages)
    pages, error = outcomes(spark, ten(0), "<div data-sitekey='k'></div>")  # the run had ended before
    assert error is None and [taken for _, _, taken in pages] == [True, False]


def test_parts_of_a_page(spark):
    odd = "<div class='tF2Cxc'><div class='tF2Cxc'><a href='https://a.example/1'><h3>In<span>ner</span></h3></a><div data-sncf='1'><div>First<div>deep</div></div></div><div class='VwiC3b'>other</div></div></div>"
    odd += "<a href='https://b.example/'><div class='tF2Cxc'><h3>Around</h3><span class='VwiC3b'>no div</span></div></a><div class='tF2Cxc'><h3>Bare</h3><a href='https://c.example/'><h3>Second</h3></a></div><div class='tF2Cxc'><h3> </h3></div>"
    pages = spark.createDataFrame([(1, odd), (2, "<p>unclosed <b>x<br><p hidden>no</p><noscript>no</noscript>&amp;</p>"), (3, None), (4, ""), (5, "<" * 50 + "</p></div>" + "a" * 100_000)], "page_id bigint, html string").withColumn("page", F.lit(7)).withColumn("body", F.lit("clash"))
    got = {r["page_id"]: r for r in parsed_pages(pages.drop("body", "page")).collect()}
    assert [tuple(b) for b in got[1]["blocks"]] == [("Inner", "https://a.example/1", "First deep"), ("Around", "https://b.example/", ""), ("Bare", "https://c.example/", "")]
    assert got[2]["body"] == "unclosed x\n&" and got[3]["body"] == got[4]["body"] == "" and len(got[5]["body"]) >= 100_000
    assert {(r["page_id"], r["pos"], r["url"]) for r in result_blocks(pages).collect()} == {(1, 0, "https://a.example/1"), (1, 1, "https://b.example/"), (1, 2, "https://c.example/")}
    assert landed(pages.limit(0).selectExpr("page_id as query_id", "page", "'' as url", "html")).count() == 0


def test_blocks_of_the_second_kind(spark):
    html = "<div data-hveid='1' data-ved='2'><a href='https://a.example/1'><h3>A</h3></a></div><div data-hveid='1'><a href='https://a.example/2'><h3>B</h3></a></div><div data-hveid='1' data-ved='2'><b data-text-ad></b><a href='https://a.example/3'><h3>C</h3></a></div>"
    assert [r["title"] for r in result_blocks(spark.createDataFrame([(1, html)], "page_id bigint, html string")).collect()] == ["A"]


def test_a_worker_holds_few_pages(spark):
    rows = spark.createDataFrame([(1, "<h3>a</h3>")], "page_id bigint, html string")
    plan = parsed_pages(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan  # a hundred rows at a time, not Arrow's 10,000
