from pyspark.sql import functions as F

from wayfind.functions import dates, text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def each(spark, values, f):
    rows = spark.createDataFrame([(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)], ["k", *"abc"[: len(values[0]) if isinstance(values[0], tuple) else 1]])
    return [r["x"] for r in rows.select("k", f(rows).alias("x")).orderBy("k").collect()]


def test_sites_terms_and_budget(spark):
    assert each(spark, [" FB ", "Twitter", "example.org"], lambda r: text.normalize_site(r["a"])) == ["facebook.com", "x.com", "example.org"]
    assert one(spark, text.unique_terms(text.strings([" b", "a", "", "b ", "a"]))) == ["b", "a"]
    assert one(spark, text.or_group(text.strings(["a b", 'c"d']))) == '("a b" OR "c\\"d")'
    assert one(spark, text.negative_terms(text.strings(["a", "b c", "-d"]))) == '-a -"b c" -d'
    assert each(spark, ['("a b" OR "c") -d', " () ", ""], lambda r: text.word_count(r["a"])) == [5, 0, 0]
    assert one(spark, text.nfc(F.lit("é"))) == "é"


def test_groups_split_until_they_fit(spark):
    site, none = F.lit("facebook.com"), F.lit(None).cast("array<array<string>>")
    names = text.strings(["one two three four five six seven eight", "nine ten eleven twelve", "b c d e f g h i"])
    assert one(spark, F.transform(text.fitted_groups(site, names, none, F.lit("trip"), text.strings([])), F.size)) == [3]
    assert one(spark, F.transform(text.fitted_groups(site, names, none, F.lit("trip"), text.strings([]), 20), F.size)) == [2, 1]
    assert one(spark, text.fitted_groups(site, names, none, F.lit("trip"), text.strings([]), 8)) is None


def test_legacy_text(spark):
    aliases = text.strings(["Đà Nẵng", "Bà Nà Hills", "Hội An", "Mỹ Khê", "Sơn Trà", "x"])
    expected = '("Đà Nẵng" OR "Hội An" OR "Mỹ Khê" OR "Sơn Trà") "du lịch" -combo -booking -hotline -"liên hệ" -zalo -sđt -inbox -ib -tour -"báo giá"'
    assert one(spark, text.legacy_text(F.lit("facebook.com"), F.lit("A"), aliases)) == expected
    assert one(spark, text.legacy_text(F.lit("x.com"), F.lit("A"), aliases)) is None


def test_ads_masks_and_times(spark):
    assert each(spark, [("Tour Đà Nẵng giá rẻ", "hotline 0912345678"), ("Xin review lịch trình", "ba ngày"), ("giá 500đ ", ""), ("giá 500đ", "x"), ("", "")], lambda r: text.ad_flag(r["a"], r["b"])) == [True, False, False, False, False]
    assert one(spark, text.mask_credentials(F.lit("see http://u:p@h:1/x"))) == "see http://***@h:1/x"
    assert one(spark, text.local_time(F.lit("2026-06-17 17:00:00").cast("timestamp"))) == "2026-06-18T00:00:00.000+07:00"


def test_urls(spark):
    cases = {
        ("https://www.facebook.com/story.php?story_fbid=1234567890&id=42", "facebook.com"): "1234567890",
        ("https://www.instagram.com/p/C9abc123xyz/", "instagram.com"): "C9abc123xyz",
        ("https://x.com/u/status/1234567890123456789", "x.com"): "1234567890123456789",
        ("https://www.facebook.com/a/1234567890/b/2234567890/3", "facebook.com"): "2234567890",
        ("https://x.com/u", "x.com"): None,
        ("not a url", "facebook.com"): None,
    }
    assert each(spark, list(cases), lambda r: urls.post_id(r["a"], r["b"])) == list(cases.values())
    allowed = {
        ("https://www.facebook.com/events/1", "facebook.com"): False,
        ("https://www.facebook.com/a/photos/1", "facebook.com"): False,
        ("https://www.facebook.com/story.php?story_fbid=1&id=2", "facebook.com"): False,
        ("https://www.facebook.com/groups/g/permalink/1/", "facebook.com"): True,
        ("https://www.facebook.com/watch/?v=1", "facebook.com"): True,
        ("https://x.com/a/status/1", "x.com"): True,
        ("https://x.com/explore", "x.com"): False,
        ("https://instagram.com/reels/", "instagram.com"): False,
        ("/posts/1", "facebook.com"): True,
        ("https://else.example/", "else.example"): True,
    }
    assert each(spark, list(allowed), lambda r: urls.eligible(r["a"], r["b"])) == list(allowed.values())
    links = ["/url?q=https%3A%2F%2Fwww.facebook.com%2Fgroups%2Fx%2Fposts%2F123&sa=U", "/preferences", "https://a.example/x#y", "ftp://a.example/", ""]
    assert each(spark, links, lambda r: urls.unwrap(r["a"])) == ["https://www.facebook.com/groups/x/posts/123", None, "https://a.example/x", None, None]


def test_dates(spark):
    d = lambda x: F.lit(x).cast("date")
    windows = one(spark, dates.split_overlapping(d("2026-01-01"), d("2026-02-01"), 14))
    assert [(str(w["content_from"])[5:], str(w["content_to"])[5:]) for w in windows] == [("01-01", "01-14"), ("01-14", "01-27"), ("01-27", "02-01")]
    assert len(one(spark, dates.split_overlapping(d("2026-05-01"), d("2026-07-31"), 14))) == 7
    assert one(spark, dates.stable_hash(F.lit("da_nang|core|0"))) == 820770399
    assert one(spark, dates.stable_hash(F.lit("ha_noi|mid|1"))) == 2119600515
    chunks = one(spark, dates.split_days(d("2026-06-24"), d("2026-06-25"), F.lit(1)))
    assert [(str(c["after"]), str(c["before"])) for c in chunks] == [("2026-06-23", "2026-06-25"), ("2026-06-24", "2026-06-26")]
    due = spark.range(4).select(dates.is_due(F.lit("k"), F.lit(4), F.date_add(d("2026-08-18"), F.col("id").cast("int"))).alias("x")).collect()
    assert sum(r["x"] for r in due) == 1
