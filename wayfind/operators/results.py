"""Result cleaning: one reject reason per result, first-wins dedup, insert-if-new, page rules, response shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.functions import text, urls

# Marks of page outcomes and the fields of a response item.
CHALLENGE_MARKS = ["/sorry/", "g-recaptcha", "data-sitekey", "unusual traffic", "lưu lượng truy cập bất thường"]
HARD_BLOCK = r"(?iu)try again later|please try again later|hãy thử lại sau|vui lòng thử lại sau"
NO_RESULTS = r"(?iu)không tìm thấy kết quả|did not match any documents|no results"
ITEM_FIELDS = ["position", "title", "link", "snippet", "date", "source", "sitelinks", "thumbnail"]
RESULT_LIMIT = 10


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that later expressions refer to without repeating it: a one-row generator, which the optimizer doesn't see through."""
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def _linked(results: DataFrame) -> DataFrame:
    out = once(results, "__link", urls.parts(urls.absolute(F.col("url"))))
    out = once(out, "clean_url", urls.unwrapped(F.col("__link"))).drop("__link")
    out = once(out, "__clean", urls.parts(F.col("clean_url")))
    return once(out, "post_id", urls.post_id_of(F.col("__clean"), F.col("site")))


def with_link(results: DataFrame) -> DataFrame:
    """results(url, site) with clean_url and post_id."""
    return _linked(results).drop("__clean")


def with_reason(results: DataFrame, status: Column | None = None) -> DataFrame:
    """results(url, site, title, snippet) with clean_url, post_id and the first failing rule as reject_reason.

    Rules in order: no usable URL, advertising, no post id, not eligible, not accessible; null where all pass.
    """
    out = _linked(results)
    reason = F.when(F.col("clean_url").isNull(), "bad_url").when(text.ad_flag(F.col("title"), F.col("snippet")), "ad").when(F.col("post_id").isNull(), "no_post_id").when(~urls.eligible_of(F.col("__clean"), F.col("site")), "bad_pattern")
    return once(out, "reject_reason", reason.when((status if status is not None else F.lit("accessible")) != "accessible", "inaccessible")).drop("__clean")


def reason_counts(results: DataFrame) -> DataFrame:
    """A14."""
    return results.groupBy("site", F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in a given order, by map-side combined minima, so a popular key is no hot task."""
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("row"))
    return best.filter(F.col(key).isNotNull()).select("row.*")


def new_posts(posts: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """Posts whose post_id, whatever the site, is not in existing; duplicates within posts collapse to the first."""
    return first_wins(posts, "post_id", order).join(existing.select("post_id"), "post_id", "left_anti")


def page_marks(url: Column, body: Column, challenge: Column) -> Column:
    """What the address and the visible text of a page say: blocked or challenge, no_results, or null; challenge tells whether its markup has one.

    Being blocked is asked only of a page that is a challenge, and only its visible text is asked, so
    an ordinary result that quotes such a phrase stays ordinary.
    """
    address, seen = F.lower(F.coalesce(url, F.lit(""))), F.coalesce(body, F.lit(""))
    whole = F.concat(address, F.lit("\n"), F.lower(seen))
    challenged = F.greatest(F.coalesce(challenge, F.lit(False)), *(whole.contains(m) for m in CHALLENGE_MARKS))
    return F.when(challenged & seen.rlike(HARD_BLOCK), "blocked").when(challenged, "challenge").when(seen.rlike(NO_RESULTS), "no_results")


def page_outcome(mark: Column, page: Column, h3: Column, fresh: Column) -> Column:
    """Blocked, challenge; ordinary where there are fresh results; else no_results, drift (the first page has headings, but none that is found as a result) or empty."""
    return F.when(mark.isin("blocked", "challenge"), mark).when(fresh > 0, "ordinary").when(mark == "no_results", "no_results").when((page == 1) & (h3 > 0), "drift").otherwise("empty")


def has_next(count: Column, page: Column, page_max: Column, threshold: Column) -> Column:
    """A full page before the last allowed one calls for another."""
    return (count >= threshold) & (page < page_max)


def pages_taken(pages: DataFrame) -> DataFrame:
    """Of pages(query_id, page, fresh, extracted, has_next) those that are kept: all before the first page that adds nothing, and none after one that ends the run."""
    stop_before = F.min(F.when(F.col("fresh") == 0, F.col("page")))
    stop_after = F.min(F.when(~F.col("has_next") | (F.col("extracted") < RESULT_LIMIT), F.col("page")))
    limits = pages.groupBy("query_id").agg(stop_before.alias("before"), stop_after.alias("after"))
    kept = (F.col("before").isNull() | (F.col("page") < F.col("before"))) & (F.col("after").isNull() | (F.col("page") <= F.col("after")))
    return pages.join(limits, "query_id").filter(kept).drop("before", "after")


def pages_read(pages: DataFrame) -> DataFrame:
    """W7 with errors: pages(query_id, page, outcome, fresh, extracted, has_next) with the error of the query, null if it has none, and whether the page is taken.

    The page that ends a run decides: an outcome of blocked or challenge is an error `captcha`, one of
    drift `parse`, and then no page of the query is taken; pages_taken() has the other rules.
    """
    failed = F.when(F.col("outcome").isin("blocked", "challenge"), "captcha").when(F.col("outcome") == "drift", "parse")
    last = F.when(~F.col("has_next") | (F.col("extracted") < RESULT_LIMIT), F.col("page"))
    ends = F.when(failed.isNotNull() | (F.col("fresh") == 0), F.col("page"))
    limits = pages.groupBy(F.col("query_id").alias("__of")).agg(F.min(F.least(ends, last)).alias("__end"), F.min(F.when(failed.isNotNull(), F.struct("page", failed.alias("error")))).alias("__fail"))
    joined = pages.join(limits, pages["query_id"].eqNullSafe(limits["__of"]))
    error = F.when(F.col("__fail.page") <= F.coalesce("__end", F.col("__fail.page")), F.col("__fail.error"))
    kept = error.isNull() & (F.col("fresh") > 0) & (F.col("__end").isNull() | (F.col("page") <= F.col("__end")))
    return joined.select(*pages.columns, error.alias("error"), kept.alias("taken"))


def first_per_run(rows: DataFrame, run: str, order: list[str], n: int = 3) -> DataFrame:
    """The first n rows of each run. Spark keeps n rows per run and task before the shuffle (window group limit)."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(run).orderBy(*order))).filter(F.col("place") <= n)


def json_items(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per usable item of responses: link trimmed and not blank, title and snippet '' unless strings; a body without an `organic` array gives no row."""
    parsed = responses.withColumn("__v", F.try_parse_json(body))
    parsed = parsed.withColumn("__items", F.try_variant_get("__v", "$.organic", "array<variant>"))
    items = parsed.select(*responses.columns, F.posexplode("__items").alias("pos", "item"))
    field = lambda name: F.when(F.schema_of_variant(F.try_variant_get("item", f"$.{name}", "variant")) == "STRING", F.try_variant_get("item", f"$.{name}", "string"))
    out = items.select(*responses.columns, "pos", text.trimmed(field("link")).alias("link"), F.coalesce(field("title"), F.lit("")).alias("title"), F.coalesce(field("snippet"), F.lit("")).alias("snippet"))
    return out.filter(F.col("link") != "")


def shape_drift(responses: DataFrame, body: str = "body") -> DataFrame:
    """Responses with drift: why the first offending item (or the whole) departs from the expected shape; null if it doesn't."""
    organic = F.get_json_object(body, "$.organic")
    items = F.from_json(organic, "array<string>")
    odd = F.transform(items, lambda item: F.when(~F.coalesce(item.startswith("{"), F.lit(False)), F.lit("organic_item_not_object")).otherwise(F.concat(F.lit("unexpected_organic_fields:"), F.array_join(F.array_except(F.json_object_keys(item), text.strings(ITEM_FIELDS)), ","))))
    first = F.try_element_at(F.filter(odd, lambda r: r != "unexpected_organic_fields:"), F.lit(1))
    return responses.withColumn("drift", F.when(organic.isNull() | ~organic.startswith("["), "missing_or_non_array_organic").otherwise(first))
