"""Ledger analytics: outcome classes, counters, percentiles, gates, resource health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfind.functions.text import safe_label
from wayfind.operators.ordered import first_reached, micros, numbered, order_statistics, product, spaced

# Reasons before anything was attempted, reasons of a failed attempt, outcomes of a label check, order of kinds.
CAPTURE_REASONS = ["challenge_unavailable", "audio_unavailable", "audio_payload_unavailable", "audio_control_unavailable", "audio_control_not_visible", "audio_control_disabled", "audio_control_click_failed", "audio_response_timeout", "audio_response_http_error", "audio_payload_too_large", "audio_payload_body_unavailable", "proxy_blocked"]
SOLVE_REASONS = ["answer_controls_unavailable", "answer_fill_failed", "answer_verify_click_failed", "answer_verification_timeout", "answer_verification_http_error", "answer_verification_unsolved", "transcription_failed", "timeout", "verification_failed"]
LABEL_OUTCOMES = ["audio_control_enabled", "audio_control_disabled", "audio_control_not_visible", "audio_control_unavailable", "challenge_unavailable", "hard_block", "no_captcha", "navigation_failed"]
KINDS = ["private", "google_public", "public"]
KNOWN = ["solved", *CAPTURE_REASONS, *SOLVE_REASONS]


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def classify(events: DataFrame) -> DataFrame:
    """Result events with `class` (solved, a known status or reason, unknown) and `at_capture`; an explicit stage wins over the class."""
    status, reason = F.coalesce("status", F.lit("")), F.coalesce("reason_code", F.lit(""))
    kind = F.when(status.isin("success", "solved"), "solved").when(status.isin(KNOWN), status).when(reason.isin(KNOWN), reason).otherwise("unknown")
    out = events.withColumn("class", kind)
    stage = F.nullif("stage", F.lit(""))
    return out.withColumn("at_capture", (F.col("class") != "solved") & F.coalesce(stage == "capture", F.col("class").isin(CAPTURE_REASONS)))


def counters(events: DataFrame, keys: list[str]) -> DataFrame:
    """Event counters, nearest-rank percentiles of durations, labels and solve rate by keys, from events of classify(), null keys and all."""
    result = F.col("event") == "result"
    solved, captured = result & (F.col("class") == "solved"), result & F.col("at_capture")
    timed = F.when(result & ~F.col("at_capture") & (F.col("duration_ms") >= 0), F.col("duration_ms"))
    label = safe_label(F.col("label"))
    n = lambda c: F.count_if(c)
    out = events.groupBy(*keys).agg(
        n(F.col("event") == "offered").alias("offered"), n(F.col("event") == "attempt").alias("attempted"), n(solved).alias("solved"), n(result & (F.col("class") != "solved") & ~F.col("at_capture")).alias("failed"), n(captured).alias("capture_failed"),
        n(F.col("event") == "paid").alias("paid"), n(F.col("event") == "hard_block").alias("hard_blocks"),
        F.count(timed).alias("timed"), F.countDistinct(F.when(F.col("event") == "offered", label)).alias("offered_labels"), F.countDistinct(label).alias("labels"),
    )
    out = out.withColumn("solve_rate", F.round(F.try_divide(F.col("solved").cast("double"), F.col("offered")), 6))
    ranks = percentiles(events.withColumn("__ms", timed), keys, "__ms", {"p50": 0.5, "p95": 0.95})
    if not keys:
        return out.join(ranks)  # one row each
    named = ranks.select(*(F.col(k).alias(f"__of_{k}") for k in keys), "p50", "p95")
    return out.join(named, [out[k].eqNullSafe(named[f"__of_{k}"]) for k in keys], "left").drop(*(f"__of_{k}" for k in keys))


def percentiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of value, whole numbers, by keys (none: one row), null values left out: the least value that covers its share of the rows."""
    return order_statistics(rows, keys, value, wanted)


def gate(counts: DataFrame, target: int, least_rate: float = 0.6, most_p95: int = 60_000, least_labels: int = 3, clean: Column | None = None) -> DataFrame:
    """Failed, ready or inconclusive from the columns of counters(); the rules apply in this order."""
    enough = (F.col("offered") >= target) & (F.col("offered_labels") >= least_labels)
    slow = ~F.coalesce(F.col("p95") <= most_p95, F.lit(False))
    dirty = ~(clean if clean is not None else F.lit(True))
    failed = dirty | (F.col("paid") > 0) | (enough & F.coalesce(F.col("solve_rate") < least_rate, F.lit(False))) | (enough & slow)
    return counts.withColumn("gate", F.when(failed, "failed").when(enough, "ready").otherwise("inconclusive"))


def histogram(events: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of value by keys, as rows."""
    return events.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def histogram_map(events: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of value by keys as one map each, in the order of values; null values are left out, and keys without any have no row."""
    counts = histogram(events.filter(F.col(value).isNotNull()), keys, value)
    return counts.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(value, "n")))).alias("counts"))  # as many entries as the result holds


def zero_filled(rows: DataFrame, categories: DataFrame, keys: DataFrame, key: str, value: str) -> DataFrame:
    """N of every category for every key, 0 where there is none; null keys and categories are left out."""
    names = categories.select(value).distinct().filter(F.col(value).isNotNull())
    grid = product(keys.select(key).distinct().filter(F.col(key).isNotNull()), names)
    return grid.join(histogram(rows, [key], value), [key, value], "left").select(key, value, F.coalesce("n", F.lit(0)).alias("n"))


def label_verdict(outcomes: DataFrame, key: str, least: int = 3) -> DataFrame:
    """Verdict by key from outcomes(label, outcome): reachable with enough distinct enabled labels, blocked if challenges were seen and none was enabled, else inconclusive."""
    enabled = F.col("outcome") == "audio_control_enabled"
    own = outcomes.filter(safe_label(F.col("label")).isNotNull()).groupBy(key).agg(F.count_if(enabled).alias("enabled"), F.bool_or(~F.col("outcome").isin("no_captcha", "navigation_failed")).alias("seen"))
    return own.select(key, "enabled", F.when(F.col("enabled") >= least, "audio_reachable").when(F.col("seen") & (F.col("enabled") == 0), "audio_blocked").otherwise("inconclusive").alias("verdict"))


def failure_outcome(kind: Column) -> Column:
    """What a query's last error makes of it: blocked by a challenge, else failed; null, no error, is ok."""
    return F.when(kind.isNull(), "ok").when(kind == "captcha", "blocked").otherwise("failed")


def selected_labels(entries: DataFrame, most: int, requested: list[str] | None = None) -> DataFrame:
    """The first `most` reportable labels of entries(ord, label, kind): none of kind rotating, each once at its first place, of those requested if any are."""
    rows = entries.filter((F.col("kind") != "rotating") & safe_label(F.col("label")).isNotNull())
    rows = rows if requested is None else rows.filter(F.col("label").isin(requested))
    first = rows.groupBy("label").agg(F.min(F.struct("ord", "kind")).alias("f"))
    return first.select("label", "f.kind", "f.ord").orderBy("ord", "label").limit(most)


def require_labels(entries: DataFrame, labels: list[str]) -> DataFrame:
    """The entries of exactly these labels; an error if one is missing or of kind rotating. At most one row per label reaches the driver."""
    found = entries.filter(F.col("label").isin(labels))
    told = found.groupBy("label").agg(F.bool_or(F.col("kind") == "rotating").alias("rotating")).collect()
    if len(told) != len(set(labels)) or any(r["rotating"] for r in told):
        raise ValueError("requested labels are unavailable or unsupported")
    return found


def snapshot(attempts: DataFrame, now: Column, rests: dict[str, int]) -> DataFrame:
    """Label, kind, uses_today, active, blocked as of now, from attempts(label, kind, event, outcome, ts) up to then.

    A label is active if its last event is an attempt whose result hasn't come, and blocked while it
    rests after its last result.
    """
    past = attempts.filter(F.col("ts") <= now)
    last = F.max_by(F.struct("event", "outcome", "ts"), F.struct("ts", "event"))
    own = past.groupBy("label", "kind").agg(F.count_if((F.col("event") == "attempt") & (F.to_date("ts") == F.to_date(now))).alias("uses_today"), last.alias("l"), F.max_by(F.struct("outcome", "ts"), F.when(F.col("event") == "result", F.struct("ts", "outcome"))).alias("r"))
    rest = F.coalesce(F.try_element_at(F.create_map(*(x for k, v in rests.items() for x in (F.lit(k), F.lit(v)))), F.col("r.outcome")), F.lit(0))
    blocked = F.coalesce(seconds(F.col("r.ts")) + rest > seconds(now), F.lit(False)) & (rest > 0)
    return own.select("label", "kind", "uses_today", (F.col("l.event") == "attempt").alias("active"), blocked.alias("blocked"))


def ranked(attempts: DataFrame, day: Column) -> DataFrame:
    """Labels by kind: uses on the day, last use, rank among those of the kind (least used first)."""
    used = attempts.groupBy("kind", "label").agg(F.count_if(F.to_date("ts") == day).alias("uses"), F.max("ts").alias("last_used"))
    keyed = used.withColumn("__kind", F.coalesce(F.concat(F.lit("1"), "kind"), F.lit("0")))
    return numbered(keyed, "__kind", ["uses", "last_used", "label"], "__place").withColumn("rank", F.col("__place") + 1).drop("__kind", "__place")


def cooldown(attempts: DataFrame, now: Column, rests: dict[str, int]) -> DataFrame:
    """Per label the last outcome, until when it rests by that outcome, and the seconds left at now."""
    rest = F.coalesce(F.try_element_at(F.create_map(*(x for k, v in rests.items() for x in (F.lit(k), F.lit(v)))), F.col("outcome")), F.lit(0))
    last = attempts.groupBy("label").agg(F.max_by("outcome", F.struct("ts", "outcome")).alias("outcome"), F.max("ts").alias("ts"))
    until = seconds(F.col("ts")) + rest
    return last.select("label", "outcome", until.alias("blocked_until"), F.greatest(until - seconds(now), F.lit(0)).alias("wait_s"))


def daily_use(attempts: DataFrame) -> DataFrame:
    """Uses per label and day; a new day starts from 0."""
    return attempts.groupBy("label", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("uses"))


def stop_point(events: DataFrame, group: str, target: int, limit_s: int, slice_s: int = 3600) -> DataFrame:
    """Per group the first event at which the target of offers is reached or the time is up, the target tested first. Events without a time take no part."""
    rows = events.filter("ts is not null").select(group, "event_id", "ts", "event", seconds(F.col("ts")).alias("at"))
    found = first_reached(rows, group, ["ts", "event_id"], F.floor(F.col("at") / slice_s), F.col("event") == "offered", target, ("at", limit_s))
    return found.select(group, "event_id", F.col("reason").alias("stop_reason"))


def heartbeats(events: DataFrame, group: str, every_s: int) -> DataFrame:
    """Group and ts of the events of which a heartbeat tells: the first of a group, and then each first one at least every_s seconds after the one told before."""
    beats = spaced(events.select(group, micros(F.col("ts")).alias("t")), group, "t", every_s * 1_000_000)
    return beats.select(group, F.timestamp_add("MICROSECOND", F.col("t"), F.lit("1970-01-01").cast("timestamp_ntz")).alias("ts"))
