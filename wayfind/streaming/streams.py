"""Streams: trigger messages to plans, duplicate-safe posts, progress and ledger counters, heartbeats."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from wayfind.operators import plan, triggers
from wayfind.operators.accounting import latest
from wayfind.operators.ordered import micros
from wayfind.sources import posts
from wayfind.sources.scratch import discard, materialise, step

#: Most rows of a file that is read again, here and by what feeds a stream: a task reads a few files, whatever their number.
FILE_ROWS = 100_000


def message_options(servers: str, topic: str) -> dict[str, str]:
    """How a topic is read: from its latest offsets."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"}


def read_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic from its latest offsets, null values skipped. Spark delivers at least once; deterministic ids make a replay harmless."""
    return spark.readStream.format("kafka").options(**message_options(servers, topic)).load().filter("value is not null")


class Progress(StreamingQueryListener):
    """Progress of streams: after each micro-batch `tell` gets a dictionary of its number, the rows read, those that came too late for the state, and what the stream observes by name. An error in `tell` is logged and stops nothing."""

    def __init__(self, tell: Callable[[dict], None]):
        self.tell = tell

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        guarded(self.tell, {"batch": p.batchId, "read": p.numInputRows, "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators), **{name: row.asDict() for name, row in p.observedMetrics.items()}})

    def onQueryTerminated(self, event):
        pass


def guarded(tell: Callable[[dict], None] | None, counts: dict) -> None:
    """Report counts; monitoring must not break a run."""
    try:
        if tell:
            tell(counts)
    except Exception:  # whatever a user's function raises
        logging.getLogger(__name__).warning("a progress function failed", exc_info=True)


def run(stream: DataFrame, sink, checkpoint: str) -> StreamingQuery:
    """Feed every micro-batch to sink(batch, batch_id) until the source has no more, for files and tests."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def job_tables(messages: DataFrame, profiles: list[str], default_profile: str, target: str, checkpoint: str) -> StreamingQuery:
    """Per micro-batch the accepted jobs, the rejects and the done messages as tables, a folder per batch so that a replay overwrites its own."""

    def sink(batch: DataFrame, number: int) -> None:
        jobs = triggers.parsed(batch, profiles, default_profile).persist()
        try:
            good = triggers.accepted(jobs)
            good.write.mode("overwrite").parquet(f"{target}/jobs/batch={number}")
            triggers.rejected(jobs).write.mode("overwrite").parquet(f"{target}/rejects/batch={number}")
            triggers.done_messages(good.select("job_id", "job_type", "profile"), "discovery").write.mode("overwrite").parquet(f"{target}/done/batch={number}")
        finally:
            jobs.unpersist()

    return run(messages, sink, checkpoint)


def planned(jobs: DataFrame, texts: DataFrame) -> DataFrame:
    """Jobs (stream or table) to queries, through a dimension texts(profile, site, text)."""
    return _fanned(jobs.withColumn("site", F.explode("sites")).join(texts, ["profile", "site"]))


def _fanned(rows: DataFrame) -> DataFrame:
    """Queries of jobs with their site and text."""
    given = F.coalesce("time_filter", F.lit("custom"))
    rows = rows.select("job_id", "site", "text", "date_from", "date_to", plan.split_for(F.col("job_type"), given, F.coalesce("split_days", F.lit(4))).alias("split"), given.alias("time_filter"), plan.mode_for(F.col("job_type")).alias("mode"))
    return plan.fan_out(rows)


def as_of(rows: DataFrame, versions: DataFrame, keys: list[str], at: str, since: str = "since") -> DataFrame:
    """rows joined with the version of a dimension that was valid at their time: of each key the rows of the latest `since` not after `at`.

    A version is all rows of a key with the same `since`. Rows of a time before the first version find
    none and are dropped, like rows of an unknown or null key.
    """
    return _within(rows, _dated(versions, keys, since), keys, at, since)


def _dated(versions: DataFrame, keys: list[str], since: str) -> DataFrame:
    """versions with __until, when the next one of their key begins."""
    spans = versions.select(*keys, since).distinct()
    spans = spans.withColumn("__until", F.lead(since).over(Window.partitionBy(*keys).orderBy(since)))  # the versions of one key
    return versions.join(spans, [*keys, since])


def _within(rows: DataFrame, dated: DataFrame, keys: list[str], at: str, since: str) -> DataFrame:
    valid = (F.col(at) >= F.col(since)) & (F.col("__until").isNull() | (F.col(at) < F.col("__until")))
    return rows.join(dated, keys).filter(valid).drop("__until")


def plan_table(messages: DataFrame, profiles: list[str], default_profile: str, texts: Callable[[SparkSession], DataFrame], target: str, checkpoint: str, received: str | None = None) -> StreamingQuery:
    """The queries of every accepted job of a stream as a table, a folder per micro-batch so that a replay overwrites its own.

    texts gives the dimension (profile, site, text) anew for every micro-batch, so that a change shows
    in the next one. With `received`, a column of messages, the dimension has versions
    (profile, since, site, text), and a job gets the one that was valid when its message came, in a replay too.
    The spans of the versions are written first: Spark knows the size of a table, but takes that of a
    join for the product of its sides, and would send all jobs to the few keys of a small dimension.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark, keys = batch.sparkSession, ["profile", "site"]
        jobs = triggers.accepted(triggers.parsed(batch, profiles, default_profile))
        with step(spark):
            if received:
                dated, _ = materialise(_dated(texts(spark), keys, "since").coalesce(1), "versions")
                rows = _fanned(_within(jobs.withColumn("site", F.explode("sites")), dated, keys, received, "since"))
            else:
                rows = planned(jobs, texts(spark))
            rows.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{target}/batch={number}")

    return run(messages, sink, checkpoint)


def counted_table(counts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """The windowed counters as a table, each micro-batch writing the windows that it changed, as they are then. read_counted() takes the last state of each."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_counted(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The counters that counted_table() wrote, one row per window and keys."""
    return latest(spark.read.parquet(target), ["start", *keys], "batch").drop("batch")


def done_options(servers: str, topic: str) -> dict[str, str]:
    """How a topic is written."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_done(messages: DataFrame, servers: str, topic: str) -> None:
    """Done messages (key, value) of a batch to a topic."""
    messages.select("key", "value").write.format("kafka").options(**done_options(servers, topic)).save()


def post_table(stream: DataFrame, order: list[str], target: str, checkpoint: str, buckets: int = 32, tell: Callable[[dict], None] | None = None) -> StreamingQuery:
    """T4: add the posts of a stream that the table doesn't hold yet, by posts.insert(): one query writes the table, and a replayed micro-batch replaces itself.

    Where the stream has a reject_reason, rows with one are no posts. tell gets, for each micro-batch,
    its number and how many rows were found, rejected and inserted; they are counted while the rows are
    written, without a pass of their own.
    """

    def sink(batch: DataFrame, number: int) -> None:
        reason = F.col("reject_reason") if "reject_reason" in batch.columns else F.lit(None)
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("found"), F.count_if(reason.isNotNull()).alias("rejected")).filter(reason.isNull())
        inserted = posts.insert(rows, target, number, order, buckets)
        guarded(tell, {"batch": number, **seen.get, "inserted": inserted})

    return run(stream, sink, checkpoint)


def bounded_posts(stream: DataFrame, at: str, lateness: str) -> DataFrame:
    """T4 with bounded state: the first of each post_id within the allowed lateness."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(["post_id"])


def windowed(events: DataFrame, at: str, lateness: str, length: str, keys: list[str]) -> DataFrame:
    """Counters per window and keys; on a table it is the batch form. Times without a zone, which watermarks don't take, are read in the session's and given back without."""
    bare = dict(events.dtypes)[at] == "timestamp_ntz"
    events = events.withColumn(at, F.col(at).cast("timestamp")) if bare else events
    late = events.withWatermark(at, lateness) if events.isStreaming else events
    return late.groupBy(F.window(at, length).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event") == "result").alias("results"), F.sum("duration_ms").alias("duration_ms")).select((F.col("w.start").cast("timestamp_ntz") if bare else F.col("w.start")).alias("start"), *keys, "n", "results", "duration_ms")


def closing_table(events: DataFrame, at: str, lateness_s: int, length_s: int, keys: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Counters per window and keys, written once a window is closed, and rows that come later than that in a table of their own.

    The watermark of a micro-batch is the latest time of all before it less the allowed lateness, as
    Spark has it. A row whose window ended by then is late; it goes to {target}/late. The others are
    added to the open windows of the batch before, and windows that the times of this batch close go to
    {target}/closed, each once. What is kept is a row for each open window and keys. All tables have a
    folder per micro-batch, so a replay overwrites its own. Rows without a time are late. read_closed()
    has the result.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark, length = batch.sparkSession, length_s * 1_000_000
        start = (F.floor(micros(F.col(at)) / length) * length).alias("start")
        before = spark.read.parquet(f"{target}/state/batch={number - 1}").first()["latest"] if number else None
        mark = None if before is None else before - lateness_s * 1_000_000
        late = F.col("start").isNull() | (F.lit(mark is not None) & (F.col("start") + length <= F.lit(mark)))
        seen = Observation()
        rows, path = materialise(batch.select("*", start).observe(seen, F.max(micros(F.col(at))).alias("latest")), "batch")
        rows.filter(late).select(*batch.columns).write.mode("overwrite").parquet(f"{target}/late/batch={number}")
        latest = max((x for x in (before, seen.get["latest"]) if x is not None), default=None)
        sums = {"n": F.count(F.lit(1)), "results": F.count_if(F.col("event") == "result"), "duration_ms": F.sum("duration_ms")}
        own = rows.filter(~late).groupBy("start", *keys).agg(*(f.cast("long").alias(name) for name, f in sums.items()))
        if number:
            own = own.unionByName(spark.read.schema(own.schema).parquet(f"{target}/open/batch={number - 1}")).groupBy("start", *keys).agg(*(F.sum(name).alias(name) for name in sums))
        own, own_path = materialise(own, "windows")
        ends = F.lit(False) if latest is None else F.col("start") + length <= F.lit(latest - lateness_s * 1_000_000)
        own.filter(ends).write.mode("overwrite").parquet(f"{target}/closed/batch={number}")
        own.filter(~ends).write.mode("overwrite").parquet(f"{target}/open/batch={number}")
        spark.range(1).select(F.lit(latest).cast("long").alias("latest")).write.mode("overwrite").parquet(f"{target}/state/batch={number}")
        discard(spark, path)
        discard(spark, own_path)

    return run(events, sink, checkpoint)


def read_closed(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The closed windows, the windows still open after the last micro-batch, and the late rows of closing_table()."""
    counts = [spark.read.parquet(f"{target}/{name}") for name in ("closed", "open")]
    last = counts[1].agg(F.max("batch").alias("b")).first()["b"]
    start = F.timestamp_add("MICROSECOND", F.col("start"), F.lit("1970-01-01").cast("timestamp_ntz"))
    closed, still = (c.withColumn("start", start) for c in (counts[0], counts[1].filter(F.col("batch") == F.lit(last))))
    return closed.drop("batch"), still.drop("batch"), spark.read.parquet(f"{target}/late").drop("batch")


class _Throttle(StatefulProcessor):
    """The time of the last event let through, kept until a timer says that it can hold nothing back any more."""

    def __init__(self, group: str, every_us: int):
        self.group, self.every = group, every_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for at in sorted(t for batch in rows for t in batch["t"].tolist()):
            if last is None or at - last >= self.every:
                out.append(at)
                last = at
        if last is not None:
            self.last.update((last,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((last + self.every) // 1000 + 1)
        yield pd.DataFrame({self.group: pd.Series([key[0]] * len(out), dtype=object), "t": pd.Series(out, dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def throttled(events: DataFrame, group: str, every_s: int, lateness: str = "10 minutes") -> DataFrame:
    """W14, stream form: group and ts of the events that come at least every_s seconds after the one of their group let through before.

    Events are taken as they come, within a micro-batch by time; those later than the watermark, which
    lies `lateness` behind the latest time before, are left out. Once the watermark has passed the last event by every_s, its state is dropped by a timer. State lies in
    RocksDB, which spark.sql.streaming.stateStore.providerClass must name.
    """
    kind = events.schema[group].dataType.simpleString()
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), F.col(group)).withWatermark("ts", lateness).withColumn("t", F.unix_micros("ts"))
    told = timed.groupBy(group).transformWithStateInPandas(_Throttle(group, every_s * 1_000_000), outputStructType=f"{group} {kind}, t bigint", outputMode="Append", timeMode="EventTime")
    return told.select(group, F.timestamp_micros("t").alias("ts"))
