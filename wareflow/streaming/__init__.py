"""Streaming forms: keyed de-duplication, live ledger, notifications, delayed re-emission, retries, windows, routing.

The watermark (an hour unless given) is a choice of this library: it bounds the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import finished
from ..sources import split_errors
from . import processors

WATERMARK = "1 hour"


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and read what it wrote."""
    out = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/rows")
    out.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def replay(spark: SparkSession, rows: DataFrame, path: str, order: str, batches: int = 4, bounds: list | None = None) -> DataFrame:
    """A stream over rows in order, a range a batch, for tests and backfills.

    The ranges are cut at `bounds` (values of the order that end a range), or at the order's approximate quantiles. Files are taken by their time, so the
    ranges are written one after the other, each by several tasks into the same number of files; a trigger takes so many. No file may be empty, as none is
    written then and a trigger would go on into the next range: there are so few files that the smallest range has 64 rows for each, and a range without rows is left out.
    """
    if bounds is None:
        at = [n / batches for n in range(1, batches)]
        bounds = sorted(set(rows.agg(F.percentile_approx(order, at, 10_000).alias("q")).first()["q"] or []))
    edges = [None, *bounds, None]
    ranges = [(F.lit(True) if low is None else F.col(order) > F.lit(low)) & (F.lit(True) if high is None else F.col(order) <= F.lit(high)) for low, high in zip(edges, edges[1:], strict=False)]
    sizes = rows.agg(*[F.count(F.when(r, 1)).alias(str(i)) for i, r in enumerate(ranges)]).first()
    filled = [i for i, n in enumerate(sizes) if n] or [0]
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(sizes) // (len(ranges) * 1000), min(sizes[i] for i in filled) // 64))
    for i in filled:
        rows.filter(ranges[i]).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def dedup_within(events: DataFrame, keys: list[str], ts: str = "ts", horizon: str = WATERMARK) -> DataFrame:
    """The first event of each key within a fixed horizon."""
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def timed(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """rows with an event time `ts` from `sec`, where they have none, and a watermark: what timers go by."""
    rows = rows if "ts" in rows.columns else rows.withColumn("ts", F.timestamp_seconds("sec"))
    return rows.withWatermark("ts", delay)


def dedup_renewed(events: DataFrame, group: str, key: str, seconds: int = 3600) -> DataFrame:
    """S1, exact: the keys of a group expire together, `seconds` after the group's latest addition.

    events has `sec`. A key is an entry of a map state of its own, looked up and added by itself; a key set that no addition renewed in time
    is forgotten as a whole, by the next event's time or when the watermark passes its end. Rows are taken in order once the watermark has passed them.
    """
    k = events.schema[key].dataType.simpleString()
    rows = timed(events).select(group, F.col("sec").cast("long").alias("sec"), F.col(key).alias("key"), "ts")
    return processors.run(rows, group, processors.Renewed(k, seconds), f"{group} {events.schema[group].dataType.simpleString()}, {key} {k}, sec long")


def live_ledger(events: DataFrame, idle: str = "2 days", ts: str = "ts") -> DataFrame:
    """Counters of each crawl, dropped after `idle` without events (update mode): a session of a crawl's events."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("long")
    return (
        events.withWatermark(ts, WATERMARK)
        .groupBy("crawlid", F.session_window(ts, idle).alias("session"))
        .agg(of("scheduled").alias("total"), of("crawled").alias("crawled"), of("failed_pages").alias("failed_pages"), of("failed_pipeline").alias("failed_pipeline"), F.min("sec").alias("start"), F.max("sec").alias("update"))
        .select("crawlid", "total", "crawled", "failed_pages", "failed_pipeline", "start", "update")
    )


def finish_notifications(events: DataFrame, idle: int = 86400, forget: int = 2 * 86400) -> DataFrame:
    """S3: one row when a crawl becomes finished; `error` if nothing came for `idle` seconds before it did.

    A silent crawl gets its row when the watermark passes the end of its time, without any later event of its own. What is known of a crawl is
    forgotten `forget` seconds (the ledger's lifetime) after its last event.
    """
    rows = timed(events).select("crawlid", F.col("sec").cast("long").alias("sec"), F.col("event_id").cast("long").alias("event_id"), "kind", F.col("n").cast("long").alias("n"), "ts")
    return processors.run(rows, "crawlid", processors.Finished(idle, forget), f"crawlid {events.schema['crawlid'].dataType.simpleString()}, status string, sec long")


def delayed_emission(messages: DataFrame, default: int = 3 * 86400) -> DataFrame:
    """The latest message of an id fires when due and is armed again; a delete disarms it.

    A message is due at its `due_date` (seconds) if it has one, else `update_interval` seconds (default where 0 or null) after it came, and again so long
    after it fired. What was due by the time of a later message of the id fires before that is taken; without one, a message fires when the watermark
    passes its time. An id has a timer for its next waiting message and one for its due time; a disarmed id has no state.
    """
    messages = messages if "due_date" in messages.columns else messages.withColumn("due_date", F.lit(None).cast("long"))
    long = [F.col(c).cast("long").alias(c) for c in ("sec", "seq", "update_interval", "due_date")]
    rows = timed(messages).select("item_id", *long, "event", "ts")
    return processors.run(rows, "item_id", processors.Delayed(default), f"item_id {messages.schema['item_id'].dataType.simpleString()}, seq long, fired long")


def retry_limit(results: DataFrame, most: int = 10, forget: int = 30 * 86400) -> DataFrame:
    """Outcomes in order (sec, seq): success clears an item's count, a failure is retried until the count reaches `most`.

    Only items that wait for a retry have state, and no longer than `forget` seconds after their last outcome: then the count starts anew.
    """
    rows = timed(results).select("item_id", F.col("sec").cast("long").alias("sec"), F.col("seq").cast("long").alias("seq"), "ok", "ts")
    return processors.run(rows, "item_id", processors.Retried(most, forget), f"item_id {results.schema['item_id'].dataType.simpleString()}, seq long, outcome string, attempts long")


def windowed_metrics(points: DataFrame, by: list[str], width: str, value: Column, ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    """Sums by tumbling window; a window is given once the watermark has passed it."""
    g = points.withWatermark(ts, watermark).groupBy(F.window(ts, width).alias("w"), *by).agg(F.sum(value).cast("long").alias("total"), F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), *by, "total", "n")


def route_stream(stream: DataFrame, sinks: Callable[[DataFrame, str], None] | list[Callable[[DataFrame, str], None]], path: str) -> None:
    """Each micro-batch goes to one or more sinks of wareflow.sinks, in order, with a name of its own.

    The name is `<query's id>-<batch number>`: the same when a batch is tried again, after a failure between two sinks too, and another one
    for every other batch and for a query with another checkpoint. A sink that replaces what it has under that name (`append_by`, `write_topics`
    with `batch`) so has each row once.
    """
    sinks = sinks if isinstance(sinks, list) else [sinks]

    def write(batch: DataFrame, number: int) -> None:
        name = f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, name)
        finally:
            batch.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", path).trigger(availableNow=True).start().awaitTermination()


def consume(messages: DataFrame, key: str, good: Callable[[DataFrame, str], None], bad: Callable[[DataFrame, str], None], path: str) -> None:
    """A2: what is there of a topic now, its messages to one sink and what isn't one to the other, in the same batch.

    The checkpoint moves on when both have the batch: after a failure of either it is read and routed again, under the same name.
    """
    route_stream(messages, [lambda b, name: good(split_errors(b, key)[0], name), lambda b, name: bad(split_errors(b, key)[1], name)], path)


def newly_finished(ledger: DataFrame, as_of: int) -> DataFrame:
    """S3 in batch: the crawls that are finished by the ledger at as_of."""
    return ledger.filter(finished(as_of)).select("crawlid")
