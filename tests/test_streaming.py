"""Streams: state by key, timers, hot groups, restarts and sinks that are written again."""

import json
import os

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from wareflow import sinks, sources
from wareflow import streaming as T
from wareflow.streaming import processors

END = 3_000_000_000


#: What the tests' times are counted from: the first watermark is 1970 itself.
T0 = 1_000_000


def write(spark, path, schema, rows):
    """A file of rows, their seconds counted from T0."""
    df = spark.createDataFrame(rows, schema)
    late = {c: F.col(c) + T0 for c in ("sec", "due_date") if c in df.columns}
    df.withColumns(late).coalesce(1).write.mode("append").parquet(path)


def batches(spark, path, schema, *parts):
    """A stream that gives each part in a batch of its own."""
    for rows in parts:
        write(spark, path, schema, rows)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def done(stream, tmp_path, name="out"):
    """The rows that a stream gives, their seconds counted from T0."""
    out = T.run_to_table(stream, str(tmp_path / name))
    return out.withColumns({c: F.col(c) - T0 for c in ("sec", "fired") if c in out.columns}).collect()


KEYS = "who long, key string, sec long"


def test_renewal_is_by_key(spark, tmp_path):
    """Additions renew the whole set, repeats don't; rows out of order within a batch and across batches are taken in their place; null keys count."""
    first = [(1, "b", 50), (1, "a", 0), (1, "a", 90), (1, None, 95), (1, None, 96), (None, "x", 5), (None, "x", 6)]
    later = [(1, "c", 60), (1, "a", 194), (1, "a", 195 + 100), (9, "end", END)]  # c came late, but before the watermark
    got = done(T.dedup_renewed(batches(spark, str(tmp_path / "in"), KEYS, first, later), "who", "key", 100), tmp_path)
    # a 0, b 50, c 60 and null 95 are additions; a at 194 is held (95 + 100 = 195 is the end), at 295 it is new
    assert {tuple(r) for r in got} == {(1, "a", 0), (1, "b", 50), (1, "c", 60), (1, None, 95), (1, "a", 295), (None, "x", 5)}


def test_many_keys_of_one_group(spark, tmp_path, monkeypatch):
    """One group with 5,000 keys in a batch and again in the next: each is an entry of its own, put in order a part at a time."""
    monkeypatch.setattr(processors, "ORDERED", 3_000)
    n = 10_000
    path = str(tmp_path / "in")
    rows = spark.range(n).select(F.lit(7).cast("long").alias("who"), F.concat(F.lit("k"), F.col("id") % (n // 2)).alias("key"), (F.col("id") * 7919 % n + T0).alias("sec"))
    for part in (rows, rows.withColumn("sec", F.col("sec") + n)):
        part.coalesce(1).write.mode("append").parquet(path)
    write(spark, path, KEYS, [(9, "end", END)])
    got = done(T.dedup_renewed(spark.readStream.schema(KEYS).option("maxFilesPerTrigger", 1).parquet(path), "who", "key", 10**6), tmp_path)
    least = {}
    for i in range(n):
        key = f"k{i % (n // 2)}"
        least[key] = min(least.get(key, n), i * 7919 % n)
    assert {(r.key, r.sec) for r in got} == set(least.items()) and len(got) == n // 2


def test_a_hundred_thousand_messages_of_one_id(spark, tmp_path, monkeypatch):
    """All in one batch, in no order, put in order a part at a time: each message replaces the one before it, which fires if it was due by then."""
    monkeypatch.setattr(processors, "ORDERED", 20_000)
    n = 100_000
    path = str(tmp_path / "in")
    rows = spark.range(n).select(F.lit(1).cast("long").alias("item_id"), F.col("id").alias("seq"), F.lit("upsert").alias("event"), (F.col("id") * 10 + T0).alias("sec"), F.when(F.col("id") % 1000 == 0, 4).otherwise(1000).cast("int").alias("update_interval"))
    rows.orderBy(F.xxhash64("seq")).coalesce(1).write.parquet(path)
    end = spark.createDataFrame([(9, 0, "upsert", n * 10 + 7200 + T0, 0)], rows.schema)
    end.coalesce(1).write.mode("append").parquet(path)
    got = done(T.delayed_emission(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path), 10**9), tmp_path)
    wanted = {(i, i * 10 + k) for i in range(0, n, 1000) for k in (4, 8)}  # every thousandth fires twice before the next
    wanted |= {(n - 1, (n - 1) * 10 + k) for k in range(1000, 3600, 1000)}  # the last one until the watermark
    assert {(r.seq, r.fired) for r in got if r.item_id == 1} == wanted


def test_messages_fire_without_a_later_one(spark, tmp_path):
    schema = "item_id string, seq long, event string, sec long, update_interval int, due_date long"
    parts = [[("a", 1, "upsert", 0, 100, None), ("b", 1, "upsert", 0, 100, 30), ("c", 1, "upsert", 0, 0, None)], [("b", 2, "delete", 120, 0, None), ("c", 2, "upsert", 10, None, None)], [("z", 1, "upsert", 3600 + 250, 0, None)]]
    got = done(T.delayed_emission(batches(spark, str(tmp_path / "in"), schema, *parts), 1000), tmp_path)
    assert {tuple(r) for r in got} == {("a", 1, 100), ("a", 1, 200), ("b", 1, 30)}


def test_finish_and_silence(spark, tmp_path):
    schema = "crawlid long, event_id long, kind string, n long, sec long"
    parts = [
        [(1, 1, "scheduled", 2, 0), (1, 3, "crawled", 1, 20), (1, 2, "crawled", 1, 10), (2, 4, "scheduled", 5, 0), (3, 5, "crawled", 1, 3)],
        [(2, 6, "crawled", 5, 86400 + 5), (1, 7, "scheduled", 1, 40 * 86400), (4, 8, "scheduled", 1, 41 * 86400)],
        [(9, 9, "end", 0, END)],
    ]
    got = done(T.finish_notifications(batches(spark, str(tmp_path / "in"), schema, *parts)), tmp_path)
    # crawl 1 was forgotten by day 40 and is a new one then
    assert {tuple(r) for r in got if r.crawlid < 9} == {(1, "finished", 20), (1, "error", 41 * 86400), (2, "error", 86400), (3, "finished", 3), (4, "error", 42 * 86400)}


def test_waiting_items_are_forgotten(spark, tmp_path):
    schema = "item_id long, seq long, sec long, ok boolean"
    parts = [[(1, 1, 0, False), (1, 2, 50, False), (2, 1, 0, False), (3, 1, 0, False)], [(1, 3, 60, False), (2, 2, 100, False), (3, 2, 10, True), (3, 3, 20, None)], [(9, 1, END, True)]]
    got = done(T.retry_limit(batches(spark, str(tmp_path / "in"), schema, *parts), 3, 100), tmp_path)
    assert {tuple(r) for r in got if r.item_id < 9} == {(1, 1, "retry", 1), (1, 2, "retry", 2), (1, 3, "abandoned", 3), (2, 1, "retry", 1), (2, 2, "retry", 1), (3, 1, "retry", 1), (3, 2, "ENRICH", 0), (3, 3, "retry", 1)}


def test_state_outlives_a_restart(spark, tmp_path):
    """What a stopped query knew, its waiting rows and its timers are there when it begins again."""
    path = str(tmp_path / "in")
    put = lambda rows: write(spark, path, KEYS, rows)
    read = lambda: T.dedup_renewed(spark.readStream.schema(KEYS).option("maxFilesPerTrigger", 1).parquet(path), "who", "key", 10_000)
    put([(1, "a", 0), (1, "b", 10)])
    put([(9, "tick", 3600 + 5)])
    assert {tuple(r) for r in done(read(), tmp_path)} == {(1, "a", 0)}
    put([(1, "a", 3700), (1, "b", 3700), (1, "c", 3700)])
    put([(9, "end", END)])
    assert {tuple(r) for r in done(read(), tmp_path) if r.who == 1} == {(1, "a", 0), (1, "b", 10), (1, "c", 3700)}


def test_orders_are_cut_by_time():
    class Rows:
        def get(self):
            return iter([(t,) for t in range(0, 10_000, 2)] + [(10_001,)] * 7)

    runs = list(processors.InOrder.runs(Rows(), 0, 20_000, processors.ORDERED + 1))
    assert runs == [(0, 20_001)]
    old, processors.ORDERED = processors.ORDERED, 500
    try:
        runs = list(processors.InOrder.runs(Rows(), 0, 20_000, 5007))
    finally:
        processors.ORDERED = old
    assert runs[0][0] == 0 and runs[-1][1] == 20_001 and all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False))
    assert max(sum(a <= t < b for (t,) in Rows().get()) for a, b in runs) <= 520


@pytest.mark.parametrize("fails", ["first", "second"])
def test_a_batch_that_is_tried_again_is_there_once(spark, tmp_path, fails):
    """The sink fails after its write in the second batch; the query begins again from its checkpoint, and another query writes beside it."""
    stream = batches(spark, str(tmp_path / "in"), "id long, collection string, command string", *[[(10 * b + i, f"c{i % 2}", "x") for i in range(5)] for b in range(4)])
    out, topics, calls = str(tmp_path / "out"), str(tmp_path / "topics"), []

    def lost(which):
        calls.append(which)
        if which == fails and calls.count(which) == 2:
            raise RuntimeError("lost")

    def first(batch, name):
        sinks.append_by(batch, out, "collection", name)
        lost("first")

    def second(batch, name):
        sinks.write_topics(batch.withColumnRenamed("collection", "topic"), path=topics, batch=name)
        lost("second")

    with pytest.raises(StreamingQueryException):
        T.route_stream(stream, [first, second], str(tmp_path / "keep"))
    T.route_stream(stream, [first, second], str(tmp_path / "keep"))
    wanted = sorted((10 * b + i, f"c{i % 2}") for b in range(4) for i in range(5))
    assert sorted((r.id, r.collection) for r in sinks.read_appended(spark, out).collect()) == wanted
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(topics).collect()) == [i for i, _ in wanted]
    T.route_stream(stream, first, str(tmp_path / "another"))  # another checkpoint: its batches don't replace those
    assert sinks.read_appended(spark, out).count() == 2 * len(wanted)


def test_topic_restarts_where_it_stopped(spark, tmp_path):
    """Messages and errors of a topic in the same batch; the error sink fails in the middle; nothing is lost or doubled."""
    folder = tmp_path / "in" / "events"
    os.makedirs(folder)
    for b in range(4):
        (folder / f"{b}.txt").write_text("".join(f'{{"event_id": {10 * b + i}}}\n' for i in range(5)) + f"broken {b}\n\n[1]\n")
    good, bad, calls = str(tmp_path / "good"), str(tmp_path / "bad"), []

    def errors(batch, name):
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("no answer")
        batch.write.mode("overwrite").text(f"{bad}/{sinks.BATCH}={name}")

    messages = lambda: sources.read_topic(spark, "events", "event_id long", path=str(tmp_path / "in"), options={"maxFilesPerTrigger": "1"})
    write = lambda batch, name: batch.write.mode("overwrite").parquet(f"{good}/{sinks.BATCH}={name}")
    with pytest.raises(StreamingQueryException):
        T.consume(messages(), "event_id", write, errors, str(tmp_path / "keep"))
    T.consume(messages(), "event_id", write, errors, str(tmp_path / "keep"))
    assert sorted(r.event_id for r in sinks.read_appended(spark, good).collect()) == sorted(10 * b + i for b in range(4) for i in range(5))
    assert sorted(r.value for r in spark.read.text(bad).collect()) == sorted(x for b in range(4) for x in (f"broken {b}", "", "[1]"))
    (folder / "4.txt").write_text('{"event_id": 99}\n')
    T.consume(messages(), "event_id", write, errors, str(tmp_path / "keep"))
    assert len(calls) == 6 and calls[2] == calls[3] and sinks.read_appended(spark, good).count() == 21


def test_replay_is_in_ranges(spark, tmp_path):
    rows = spark.range(9000).select((F.col("id") * 7 % 9000).alias("at"), F.col("id").alias("n"))
    seen = []
    stream = T.replay(spark, rows, str(tmp_path / "in"), "at")
    T.route_stream(stream, lambda batch, name: seen.append(batch.agg(F.min("at"), F.max("at"), F.count("at")).first()), str(tmp_path / "keep"))
    assert len(seen) == 4 and sum(r[2] for r in seen) == 9000 and all(a[1] < b[0] for a, b in zip(seen, seen[1:], strict=False)) and min(r[2] for r in seen) > 2000


def test_a_small_range_is_a_batch_of_its_own(spark, tmp_path):
    """A range of one row among ranges of thousands, and one without rows: no batch has rows of two ranges."""
    rows = spark.range(60_000).select(F.when(F.col("id") < 30_000, F.col("id")).when(F.col("id") == 30_000, 50_000).otherwise(F.col("id") + 100_000).alias("at"))
    seen = []
    stream = T.replay(spark, rows, str(tmp_path / "in"), "at", bounds=[29_999, 40_000, 50_000])
    T.route_stream(stream, lambda batch, name: seen.append(batch.agg(F.min("at"), F.max("at"), F.count("at")).first()), str(tmp_path / "keep"))
    assert [tuple(r) for r in seen] == [(0, 29_999, 30_000), (50_000, 50_000, 1), (130_001, 159_999, 29_999)]


def test_relational_windows_are_even(spark, tmp_path):
    """Against a database: a tenth of the id range has nine tenths of the rows, and each window still has about as many as the others."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url = "jdbc:derby:memory:even;create=true"
    rows = spark.range(5000).select(F.when(F.col("id") < 4500, F.col("id")).otherwise(F.col("id") * 100).cast("long").alias("id"), (F.col("id") % 4).cast("int").alias("site"))
    rows.coalesce(1).write.jdbc(url, "items", mode="overwrite")
    got = sources.read_relational(spark, url, "items", '"id"', width=250, where='"site" = 3')
    each = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert got.count() == 1250 and got.rdd.getNumPartitions() == 5 and len(each) == 5 and max(each) <= 1.3 * min(each)
    assert {r.id for r in got.collect()} == {r.id for r in rows.filter("site = 3").collect()}
    fixed = sources.read_relational(spark, url, "items", '"id"', 0, 4500, 1000, '"site" = 3')
    assert fixed.rdd.getNumPartitions() == 5 and fixed.count() == 1125
    assert sources.read_relational(spark, url, "items", '"id"', where='"site" = 9').count() == 0
    assert sources.read_relational(spark, url, "items", '"id"', width=10**6).count() == 5000


def plain_retries(rows, most, forget):
    count, last, out = 0, None, []
    for sec, seq, ok in rows:
        count = 0 if ok or (last is not None and sec - last >= forget) else count
        count, last = 0 if ok else count + 1, sec
        out.append((seq, "ENRICH" if ok else "retry" if count < most else "abandoned", count))
        count = 0 if count >= most else count
    return out


def plain_notices(rows, idle, forget):
    total, done, last, told, out = 0, 0, None, False, []
    for sec, _, kind, n in rows:
        if told and sec - last >= forget:
            total, done, last, told = 0, 0, None, False
        if last is not None and not told and sec - last >= idle:
            told = True
            out.append(("error", last + idle))
        total, done, last = total + n * (kind == "scheduled"), done + n * (kind != "scheduled"), sec
        if not told and (0 < total <= done or (total == 0 and done > 0)):
            told = True
            out.append(("finished", sec))
    return out


def plain_firings(rows, default, end):
    due, out = None, []
    for sec, seq, event, wait, date in [*rows, (end, None, None, None, None)]:
        while due is not None and due <= sec:
            out.append((held, due))  # noqa: F821
            due += each  # noqa: F821
        held, each = seq, wait or default
        due = None if event == "delete" else sec + each if date is None else date
    return out


@pytest.mark.parametrize("seed", range(5))
def test_rows_are_taken_by_columns(seed, monkeypatch):
    """Retries, notices and firings of many rows in runs of any length, by columns: as row by row."""
    import random

    import pyarrow as pa

    r = random.Random(seed)
    monkeypatch.setattr(processors, "GIVEN", 7)
    secs = [0]
    for _ in range(3000):
        secs.append(secs[-1] + r.choice([0, 1, 5, 20, 90, 100, 250]))
    results = [(t, i, r.choice([True, False, False, None])) for i, t in enumerate(secs)]
    events = [(t, i, r.choice(["scheduled", "crawled", "crawled", None]), r.randint(0, 3)) for i, t in enumerate(secs)]
    messages = [(t, i, r.choice(["upsert", "delete", None]), r.choice([0, None, 3, 40]), r.choice([None, None, t - 10, t + 100])) for i, t in enumerate(secs)]

    def taken(processor, rows, end=None):
        processor.load(None)
        out, at = [], 0
        while at < len(rows):
            n = r.choice([1, 2, 50, 700])
            part = rows[at : at + n]
            out += [x for c in processor.take(pa.table({c: pa.array(v) for c, v in zip(processor.waits, zip(*part, strict=True), strict=True)})) for x in zip(*c, strict=True)]
            at += n
        return out + [x for c in processor.passed(end) for x in zip(*c, strict=True)] if end else out

    assert taken(processors.Retried(3, 100), results) == plain_retries(results, 3, 100)
    assert taken(processors.Finished(90, 200), events) == plain_notices(events, 90, 200)
    assert taken(processors.Delayed(30), messages, secs[-1] + 500) == plain_firings(messages, 30, secs[-1] + 500)
