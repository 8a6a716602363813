"""Streaming queries over replayed tables, each with the oracle of its batch twin."""

from __future__ import annotations

from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from .. import sinks
from .. import streaming as T
from ..fixtures import cte, view
from ..sources import read_topic, split_errors
from .q_ledger import LEDGER
from .q_messages import scratch

QUERIES, SQL = {}, {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def live(s, rows, order):
    return T.replay(s, rows, scratch(s, "replay"), order)


def stamped(s, d, name):
    """A view with `ts` as a timestamp of its seconds."""
    return view(s, d, name).withColumn("ts", F.timestamp_seconds("sec"))


def a2(s, d):
    root = scratch(s, "topics")
    rows = view(s, d, "ev").select(F.when(F.col("k") % 10 == 0, "broken").otherwise(F.to_json(F.struct("event_id", "event_type", "k"))).alias("value"))
    rows.repartition(3).write.text(f"{root}/events")
    good, _ = split_errors(read_topic(s, "events", "event_id long, event_type string, k int", path=root), "event_id")
    return T.run_to_table(good, scratch(s, "out"))


add("a2_read_topic", a2, cte("ev") + "select event_id, event_type, k from ev where k % 10 <> 0")


#: Seconds of a period of S1, of the gap that follows it once the times are drawn apart, and of its horizon.
PERIOD, APART, HORIZON = 10 * 86400, 40 * 86400, 12 * 86400


def s1(s, d):
    """The events in periods of ten days, drawn so far apart that a key's horizon has passed when the next one begins; between them, messages of no
    crawl let the watermark pass it: it comes after a batch, and what has expired goes at the end of the next."""
    x = view(s, d, "crawl_events").select("crawlid", "url", (F.col("sec") + F.floor(F.col("sec") / PERIOD) * APART).alias("sec"))
    periods = [r[0] for r in x.select(F.floor(F.col("sec") / (PERIOD + APART)).cast("long")).distinct().orderBy(F.floor(F.col("sec") / (PERIOD + APART)).cast("long")).collect()]
    ends = [p * (PERIOD + APART) + PERIOD for p in periods]
    ticks = s.createDataFrame([(end, i) for end in ends for i in range(3)], "end long, i long").crossJoin(s.range(64 * int(s.conf.get("spark.sql.shuffle.partitions"))))  # enough for replay()'s files
    ticks = ticks.select(F.lit(-1).cast(x.schema["crawlid"].dataType).alias("crawlid"), F.concat_ws(" ", "end", "i", "id").alias("url"), (F.col("end") + (F.col("i") + 1) * HORIZON).alias("sec"))
    x = x.unionByName(ticks).withColumn("ts", F.timestamp_seconds("sec"))
    stream = T.replay(s, x, scratch(s, "replay"), "sec", bounds=[end + i * HORIZON for end in ends for i in range(4)][:-1])
    out = T.run_to_table(T.dedup_within(stream, ["crawlid", "url"], horizon=f"{HORIZON} seconds").select("crawlid", "url", "sec"), scratch(s, "out"))
    return out.filter("crawlid >= 0").select("crawlid", "url", F.floor(F.col("sec") / (PERIOD + APART)).cast("long").alias("period"))


add("s1_dedup_within", s1, cte("crawl_events") + f"select distinct crawlid, url, cast(floor(sec / {PERIOD}) as bigint) as period from crawl_events")
RENEWED = 6 * 3600
#: A message of no group's, long after all others: the watermark passes all timers.
END = 4000000000


def s1_renewed(s, d):
    x = view(s, d, "crawl_events").select("crawlid", "url", "sec")
    end = s.range(1).select(F.lit(-1).cast(x.schema["crawlid"].dataType).alias("crawlid"), F.lit("end").alias("url"), F.lit(END).cast("long").alias("sec"))
    return T.run_to_table(T.dedup_renewed(live(s, x.unionByName(end), "sec"), "crawlid", "url", RENEWED), scratch(s, "out")).filter("crawlid >= 0")


add(
    "s1_dedup_renewed",
    s1_renewed,
    # row by row: the set of keys, when it was last added to, and whether this row was an addition
    cte("crawl_events").replace("with ", "with recursive ", 1) + f""", o as (select crawlid, url, sec, row_number() over (partition by crawlid order by sec, url) as i from crawl_events),
 r(crawlid, i, url, sec, held, last, fresh) as (select crawlid, i, url, sec, [url], sec, true from o where i = 1 union all
  select o.crawlid, o.i, o.url, o.sec, case when o.sec - r.last >= {RENEWED} then [o.url] when list_contains(r.held, o.url) then r.held else list_append(r.held, o.url) end,
   case when o.sec - r.last >= {RENEWED} or not list_contains(r.held, o.url) then o.sec else r.last end, o.sec - r.last >= {RENEWED} or not list_contains(r.held, o.url) from r join o on o.crawlid = r.crawlid and o.i = r.i + 1)
 select crawlid, url, sec from r where fresh""",
)


#: Hours without an event after which a crawl's counters begin anew.
IDLE = 6


def s2(s, d):
    x = stamped(s, d, "crawl_events").select("crawlid", "kind", "n", "sec", "ts")
    end = x.groupBy("crawlid").agg(F.max("sec").alias("sec")).select("crawlid", F.lit("end").alias("kind"), F.lit(0).cast(x.schema["n"].dataType).alias("n"), (F.col("sec") + 400 * 86400).alias("sec"), F.timestamp_seconds(F.col("sec") + 400 * 86400).alias("ts"))
    return T.run_to_table(T.live_ledger(live(s, x.unionByName(end), "ts"), f"{IDLE} hours"), scratch(s, "out")).filter("total + crawled + failed_pages + failed_pipeline > 0")


add(
    "s2_live_ledger",
    s2,
    cte("crawl_events") + f""", g as (select *, case when sec - lag(sec) over (partition by crawlid order by sec, event_id) <= {IDLE * 3600} then 0 else 1 end as fresh from crawl_events),
 o as (select *, sum(fresh) over (partition by crawlid order by sec, event_id) as session from g),
 of_kind as (select crawlid, session, sum(case when kind = 'scheduled' then n else 0 end)::bigint as total, sum(case when kind = 'crawled' then n else 0 end)::bigint as crawled, sum(case when kind = 'failed_pages' then n else 0 end)::bigint as failed_pages,
  sum(case when kind = 'failed_pipeline' then n else 0 end)::bigint as failed_pipeline, min(sec) as start, max(sec) as "update" from o group by all)
 select crawlid, total, crawled, failed_pages, failed_pipeline, start, "update" from of_kind""",
)


def s3(s, d):
    x = view(s, d, "crawl_events").select("event_id", "crawlid", "kind", "n", "sec")
    end = s.range(1).select(F.lit(1 << 60).alias("event_id"), F.lit(-1).cast("long").alias("crawlid"), F.lit("end").alias("kind"), F.lit(0).cast(x.schema["n"].dataType).alias("n"), F.lit(END).cast("long").alias("sec"))
    return T.run_to_table(T.finish_notifications(live(s, x.unionByName(end), "sec")), scratch(s, "out")).filter("crawlid >= 0").select("crawlid", "status", "sec")


add(
    "s3_notifications",
    s3,
    # row by row: what is known of a crawl, forgotten two days after its last event once its end was told, and what the row gives
    cte("crawl_events").replace("with ", "with recursive ", 1) + """, o as (select crawlid, sec, kind, n, row_number() over (partition by crawlid order by sec, event_id) as i, count(*) over (partition by crawlid) as rows from crawl_events),
 r(crawlid, i, total, done, last, told, silent, fin) as (select crawlid, 0, 0::hugeint, 0::hugeint, null::bigint, false, null::bigint, null::bigint from o where i = 1 union all
  select crawlid, i, total, done, sec, told or fin, silent, case when fin then sec end from (select *, not told and ((total > 0 and total <= done) or (total = 0 and done > 0)) as fin from
   (select crawlid, i, sec, silent, told or silent is not null as told, total + case when kind = 'scheduled' then n else 0 end as total, done + case when kind = 'scheduled' then 0 else n end as done from
    (select *, case when last is not null and not told and sec - last >= 86400 then last + 86400 end as silent from
     (select o.crawlid, o.i, o.sec, o.kind, o.n, r.told and o.sec - r.last < 172800 as told, case when not (r.told and o.sec - r.last >= 172800) then r.last end as last,
       case when r.told and o.sec - r.last >= 172800 then 0 else r.total end as total, case when r.told and o.sec - r.last >= 172800 then 0 else r.done end as done from r join o on o.crawlid = r.crawlid and o.i = r.i + 1))))),
 e as (select *, row_number() over (partition by crawlid order by i desc) as back from r)
 select crawlid, 'error' as status, silent as sec from r where silent is not null union all select crawlid, 'finished', fin from r where fin is not null union all select crawlid, 'error', last + 86400 from e where back = 1 and not told""",
)

#: When the last message of S4 comes; what is due until an hour before has fired.
LAST = 1800000000


def s4(s, d):
    m = view(s, d, "delayed_messages").join(view(s, d, "site_delay"), "site").select("item_id", "seq", "event", "sec", (F.col("update_interval") * 300).cast("int").alias("update_interval"))
    m = m.withColumn("due_date", F.when(F.col("seq") % 5 == 0, F.col("sec") + F.col("seq") % 70 * 86400))
    end = s.range(1).select(F.lit(-1).cast("long").alias("item_id"), F.lit(0).cast("long").alias("seq"), F.lit("upsert").alias("event"), F.lit(LAST).cast("long").alias("sec"), F.lit(0).alias("update_interval"), F.lit(None).cast("long").alias("due_date"))
    return T.run_to_table(T.delayed_emission(live(s, m.unionByName(end), "sec"), 86400 * 500), scratch(s, "out")).filter("item_id >= 0")


add(
    "s4_delayed_emission",
    s4,
    cte("delayed_messages", "site_delay") + f""", m as (select item_id, seq, event, sec, coalesce(nullif(update_interval * 300, 0), 43200000) as wait, case when seq % 5 = 0 then sec + seq % 70 * 86400 end as due_date from delayed_messages join site_delay using (site)), n as (select *, coalesce(due_date, sec + wait) as due, coalesce(lead(sec) over (partition by item_id order by sec, seq), {LAST} - 3600) as until from m),
 f as (select item_id, seq, due + wait * i as fired from n, range(0, 400) r(i) where event <> 'delete' and due + wait * i <= until) select item_id, seq, cast(fired as bigint) as fired from f""",
)


#: Seconds after which an item's failures are forgotten.
FORGET = 12 * 3600


def s5(s, d):
    r = view(s, d, "ev").select((F.col("user_id") % 30).alias("item_id"), F.col("event_id").alias("seq"), "sec", (F.col("k") % 3 == 0).alias("ok"))
    end = s.range(1).select(F.lit(-1).cast("long").alias("item_id"), F.lit(0).cast("long").alias("seq"), F.lit(END).cast("long").alias("sec"), F.lit(True).alias("ok"))
    return T.run_to_table(T.retry_limit(live(s, r.unionByName(end), "sec"), 3, FORGET), scratch(s, "out")).filter("item_id >= 0")


add(
    "s5_retry_limit",
    s5,
    cte("ev") + f""", r as (select user_id % 30 as item_id, event_id as seq, sec, k % 3 = 0 as ok from ev), g as (select *, case when sec - lag(sec) over (partition by item_id order by sec, seq) >= {FORGET} then 1 else 0 end as late from r),
 b as (select *, sum(late + case when ok then 1 else 0 end) over (partition by item_id order by sec, seq) as run from g), c as (select *, sum(case when ok then 0 else 1 end) over (partition by item_id, run order by sec, seq) as f from b)
 select item_id, seq, case when ok then 'ENRICH' when f % 3 = 0 then 'abandoned' else 'retry' end as outcome, cast(case when ok then 0 when f % 3 = 0 then 3 else f % 3 end as bigint) as attempts from c""",
)


def s6(s, d):
    p = stamped(s, d, "metric_points").select("app", "site", "value", "ts")
    end = s.range(1).select(F.lit(0).cast("long").alias("app"), F.lit(-1).cast("long").alias("site"), F.lit(0).alias("value"), F.timestamp_seconds(F.lit(4000000000)).alias("ts"))
    out = T.run_to_table(T.windowed_metrics(live(s, p.unionByName(end), "ts"), ["app", "site"], "1 day", F.col("value")), scratch(s, "out"))
    return out.filter("site >= 0").select(F.unix_timestamp("start").alias("start"), "app", "site", "total", "n")


add("s6_windowed_metrics", s6, cte("metric_points") + "select cast(floor(sec / 86400) as bigint) * 86400 as start, app, site, cast(sum(value) as bigint) as total, count(*) as n from metric_points group by all")


def s7(s, d):
    """Two sinks; the second fails once in the middle, after the first has the batch, and the query is started again."""
    out, topics, keep = scratch(s, "routed"), scratch(s, "topics"), scratch(s, "checkpoint")
    x = view(s, d, "logs").select("event_id", "logger", "level")
    stream, tried = live(s, x, "event_id"), []

    def second(batch, name):
        tried.append(name)
        sinks.write_topics(batch.withColumnRenamed("logger", "topic"), path=topics, batch=name)
        if len(tried) == 2:
            raise RuntimeError("lost after the write")

    both = [lambda batch, name: sinks.append_by(batch, out, "logger", name), second]
    try:
        T.route_stream(stream, both, keep)
    except StreamingQueryException as e:
        if "lost after the write" not in str(e):
            raise
        T.route_stream(stream, both, keep)
    one = sinks.read_appended(s, out).select("event_id", F.col("logger").cast("string").alias("logger"), "level", F.lit("collection").alias("sink"))
    other = s.read.text(topics).select(F.from_json("value", "event_id long, level string").alias("m"), F.col("topic").cast("string").alias("logger"))
    return one.unionByName(other.select("m.event_id", "logger", "m.level", F.lit("topic").alias("sink")))


add("s7_routed_sinks", s7, cte("logs") + "select event_id, logger, level, sink from logs cross join (select unnest(['collection', 'topic']) as sink) s")
