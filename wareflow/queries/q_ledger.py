"""Queries and oracle of the ledger and log families."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import AS_OF, cte, view
from ..operators import ledger as L
from ..operators import logs as G

QUERIES, SQL = {}, {}
LEDGER = """, led as (select crawlid, cast(coalesce(sum(case when kind='scheduled' then n end),0) as bigint) as total, cast(coalesce(sum(case when kind='crawled' then n end),0) as bigint) as crawled,
 cast(coalesce(sum(case when kind='failed_pages' then n end),0) as bigint) as failed_pages, cast(coalesce(sum(case when kind='failed_pipeline' then n end),0) as bigint) as failed_pipeline, cast(0 as bigint) as dropped,
 min(sec) as start, max(sec) as "update" from crawl_events group by crawlid) """


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


ce = cte("crawl_events")
lg = cte("logs")
add("f1_ledger", lambda s, d: L.ledger(view(s, d, "crawl_events")), ce + LEDGER + "select * from led")
add(
    "f2_report",
    lambda s, d: L.report(L.ledger(view(s, d, "crawl_events"))),
    ce + LEDGER + """, m as (select *, round(("update" - start) / 60.0, 2) as minutes from led) select crawlid, cast(minutes as double) as minutes,
 coalesce(case when minutes = 0 then 0 else round(cast(crawled as double) / cast(minutes as double), 2) end, 0) as per_minute,
 coalesce(case when total = 0 then 0 else round(crawled * 100.0::double / total, 2) end, 0) as success, total - crawled - failed_pages - failed_pipeline - dropped as missing from m""",
)
DONE = "((total > 0 and total <= crawled+failed_pages+failed_pipeline) or (total = 0 and crawled+failed_pages+failed_pipeline > 0) or {a} - \"update\" >= 86400)"
for name, when in (("f3_finish_rule", AS_OF), ("f3_finish_rule_later", AS_OF + 2 * 86400)):
    add(
        name,
        lambda s, d, when=when: L.finish_rule(L.ledger(view(s, d, "crawl_events")), when),
        ce + LEDGER + f"select crawlid, {DONE.format(a=when)} as finished, cast(case when {DONE.format(a=when)} then total - crawled - failed_pages - failed_pipeline else 0 end as bigint) as missing from led",
    )
add("f4_task_list", lambda s, d: L.task_list(L.ledger(view(s, d, "crawl_events"))), ce + LEDGER + "select * from led")
add(
    "f4_task_lookup",
    lambda s, d: L.task_lookup(L.ledger(view(s, d, "crawl_events")), "3|5|8|13|99", AS_OF),
    ce + LEDGER + f"select crawlid, case when {DONE.format(a=AS_OF)} then 'finished' else 'crawled' end as status from led where cast(crawlid as string) in ('3','5','8','13','99')",
)
add(
    "f5_failure_details",
    lambda s, d: L.failure_details(view(s, d, "crawl_events")),
    ce + "select crawlid, kind, url, times, split_part(reason,'|',1) as line, cast(len(string_split(reason,'|')) as bigint) as lines from (select crawlid, kind, url, count(*) as times, arg_max(reason, (us, event_id)) as reason from crawl_events where kind like 'failed%' group by all)",
)
add("f5_failure_counts", lambda s, d: L.failure_counts(view(s, d, "crawl_events")), ce + "select crawlid, kind, count(*) as failures, count(distinct url) as urls from crawl_events where kind like 'failed%' group by all")
add(
    "f6_feed_rate",
    lambda s, d: L.feed_rate(view(s, d, "logs"), "crawlid", "success"),
    lg + "select crawlid, round(avg(case when success then 1.0::double else 0.0 end) * 100, 2) as success_rate, round(avg(case when success then 0.0::double else 1.0 end) * 100, 2) as failure_rate from logs group by 1",
)


def f7(s, d):
    p = view(s, d, "part")
    nodes = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type"))
    return L.quality_report(p.select(F.col("p_partkey").alias("product_id"), nodes.alias("nodes"), F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.col("p_brand")).alias("brand")))


add("f7_quality_report", f7, "select p_partkey as product_id, p_size % 5 = 0 as no_nodes, p_partkey % 9 = 0 or p_brand = '' as no_brand from part where p_size % 5 = 0 or p_partkey % 9 = 0 or p_brand = ''")
add(
    "f8_refresh_counts",
    lambda s, d: L.refresh_counts(view(s, d, "ev").select("sec", (F.col("user_id") % 5).alias("site"), F.concat(F.when(F.col("k") % 3 == 0, "x_roc_").otherwise("roc"), F.col("k").cast("string")).alias("crawl_name"))),
    cte("ev") + "select user_id % 5 as site, cast(floor(sec / 86400) as bigint) * 86400 as bucket, count(*) as n from ev where k % 3 = 0 group by all",
)
# spiders of very different sizes: the square root of the customer
add("f9_admission", lambda s, d: L.admission(view(s, d, "orders").select(F.floor(F.sqrt(F.col("o_custkey"))).alias("spiderid")), 200), "select cast(floor(sqrt(o_custkey)) as bigint) as spiderid, count(*) as waiting, count(*) <= 200 as admitted from orders group by 1")
add(
    "f10_task_summary",
    lambda s, d: L.task_summary(view(s, d, "logs").select((F.col("host") + F.when(F.col("success"), 0).otherwise(F.col("host") % 2 * 100)).alias("site"), F.col("success").alias("ok"))),
    # the errors of odd hosts are a site of their own, which has no success
    lg + "select host + case when success then 0 else host % 2 * 100 end as site, count(*) as total, count(*) filter (where not success) as errors, count(*) filter (where not success) < count(*) as success from logs group by 1",
)


def c15(s, d, which):
    purged = s.createDataFrame([(3, None), (4, 4), (5, 99)], "crawlid long, spiderid long")
    events = view(s, d, "crawl_events")
    led, queue = L.purge_crawl(L.ledger(events), events.filter("kind = 'scheduled'").select("event_id", "crawlid", "spiderid"), purged)
    return led if which else queue


add("c15_purge_ledger", lambda s, d: c15(s, d, True), ce + LEDGER + "select * from led where crawlid not in (3,4,5)")
add("c15_purge_queue", lambda s, d: c15(s, d, False), ce + "select event_id, crawlid, spiderid from crawl_events where kind = 'scheduled' and crawlid <> 3 and not (crawlid = 4 and spiderid = 4) and not (crawlid = 5 and spiderid = 99)")
add(
    "g9_in_flight",
    lambda s, d: L.in_flight(view(s, d, "metric_points")).select("event_id", "app", "site", "backlog", "site_backlog"),
    cte("metric_points") + "select event_id, app, site, cast(sum(value) over (partition by app, site order by us, event_id) as bigint) as backlog, cast(sum(value) over (partition by site order by us, event_id) as bigint) as site_backlog from metric_points",
)
add(
    "g12_endpoint_health",
    lambda s, d: L.endpoint_health(view(s, d, "ev").select(F.col("user_id").alias("endpoint"), F.col("event_id").alias("seq"), (F.col("k") % 3 == 0).alias("ok"))),
    cte("ev") + """, r as (select user_id as endpoint, event_id as seq, k % 3 = 0 as ok, sum(case when k % 3 = 0 then 1 else 0 end) over (partition by user_id order by event_id) as run from ev),
 f as (select *, cast(sum(case when ok then 0 else 1 end) over (partition by endpoint, run order by seq) as bigint) as failures from r)
 select endpoint, arg_max(failures, seq) as failures, max(failures) as worst, max(failures) > 5 as dropped from f group by 1""",
)

# logs
for term, n in (("host", 5), ("status_code", 25), ("appid", 5)):
    add(f"f11_top_{term}", lambda s, d, t=term, n=n: G.top_terms(view(s, d, "logs"), t, n), lg + f"select {term}, count(*) as n from logs group by 1 order by n desc, {term} limit {n}")
add(
    "f12_nested_top",
    lambda s, d: G.nested_top(view(s, d, "logs"), "appid", "crawlid"),
    lg + """, p as (select appid, crawlid, count(*) as n from logs group by all), t as (select appid, cast(sum(n) as bigint) as total from p group by 1 order by 2 desc, 1 limit 5)
 select * from (select appid, crawlid, n, total, cast(row_number() over (partition by appid order by n desc, crawlid) as int) as rank from p join t using (appid)) where rank <= 5""",
)
add(
    "f13_filter_buckets",
    lambda s, d: G.filter_buckets(view(s, d, "logs"), {"both": F.col("parsed") & F.col("valid"), "parsed only": F.col("parsed") & ~F.col("valid"), "neither": ~F.col("parsed") & ~F.col("valid")}, "appid"),
    lg + """, b as (select appid, case when parsed and valid then 'both' when parsed then 'parsed only' when not valid then 'neither' end as bucket from logs), c as (select bucket, appid, count(*) as n from b where bucket is not null group by all)
 select * from (select bucket, appid, n, cast(row_number() over (partition by bucket order by n desc, appid) as int) as rank from c) where rank <= 5""",
)
B = "cast(floor(sec / {w}) as bigint) * {w}"
for term in ("status_code", "success", "message"):
    add(
        f"f14_histogram_{term}",
        lambda s, d, t=term: G.histogram_terms(view(s, d, "logs"), t, 7200),
        lg + f", c as (select {B.format(w=7200)} as bucket, {term}, count(*) as n from logs group by all) select * from (select *, cast(row_number() over (partition by bucket order by n desc, {term}) as int) as rank from c) where rank <= 5",
    )
add(
    "f15_histogram_share",
    lambda s, d: G.histogram_share(view(s, d, "logs"), "host", 7200),
    lg + f", c as (select {B.format(w=7200)} as bucket, host, count(*) as n from logs group by all) select * from (select *, cast(row_number() over (partition by bucket order by n desc, host) as int) as rank, round(100.0::double * n / sum(n) over (partition by bucket), 6) as share from c) where rank <= 20",
)
add("f16_histogram_valid", lambda s, d: G.histogram_valid(view(s, d, "logs"), 7200), lg + f"select {B.format(w=7200)} as bucket, count(*) filter (where valid) as valid, count(*) filter (where not valid) as invalid from logs group by 1")
add(
    "f17_rolling_totals",
    lambda s, d: G.rolling_totals(view(s, d, "logs"), "appid", [900, 86400, 604800]).select("event_id", *[f"{a}_{n}" for n in (900, 86400, 604800) for a in ("total", "fail")]),
    lg + "select event_id, " + ", ".join(f"count(*) over (partition by appid order by sec range between {n} preceding and current row) as total_{n}, count(*) filter (where not success) over (partition by appid order by sec range between {n} preceding and current row) as fail_{n}" for n in (900, 86400, 604800)) + " from logs",
)
ROLLED = "count(*) over (partition by status_code order by sec range between {n} preceding and current row)"
add(
    "f17_link_totals",
    lambda s, d: G.link_totals(view(s, d, "logs"), "status_code", [900, 3600, 86400], 7200),
    lg + ", r as (select sec, status_code, " + ", ".join(f"{ROLLED.format(n=n)} as t_{n}" for n in (900, 3600, 86400)) + f" from logs) select {B.format(w=7200)} as bucket, status_code, " + ", ".join(f"round(avg(t_{n}), 6) as avg_total_{n}" for n in (900, 3600, 86400)) + " from r group by 1, 2",
)
add(
    "f17_queue_backlog",
    lambda s, d: G.queue_backlog(view(s, d, "metric_points").withColumnRenamed("site", "queue"), "queue", 7200),
    cte("metric_points") + f", r as (select sec, site as queue, sum(value) over (partition by site order by us, event_id) as v from metric_points) select {B.format(w=7200)} as bucket, queue, round(avg(v), 6) as avg_backlog from r group by 1, 2",
)
add(
    "f17_histogram_averages",
    lambda s, d: G.histogram_averages(G.rolling_totals(view(s, d, "logs"), "appid", [3600]), 7200, ["total_3600", "fail_3600", "k"]),
    lg + f""", r as (select *, count(*) over (partition by appid order by sec range between 3600 preceding and current row) as total_3600, count(*) filter (where not success) over (partition by appid order by sec range between 3600 preceding and current row) as fail_3600 from logs)
 select {B.format(w=7200)} as bucket, round(avg(total_3600), 6) as avg_total_3600, round(avg(fail_3600), 6) as avg_fail_3600, round(avg(k), 6) as avg_k from r group by 1""",
)
add(
    "f18_single_metrics",
    lambda s, d: G.single_metrics(view(s, d, "logs").groupBy(G.bucket(86400)).agg((F.max("sec") - F.min("sec")).alias("lifetime"), F.count("appid").alias("spiders"), F.countDistinct("appid").alias("unique_spiders"))),
    lg + f", b as (select {B.format(w=86400)} as bucket, max(sec) - min(sec) as lifetime, count(appid) as spiders, count(distinct appid) as unique_spiders from logs group by 1) select max(lifetime) as max_lifetime, round(avg(spiders), 6) as avg_spiders, round(avg(unique_spiders), 6) as avg_unique_spiders from b",
)
add(
    "f19_auto_histogram",
    lambda s, d: G.auto_histogram(view(s, d, "logs")),
    lg + ", s as (select max(sec) - min(sec) as s from logs), w as (select min(w) as width from (values " + ",".join(f"(cast({w} as bigint))" for w in G.WIDTHS) + ") v(w), s where s.s / w <= 100) select (sec // width) * width as bucket, count(*) as n, width from logs, w group by all",
)
add(
    "f20_saved_search",
    lambda s, d: G.saved_search(view(s, d, "logs"), "logger2", ["event_id", "level", "message", "appid", "status_code", "sec"]),
    lg + "select event_id, level, message, appid, status_code, sec from logs where logger = 'logger2'",
)
add(
    "g15_retention",
    lambda s, d: G.retention(view(s, d, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp")), "stamp", AS_OF, F.when(F.col("user_id") % 3 == 0, 6).otherwise(10)),
    f"select event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp from events where strftime(ts, '%Y-%m-%d %H:%M:%S') > strftime(make_timestamp(cast({AS_OF} - case when user_id % 3 = 0 then 6 else 10 end * 86400 as bigint) * 1000000), '%Y-%m-%d %H:%M:%S')",
)
