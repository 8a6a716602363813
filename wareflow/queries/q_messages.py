"""Queries and oracle of sources, sinks, extraction rules and message stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from .. import sinks, sources
from ..fixtures import cte, view
from ..operators import messages as M
from ..operators.rules import Rule, extract

QUERIES, SQL = {}, {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def scratch(spark, name: str) -> str:
    """A new folder that driver and executors share (spark.checkpoint.dir where it is set)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared or tempfile.mkdtemp(prefix='spark-scratch-')}/{name}-{uuid.uuid4().hex}"


lg = cte("logs")


def a1(s, d):
    path = scratch(s, "logs")
    view(s, d, "logs").select("event_id", "logger", "level", "message", F.col("appid").cast("string").alias("appid"), F.col("status_code").cast("string").alias("status_code"), "parsed").write.json(path)
    return sources.read_logs(s, path).select("event_id", "logger", "level", "message", "appid", "status_code", "parsed")


add("a1_read_logs", a1, lg + "select event_id, logger, level, message, cast(appid as string) as appid, cast(status_code as string) as status_code, parsed from logs")


def a3(s, d, mode):
    path = scratch(s, "feed")
    p = view(s, d, "pages")
    line = F.concat(F.when(F.col("page_id") == 0, "﻿").otherwise(""), F.when(F.lit(mode == "crawl"), F.concat(F.lit("c"), F.col("page_id") % 3, F.lit("    "))).otherwise(""), "url", F.lit("\r"))
    lines = p.select(line.alias("value"))
    lines.unionByName(lines).unionByName(s.range(3).select(F.lit("  ").alias("value"))).write.text(path)
    return sources.read_feed(s, path, mode, "feed")


add("a3_read_feed", lambda s, d: a3(s, d, "url"), "select distinct 'feed' as crawlid, url from pages")
add("a3_read_crawl_feed", lambda s, d: a3(s, d, "crawl"), "select distinct 'c' || (page_id % 3) as crawlid, url from pages")


def a4(s, d):
    path = scratch(s, "sheet")
    view(s, d, "part").select(F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("Catalog Number"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit("P"), F.col("p_partkey") % 50)).alias("parent_productid"), F.col("p_partkey").alias("productid"), "p_name").write.option("header", True).csv(path)
    return sources.read_sheet(s, path).select("parent", F.size("rows").cast("long").alias("n"), F.aggregate("rows", F.lit(0).cast("long"), lambda a, x: a + x["productid"].cast("long")).alias("total"))


add("a4_read_sheet", a4, "select coalesce(case when p_size % 3 <> 0 then p_brand end, case when p_size % 2 <> 0 then 'P' || (p_partkey % 50) end, cast(p_partkey as string)) as parent, count(*) as n, cast(sum(p_partkey) as bigint) as total from part group by 1")
add("a5_windowed_scan", lambda s, d: sources.windowed_scan(view(s, d, "orders"), "o_orderkey", 10000, "o_custkey % 7 = 3").groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low")), "select o_orderkey // 10000 as \"window\", count(*) as n, min(o_orderkey) as low from orders where o_custkey % 7 = 3 group by 1")


def a5(s, d):
    """The orders in a database of the driver's own (local masters only), read back in even id windows with a filter that runs there."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    s._jvm.java.lang.System.setProperty("derby.stream.error.file", f"{tempfile.gettempdir()}/derby-{uuid.uuid4().hex}.log")
    view(s, d, "orders").select("o_orderkey", (F.col("o_custkey") % 7).cast("int").alias("site"), "o_totalprice").repartition(4).write.jdbc(url, "orders")
    return sources.read_relational(s, url, "orders", '"o_orderkey"', width=200, where='"site" = 3').select("o_orderkey", "o_totalprice")


add("a5_relational", a5, "select o_orderkey, o_totalprice from orders where o_custkey % 7 = 3")


def a6(s, d):
    path = scratch(s, "files")
    view(s, d, "nation").select("n_name", F.col("n_nationkey").alias("key")).repartition(4).write.partitionBy("key").text(path)  # a file a nation
    found = sources.read_manifest(s, path, "*.txt")
    return sources.without_digest(found, s.createDataFrame([("d41d8cd98f00b204e9800998ecf8427e",)], "digest string")).select("size", "digest")


add("a6_manifest", a6, "select length(n_name) + 1 as size, md5(n_name || chr(10)) as digest from nation")


def a7(s, d):
    path = sinks.write_tasks(view(s, d, "crawl_events").select("spiderid", "crawlid", "event_id", "kind"), scratch(s, "tasks"), "20240131000000")
    return s.read.json(path).select(F.col("spiderid").cast("long").alias("spiderid"), F.col("crawlid").cast("long").alias("crawlid"), "event_id", "kind")


add("a7_task_files", a7, cte("crawl_events") + "select spiderid, crawlid, event_id, kind from crawl_events")
add(
    "a8_route_topics",
    lambda s, d: sinks.route_topics(view(s, d, "ev").select("event_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("command"), F.col("sec").cast("double").alias("timestamp")), {"click": "t_click", "error": "t_error"}, "t_default").select("event_id", "topic", "stamp"),
    cte("ev") + "select event_id, case event_type when 'click' then 't_click' when 'error' then 't_error' else 't_default' end as topic, case when event_type = 'view' then strftime(make_timestamp(sec * 1000000), '%Y%m%d%H%M%S') else cast(sec as string) end as stamp from ev",
)


def a9(s, d, column):
    path = scratch(s, "routed")
    rows = view(s, d, "logs").select("event_id", "level", F.col(column).alias("route"))
    sinks.append_by(rows.filter("event_id % 2 = 0"), path, "route")
    sinks.append_by(rows.filter("event_id % 2 = 1"), path, "route")
    return s.read.parquet(path).select("event_id", "level", F.col("route").cast("string").alias("route"))


add("a9_collections", lambda s, d: a9(s, d, "message"), lg + "select event_id, level, message as route from logs")
add("a10_logger_folders", lambda s, d: a9(s, d, "logger"), lg + "select event_id, level, logger as route from logs")
add("a11_metric_points", lambda s, d: sinks.metric_points(view(s, d, "metric_points").withColumn("site", F.when(F.col("site") > 0, F.concat(F.lit("s"), "site")).otherwise("")), "items", ["app", "site"], F.col("value")), cte("metric_points") + "select 'items' as measurement, app, 's' || site as site, sec, value from metric_points where site > 0")

RULES = [
    Rule("lang", (("regex", '<html lang="([a-z]+)"'),), order=1),
    Rule("title", (("regex", "<nothing>(.*?)</nothing>"), ("regex", "<title>(.*?)</title>")), order=1, input="reverse"),
    Rule("n_links", (("regex", 'href="([^"]*)"'),), order=1, output=lambda v: F.size(v).cast("string"), skip=True),
    Rule("label", (("sql", "concat(lang, '-', n_links)"),), order=2),
    Rule("missing", (("regex", "<x>(.*?)</x>"),), default="none", order=3),
]
add(
    "b7_extract_rules",
    lambda s, d: extract(view(s, d, "pages"), RULES),
    "select page_id, url, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) as lang, trim(reverse(regexp_extract(html, '<title>(.*?)</title>', 1))) as title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) || '-' || len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as label, 'none' as missing from pages",
)
add("b7_extract_css", lambda s, d: extract(view(s, d, "pages"), [Rule("first", (("css", "nav li a[href]::attr(href)"),)), Rule("ad", (("css", "div.ad::text"),)), Rule("links", (("css", "li a::text"),), output=lambda v: F.size(v).cast("string"))]), "select page_id, url, regexp_extract(html, '<li><a href=\"([^\"]*)\"', 1) as first, trim(regexp_replace(regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1), '\\s+', ' ', 'g')) as ad, cast(len(regexp_extract_all(html, '<li><a ', 0)) as string) as links from pages")

ev = cte("ev")


def h1(s, d):
    x = view(s, d, "ev").select("event_id", F.col("event_type").alias("body"), "k")
    return M.compose(x, [lambda t: t.withColumn("body", F.upper("body")), lambda t: t.withColumn("body", F.when(F.col("k") % 3 == 0, "").otherwise(F.col("body"))), lambda t: t.withColumn("body", F.concat("body", F.lit("!")))]).select("event_id", "body")


add("h1_compose", h1, ev + "select event_id, upper(event_type) || '!' as body from ev where k % 3 <> 0")


def h2(s, d, branch):
    x = view(s, d, "ev").select("event_id", F.when(F.col("event_type") == "view", "explore").otherwise("update").alias("type"), (F.col("k") % 10 == 0).alias("seed"), F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit("c"), "user_id")).alias("crawlid"))
    return M.route(x, M.heavy(F.col("type"), F.col("seed"), F.col("crawlid")))[branch].select("event_id", "type", "crawlid")


for name, branch in (("h2_heavy", 0), ("h2_pass", 1)):
    add(name, lambda s, d, b=branch: h2(s, d, b), ev + f"select event_id, case when event_type = 'view' then 'explore' else 'update' end as type, case when user_id % 2 = 0 then cast(user_id as string) else 'c' || user_id end as crawlid from ev where {'not' if branch else ''} ((k % 10 = 0 or event_type = 'view') and user_id % 2 <> 0)")
add(
    "h3_build_images",
    lambda s, d: M.build_images(view(s, d, "pages").select("page_id", F.lit("loco_site").alias("spiderid"), F.array("url", F.concat("url", F.lit(".PNG"))).alias("image_urls"))).select("page_id", F.posexplode("images").alias("pos", "i")).select("page_id", "pos", "i.url", "i.path", "i.origin"),
    "with u as (select page_id, unnest([0, 1]) as pos, unnest([url, url || '.PNG']) as url from pages) select page_id, pos, url, '/site/' || sha1(url) || coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([.][a-zA-Z0-9]+)$', 1)), ''), '.jpg') as path, 'source' as origin from u",
)
add(
    "h4_intake",
    lambda s, d: M.intake(view(s, d, "line").select((F.col("l_partkey") * 1000000 + F.col("pos")).alias("seq"), F.concat(F.lit("i"), F.col("l_partkey") % 400).alias("item_id"), F.concat(F.when(F.col("l_returnflag") == "A", "Image").otherwise("Bullet"), F.lit("::"), "l_linenumber").alias("item_type"), F.when(F.col("l_suppkey") % 3 == 0, "done").otherwise("").alias("translated")), "Bullet", "translated", "seq"),
    cte("line") + "select 'i' || (l_partkey % 400) as item_id, 'Bullet::' || l_linenumber as item_type, min(l_partkey * 1000000 + pos) as seq, '' as translated from line where l_returnflag <> 'A' and l_suppkey % 3 <> 0 group by 1, 2",
)


def memory(s, d):
    return view(s, d, "documents").select(F.explode(F.array_distinct(F.split("text", "[ \n]+"))).alias("src")).distinct().filter("src <> '' and length(src) % 2 = 0").select("src", F.reverse("src").alias("dst"))


MEMORY = "memory as (select src, reverse(src) as dst from (select distinct unnest(regexp_split_to_array(text, '[ \\n]+')) as src from documents) where src <> '' and length(src) % 2 = 0)"
add(
    "h5_translate",
    lambda s, d: M.translate(view(s, d, "documents").select(F.col("doc_id").alias("id"), "text"), memory(s, d)).select("id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n")),
    f"with {MEMORY}, p as (select doc_id as id, regexp_split_to_array(text, '[ \\n]+') as a from documents), u as (select id, unnest(a) as src, unnest(range(len(a))) as pos from p), t as (select id, string_agg(coalesce(dst, src), ' ' order by pos) as text from u left join memory using (src) group by id) select id, md5(text) as digest, length(text) as n from t",
)
add(
    "h5_translate_pairs",
    lambda s, d: M.translate_pairs(view(s, d, "part").select(F.col("p_partkey").alias("id"), F.to_json(F.array("p_brand", "p_name", "p_type", F.lit("small ring"), F.lit("tail"))).alias("specs")), view(s, d, "part").select(F.col("p_name").alias("src"), F.upper("p_name").alias("dst"))),
    "select p_partkey as id, '[\"' || p_brand || '\",\"' || upper(p_name) || '\",\"' || p_type || '\",\"' || case when 'small ring' in (select p_name from part) then 'SMALL RING' else 'small ring' end || '\"]' as specs from part",
)


def h6(s, d):
    pages = view(s, d, "pages")
    seg = M.tag_segments(pages, "page_id", "html")
    texts = seg.select("page_id", F.posexplode("texts").alias("pos", "text")).withColumn("text", F.translate("text", "e", "E"))
    return M.fill_template(seg, "page_id", texts).join(pages.select("page_id", F.upper("html").alias("u")), "page_id").select("page_id", (F.upper("html") == F.col("u")).alias("whole"), F.length("html").cast("long").alias("n"))


add("h6_tag_segments", h6, "select page_id, true as whole, length(html) as n from pages")
add(
    "h6_segments",
    lambda s, d: M.tag_segments(view(s, d, "pages"), "page_id", "html").select("page_id", F.size("texts").cast("long").alias("n"), F.md5(F.array_join("texts", "|")).alias("digest")),
    "with t as (select page_id, list_filter(regexp_split_to_array(html, '<[^>]*>'), lambda x: trim(x) <> '') as t from pages) select page_id, len(t) as n, md5(array_to_string(t, '|')) as digest from t",
)
add(
    "h7_merge_results",
    lambda s, d: M.merge_results(view(s, d, "ev").select(F.col("event_id").alias("item_id"), (F.col("k") % 4 > 0).alias("ok")), view(s, d, "ev").filter("k % 3 > 0").select(F.col("event_id").alias("item_id"), (F.col("k") % 13).alias("attempts")), 10),
    ev + ", r as (select event_id as item_id, k % 4 > 0 as ok, case when k % 3 > 0 then k % 13 else 0 end + case when k % 4 > 0 then 0 else 1 end as attempts from ev) select item_id, ok, attempts, case when ok then 'ENRICH' when attempts < 10 then 'retry' else 'abandoned' end as outcome from r",
)
