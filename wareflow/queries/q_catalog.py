"""Queries and oracle of the catalog, the frontier and the refresh loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import AS_OF, cte, view
from ..operators import catalog as C
from ..operators import frontier as N
from ..operators.pages import extract_links
from ..operators.variants import SiteMapping
from ..plans import build_packages, discover, refresh
from .q_pages import HREFS

QUERIES, SQL = {}, {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


CAP = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


def keyed(s, d, bad):
    x = view(s, d, "items").select(F.when(F.col("product_id") % 4 == 0, F.concat(F.lit("given"), "product_id")).otherwise("").alias("meta_id"), "site", F.when(F.col("product_id") % 6 == 1, F.lit(None)).otherwise(F.col("product_id").cast("string")).alias("product_id"), F.col("product_id").alias("row"))
    return C.spu_key(x)[bad].select("row", "site", F.coalesce("spu", F.lit("none")).alias("spu"))


E1 = cte("items") + ", k as (select product_id as row, site, coalesce(case when product_id % 4 = 0 then 'given' || product_id end, case when product_id % 6 <> 1 then site || '#' || product_id end) as spu from items) select row, site, coalesce(spu, 'none') as spu from k where spu is {n} null"
add("e1_spu_key", lambda s, d: keyed(s, d, 0), E1.format(n="not"))
add("e1_no_key", lambda s, d: keyed(s, d, 1), E1.format(n=""))


def imgs(s, d):
    return view(s, d, "images").withColumn("spu", F.concat(F.lit("site#"), "product_id"))


add(
    "e2_entity_ids",
    lambda s, d: imgs(s, d).select(
        "url", C.image_id(F.col("spu"), F.col("color"), F.when(F.col("pos") == 1, "").otherwise(F.col("pos").cast("string")), F.col("url")).alias("image"), C.album_id(F.col("spu"), F.col("color")).alias("album"), C.text_id(F.col("spu"), F.col("url")).alias("text_id"), C.sku_id(F.col("spu"), F.col("color")).alias("sku"), C.item_type("dimension", F.col("color")).alias("kind")
    ),
    cte("images") + f", i as (select *, 'site#' || product_id as spu, {CAP.format(c='color')} as cap from images) select url, spu || '::' || cap || '::' || case when pos = 1 then substr(md5(url), 1, 6) else cast(pos as string) end as image, spu || '::' || cap as album, spu || '::' || substr(md5(url), 1, 6) as text_id, spu || '#' || color as sku, 'Dimension::' || cap as kind from i",
)
ROWS = "im as (select product_id, color, pos, url, url like '%MAIN%' as is_main, coalesce(nullif(regexp_extract(url, '_([A-Za-z0-9]+)', 1), ''), 'MAIN') as kind from images)"


def rows(s, d):
    return C.image_rows(view(s, d, "images"), SiteMapping("shop"))


add("e3_image_rows", rows, cte("images") + f", {ROWS} select * from im")
add("e4_ensure_main", lambda s, d: C.ensure_main(rows(s, d)), cte("images") + f", {ROWS} select product_id, color, pos, url, kind, is_main or (pos = 0 and not bool_or(is_main) over (partition by product_id, color)) as is_main from im")
add(
    "e5_albums",
    lambda s, d: C.albums(imgs(s, d).withColumn("image_id", C.image_id(F.col("spu"), F.col("color"), F.col("pos").cast("string"), F.col("url")))).select("spu", "color", "album_id", F.array_join(F.transform("references", lambda x: F.concat(x["item_type"], F.lit("="), x["item_id"])), ",").alias("refs")),
    cte("images") + f", i as (select *, 'site#' || product_id as spu, {CAP.format(c='color')} as cap from images) select spu, color, spu || '::' || cap as album_id, string_agg('Image::Product=' || spu || '::' || cap || '::' || pos, ',' order by pos) as refs from i group by all",
)
add(
    "e6_dimensions",
    lambda s, d: C.dimensions(view(s, d, "part").select(F.col("p_partkey").alias("sku_id"), "p_brand", F.when(F.col("p_size") % 2 == 0, F.lit(None)).otherwise(F.col("p_size").cast("string")).alias("size"), F.when(F.col("p_size") % 3 == 0, "").otherwise("w").alias("width")), {"p_brand": "color", "size": "size", "width": ""}),
    "select p_partkey as sku_id, 'color' as name, p_brand as value from part union all select p_partkey, 'size', case when p_size % 2 = 0 then '' else cast(p_size as string) end from part union all select p_partkey, '', 'w' from part where p_size % 3 <> 0",
)
add(
    "e7_volatile",
    lambda s, d: C.volatile(view(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("price"), F.when(F.col("p_size") % 8 == 0, 0.0).otherwise(F.col("p_retailprice") + 5).alias("list_price"), (F.col("p_size") % 3 > 0).alias("available"), (F.col("p_size") % 5).alias("stock"))),
    "with p as (select p_partkey, case when p_size % 4 = 0 then 0.0 else p_retailprice end as price, case when p_size % 8 = 0 then 0.0 else p_retailprice + 5 end as list_price, p_size % 3 > 0 as available, p_size % 5 as stock from part), q as (select * replace (coalesce(nullif(price, 0), list_price) as price) from p) select *, price > 0 and available and stock > 0 as availability from q",
)
add(
    "e8_unique_references",
    lambda s, d: C.unique_references(view(s, d, "line").select(F.when(F.col("l_suppkey") % 10 == 0, "").otherwise(F.concat(F.lit("i"), F.col("l_partkey") % 300)).alias("item_id"), F.col("l_returnflag").alias("item_type"), (F.col("l_partkey") * 1000000 + F.col("pos")).alias("pos"), "l_orderkey")),
    cte("line") + ", r as (select 'i' || (l_partkey % 300) as item_id, l_returnflag as item_type, l_partkey * 1000000 + pos as pos, l_orderkey from line where l_suppkey % 10 <> 0) select item_id, item_type, min(pos) as pos, arg_min(l_orderkey, pos) as l_orderkey from r group by 1, 2",
)
add("e9_status_class", lambda s, d: view(s, d, "logs").groupBy(C.status_class(F.col("status_code")).alias("class"), "status_code").agg(F.count(F.lit(1)).alias("n")), cte("logs") + "select case when status_code < 300 then 'NORMAL' else 'ERROR' end as class, status_code, count(*) as n from logs group by all")


def packed(s, d):
    spus = view(s, d, "part").select(F.concat(F.lit("site#"), "p_partkey").alias("spu"), (F.col("p_partkey") % 40).alias("crawlid"), F.lit("site").alias("spiderid"))
    skus = view(s, d, "line").select(F.concat(F.lit("site#"), "l_partkey").alias("spu"), "pos", F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("sku_id"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("stock"))
    return C.packages(spus, skus, "1.0", "EXPORT").select("spu", "version", "command", "trace.crawlid", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("items"), F.array_join(F.transform("references", lambda x: x["item_id"]), ",").alias("refs"), F.round(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["price"]), 2).alias("sum_price"))


add("e10_packages", packed, cte("line") + "select 'site#' || p_partkey as spu, '1.0' as version, 'EXPORT' as command, p_partkey % 40 as crawlid, count(l_partkey) as items, string_agg(l_orderkey || '-' || l_linenumber, ',' order by pos) as refs, round(sum(l_extendedprice), 2) as sum_price from part left join line on l_partkey = p_partkey group by p_partkey")


def hierarchy(s, d):
    r = view(s, d, "region").select(F.concat(F.lit("/r#"), "r_regionkey").alias("path"), F.col("r_name").alias("value"))
    n = view(s, d, "nation").select(F.concat(F.lit("/r#"), "n_regionkey", F.lit("/n#"), "n_nationkey").alias("path"), F.col("n_name").alias("value"))
    c = view(s, d, "customer").join(view(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("/r#"), "n_regionkey", F.lit("/n#"), "n_nationkey", F.lit("/c#"), "c_custkey").alias("path"), F.col("c_mktsegment").alias("value"))
    return r.unionByName(n).unionByName(c)


def rolled(s, d):
    return C.roll_up(hierarchy(s, d)).select("path", F.md5("json").alias("digest"), F.length("json").cast("long").alias("n"))


J = """'{{"path":"' || {p} || '","value":"' || {v} || '","children":[' || coalesce({c}, '') || ']}}'"""
add(
    "e11_roll_up",
    rolled,
    "with c as (select c_nationkey, '/r#' || n_regionkey || '/n#' || n_nationkey || '/c#' || c_custkey as path, c_mktsegment as v from customer join nation on c_nationkey = n_nationkey), "
    + f"cn as (select c_nationkey, string_agg({J.format(p='path', v='v', c='null')}, ',' order by path) as ch from c group by 1), n as (select n_regionkey, '/r#' || n_regionkey || '/n#' || n_nationkey as path, n_name as v, ch from nation left join cn on c_nationkey = n_nationkey), nr as (select n_regionkey, string_agg({J.format(p='path', v='v', c='ch')}, ',' order by path) as ch from n group by 1), "
    + f"r as (select '/r#' || r_regionkey as path, {J.format(p=chr(39) + '/r#' + chr(39) + ' || r_regionkey', v='r_name', c='ch')} as js from region left join nr on n_regionkey = r_regionkey) select path, md5(js) as digest, length(js) as n from r",
)


def chunked(s, d):
    """The nested arrays of the roll-up with chunks of 40 nodes, flattened to a row for each entry of the second level."""
    x = C.roll_up_chunks(hierarchy(s, d), size=40).select("path", "chunk", "chunks", F.explode_outer("children").alias("c"))
    return x.select("path", "chunk", "chunks", F.col("c.path").alias("child"), F.col("c.chunk").alias("child_chunk"), F.size("c.children").cast("long").alias("n"), F.md5(F.array_join(F.transform("c.children", lambda k: F.concat(k["path"], F.lit("="), k["value"])), ",")).alias("digest"))


_AT = "('0x' || substr(md5({x}), 1, 8))::bigint % {n}"
add(
    "e11_roll_up_chunks",
    chunked,
    f"""with c as (select '/r#' || n_regionkey || '/n#' || n_nationkey as up, '/r#' || n_regionkey || '/n#' || n_nationkey || '/c#' || c_custkey as path, c_mktsegment as v from customer join nation on c_nationkey = n_nationkey),
 cc as (select *, ceil(count(*) over (partition by up) / 40)::bigint as chunks from c), ca as (select up, {_AT.format(x='path', n='chunks')} as chunk, count(*) as n, md5(string_agg(path || '=' || v, ',' order by path)) as digest from cc group by 1, 2),
 n as (select '/r#' || n_regionkey as up, '/r#' || n_regionkey || '/n#' || n_nationkey as path from nation), e as (select n.up, n.path, coalesce(chunk, 0) as chunk, coalesce(n, 0) as n, coalesce(digest, md5('')) as digest from n left join ca on ca.up = n.path),
 ee as (select *, ceil(sum(n + 1) over (partition by up) / 40)::bigint as chunks from e), r as (select '/r#' || r_regionkey as path from region)
 select r.path, coalesce({_AT.format(x="ee.path || '#' || ee.chunk", n='ee.chunks')}, 0) as chunk, coalesce(ee.chunks, 1) as chunks, ee.path as child, ee.chunk as child_chunk, n, digest from r left join ee on ee.up = r.path""",
)
add(
    "e12_group_in_order",
    lambda s, d: C.group_in_order(view(s, d, "line"), "l_partkey", "l_returnflag", "l_linenumber", "pos").select("l_partkey", "l_returnflag", F.col("group_pos").cast("long").alias("group_pos"), F.array_join("values", ",").alias("values")),
    cte("line") + ", g as (select l_partkey, l_returnflag, min(pos) as f, string_agg(cast(l_linenumber as string), ',' order by pos) as \"values\" from line group by 1, 2) select l_partkey, l_returnflag, row_number() over (partition by l_partkey order by f) as group_pos, \"values\" from g",
)


def planned(s, d):
    x = C.ensure_main(rows(s, d)).withColumns({"image_id": F.concat_ws("::", "product_id", "color", "pos"), "image_count": (F.col("product_id") % 8).cast("int")})
    return C.image_plan(x)


add(
    "e13_image_plan",
    planned,
    cte("images") + f", {ROWS}, m as (select *, is_main or (pos = 0 and not bool_or(is_main) over (partition by product_id, color)) as main, product_id || '::' || color || '::' || pos as image_id from im), e as (select m.*, i from m, range(1, 7) r(i) where main and i <= 6 - product_id % 8) select image_id, image_id || '_' || i as derived_id, kind || '_' || i as kind, '/plan/' || sha1(url || '#' || i) || '.jpg' as path from e",
)


def chosen(s, d):
    ranks = view(s, d, "nation").filter("n_nationkey < 2").select(F.when(F.col("n_nationkey") == 0, "2").otherwise("MAIN").alias("kind"), F.col("n_nationkey").alias("rank"))
    return C.choose_main(rows(s, d), ranks).fillna({"rank": 9})


add("e14_choose_main", chosen, cte("images") + f", {ROWS}, r as (select *, case kind when '2' then 0 when 'MAIN' then 1 end as rank from im), n as (select *, row_number() over (partition by product_id, color order by rank nulls last, pos) as n from r) select product_id, color, url, cast(coalesce(rank, 9) as int) as rank from n where n = 1")
add(
    "e15_keyed_last",
    lambda s, d: C.keyed_last(view(s, d, "line"), "l_partkey", "l_returnflag", "l_orderkey", "pos").select("l_partkey", F.explode("by_key").alias("flag", "l_orderkey")),
    cte("line") + "select l_partkey, l_returnflag as flag, arg_max(l_orderkey, pos) as l_orderkey from line group by 1, 2",
)
add(
    "e16_merge",
    lambda s, d: view(s, d, "part").select("p_partkey", F.array_join(C.concat_lists(F.array(F.array("p_brand", "p_type"), F.array("p_name"))), "|").alias("list"), F.to_json(C.merge_maps(F.array(F.create_map(F.lit("a"), "p_brand", F.lit("b"), F.lit("1")), F.create_map(F.lit("b"), "p_type")))).alias("map")),
    "select p_partkey, p_brand || '|' || p_type || '|' || p_name as list, '{\"a\":\"' || p_brand || '\",\"b\":\"' || p_type || '\"}' as map from part",
)
add(
    "e17_bullets",
    lambda s, d: C.bullets(view(s, d, "part").select(F.concat(F.lit("site#"), "p_partkey").alias("spu"), "p_name", "p_size", "p_type", C.span_items(F.concat(F.lit("<span>"), "p_type", F.lit("</span><b>x</b><span>"), "p_brand", F.lit("</span>"))).alias("spans")), {"title": "p_name", "desc": "if(p_size % 2 = 0, p_type, '')", "features": "spans"}),
    "with b as (select 'site#' || p_partkey as spu, 'title' as kind, p_name as text from part union all select 'site#' || p_partkey, 'desc', p_type from part where p_size % 2 = 0 union all select 'site#' || p_partkey, 'features', '[\"' || p_type || '\",\"' || p_brand || '\"]' from part) select spu || '::' || substr(md5(text), 1, 6) as bullet_id, * from b where text <> ''",
)

# frontier
add("g1_dispatch_plan", lambda s, d: N.dispatch_plan(view(s, d, "requests"), F.col("spiderid") + 20, 3), cte("requests") + "select * from (select *, cast(row_number() over (partition by spiderid order by priority desc, seq) as int) as rank from requests) where rank <= (spiderid + 20) * 3")
PLAN = f"with {HREFS}, l as (select link, min(page_id * 1000 + pos) as seq, arg_min(page_id, page_id * 1000 + pos) as page_id, arg_min(pos, page_id * 1000 + pos) as pos from links group by link), h as (select page_id, regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1), '^[^.]+[.]', '') as spiderid from pages), r as (select spiderid, link, 80 - pos as priority, seq from l join h using (page_id)) select * from (select *, cast(row_number() over (partition by spiderid order by priority desc, seq) as int) as rank from r) where rank <= 60"
add("g1_dispatch_plan_pages", lambda s, d: discover(view(s, d, "pages")), PLAN)
add(
    "g2_priorities",
    lambda s, d: extract_links(view(s, d, "pages")).select("page_id", "pos", N.derived_priority(F.element_at(F.array(F.lit("item"), F.lit("next"), F.lit("follow"), F.lit("retry")), F.col("pos") % 4 + 1), F.col("page_id")).alias("priority")),
    f"with {HREFS} select page_id, pos, case pos % 4 when 0 then page_id - 20 when 1 then page_id when 2 then page_id + 1 else page_id - 1 end as priority from links",
)
add("g3_first_seen", lambda s, d: N.first_seen(extract_links(view(s, d, "pages")).withColumn("crawlid", F.col("page_id") % 5), ["crawlid", "link"], ["page_id", "pos"]), f"with {HREFS}, c as (select *, page_id % 5 as crawlid from links), n as (select *, row_number() over (partition by crawlid, link order by page_id, pos) as n from c) select crawlid, link, page_id, pos from n where n = 1")
add(
    "g4_distinct_by",
    lambda s, d: N.distinct_by(view(s, d, "line"), "l_partkey", "l_returnflag", "l_orderkey", "pos").select("l_partkey", F.array_join("kept", ",").alias("kept")),
    cte("line") + ", f as (select l_partkey, l_returnflag, min(pos) as p, arg_min(l_orderkey, pos) as k from line group by 1, 2) select l_partkey, string_agg(cast(k as string), ',' order by p) as kept from f group by 1",
)
add(
    "g4_distinct_in_order",
    lambda s, d: view(s, d, "line").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("pos", "l_linenumber"))).alias("x")).select("l_partkey", F.array_join(N.distinct_in_order(F.col("x.l_linenumber")), ",").alias("numbers")),
    cte("line") + ", f as (select l_partkey, l_linenumber, min(pos) as p from line group by 1, 2) select l_partkey, string_agg(cast(l_linenumber as string), ',' order by p) as numbers from f group by 1",
)
LATEST = "latest as (select * from (select *, row_number() over (partition by item_id order by sec desc, seq desc) as n from delayed_messages) where n = 1 and event <> 'delete')"
dm = cte("delayed_messages", "site_delay")


def latest(s, d):
    return N.latest_messages(view(s, d, "delayed_messages"), ["sec", "seq"])


def due(s, d):
    return N.due_items(latest(s, d).withColumn("due_date", F.when(F.col("seq") % 9 == 0, F.lit(AS_OF + 5).cast("long")).when(F.col("seq") % 9 == 1, F.lit(AS_OF - 5).cast("long"))), view(s, d, "site_delay"), AS_OF, 3 * 86400).select("item_id", "site", "seq", "due")


DUE = dm + f", {LATEST}, du as (select item_id, site, seq, cast(case when seq % 9 = 0 then {AS_OF + 5} when seq % 9 = 1 then {AS_OF - 5} else sec + coalesce(nullif(update_interval, 0), 259200) end as bigint) as due from latest left join site_delay using (site)), due as (select * from du where due <= {AS_OF})"
add("g5_latest_messages", latest, dm + f", {LATEST} select item_id, seq, site, event, sec from latest")
add("g6_due_items", due, DUE + " select * from due")
add("g7_refresh_batches", lambda s, d: N.refresh_batches(due(s, d).withColumn("site", F.when(F.col("seq") % 11 == 0, "").otherwise(F.col("site"))), AS_OF, {"NATION_3": 2, "NATION_4": 4}, 7), DUE + " select item_id, site, due, cast((row_number() over (partition by site order by due, item_id) - 1) // 7 as bigint) as chunk from due where seq % 11 <> 0 and site <> 'NATION_3'")
add(
    "g8_redelay",
    lambda s, d: N.redelay(due(s, d).select("item_id"), latest(s, d).filter("item_id % 5 <> 0").select("item_id", (F.col("item_id") % 3 > 0).alias("ok")), AS_OF, 86400),
    DUE + f" select item_id, cast(case when item_id % 5 <> 0 and item_id % 3 > 0 then {AS_OF + 86400} else {AS_OF} end as bigint) as due from due",
)
add("g10_reconcile_store", lambda s, d: N.reconcile_store(latest(s, d), [due(s, d), latest(s, d).filter("item_id % 7 = 0")]), DUE + " select a as stored, a - b - c as difference, a - b - c <> 0 as wrong from (select count(*) as a, count(*) filter (where item_id % 7 = 0) as c from latest), (select count(*) as b from due)")
add(
    "g11_retry_plan",
    lambda s, d: N.retry_plan(view(s, d, "fetch_log").withColumn("ok", F.col("ok") & (F.col("url_key") % 3 == 0)), 2).fillna({"priority": 1}),
    cte("fetch_log") + ", g as (select url_key, count(*) as attempts, bool_or(ok and url_key % 3 = 0) as done, arg_max(listing, attempt_seq) as listing from fetch_log group by 1) select url_key, attempts, listing, case when listing or attempts <= 2 then 'requeue' else 'failed' end as action, coalesce(case when listing or attempts <= 2 then attempts * -10 end, 1) as priority, case when listing then 1 else 0 end as extra_total from g where not done",
)


def searched(s, d):
    listing = view(s, d, "line").select((F.col("l_partkey") % 50).alias("query"), F.col("l_suppkey").alias("shop"), (F.floor(F.col("l_partkey") / 500) + 1).alias("page"), (F.col("l_partkey") * 100 + F.col("pos")).alias("pos"))
    return N.search_positions(listing, view(s, d, "supplier").filter("s_nationkey < 5").select(F.col("s_suppkey").alias("shop")), 1)


add("g13_search_positions", searched, cte("line") + ", l as (select l_partkey % 50 as query, l_suppkey as shop, cast(floor(l_partkey / 500) as bigint) + 1 as page, l_partkey * 100 + pos as pos from line), r as (select *, cast(row_number() over (partition by query order by page, pos) as int) as rank, max(page) over (partition by query) as pages from l) select query, shop, page, rank from r where page <= least(pages, 2) and shop in (select s_suppkey from supplier where s_nationkey < 5)")
add(
    "g14_keyword_residue",
    lambda s, d: N.keyword_residue(view(s, d, "documents").select("source", F.col("doc_id").alias("pos"), F.col("text").alias("title")), "source", F.lit("the"), ["and", "ing"]).select("source", F.md5("residue").alias("digest"), F.length("residue").cast("long").alias("n")),
    "with t as (select source, string_agg(lower(text), '' order by doc_id) as t from documents group by 1), r as (select source, replace(replace(replace(regexp_replace(t, '[^a-z]', '', 'g'), 'the', ''), 'and', ''), 'ing', '') as r from t) select source, md5(r) as digest, length(r) as n from r",
)


# end to end


def refreshed(s, d):
    messages = view(s, d, "delayed_messages").withColumn("due_date", F.when(F.col("seq") % 9 == 0, F.lit(AS_OF + 5).cast("long")).when(F.col("seq") % 9 == 1, F.lit(AS_OF - 5).cast("long")))
    requests = view(s, d, "orders").select(F.concat(F.lit("NATION_"), F.floor(F.sqrt("o_custkey")) % 25).alias("spiderid"))
    results = latest(s, d).filter("item_id % 5 <> 0").select("item_id", (F.col("item_id") % 3 > 0).alias("ok"))
    return refresh(messages, view(s, d, "site_delay"), requests, results, AS_OF, 3 * 86400, {"NATION_3": 2, "NATION_4": 4}, 7, 200, 86400)


add(
    "p2_refresh_loop",
    refreshed,
    DUE + f""", b as (select item_id, site, due, cast((row_number() over (partition by site order by due, item_id) - 1) // 7 as bigint) as chunk from due where site <> 'NATION_3'),
 full_ as (select 'NATION_' || (cast(floor(sqrt(o_custkey)) as bigint) % 25) as site from orders group by 1 having count(*) > 200), s as (select *, site not in (select site from full_) as sent from b)
 select item_id, site, chunk, sent, cast(case when not sent then due when item_id % 5 <> 0 and item_id % 3 > 0 then {AS_OF + 86400} else {AS_OF} end as bigint) as due from s""",
)
TOPICS = {"EXPORT": "export", "UPDATE": "update"}


def built(s, d, rejected=False):
    p = F.col("p_partkey")
    products = view(s, d, "part").select(p.alias("product_id"), F.when(p % 4 == 0, F.concat(F.lit("given"), p)).otherwise("").alias("meta_id"), F.when(p % 7 != 3, F.concat(F.lit("site"), p % 6)).alias("site"), (p % 40).alias("crawlid"), (p % 7).alias("spiderid"), F.element_at(F.array(F.lit("EXPORT"), F.lit("UPDATE"), F.lit("OTHER")), (p % 3 + 1).cast("int")).alias("command"))
    q = F.col("l_quantity").cast("long")
    skus = view(s, d, "line").select(F.col("l_partkey").alias("product_id"), "pos", F.concat("l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "pos").alias("sku_id"), F.when(q % 3 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("price"), (F.col("l_extendedprice") + 5).alias("list_price"), (F.col("l_returnflag") != "R").alias("available"), (q % 5).alias("stock"))
    packages, without = build_packages(products, skus, view(s, d, "images"), SiteMapping("shop"), "1.0", TOPICS, "other", AS_OF)
    if rejected:
        return without.select(F.col("product_id").cast("long").alias("product_id"), "command")
    text = lambda refs: F.array_join(F.transform(refs, lambda x: F.concat(x["item_type"], F.lit("="), x["item_id"])), ",")
    albums = F.array_join(F.transform("albums", lambda a: F.concat(a["album_id"], F.lit(":"), text(a["references"]))), ";")
    return packages.select("spu", "topic", "stamp", "version", "trace.crawlid", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("items"), F.round(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["price"]), 2).alias("sum_price"), F.md5(text(F.col("references"))).alias("refs"), F.md5(albums).alias("albums"))


KEYED = "k as (select p_partkey as product_id, coalesce(case when p_partkey % 4 = 0 then 'given' || p_partkey end, case when p_partkey % 7 <> 3 then 'site' || (p_partkey % 6) || '#' || p_partkey end) as spu, case p_partkey % 3 when 0 then 'EXPORT' when 1 then 'UPDATE' else 'OTHER' end as command from part)"
add(
    "p1_packages",
    built,
    cte("line", "images") + f""", {KEYED}, sk as (select spu, spu || '#' || l_orderkey || '-' || l_linenumber || '-' || pos as sku, case when cast(l_quantity as bigint) % 3 = 0 then l_extendedprice + 5 else l_extendedprice end as price from line join k on k.product_id = l_partkey where spu is not null),
 im as (select spu, {CAP.format(c='color')} as cap, color, images.product_id, pos, url, url like '%MAIN%' as main, spu || '::' || {CAP.format(c='color')} || '::' || coalesce(nullif(regexp_extract(url, '_([A-Za-z0-9]+)', 1), ''), 'MAIN') as image_id from images join k on k.product_id = images.product_id where spu is not null),
 i2 as (select *, main or (pos = 0 and not bool_or(main) over (partition by product_id, color)) as is_main from im),
 al as (select spu, spu || '::' || cap as album, string_agg('Image::Product=' || image_id, ',' order by pos) as r from im group by all), al2 as (select spu, md5(string_agg(album || ':' || r, ';' order by album)) as albums from al group by 1),
 rf as (select spu, 'Sku' as t, sku as i from sk union select spu, 'Album', album from al union select spu, 'Image::Product', image_id from i2 where is_main), rf2 as (select spu, md5(string_agg(t || '=' || i, ',' order by t, i)) as refs from rf group by 1),
 it as (select spu, count(*) as items, round(sum(price), 2) as sum_price from sk group by 1)
 select k.spu, case command when 'EXPORT' then 'export' when 'UPDATE' then 'update' else 'other' end as topic, '{AS_OF}' as stamp, '1.0' as version, product_id % 40 as crawlid, coalesce(items, 0) as items, sum_price, refs, albums
 from k left join it using (spu) left join rf2 using (spu) left join al2 using (spu) where k.spu is not null""",
)
add("p1_packages_rejected", lambda s, d: built(s, d, True), f"with {KEYED} select product_id, command from k where spu is null")
