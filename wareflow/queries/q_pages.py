"""Queries and oracle of page extraction and per-value rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte, view
from ..operators import pages as P
from ..operators import prices as R

QUERIES, SQL = {}, {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


HREFS = """hrefs as (select page_id, url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) as h from pages),
 hp as (select page_id, url, unnest(h) as href, unnest(range(len(h))) as i from hrefs), hm as (select page_id, url, href, min(i) as m from hp group by page_id, url, href), hd as (select page_id, url, href, row_number() over (partition by page_id order by m) - 1 as pos from hm),
 links as (select page_id, cast(pos as int) as pos, case when href like '//%' then regexp_extract(url, '^([a-zA-Z]+:)', 1) || href when href like '/%' then regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || href else href end as link from hd)"""
add("b1_links", lambda s, d: P.extract_links(view(s, d, "pages")), f"with {HREFS} select * from links")
add(
    "b2_next_page_arg",
    lambda s, d: view(s, d, "pages").select("page_id", P.next_page_arg(F.col("url"), "page", 1).alias("next_page")),
    "select page_id, case when regexp_matches(url, '[?&]page=[0-9]+') then regexp_extract(url, '^(.*[?&]page=)[0-9]+', 1) || (cast(regexp_extract(url, '[?&]page=([0-9]+)', 1) as int) + 1) || regexp_extract(url, '[?&]page=[0-9]+(.*)$', 1) else url || case when contains(url, '?') then '&' else '?' end || 'page=2' end as next_page from pages",
)
add(
    "b3_next_page_offset",
    lambda s, d: view(s, d, "pages").select("page_id", P.next_page_offset(F.col("url"), "page", 10, F.col("page_id").cast("int") % 7 + 1).alias("next_page")),
    "select page_id, case when regexp_matches(url, '[?&]page=[0-9]+') then regexp_extract(url, '^(.*[?&]page=)[0-9]+', 1) || (cast(regexp_extract(url, '[?&]page=([0-9]+)', 1) as int) + page_id % 7 + 1) || regexp_extract(url, '[?&]page=[0-9]+(.*)$', 1) when contains(url, '?') then url || '&page=' || (10 + page_id % 7 + 1) else url || '?page=' || (page_id % 7 + 2) end as next_page from pages",
)
add(
    "b4_next_page_path",
    lambda s, d: view(s, d, "pages").select("page_id", P.next_page_path(F.col("url"), "/en/", 1, "/").alias("next_page")),
    "with p as (select page_id, regexp_extract(url, '^([^?#]*)', 1) as path, regexp_extract(url, '^[^?#]*(.*)$', 1) as tail from pages) select page_id, case when regexp_matches(path, '/en/([0-9]+)/') then regexp_extract(path, '^(.*/en/)[0-9]+/', 1) || (cast(regexp_extract(path, '/en/([0-9]+)/', 1) as int) + 1) || regexp_extract(path, '/en/[0-9]+(/.*)$', 1) else regexp_replace(path, '/$', '') || '/en/2/' end || tail as next_page from p",
)


def b5(s, d):
    pages = view(s, d, "pages")
    links = P.extract_links(pages)
    seen = links.filter("page_id % 3 = 0")
    return P.plan_next_pages(pages, links, seen, P.next_page_arg(F.col("url"), "page", 1))


add("b5_next_page_plan", b5, f"with {HREFS}, e as (select page_id, count(*) as effective from links where link not in (select link from links where page_id % 3 = 0) group by 1), n as ({SQL['b2_next_page_arg']}) select page_id, effective, next_page from e join n using (page_id)")
add(
    "b6_base_fields",
    lambda s, d: P.base_fields(view(s, d, "pages")),
    "with h as (select page_id, url, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) as host from pages) select page_id, url, host, case when contains(host, '.') then regexp_replace(host, '^[^.]+[.]', '') end as domain, regexp_extract(url, '^([^?#]*)', 1) as response_url from h",
)
add(
    "b8_spec_rows",
    lambda s, d: P.spec_rows(view(s, d, "pages"), "<li>(.*?)</li>", '(?:href="|">)([^"<]*)'),
    """with r as (select page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) as l from pages), u as (select page_id, cast(unnest(range(len(l))) as int) as pos, unnest(l) as row from r),
 c as (select page_id, pos, list_transform(regexp_extract_all(row, '(?:href="|">)([^"<]*)', 1), lambda x: trim(x)) as c from u) select page_id, pos, c[1] as "key", c[2] as "value" from c where len(c) = 2 and (c[1] <> '' or c[2] <> '')""",
)
add(
    "b9_embedded_state",
    lambda s, d: P.embedded_state(view(s, d, "events").withColumn("js", F.concat(F.lit("{k: "), F.regexp_extract("props", "([0-9]+)", 1), F.lit(", 'name': 'it'}"))), "js", "k int, name string").select("event_id", F.col("state.k").alias("k"), F.col("state.name").alias("name")),
    cte("ev") + "select event_id, k, 'it' as name from ev",
)
add(
    "b9_embedded_script",
    lambda s, d: P.embedded_state(view(s, d, "pages").withColumn("js", F.concat(F.lit("{n: "), F.regexp_extract("html", r"track\(([0-9]+)\)", 1), F.lit("}"))), "js", "n long").select("page_id", F.col("state.n").alias("n")),
    "select page_id, cast(regexp_extract(html, 'track\\(([0-9]+)\\)', 1) as bigint) as n from pages",
)
steps = "{c}"
for a, b in P.HTML_STEPS:
    steps = f"regexp_replace({steps}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace('{1}', chr(92) + '1').replace(chr(39), chr(39) * 2)}', 'g')"
add("b10_clean_html", lambda s, d: view(s, d, "pages").select("page_id", F.md5(P.clean_html(F.col("html"))).alias("digest")), f"select page_id, md5({steps.format(c='html')}) as digest from pages")
add("b10_clean_documents", lambda s, d: view(s, d, "documents").select("doc_id", F.md5(P.clean_html(F.col("text"))).alias("digest")), f"select doc_id, md5({steps.format(c='text')}) as digest from documents")
add("b11_clean_id", lambda s, d: view(s, d, "part").select("p_partkey", R.clean_id(F.concat_ws("-", "p_brand", "p_name")).alias("mpn")), "select p_partkey, regexp_replace(p_brand || '-' || p_name, '[^a-zA-Z0-9]', '', 'g') as mpn from part")
PRICE = "coalesce(try_cast(regexp_extract(replace(case when contains({c}, 'EUR') then replace(replace({c}, '.', ''), ',', '.') else {c} end, ',', ''), '([0-9.]+)', 1) as double), 0.0)"
it = cte("items")
add("b12_price", lambda s, d: view(s, d, "items").select("product_id", "price_text", R.format_price(F.col("price_text")).alias("price"), R.format_price(F.col("list_price_text")).alias("list_price")), it + f"select product_id, price_text, {PRICE.format(c='price_text')} as price, {PRICE.format(c='list_price_text')} as list_price from items")
OK = "regexp_matches(lower(reason_text), '^(in stock|only|usually ships|available)')"
STOCK = "cast(case when regexp_matches(reason_text, '([0-9]*)[^0-9]*[iI]n\\s[sS]tock') then coalesce(nullif(coalesce(try_cast(regexp_extract(reason_text, '([0-9]*)[^0-9]*[iI]n\\s[sS]tock', 1) as int), 0), 0), 5) when {ok} then 5 else 0 end as int)".replace("{ok}", OK)
add("b13_stock", lambda s, d: view(s, d, "items").select("product_id", R.availability(F.col("reason_text")).alias("available"), R.stock(F.col("reason_text"), R.availability(F.col("reason_text"))).alias("stock")), it + f"select product_id, {OK} as available, {STOCK} as stock from items")
SHIP = "case when regexp_matches(lower(shipping_text), 'free|gratis') then '0' when contains(shipping_text, '+') then shipping_text end"
add("b14_shipping", lambda s, d: view(s, d, "items").select("product_id", R.shipping_class(F.col("shipping_text")).alias("shipping")), it + f"select product_id, {SHIP} as shipping from items")
add("b12_b14_priced", lambda s, d: R.priced(view(s, d, "items")), it + f"select product_id, site, {PRICE.format(c='price_text')} as price, {PRICE.format(c='list_price_text')} as list_price, {OK} as available, {STOCK} as stock, {SHIP} as shipping from items")
add(
    "b15_take_first",
    lambda s, d: view(s, d, "items").select("product_id", R.take_first(F.array("price_text", F.lit(" "), "list_price_text", F.lit("  z "))).alias("first"), R.take_first(F.array("price_text", F.lit("   "))).alias("last")),
    it + "select product_id, coalesce(nullif(trim(price_text), ''), nullif(trim(list_price_text), ''), 'z') as first, coalesce(nullif(trim(price_text), ''), '') as last from items",
)
add(
    "b16_choose_id",
    lambda s, d: view(s, d, "identifiers").select("product_id", R.choose_id(F.when(F.col("product_id") % 4 == 0, F.col("mpn")).otherwise(""), [F.col("upc"), F.col("ean"), F.when(F.col("product_id") % 5 == 0, "").otherwise(F.col("mpn"))]).alias("id")),
    cte("identifiers") + "select product_id, coalesce(nullif(case when product_id % 4 = 0 then mpn else '' end, ''), nullif(case when product_id % 5 = 0 then '' else mpn end, ''), nullif(ean, ''), nullif(upc, ''), '') as id from identifiers",
)
add(
    "b17_currency",
    lambda s, d: view(s, d, "pages").select("page_id", R.currency(F.col("url"), F.when(F.col("page_id") % 9 == 0, "farfetch").when(F.col("page_id") % 9 == 1, "ssence").otherwise(""), {"farfetch": "CNY", "ssence": "CAD"}).alias("currency")),
    "select page_id, case when page_id % 9 = 1 then 'CAD' when page_id % 9 = 0 then 'CNY' when contains(url, '.com') then 'USD' when contains(url, '.de') then 'EUR' else 'JPY' end as currency from pages",
)
add(
    "b18_fingerprint",
    lambda s, d: view(s, d, "pages").select("page_id", P.fingerprint(F.element_at(F.array(F.lit("amazon"), F.lit("shop"), F.lit("other")), (F.col("page_id") % 3 + 1).cast("int")), F.col("url"), {"amazon": "^(.*?)ref", "shop": "^(.*/[0-9]+)"}).alias("print")),
    "select page_id, coalesce(case page_id % 3 when 0 then nullif(regexp_extract(url, '^(.*?)ref', 1), '') when 1 then nullif(regexp_extract(url, '^(.*/[0-9]+)', 1), '') end, url) as print from pages",
)


def b19(s, d):
    codes = view(s, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.concat(F.lit("S"), F.col("p_size") % 6).alias("site"))
    nation = view(s, d, "nation").filter("n_nationkey < 4")
    templates = nation.select(F.concat(F.lit("S"), "n_nationkey").alias("site"), F.concat(F.lit("https://www."), F.lower("n_name"), F.lit(".{tld}/dp/{code}")).alias("template"), F.when(F.col("n_regionkey") % 2 == 0, "com").otherwise("de").alias("tld"))
    return P.code_urls(codes, templates)


add("b19_code_urls", b19, "select cast(p_partkey as string) as code, 'S' || n_nationkey as site, 'https://www.' || lower(n_name) || '.' || case when n_regionkey % 2 = 0 then 'com' else 'de' end || '/dp/' || p_partkey as url from part join nation on p_size % 6 = n_nationkey where n_nationkey < 4")
add(
    "b20_image_urls",
    lambda s, d: P.image_urls(view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.array(F.concat(F.lit("//i/"), "p_partkey", F.lit("_COLOR_1.jpg")), F.concat(F.lit("//i/"), "p_partkey", F.lit("_COLOR_2.jpg"))).alias("images"), F.array(F.lit("red"), F.lit("blue"), "p_brand").alias("colors")), "COLOR", "colors"),
    "with v as (select p_partkey as product_id, p_brand from part), i as (select unnest([0, 1]) as image_pos), c as (select unnest([0, 1, 2]) as value_pos) select product_id, image_pos, value_pos, '//i/' || product_id || '_' || case value_pos when 0 then 'red' when 1 then 'blue' else p_brand end || '_' || (image_pos + 1) || '.jpg' as image_url from v, i, c",
)


def b21(s, d):
    w, h = R.cap_size(F.col("p_size") * 90, F.col("p_partkey") % 3000 + 1)
    return view(s, d, "part").select("p_partkey", w.alias("width"), h.alias("height"))


add("b21_cap_size", b21, "with p as (select p_partkey, p_size * 90 as w, p_partkey % 3000 + 1 as h from part) select p_partkey, cast(case when greatest(w, h) > 2000 then floor(w * 2000 / greatest(w, h)) else w end as bigint) as width, cast(case when greatest(w, h) > 2000 then floor(h * 2000 / greatest(w, h)) else h end as bigint) as height from p")
add(
    "b22_storage_path",
    lambda s, d: view(s, d, "pages").select("page_id", *[P.storage_path(F.lit("loco_shop"), F.col("url"), m).alias(m) for m in ("formatter", "filter", "sharded")]),
    "with e as (select page_id, sha1(url) as h, coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([.][a-zA-Z0-9]+)$', 1)), ''), '.jpg') as x from pages) select page_id, '/shop/' || h || '.jpg' as formatter, '/shop/' || h || x as filter, '/shop/' || h[1:2] || '/' || h[3:4] || '/' || h || x as sharded from e",
)


def b23(s, d):
    o = view(s, d, "offers")
    g = o.groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("pos", "cents", "merchant"))).alias("o"))
    a = g.select(
        "product_id",
        F.expr("transform(o, x -> if(x.cents % 10 = 0, ' ', cast(x.cents as string)))").alias("prices"),
        F.expr("transform(slice(o, 1, greatest(1, size(o) - 2)), x -> concat('s', x.cents % 7))").alias("shipping"),
        F.expr("transform(slice(o, 1, greatest(1, size(o) - 1)), x -> cast(x.merchant as string))").alias("merchants"),
    )
    return a.select("product_id", F.posexplode(R.offer_list(F.col("prices"), F.col("shipping"), F.col("merchants"))).alias("pos", "o")).select("product_id", "pos", "o.price", "o.shipping", "o.merchant")


add(
    "b23_offer_list",
    b23,
    cte("offers") + """, n as (select *, count(*) over (partition by product_id) as n from offers), t as (select product_id, pos, case when cents % 10 = 0 then ' ' else cast(cents as string) end as price, case when pos <= greatest(1, n - 2) then 's' || (cents % 7) else '' end as shipping, case when pos <= greatest(1, n - 1) then cast(merchant as string) else '' end as merchant from n)
 select product_id, cast(row_number() over (partition by product_id order by pos) - 1 as int) as pos, price, shipping, merchant from t where trim(price) <> ''""",
)


def b24(s, d):
    o = view(s, d, "offers").groupBy("product_id").agg(F.expr("transform(array_sort(collect_list(struct(pos, cents))), x -> cast(x.cents as double))").alias("offers"))
    p = view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.expr("case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then 0.0 else p_retailprice end").alias("price"), F.expr("if(p_partkey % 2 = 0, p_retailprice - 1, null)").alias("from_price"))
    return p.join(o, "product_id", "left").select("product_id", R.base_price(F.col("price").cast("double"), F.col("from_price").cast("double"), F.col("offers")).alias("price"))


add("b24_base_price", b24, cte("offers") + ", f as (select product_id, cast(cents as double) as first from offers where pos = 1) select p_partkey as product_id, coalesce(nullif(case when p_partkey % 3 = 1 then 0.0 when p_partkey % 3 = 2 then p_retailprice when p_partkey % 2 = 0 then p_retailprice - 1 end, 0), first, 0.0) as price from part left join f on product_id = p_partkey")


def b25(s, d):
    a, b = R.condition(F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.lit(None)).otherwise(F.col("p_type")))
    return view(s, d, "part").select("p_partkey", a.alias("condition"), b.alias("note"))


add("b25_condition", b25, "select p_partkey, case when p_size % 3 = 2 and p_type <> '' then 'special' else 'new' end as condition, case when p_size % 3 = 2 then p_type else '' end as note from part")


def b26(s, d):
    links = P.extract_links(view(s, d, "pages"))
    products = links.filter("pos % 2 = 0").select("link", F.col("page_id").alias("product_id")).distinct()
    tasks = view(s, d, "pages").filter("page_id % 2 = 0").select("page_id", F.lit("gender").alias("type"), F.array(F.concat(F.lit("t"), F.col("page_id") % 5), F.lit("all")).alias("tags"))
    return P.enrich_tags(links, products, tasks).select("product_id", "type", F.array_join("tags", ",").alias("tags"))


add(
    "b26_enrich_tags",
    b26,
    f"with {HREFS}, pr as (select distinct link, page_id as product_id from links where pos % 2 = 0), j as (select product_id, unnest(['t' || (l.page_id % 5), 'all']) as tag from links l join pr using (link) where l.page_id % 2 = 0) select product_id, 'GENDER' as type, string_agg(distinct tag, ',' order by tag) as tags from j group by 1",
)
add(
    "b27_selected_option",
    lambda s, d: view(s, d, "ev").select("event_id", R.selected_option(F.expr("transform(sequence(1, 4), i -> struct(i as n, (k * i) % 5 = 3 as selected))"))["n"].alias("n")),
    cte("ev") + "select event_id, case when k % 5 = 3 then 1 when (k * 2) % 5 = 3 then 2 when (k * 3) % 5 = 3 then 3 else 4 end as n from ev",
)
add(
    "b28_regroup",
    lambda s, d: view(s, d, "pages").select("page_id", F.posexplode(P.regroup(F.regexp_extract_all("html", F.lit(">([^<]*)</a>"), F.lit(1)), 3)).alias("pos", "text")),
    "with t as (select page_id, regexp_extract_all(html, '>([^<]*)</a>', 1) as a from pages), u as (select page_id, a, cast(unnest(range(len(a) // 3)) as int) as pos from t) select page_id, pos, a[pos * 3 + 1] || a[pos * 3 + 2] || a[pos * 3 + 3] as text from u",
)
