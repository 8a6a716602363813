"""Queries and oracle of joins and variant flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import cte, view
from ..operators import joins as J
from ..operators import variants as V
from ..operators.variants import SiteMapping

QUERIES, SQL = {}, {}


def add(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


add(
    "c1_site_codes",
    lambda s, d: J.site_codes(view(s, d, "supplier").select("s_suppkey", F.concat(F.lit("Nation_"), F.col("s_nationkey") + 3).alias("site_code")), view(s, d, "site_codes")).fillna({"spiderid": -1}),
    cte("site_codes") + "select s_suppkey, 'Nation_' || (s_nationkey + 3) as site_code, coalesce(spiderid, -1) as spiderid from supplier left join site_codes on code = 'nation_' || (s_nationkey + 3)",
)
add(
    "c2_cost_floor",
    lambda s, d: J.cost_floor(view(s, d, "part").select(F.col("p_partkey").alias("product_id"), (F.col("p_retailprice") * 30).alias("cost")), view(s, d, "cost_floor")),
    cte("cost_floor") + "select p_partkey as product_id, least(p_retailprice * 30, coalesce(offer_price, 1000000)) as cost from part left join cost_floor on product_id = p_partkey",
)
add(
    "c3_attach_feed",
    lambda s, d: J.attach_feed(view(s, d, "part").select(F.col("p_partkey").alias("product_id")), view(s, d, "line").filter("l_returnflag = 'A'").select(F.col("l_partkey").alias("product_id"), "pos", "l_suppkey"), ["pos", "l_suppkey"]).select("product_id", F.array_join(F.transform("ware", lambda x: x["l_suppkey"].cast("string")), ",").alias("ware")),
    cte("line") + "select p_partkey as product_id, string_agg(cast(l_suppkey as string), ',' order by pos) as ware from part left join (select * from line where l_returnflag = 'A') on l_partkey = p_partkey group by 1",
)
add(
    "c4_enrich_ids",
    lambda s, d: J.enrich_ids(view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_size") > 40, "own").otherwise("").alias("upc"), F.lit("").alias("ean"), F.lit(None).cast("string").alias("mpn")), view(s, d, "identifiers")),
    cte("identifiers") + "select p_partkey as product_id, case when p_size > 40 then 'own' else nullif(upc, '') end as upc, nullif(ean, '') as ean, nullif(mpn, '') as mpn from part left join identifiers on product_id = p_partkey",
)
add(
    "c5_cross_site",
    lambda s, d: J.cross_site(view(s, d, "lineitem").select(F.col("l_orderkey").alias("upc"), "l_partkey", "l_linenumber"), view(s, d, "orders").select(F.col("o_orderkey").alias("upc"), "o_custkey", "o_orderstatus"), "upc", F.col("o_orderstatus") == "F"),
    "select l_orderkey as upc, l_partkey, l_linenumber, o_custkey, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'",
)
add(
    "c6_unprocessed",
    lambda s, d: J.unprocessed(view(s, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey"), view(s, d, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("id")), "id"),
    "select o_orderkey as id, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1)",
)
add(
    "c7_resolve_mapping",
    lambda s, d: J.resolve_mapping(
        view(s, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("NATION_"), "s_nationkey")).otherwise((F.col("s_nationkey") + 5).cast("string")).alias("name")).distinct(), view(s, d, "nation").select(F.col("n_name").alias("code"), F.col("n_nationkey").alias("id"))
    ),
    "with n as (select distinct case when s_suppkey % 2 = 0 then 'NATION_' || s_nationkey else cast(s_nationkey + 5 as string) end as name from supplier) select name, case when name not like 'N%' then n_name end as code, n_nationkey as id from n join nation on n_name = name or cast(n_nationkey as string) = name",
)
SK = "select p_partkey as product_id, unnest(['red', 'navy BLUE', 'green']) as color from part"


def skus(s, d):
    return view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.explode(F.array(F.lit("red"), F.lit("navy BLUE"), F.lit("green"))).alias("color"))


def albums(s, d):
    a = view(s, d, "images").filter("pos = 0 and product_id % 4 <> 1").select("product_id", "color", F.col("url").alias("album"))
    return a.unionByName(view(s, d, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").alias("product_id"), F.lit("initial").alias("color"), F.concat(F.lit("init"), "p_partkey").alias("album")))


for name, drop in (("c8_album_lookup", False), ("c8_album_or_drop", True)):
    add(
        name,
        lambda s, d, drop=drop: J.album_lookup(skus(s, d), albums(s, d), drop=drop),
        cte("images") + f", sk as ({SK}), al as (select product_id, color, url as album from images where pos = 0 and product_id % 4 <> 1), r as (select sk.product_id, sk.color, coalesce(al.album, case when sk.product_id % 3 = 0 then 'init' || sk.product_id end) as album from sk left join al on al.product_id = sk.product_id and al.color = sk.color) select * from r" + (" where album is not null" if drop else ""),
    )
add(
    "c9_backfill_color",
    lambda s, d: J.backfill_color(view(s, d, "line").select(F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("color"), "pos", F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(F.concat(F.lit("c"), "pos")).alias("color_id"))),
    cte("line") + "select l_partkey as product_id, l_returnflag as color, cast(pos as int) as pos, case when l_linenumber % 2 = 1 then 'c' || pos else 'c' || max(case when l_linenumber % 2 = 1 then pos end) over (partition by l_partkey, l_returnflag) end as color_id from line",
)


def merged(s, d):
    p = view(s, d, "part").withColumns({"product_id": F.col("p_partkey")})
    colors = F.expr("transform(sequence(0, 3), i -> struct(p_partkey * 10 + i as variant, concat('c', i % 2) as name))")
    sizes = F.expr("if(p_partkey % 3 = 0, cast(array() as array<struct<variant:bigint,name:string>>), transform(sequence(2, 5), i -> struct(p_partkey * 10 + i as variant, concat('s', i) as name)))")
    return V.merge_attributes(p.select("product_id", colors.alias("colors"), sizes.alias("sizes")))


MERGED = "with c as (select p_partkey as product_id, p_partkey * 10 + i as variant, 'c' || (i % 2) as color from part, range(4) r(i)), s as (select p_partkey as product_id, p_partkey * 10 + i as variant, 's' || i as size from part, range(2, 6) r(i) where p_partkey % 3 <> 0) select product_id, variant, color, size from c full join s using (product_id, variant) where product_id % 3 = 0 or (color is not null and size is not null)"
add("c10_merge_attributes", merged, MERGED)


def complement(s, d):
    g = view(s, d, "line").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("l_returnflag").alias("color"), F.concat(F.lit("s"), "l_linenumber").alias("size"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("stock")))).alias("x"))
    g = g.select(F.col("l_partkey").alias("product_id"), F.expr("transform(x, y -> struct(y.color, y.size, y.price, y.stock))").alias("stocked"), F.array(F.lit("A"), F.lit("N")).alias("colors"), F.array(F.lit("s1"), F.lit("s2"), F.lit("s9")).alias("sizes"))
    return V.complement_sizes(g)


COMPLEMENT = cte("line") + """, p as (select distinct l_partkey as product_id from line), g as (select product_id, color, size from p, (select unnest(['A','N']) as color) c, (select unnest(['s1','s2','s9']) as size) z),
 f as (select l_partkey as product_id, l_returnflag as color, 's' || l_linenumber as size, arg_min(l_extendedprice, pos) as price, arg_min(cast(l_quantity as int), pos) as stock from line group by all)
 select product_id, color, size, coalesce(price, 0.0) as price, coalesce(stock, 0) as stock from g left join f using (product_id, color, size) union all select l_partkey, l_returnflag, null, l_extendedprice, cast(l_quantity as int) from line where l_linenumber not in (1, 2, 9)"""
add("c11_complement_sizes", complement, COMPLEMENT)


def product(s, d):
    p = view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.expr("array('red', concat('b', p_size))").alias("color"), F.expr("array('S', ' ', 'L')").alias("size"), F.expr("if(p_partkey % 2 = 0, cast(array() as array<string>), array('D', 'EE'))").alias("width"))
    return V.cartesian(p, ["color", "size", "width"])


PRODUCT = "select p_partkey as product_id, color, size, width from (select p_partkey, p_size, unnest(['red', 'b' || p_size]) as color from part) c, (select unnest(['S', 'L']) as size) s, (select unnest(['D', 'EE', 'default']) as width) w where (p_partkey % 2 = 0) = (width = 'default')"
add("c12_cartesian", product, PRODUCT)


def aligned(s, d):
    o = view(s, d, "offers").groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("pos", "cents", "merchant"))).alias("o"))
    return V.align(o.select("product_id", F.expr("transform(o, x -> x.cents)").alias("prices"), F.expr("transform(filter(o, x -> x.merchant % 4 > 0), x -> x.merchant)").alias("variants")), "product_id", "prices", "variants")


add("c13_align", aligned, cte("offers") + ", v as (select product_id, merchant, row_number() over (partition by product_id order by pos) as at from offers where merchant % 4 > 0) select o.product_id, cast(o.pos as int) as pos, o.cents as prices, v.merchant as variants from offers o join v on v.product_id = o.product_id and v.at = o.pos")
add(
    "c13_half_split",
    lambda s, d: view(s, d, "part").select("p_partkey", F.explode(V.half_split(F.array(F.lit("k1"), F.concat(F.lit("k"), F.col("p_size") % 2 + 1), F.lit("k3"), F.lit("a"), F.lit("b"), "p_brand"))).alias("name", "value")),
    "select p_partkey, unnest(case when p_size % 2 = 0 then ['k1', 'k3'] else ['k1', 'k2', 'k3'] end) as name, unnest(case when p_size % 2 = 0 then ['b', p_brand] else ['a', 'b', p_brand] end) as value from part",
)


def matched(s, d):
    images = view(s, d, "pages").select("url", F.col("page_id").alias("pos"))
    literal = view(s, d, "pages").filter("page_id % 10 = 0").select(F.col("url").alias("text"), F.lit(False).alias("pattern"))
    patterns = view(s, d, "nation").filter("n_nationkey < 5").select(F.concat(F.lit("/[0-9]*"), F.col("n_nationkey") + 2, F.lit("/?$")).alias("text"), F.lit(True).alias("pattern"))
    return J.image_match(images, literal.unionByName(patterns))


add("c14_image_match", matched, "with w as (select url as text, false as p from pages where page_id % 10 = 0 union all select '/[0-9]*' || (n_nationkey + 2) || '/?$', true from nation where n_nationkey < 5), m as (select text, page_id as pos, url from w join pages on url = text or (p and regexp_matches(url, text))) select text, min(pos) as pos, arg_min(url, pos) as url from m group by 1")
add(
    "c16_orphans",
    lambda s, d: J.orphans(view(s, d, "pages").select(F.col("url").alias("path")), view(s, d, "pages").filter("page_id % 2 = 0").select(F.col("url").alias("path"))),
    "with u as (select url as path, regexp_extract(url, '^(.*/)', 1) as folder from pages) select path from u where folder in (select regexp_extract(url, '^(.*/)', 1) from pages where page_id % 2 = 0) and path not in (select url from pages where page_id % 2 = 0)",
)
add(
    "c17_repair_delays",
    lambda s, d: J.repair_delays(view(s, d, "orders").select(F.col("o_orderkey").alias("item_id")), view(s, d, "lineitem").filter("l_linenumber < 3").select(F.col("l_orderkey").alias("item_id")), 1706659200000),
    "select o_orderkey as item_id, 1706659200000 as due_ms from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber < 3)",
)
add(
    "c18_update_ids",
    lambda s, d: J.update_ids(
        view(s, d, "lineitem").select(F.col("l_orderkey").alias("parent_id"), "l_linenumber", F.col("l_partkey").cast("string").alias("mpn")),
        view(s, d, "orders").select(F.col("o_orderkey").alias("parent_id"), F.col("o_orderstatus").alias("site"), F.concat("o_orderpriority", F.lit("#m"), "o_custkey").alias("raw")),
        {"F": "#(m[0-9]+)", "O": "^([0-9]+)-H"},
    ),
    "select l_orderkey as parent_id, l_linenumber, coalesce(case o_orderstatus when 'F' then 'm' || o_custkey when 'O' then nullif(regexp_extract(o_orderpriority, '^([0-9]+)-H', 1), '') end, cast(l_partkey as string)) as mpn from lineitem left join orders on l_orderkey = o_orderkey",
)
add(
    "c19_reconcile",
    lambda s, d: J.reconcile(view(s, d, "identifiers").select("product_id", F.when(F.col("product_id") % 2 == 0, F.col("ean")).otherwise("").alias("ean"), F.when(F.col("product_id") % 5 == 0, F.col("mpn")).otherwise("").alias("mpn")), view(s, d, "identifiers")),
    cte("identifiers") + """, o as (select product_id, case when product_id % 2 = 0 then ean else '' end as e, case when product_id % 5 = 0 then mpn else '' end as m, ean, mpn from identifiers), n as (select product_id, e, m, coalesce(nullif(e, ''), ean) as ne, coalesce(nullif(m, ''), mpn) as nm from o),
 w as (select *, (ne is distinct from e) and (nm is distinct from m) as written from n) select product_id, case when written then ne else e end as ean, case when written then nm else m end as mpn, written from w""",
)
for name, known in (("c20_known", True), ("c20_unknown", False)):
    add(
        name,
        lambda s, d, known=known: J.known_items(view(s, d, "pages").select("page_id", F.regexp_extract("url", "([0-9]+)", 1).alias("print")), view(s, d, "part").filter("p_partkey % 3 = 0").select(F.col("p_partkey").cast("string").alias("print")), known),
        f"select page_id, regexp_extract(url, '([0-9]+)', 1) as print from pages where regexp_extract(url, '([0-9]+)', 1) {'' if known else 'not'} in (select cast(p_partkey as string) from part where p_partkey % 3 = 0)",
    )

# variant shapes
BASE = "price, list_price, stock, available, currency"
add(
    "d1_single_sku",
    lambda s, d: V.single_sku(view(s, d, "part").select(F.concat(F.lit("site#"), "p_partkey").alias("product_id"), "p_retailprice", "p_size", "p_brand"), SiteMapping("one", sku_id="regexp_extract(product_id, '#(.*)', 1)", price="p_retailprice", list_price="p_retailprice + 1", stock="if(p_size > 10, 5, 0)", available="p_size > 10", color="p_brand")),
    "select 'site#' || p_partkey as product_id, cast(p_partkey as string) as sku_id, p_brand as color, '' as size, p_retailprice as price, p_retailprice + 1 as list_price, case when p_size > 10 then 5 else 0 end as stock, p_size > 10 as available, 'USD' as currency from part",
)


def nested(s, d):
    sku = F.struct("pos", F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"), F.col("l_returnflag").alias("c"), F.col("l_linenumber").cast("string").alias("sz"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("q"))
    return view(s, d, "line").groupBy(F.col("l_partkey").alias("product_id")).agg(F.array_sort(F.collect_list(sku)).alias("skus"))


LIST = SiteMapping("list", sku_id="id", price="price", list_price="price", stock="q", available="q > 0", color="c", size="if(sz rlike '^[0-9]+$', cast(cast(sz as double) / 10 as string), sz)", currency="EUR")


def d2(s, d):
    x = nested(s, d).withColumn("self", F.struct(F.lit(1).alias("pos"), F.concat(F.lit("self"), "product_id").alias("id"), F.lit("").alias("c"), F.lit("one").alias("sz"), F.lit(1.5).alias("price"), F.lit(0).alias("q")))
    return V.sku_list(x.withColumn("skus", F.when(F.col("product_id") % 5 == 0, F.slice("skus", 1, 0)).otherwise(F.col("skus"))).withColumn("skus", F.expr("transform(skus, x -> struct(cast(x.pos as int) as pos, x.id, x.c, x.sz, x.price, x.q))")), LIST).drop("sku_pos")


add(
    "d2_sku_list",
    d2,
    cte("line") + """select l_partkey as product_id, l_orderkey || '-' || l_linenumber as sku_id, l_returnflag as color, cast(l_linenumber / 10.0::double as string) as size, l_extendedprice as price, l_extendedprice as list_price, cast(l_quantity as int) as stock, l_quantity >= 1 as available, 'EUR' as currency from line where l_partkey % 5 <> 0
 union all select distinct l_partkey, 'self' || l_partkey, '', 'one', 1.5, 1.5, 0, false, 'EUR' from line where l_partkey % 5 = 0""",
)


def d3(s, d, outer, skip):
    by = view(s, d, "line").groupBy(F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("color_id")).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("l_linenumber").cast("string").alias("sz"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("q")))).alias("sizes"))
    by = by.withColumn("sizes", F.when(F.col("color_id") == "R", F.slice("sizes", 1, 0)).otherwise(F.col("sizes")))
    p = by.groupBy("product_id").agg(F.collect_list(F.struct("color_id", "sizes")).alias("colors"))
    m = SiteMapping("color", sku_id="concat(color_id, coalesce(sz, '-'))", price="coalesce(price, 0D)", list_price="0D", stock="coalesce(q, 0)", available="coalesce(q > 0, false)", color="color_id", size="coalesce(sz, '')")
    return V.color_sizes(p, m, outer, skip)


for name, outer, skip in (("d3_color_sizes", True, False), ("d3_color_sizes_inner", False, True)):
    add(
        name,
        lambda s, d, outer=outer, skip=skip: d3(s, d, outer, skip),
        cte("line") + f""", l as (select *, row_number() over (partition by l_partkey, l_returnflag order by pos) as r from line), x as (select l_partkey as product_id, l_returnflag as color_id, cast(l_linenumber as string) as sz, l_extendedprice as price, cast(l_quantity as int) as q from l where l_returnflag <> 'R' {'and r > 1' if skip else ''}
 {"union all select distinct l_partkey, l_returnflag, cast(null as string), cast(null as double), cast(null as int) from l where l_returnflag = 'R'" if outer else ''})
 select product_id, color_id, color_id || coalesce(sz, '-') as sku_id, color_id as color, coalesce(sz, '') as size, coalesce(price, 0.0) as price, 0.0::double as list_price, coalesce(q, 0) as stock, coalesce(q > 0, false) as available, 'USD' as currency from x""",
    )


def d4(s, d):
    one = view(s, d, "line").groupBy(F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("c"), F.col("l_linenumber").cast("string").alias("z"), F.concat(F.lit("w"), F.col("l_suppkey") % 2).alias("w")).agg(F.struct(F.max("l_extendedprice").alias("price"), F.sum("l_quantity").cast("int").alias("q")).alias("sku"))
    a = one.groupBy("product_id", "c", "z").agg(F.map_from_entries(F.collect_list(F.struct("w", "sku"))).alias("m"))
    b = a.groupBy("product_id", "c").agg(F.map_from_entries(F.collect_list(F.struct("z", "m"))).alias("m"))
    p = b.groupBy("product_id").agg(F.map_from_entries(F.collect_list(F.struct("c", "m"))).alias("variants"))
    return V.color_size_width(p, SiteMapping("width", sku_id="concat_ws('/', color, size, width)", list_price="price", stock="q", available="q > 0", color="color", size="size"))


add("d4_color_size_width", d4, "select l_partkey as product_id, 'w' || (l_suppkey % 2) as width, l_returnflag || '/' || l_linenumber || '/w' || (l_suppkey % 2) as sku_id, l_returnflag as color, cast(l_linenumber as string) as size, max(l_extendedprice) as price, max(l_extendedprice) as list_price, cast(sum(l_quantity) as int) as stock, sum(l_quantity) > 0 as available, 'USD' as currency from lineitem group by l_partkey, l_returnflag, l_linenumber, l_suppkey % 2")
add("d5_color_size_product", lambda s, d: V.cartesian(view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.array("p_brand", F.lit("red")).alias("color"), F.expr("transform(sequence(1, 1 + p_size % 3), x -> concat('s', x))").alias("size")), ["color", "size"]), "select p_partkey as product_id, color, 's' || i as size from (select p_partkey, p_size, unnest([p_brand, 'red']) as color from part) c, range(1, 4) r(i) where i <= 1 + p_size % 3")
add(
    "d6_sizes_only",
    lambda s, d: V.sizes_only(view(s, d, "part").select(F.col("p_partkey").alias("product_id"), F.expr("array(concat('EU_', p_size, '_', p_partkey, ' [$', p_size, '.5 - last one]'), concat('M_', p_partkey))").alias("labels")), SiteMapping("sizes", price="coalesce(try_cast(price_text as double), 0D)", list_price="0D", stock="if(reason = '', 5, 1)", size="size_text")),
    "select p_partkey as product_id, 0 as pos, 'last one' as reason, cast(p_partkey as string) as sku_id, '' as color, 'EU_' || p_size as size, p_size + 0.5::double as price, 0.0::double as list_price, 1 as stock, true as available, 'USD' as currency from part union all select p_partkey, 1, '', cast(p_partkey as string), '', 'M', 0.0, 0.0, 5, true, 'USD' from part",
)


def d7(s, d):
    one = view(s, d, "line").groupBy(F.col("l_partkey").alias("product_id"), F.concat("l_returnflag", F.lit("-"), "l_linenumber").alias("k")).agg(F.max("l_extendedprice").alias("price"), F.count(F.lit(1)).cast("int").alias("q"))
    sku = F.struct(F.when(F.col("k").startswith("A"), F.lit("solo")).otherwise(F.concat(F.lit("Colour "), F.substring("k", 1, 1), F.lit(", Size "), F.substring("k", 3, 1))).alias("name"), "price", "q")
    p = one.groupBy("product_id").agg(F.map_from_entries(F.collect_list(F.struct("k", sku))).alias("sku_map"))
    return V.sku_map(p, SiteMapping("map", sku_id="sku_key", list_price="price", stock="q", color="c_name", size="s_name"))


add(
    "d7_sku_map",
    d7,
    "select l_partkey as product_id, l_returnflag as c_id, cast(l_linenumber as string) as s_id, l_returnflag || '-' || l_linenumber as sku_id, case when l_returnflag = 'A' then 'solo' else 'Colour ' || l_returnflag end as color, case when l_returnflag = 'A' then '' else 'Size ' || l_linenumber end as size, max(l_extendedprice) as price, max(l_extendedprice) as list_price, cast(count(*) as int) as stock, true as available, 'USD' as currency from lineitem group by l_partkey, l_returnflag, l_linenumber",
)
add("d8_merged_variants", lambda s, d: merged(s, d).filter("size is not null"), f"select * from ({MERGED}) where size is not null")
add("d9_stock_complement", lambda s, d: complement(s, d).filter("stock = 0"), f"select * from ({COMPLEMENT}) where stock = 0")
add(
    "d10_spec_pairs",
    lambda s, d: V.spec_pairs(view(s, d, "ev").select("event_id", F.create_map(F.lit("frame_type"), "event_type", F.lit("k_value"), F.col("k").cast("string"), F.lit("is_new"), (F.col("k") % 2 == 0).cast("string"), F.lit("gone"), F.lit(None).cast("string")).alias("m")), "event_id", "m"),
    cte("ev") + "select event_id, 'frametype' as name, event_type as value from ev union all select event_id, 'kvalue', cast(k as string) from ev where k <> 0 union all select event_id, 'isnew', 'Yes' from ev where k % 2 = 0",
)
