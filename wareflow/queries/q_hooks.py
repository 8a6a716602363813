"""Queries and oracle of what users give: field processors, site adapters, translate functions, delay and schedule rules."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..fixtures import AS_OF, cte, view
from ..operators import catalog, frontier, messages, variants
from ..operators.rules import Rule, extract
from .q_catalog import DUE, due

QUERIES, SQL = {}, {}


def add(name, query, sql):
    QUERIES[name], SQL[name] = query, sql


def u1(s, d):
    """Processors of all three forms: a function of columns, an SQL function's name, a function that the user registered."""

    @F.pandas_udf("string")
    def marks(x: pd.Series) -> pd.Series:
        return x.fillna("").str.replace(r"[a-z]+", "", regex=True)

    s.udf.register("user_marks", marks)
    hrefs = (("regex", 'href="([^"]*)"'),)
    rules = [
        Rule("title", (("regex", "<title>(.*?)</title>"),), order=1, input="reverse"),
        Rule("paths", hrefs, order=1, input=lambda x: F.regexp_replace(x, "[?#].*$", ""), output=lambda v: F.array_join(F.array_distinct(v), "|")),
        Rule("last", hrefs, order=1, output=lambda v: F.try_element_at(v, F.lit(-1)), default="-"),
        Rule("joined", (("sql", "title"), ("sql", "last")), order=2, output=lambda v: F.array_join(v, " > ")),
    ]
    found = extract(view(s, d, "pages"), rules)
    return found.withColumn("short", F.call_function("user_marks", F.col("last")))


add(
    "u1_field_processors",
    u1,
    """with p as (select page_id, url, reverse(regexp_extract(html, '<title>(.*?)</title>', 1)) as title, regexp_extract_all(html, 'href="([^"]*)"', 1) as h from pages),
 q as (select page_id, url, trim(title) as title, h, case when len(h) > 0 and h[-1] <> '' then h[-1] else '-' end as last from p), x as (select *, list_transform(h, lambda v: regexp_replace(v, '[?#].*$', '')) as a from q)
 select page_id, url, title, coalesce(array_to_string(list_filter(a, lambda v, i: list_position(a, v) = i), '|'), '') as paths, last, title || ' > ' || last as joined,
  regexp_replace(last, '[a-z]+', '', 'g') as short from x""",
)


def u2(s, d):
    """Two sites with rules of their own for the same shape of record: one that drops what can't be had, one that halves what is too dear."""
    line = view(s, d, "line").withColumn("product_id", F.col("l_partkey"))
    first = variants.SiteMapping("first", sku_id="concat(l_orderkey, '-', l_linenumber, '-', pos)", price="l_extendedprice", list_price="l_extendedprice * 2", stock="cast(l_quantity as int)", color="lower(l_returnflag)", available="l_quantity > 10", extra={"tax": "l_discount * 100"}, process=lambda x: x.filter("available"))
    second = variants.SiteMapping("second", currency="EUR", sku_id="concat('x', l_orderkey, '-', pos)", price="if(l_extendedprice > 50000, l_extendedprice / 2, l_extendedprice)", list_price="0D", stock="0", size="cast(l_linenumber as string)", extra={"tax": "0D"})
    both = [variants.single_sku(line.filter(F.col("l_partkey") % 2 == n), m).withColumn("site", F.lit(m.site)) for n, m in enumerate((first, second))]
    return both[0].unionByName(both[1])


add(
    "u2_site_adapter",
    u2,
    cte("line")
    + """select l_partkey as product_id, l_orderkey || '-' || l_linenumber || '-' || pos as sku_id, lower(l_returnflag) as color, '' as size, l_extendedprice as price, l_extendedprice * 2 as list_price, cast(l_quantity as int) as stock, true as available, l_discount * 100 as tax, 'USD' as currency, 'first' as site
  from line where l_partkey % 2 = 0 and l_quantity > 10
 union all select l_partkey, 'x' || l_orderkey || '-' || pos, '', cast(l_linenumber as string), case when l_extendedprice > 50000 then l_extendedprice / 2 else l_extendedprice end, 0.0::double, 0, true, 0.0::double, 'EUR', 'second' from line where l_partkey % 2 = 1""",
)


def u2_images(s, d):
    m = variants.SiteMapping("shop", is_main="url like '%\\_1.jpg'", image_type="regexp_extract(url, '_(MAIN)', 1)", position="2 - pos")
    return catalog.ensure_main(catalog.image_rows(view(s, d, "images"), m))


add(
    "u2_image_rules",
    u2_images,
    cte("images") + r""", i as (select product_id, color, url, url like '%\_1.jpg' escape '\' as m, 2 - pos as pos from images)
 select product_id, color, url, pos, 'MAIN' as kind, m or (not bool_or(m) over (partition by product_id, color) and pos = min(pos) over (partition by product_id, color)) as is_main from i""",
)


def u3(s, d):
    """A user's function of segments, vectorised, in place of a memory."""

    @F.pandas_udf("string")
    def turn(x: pd.Series) -> pd.Series:
        return x.where(x.str.len() % 2 == 0, x.str.slice(start=1) + x.str.slice(stop=1))

    texts = view(s, d, "documents").filter("text is not null").select(F.col("doc_id").alias("id"), "text")
    return messages.translate(texts, None, function=turn).select("id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


add(
    "u3_translate_function",
    u3,
    "with u as (select doc_id as id, unnest(a) as w, unnest(range(len(a))) as pos from (select doc_id, regexp_split_to_array(text, '[ \\n]+') as a from documents)), t as (select id, string_agg(case when length(w) % 2 = 0 then w else substr(w, 2) || left(w, 1) end, ' ' order by pos) as text from u group by 1) select id, md5(text) as digest, length(text) as n from t",
)


def u4(s, d):
    """Sites that are closed on the day, and a predicate by which some sites are only asked in the first half of an hour; delays are the sites' table."""
    early = lambda site, now: (F.length(site) < 9) | (F.minute(now) < 30)
    return frontier.refresh_batches(due(s, d), AS_OF + 45 * 60, {"NATION_3": 2, "NATION_5": 2, "NATION_4": 4}, 5, early)


add("u4_schedule", u4, DUE + " select item_id, site, due, cast((row_number() over (partition by site order by due, item_id) - 1) // 5 as bigint) as chunk from due where length(site) < 9 and site not in ('NATION_3', 'NATION_5')")
