"""Domain-shaped views over the base tables, written once in SQL that Spark and the oracle both read.

`view(spark, sf_dir, name)` gives a DataFrame; `cte(names)` gives the same definitions as a WITH clause
for the oracle. Placeholders: {US:c} is column c in microseconds since 1970.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: The report time of every query on events, in seconds (2024-01-31 00:00:00).
AS_OF = 1706659200

VIEWS = {
    "ev": "select event_id, user_id, event_type, value, props, {US:ts} as us, cast(floor({US:ts} / 1000000) as bigint) as sec, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events",
    "crawl_events": """select event_id, user_id % 40 as crawlid, (user_id % 40) % 7 as spiderid,
        case event_type when 'view' then 'scheduled' when 'click' then 'crawled' when 'purchase' then 'crawled' when 'error' then 'failed_pages' else 'failed_pipeline' end as kind,
        case when event_type = 'view' then 1 + k % 6 else 1 end as n,
        concat('http://x/', cast(k as string)) as url, concat('e', cast(k % 5 as string), '|at ', cast(k as string)) as reason, us, sec from ev""",
    "metric_points": "select event_id, user_id % 3 as app, user_id % 5 as site, us, sec, case when event_type = 'signup' then 1 else -1 end as value from ev where event_type in ('signup', 'purchase')",
    "logs": """select event_id, concat('logger', cast(user_id % 4 as string)) as logger, case when event_type = 'error' then 'ERROR' else 'INFO' end as level, user_id % 9 as appid, user_id % 40 as crawlid, user_id % 25 as host,
        case event_type when 'view' then 200 when 'click' then 200 when 'purchase' then 302 when 'signup' then 404 else 503 end as status_code,
        (k % 4 <> 0 or k % 8 = 0) as parsed, k % 4 <> 0 as valid, event_type <> 'error' as success, concat('message ', cast(k % 12 as string)) as message, value, us, sec, k from ev""",
    "fetch_log": "select event_id, user_id * 100 + k % 10 as url_key, event_id as attempt_seq, event_type <> 'error' as ok, k % 11 = 0 as listing, us from ev",
    "delayed_messages": """select o_orderkey as seq, o_orderkey % 500 as item_id, n_name as site, case when o_orderstatus = 'F' and o_orderkey % 17 = 0 then 'delete' else 'upsert' end as event,
        cast(floor({US:o_orderdate} / 1000000) as bigint) as sec from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "site_delay": "select n_name as site, n_nationkey % 4 * 86400 as update_interval from nation",
    "site_codes": "select lower(n_name) as code, n_regionkey as spiderid from nation",
    "requests": "select o_custkey % 7 as spiderid, cast(substr(o_orderpriority, 1, 1) as int) as priority, o_orderkey as seq from orders",
    "cents": "select p_partkey as product_id, p_name, p_brand, p_type, p_size, cast(round(p_retailprice * 100) as bigint) as c from part",
    "price_words": "select product_id, p_name, p_brand, p_type, p_size, c, concat(cast(cast(floor(c / 100) as bigint) as string), '.', lpad(cast(c % 100 as string), 2, '0')) as plain from cents",
    "items": """select product_id, concat('site', cast(product_id % 6 as string)) as site, p_name as title, p_brand as brand, p_type as kind, p_size as size,
        case when product_id % 7 = 0 then '' when product_id % 5 = 0 then concat('EUR ', regexp_replace(plain, '([0-9])([0-9][0-9][0-9])[.]', '\\\\1.\\\\2,'))
            when product_id % 11 = 0 then concat('$', plain, ' - $99') when product_id % 13 = 0 then '1.2.3' else concat('$', plain) end as price_text,
        case when product_id % 4 = 0 then '' else concat('$1,', lpad(cast(c % 1000 as string), 3, '0'), '.50') end as list_price_text,
        case product_id % 6 when 0 then 'In Stock.' when 1 then concat('Only ', cast(p_size as string), ' left in stock') when 2 then '0 in stock' when 3 then 'Usually ships in 2 days' when 4 then 'Currently unavailable' else '' end as reason_text,
        case product_id % 5 when 0 then 'FREE Shipping' when 1 then concat('+ $', plain, ' shipping') when 2 then 'gratis' when 3 then 'slow boat' else '' end as shipping_text
        from price_words""",
    "line": "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, cast(floor({US:l_shipdate} / 1000000) as bigint) as ship_sec, row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {US:l_shipdate}, l_quantity, l_discount, l_tax) as pos from lineitem",
    "offers": "select l_partkey as product_id, l_suppkey as merchant, cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint) as cents, pos from line",
    "cost_floor": "select l_partkey as product_id, min(l_extendedprice) as offer_price from lineitem where l_partkey % 2 = 0 group by l_partkey",
    "identifiers": """select p_partkey as product_id, case when p_partkey % 3 = 0 then '' else concat('9', lpad(cast(p_partkey as string), 11, '0')) end as upc,
        case when p_partkey % 3 = 0 then '' else concat('09', lpad(cast(p_partkey as string), 11, '0')) end as ean, case when p_partkey % 3 = 0 then '' else s_name end as mpn
        from part left join supplier on s_suppkey = p_partkey % 13""",
    "images": """select p_partkey as product_id, color, pos, concat('//img/', cast(p_partkey as string), '_', case when pos = p_partkey % 4 then 'MAIN' else cast(pos as string) end, '.jpg') as url
        from part cross join (select 'red' as color union all select 'navy BLUE' as color) c cross join (select 0 as pos union all select 1 as pos union all select 2 as pos) p""",
}

_NAMES = re.compile(r"\b(from|join)\s+\(?\s*([a-z_]+)", re.I)
_US = re.compile(r"\{US:(\w+)\}")


def _needs(name: str) -> list[str]:
    out: list[str] = []
    for n in [m[1] for m in _NAMES.findall(VIEWS[name])]:
        if n in VIEWS and n not in out:
            out += [x for x in _needs(n) if x not in out] + [n]
    return out


def cte(*names: str) -> str:
    """`with a as (...), b as (...)` for the views and those that they need, in the oracle's SQL."""
    order: list[str] = []
    for name in names:
        order += [x for x in [*_needs(name), name] if x not in order]
    body = ", ".join(f"{n} as ({VIEWS[n]})" for n in order)
    return "with " + _US.sub(r"epoch_us(\1)", body).replace("\\\\1", "\\1").replace("\\\\2", "\\2") + " "


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _US.sub(r"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', \1)", VIEWS[name])
    text = text.replace("\\\\1", "$1").replace("\\\\2", "$2")
    used = {n for n in [m[1] for m in _NAMES.findall(text)] if n in TABLES or n in VIEWS}
    for n in used:
        text = re.sub(rf"\b(from|join)(\s+\(?\s*){n}\b", rf"\1\2{{{n}}}", text)
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in used})
