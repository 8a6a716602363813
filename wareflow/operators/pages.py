"""From pages to links and fields: native regular expressions over the html column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve(base: Column, href: Column) -> Column:
    """A link made absolute: full, scheme-relative, root-relative, or relative to the page's folder."""
    root = F.regexp_extract(base, "^([a-zA-Z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([a-zA-Z]+://[^?#]*/)", 1)
    folder = F.when(F.length(folder) > F.length(root), folder).otherwise(F.concat(root, F.lit("/")))
    scheme = F.regexp_extract(base, "^([a-zA-Z]+:)", 1)
    return F.when(href.rlike("^[a-zA-Z]+://"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href))


def extract_links(pages: DataFrame, pattern: str = '<a [^>]*href="([^"]*)"') -> DataFrame:
    """B1: the distinct links of each page, resolved, with the place of their first occurrence."""
    hrefs = F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))
    return pages.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href")).select("page_id", "pos", resolve(F.col("url"), F.col("href")).alias("link"))


def next_page_arg(url: Column, name: str, first: int) -> Column:
    """B2: the counter in the query plus one; without it the argument is added, counting from first + 1."""
    found = F.regexp_extract(url, f"[?&]{name}=([0-9]+)", 1)
    grown = F.concat(F.regexp_extract(url, f"^(.*[?&]{name}=)[0-9]+", 1), (found.try_cast("int") + 1).cast("string"), F.regexp_extract(url, f"[?&]{name}=[0-9]+(.*)$", 1))
    added = F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit(f"{name}={first + 1}"))
    return F.when(found != "", grown).otherwise(added)


def next_page_offset(url: Column, name: str, begin: int, n: Column) -> Column:
    """Offset + n; begin + n where the query lacks it; n + 1 where there is no query."""
    found = F.regexp_extract(url, f"[?&]{name}=([0-9]+)", 1)
    grown = F.concat(F.regexp_extract(url, f"^(.*[?&]{name}=)[0-9]+", 1), (found.try_cast("int") + n).cast("string"), F.regexp_extract(url, f"[?&]{name}=[0-9]+(.*)$", 1))
    with_query = F.concat(url, F.lit(f"&{name}="), (F.lit(begin) + n).cast("string"))
    without = F.concat(url, F.lit(f"?{name}="), (n + 1).cast("string"))
    return F.when(found != "", grown).when(url.contains("?"), with_query).otherwise(without)


def next_page_path(url: Column, prefix: str, first: int, suffix: str) -> Column:
    """The counter between prefix and suffix in the path plus one; else prefix, first + 1 and suffix are added."""
    path, tail = F.regexp_extract(url, "^([^?#]*)", 1), F.regexp_extract(url, "^[^?#]*(.*)$", 1)
    rule = f"{prefix}([0-9]+){suffix}"
    found = F.regexp_extract(path, rule, 1)
    grown = F.concat(F.regexp_extract(path, f"^(.*{prefix})[0-9]+{suffix}", 1), (found.try_cast("int") + 1).cast("string"), F.regexp_extract(path, f"{prefix}[0-9]+({suffix}.*)$", 1))
    added = F.concat(F.regexp_replace(path, f"{suffix}$", ""), F.lit(f"{prefix}{first + 1}{suffix}"))
    return F.concat(F.when(found != "", grown).otherwise(added), tail)


def plan_next_pages(pages: DataFrame, links: DataFrame, seen: DataFrame, rule: Column) -> DataFrame:
    """The next page of each page with one link at least that was not seen; the rule's column gives its URL."""
    fresh = links.join(seen.select("link").distinct(), "link", "left_anti").groupBy("page_id").agg(F.count(F.lit(1)).alias("effective"))
    return pages.join(fresh, "page_id").select("page_id", "effective", rule.alias("next_page"))


def base_fields(pages: DataFrame) -> DataFrame:
    """Host, domain (host without its first label, null if it has one label only), seed and response URL."""
    host = F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1)
    return pages.select("page_id", "url", host.alias("host"), F.when(host.contains("."), F.regexp_replace(host, "^[^.]+[.]", "")).alias("domain"), F.regexp_extract("url", "^([^?#]*)", 1).alias("response_url"))


def spec_rows(pages: DataFrame, row: str, cell: str) -> DataFrame:
    """(page, key, value) for rows with exactly two cells, one of them at least not blank."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(row), F.lit(1))).alias("pos", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(cell), F.lit(1)), lambda x: F.trim(x))
    two = rows.select("page_id", "pos", cells.alias("c")).filter("size(c) = 2")
    return two.select("page_id", "pos", F.col("c")[0].alias("key"), F.col("c")[1].alias("value")).filter("key <> '' or value <> ''")


def embedded_state(rows: DataFrame, column: str, schema: str, pattern: str | None = None) -> DataFrame:
    """A JavaScript literal (bare keys and single quotes allowed) as a struct; what is empty gives empty fields."""
    text = F.regexp_extract(column, pattern, 1) if pattern else F.col(column)
    text = F.when(F.trim(text) == "", "{}").otherwise(text)
    return rows.withColumn("state", F.from_json(text, schema, {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}))


#: The cleaning steps of B10 in their order: pattern and replacement.
HTML_STEPS = (
    ("[\n\t\r]", ""),
    ("  ", ""),
    ("[‘’]", "'"),
    ("﻿", ""),
    ("•", ":"),
    ("<([a-zA-Z0-9]+) [^>]*>", "<{1}>"),
    ("<script>[^<]*</script>", ""),
    ("</?a[^>]*>", ""),
)


def clean_html(c: Column) -> Column:
    """The ordered replacements of HTML_STEPS. Every tag that starts with an `a` goes, <article> too."""
    for pattern, to in HTML_STEPS:
        c = F.regexp_replace(c, pattern, to.replace("{1}", "$1"))
    return c


#: What identifies a page, by site; the text before or matched by the pattern.
FINGERPRINTS = {"amazon": "^(.*?)ref", "eastbay": "^(.*model:[0-9]+/)", "zappos": "(product/[0-9]+)", "6pm": "(product/[0-9]+)"}


def fingerprint(site: Column, url: Column, rules: dict[str, str] | None = None) -> Column:
    """The site's part of the URL, else the whole URL."""
    found = F.lit(None).cast("string")
    for s, pattern in (rules or FINGERPRINTS).items():
        found = F.when(site == s, F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))).otherwise(found)
    return F.coalesce(found, url)


def code_urls(codes: DataFrame, templates: DataFrame) -> DataFrame:
    """Product codes to URLs by the site's template ({code}, {tld}); unknown sites are dropped."""
    return codes.join(templates, "site").select("code", "site", F.regexp_replace(F.regexp_replace("template", r"\{code\}", F.col("code")), r"\{tld\}", F.col("tld")).alias("url"))


def image_urls(rows: DataFrame, token: str, values: str, images: str = "images") -> DataFrame:
    """Every image with every value of `values` in place of the token; images are the outer loop."""
    one = rows.select("product_id", F.posexplode(images).alias("image_pos", "image"), values)
    return one.select("product_id", "image_pos", "image", F.posexplode(values).alias("value_pos", "value")).select("product_id", "image_pos", "value_pos", F.replace("image", F.lit(token), F.col("value")).alias("image_url"))


def storage_path(spider: Column, url: Column, mode: str = "formatter") -> Column:
    """/spider/sha1(url).ext without loco_. Modes: formatter (.jpg), filter (own extension), sharded (by hash prefix)."""
    name, digest = F.regexp_replace(spider, "^loco_", ""), F.sha1(F.encode(url, "UTF-8"))
    ext = F.lower(F.regexp_extract(F.regexp_extract(url, "^([^?#]*)", 1), r"([.][a-zA-Z0-9]+)$", 1))
    ext = F.when(F.lit(mode) == "formatter", ".jpg").otherwise(F.coalesce(F.nullif(ext, F.lit("")), F.lit(".jpg")))
    if mode == "sharded":
        return F.concat(F.lit("/"), name, F.lit("/"), F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 3, 2), F.lit("/"), digest, ext)
    return F.concat(F.lit("/"), name, F.lit("/"), digest, ext)


def enrich_tags(links: DataFrame, products: DataFrame, tasks: DataFrame) -> DataFrame:
    """The products whose link is on a task's page get the task's tags; the type is upper-cased."""
    on = links.join(tasks, "page_id").join(products.select("link", "product_id"), "link")
    found = on.groupBy("product_id", F.upper("type").alias("type")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("tags"))
    return found


def regroup(values: Column, n: int) -> Column:
    """Every n consecutive texts become one; a short tail is dropped."""
    full = F.floor(F.size(values) / n).cast("int")
    return F.when(full > 0, F.transform(F.sequence(F.lit(0), full - 1), lambda i: F.array_join(F.slice(values, i * n + 1, n), ""))).otherwise(F.array().cast("array<string>"))
