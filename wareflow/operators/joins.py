"""Joins of items, sites, costs and identifiers. Dimension tables carry no forced broadcast unless their size is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def site_codes(feeds: DataFrame, codes: DataFrame, how: str = "left") -> DataFrame:
    """The spider of each feed's site code, in any case."""
    c = codes.select(F.upper("code").alias("__code"), "spiderid")
    return feeds.join(c, F.upper("site_code") == F.col("__code"), how).drop("__code")


def cost_floor(items: DataFrame, offers: DataFrame, default: float = 1_000_000.0) -> DataFrame:
    """Cost is the lesser of cost and offer price (default if there is none); one price a product."""
    one = offers.groupBy("product_id").agg(F.min("offer_price").alias("offer_price"))
    return items.join(one, "product_id", "left").withColumn("cost", F.least("cost", F.coalesce("offer_price", F.lit(default)))).drop("offer_price")


def attach_feed(items: DataFrame, feed: DataFrame, order: list[str]) -> DataFrame:
    """A product's feed rows as the list `ware`, in order; null where there are none."""
    ware = feed.groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("ware"))
    return items.join(ware, "product_id", "left")


def enrich_ids(items: DataFrame, ids: DataFrame) -> DataFrame:
    """C4: upc, ean and mpn by product, the item's own first."""
    names = ("upc", "ean", "mpn")
    found = ids.select("product_id", *[F.col(n).alias(f"__{n}") for n in names])
    return items.join(found, "product_id", "left").select(*[c for c in items.columns if c not in names], *[F.coalesce(F.nullif(n, F.lit("")), F.nullif(f"__{n}", F.lit(""))).alias(n) for n in names])


def cross_site(left: DataFrame, right: DataFrame, key: str, keep: Column) -> DataFrame:
    """Rows of two sites with one key, after the filter of the right site."""
    return left.join(right.filter(keep), key)


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that were not processed yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def resolve_mapping(names: DataFrame, mapping: DataFrame) -> DataFrame:
    """A name is a code (gives the id) or an id (gives code and id, and wins): two equi joins and a union."""
    by_id = names.join(mapping, names["name"] == mapping["id"].cast("string")).select("name", F.struct(F.lit(2).alias("rank"), "code", "id").alias("m"))
    by_code = names.join(mapping, names["name"] == mapping["code"]).select("name", F.struct(F.lit(1).alias("rank"), F.lit(None).cast("string").alias("code"), "id").alias("m"))
    return by_id.unionByName(by_code).groupBy("name").agg(F.max("m").alias("m")).select("name", "m.code", "m.id")


def album_lookup(skus: DataFrame, albums: DataFrame, fallback: str = "initial", drop: bool = False) -> DataFrame:
    """The album of the SKU's colour, else that of the fallback colour, else none (dropped if asked for)."""
    exact = albums.select("product_id", "color", F.col("album").alias("__own"))
    other = albums.filter(F.col("color") == fallback).select("product_id", F.col("album").alias("__other"))
    found = skus.join(exact, ["product_id", "color"], "left").join(other, "product_id", "left")
    found = found.withColumn("album", F.coalesce("__own", "__other")).drop("__own", "__other")
    return found.filter("album is not null") if drop else found


def backfill_color(skus: DataFrame) -> DataFrame:
    """A missing colour id from the last sibling SKU of the product with that colour."""
    w = Window.partitionBy("product_id", "color").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return skus.withColumn("color_id", F.coalesce(F.nullif("color_id", F.lit("")), F.last(F.nullif("color_id", F.lit("")), ignorenulls=True).over(w)))


#: Letters of a gram of C14 at most, and the parts that a gram's images are dealt to.
GRAM, SALTS = 3, 32
#: Escapes of a pattern that stand for a class, a place or an earlier group, and not for their letter.
_NOT_LETTERS = set("dDwWsShHvVRXbBAzZGtnrfae0123456789")


def required_grams(pattern: str | None) -> list[str]:
    """Texts of GRAM letters at most that whatever a regular expression finds must hold; none if that isn't plain to see.

    Only letters outside of groups and classes count, each without a quantifier that lets it go. An alternative outside of groups, a flag or an
    escape that isn't known gives none.
    """
    runs, run, i, p = [], "", 0, pattern or ""

    def end():
        nonlocal run
        runs.append(run)
        run = ""

    while i < len(p):
        c = p[i]
        if c == "|" or p.startswith("(?", i) and p[i + 2 : i + 3] not in (":", "=", "!", "<"):
            return []
        if c == "\\":
            n = p[i + 1 : i + 2]
            if n.isalnum() and n not in _NOT_LETTERS or not n or n == "0":
                return []
            if n.isalnum():
                end()
            else:
                run += n
            i += 2
        elif c == "[" or c == "(":
            end()
            i = _closed(p, i)
            if i < 0:
                return []
        elif c in "?*{":
            run = run[:-1]
            end()
            i = p.find("}", i) + 1 if c == "{" else i + 1
            if not i:
                return []
        elif c in "+.^$":
            end()
            i += 1
        else:
            run += c
            i += 1
    end()
    return list(dict.fromkeys(r[k : k + GRAM] for r in runs if r for k in range(max(1, len(r) - GRAM + 1))))


def _closed(p: str, at: int) -> int:
    """Where a class or a group that begins at `at` has ended; -1 if it doesn't, or has a class in a class."""
    if p[at] == "[":
        i = at + 2 if p.startswith("[^", at) else at + 1
        i += p.startswith("]", i)
        while i < len(p) and p[i] != "]":
            if p[i] == "[" or p.startswith("&&", i):
                return -1
            i += 2 if p[i] == "\\" else 1
        return i + 1 if i < len(p) else -1
    depth, i = 0, at
    while i < len(p):
        if p[i] == "\\":
            i += 2
            continue
        if p[i] == "[":
            if (i := _closed(p, i)) < 0:
                return -1
            continue
        depth += (p[i] == "(") - (p[i] == ")")
        i += 1
        if not depth:
            return i
    return -1


def image_match(images: DataFrame, wanted: DataFrame) -> DataFrame:
    """C14: an image for each wanted text (`text`, `pattern`): equal, or found by it as a pattern (a Java regular expression); the first by position.

    Equal texts meet by an equi join. A pattern meets the images that hold a gram which it requires, the rarest of its grams among them, and only those
    are searched; so patterns may be many. One that requires none meets all images. A gram's images are dealt to SALTS parts, to each of which its patterns go.
    Null texts and URLs match nothing.
    """
    found = images.select("url", "pos").filter("url is not null")
    asked = wanted.select("text", "pattern").filter("text is not null").distinct()
    equal = found.join(asked.select("text").distinct(), F.col("url") == F.col("text")).select("text", "pos", "url")
    grams = F.udf(required_grams, "array<string>")
    patterns = asked.filter("pattern").select("text", grams("text").alias("grams"))
    pairs = patterns.select("text", F.explode_outer("grams").alias("gram"))
    held = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("url") - n + 1, F.lit(1))), lambda i: F.substring("url", i, n)))))
    of_url = found.select("url", "pos", F.explode(F.concat(F.array(F.lit("")), held)).alias("gram"))
    common = of_url.join(pairs.select("gram").filter("gram is not null").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = pairs.join(common, "gram", "left").groupBy("text").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g"))
    rarest = rarest.select("text", F.coalesce("g.gram", F.lit("")).alias("gram"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = of_url.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    matched = dealt.join(rarest, ["gram", "salt"]).filter(F.expr("url rlike text")).select("text", "pos", "url")
    return equal.unionByName(matched).groupBy("text").agg(F.min(F.struct("pos", "url")).alias("m")).select("text", "m.pos", "m.url")


def orphans(files: DataFrame, images: DataFrame) -> DataFrame:
    """Files in a referenced folder that no image references."""
    folder = F.regexp_extract("path", "^(.*/)", 1)
    used = images.select("path").distinct()
    return files.join(used.select(folder.alias("folder")).distinct(), folder == F.col("folder"), "left_semi").join(used, "path", "left_anti")


def repair_delays(messages: DataFrame, due: DataFrame, at_ms: int) -> DataFrame:
    """C17: stored messages without a due entry get one (milliseconds)."""
    return messages.join(due.select("item_id").distinct(), "item_id", "left_anti").select("item_id", F.lit(at_ms).cast("long").alias("due_ms"))


def update_ids(children: DataFrame, records: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Ids computed anew from the raw record by the site's pattern replace those of the children."""
    new = F.lit(None).cast("string")
    for site, pattern in rules.items():
        new = F.when(F.col("site") == site, F.nullif(F.regexp_extract("raw", pattern, 1), F.lit(""))).otherwise(new)
    ids = records.select("parent_id", new.alias("__new"))
    return children.join(ids, "parent_id", "left").withColumn("mpn", F.coalesce("__new", "mpn")).drop("__new")


def reconcile(old: DataFrame, new: DataFrame) -> DataFrame:
    """Ean and mpn stay unless empty; a row is written only if both differ from what it had."""
    n = new.select("product_id", F.col("ean").alias("__e"), F.col("mpn").alias("__m"))
    j = old.join(n, "product_id")
    ean, mpn = F.coalesce(F.nullif("ean", F.lit("")), "__e"), F.coalesce(F.nullif("mpn", F.lit("")), "__m")
    both = (~ean.eqNullSafe(F.col("ean"))) & (~mpn.eqNullSafe(F.col("mpn")))
    return j.select("product_id", F.when(both, ean).otherwise(F.col("ean")).alias("ean"), F.when(both, mpn).otherwise(F.col("mpn")).alias("mpn"), both.alias("written"))


def known_items(rows: DataFrame, catalog: DataFrame, known: bool) -> DataFrame:
    """C20: rows whose fingerprint the catalog has, or has not."""
    return rows.join(catalog.select("print").distinct(), "print", "left_semi" if known else "left_anti")
