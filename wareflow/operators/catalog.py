"""The catalog graph: products, variants, images, albums, texts, dimensions and their references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .variants import SiteMapping


def capitalize(c: Column) -> Column:
    """First letter upper, all others lower (initcap would raise every word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def md5_6(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 6)


def spu_key(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The given id, else site#product_id; rows with neither come back apart."""
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    key = F.coalesce(full("meta_id"), F.concat("site", F.lit("#"), full("product_id")))
    keyed = items.withColumn("spu", key)
    return keyed.filter("spu is not null"), keyed.filter("spu is null")


def image_id(spu: Column, color: Column, kind: Column, url: Column) -> Column:
    """Spu::Colour::type, or a short hash of the URL where there is no type."""
    return F.concat_ws("::", spu, capitalize(color), F.coalesce(F.nullif(kind, F.lit("")), md5_6(url)))


def album_id(spu: Column, color: Column) -> Column:
    return F.concat_ws("::", spu, capitalize(color))


def text_id(spu: Column, text: Column) -> Column:
    return F.concat_ws("::", spu, md5_6(text))


def sku_id(spu: Column, sku: Column) -> Column:
    return F.concat_ws("#", spu, sku)


def item_type(kind: str, name: Column) -> Column:
    return F.concat(F.lit(f"{capitalize_text(kind)}::"), capitalize(name))


def capitalize_text(text: str) -> str:
    return text[:1].upper() + text[1:].lower()


def image_rows(images: DataFrame, site: SiteMapping) -> DataFrame:
    """One row an image, with its type, main flag and position by the site's rules."""
    return images.withColumns(site.image_rules())


def ensure_main(images: DataFrame) -> DataFrame:
    """Where no image of a colour is main, the first becomes main."""
    w = Window.partitionBy("product_id", "color")
    first = F.row_number().over(w.orderBy("pos")) == 1
    return images.withColumn("is_main", F.col("is_main") | (first & ~F.max("is_main").over(w)))


def albums(images: DataFrame) -> DataFrame:
    """E5: the references of a colour's images in order."""
    ref = F.struct("pos", F.col("image_id").alias("item_id"), F.lit("Image::Product").alias("item_type"))
    g = images.groupBy("spu", "color").agg(F.array_sort(F.collect_list(ref)).alias("r"))
    return g.select("spu", "color", album_id(F.col("spu"), F.col("color")).alias("album_id"), F.transform("r", lambda x: F.struct(x["item_id"].alias("item_id"), x["item_type"].alias("item_type"))).alias("references"))


def dimensions(skus: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row for each field of a SKU, unless key and value are both empty; fields maps column to name."""
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), F.coalesce(F.col(c), F.lit("")).alias("value")) for c, name in fields.items()])
    return skus.select("sku_id", F.explode(pairs).alias("d")).select("sku_id", "d.name", "d.value").filter("name <> '' or value <> ''")


def volatile(skus: DataFrame) -> DataFrame:
    """Price falls back to the list price when 0; to be had means a price, the flag and stock."""
    price = F.coalesce(F.nullif(F.col("price"), F.lit(0.0)), F.col("list_price"))
    return skus.withColumn("price", price).withColumn("availability", (F.col("price") > 0) & F.col("available") & (F.col("stock") > 0))


def unique_references(refs: DataFrame, keys=("item_id", "item_type")) -> DataFrame:
    """The first row of each key; rows with a null or empty key are rejected."""
    good = refs
    for k in keys:
        good = good.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    w = Window.partitionBy(*keys).orderBy("pos")
    return good.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def status_class(status: Column) -> Column:
    """Below 300 is NORMAL, all else ERROR."""
    return F.when(status < 300, "NORMAL").otherwise("ERROR")


def packages(spus: DataFrame, skus: DataFrame, version: str, command: str) -> DataFrame:
    """One message a product: its items in order, their references and the trace."""
    item = F.struct("pos", F.col("sku_id").alias("item_id"), F.lit("Sku").alias("item_type"), "price", "stock")
    g = skus.groupBy("spu").agg(F.array_sort(F.collect_list(item)).alias("items"))
    refs = F.transform("items", lambda x: F.struct(x["item_id"].alias("item_id"), x["item_type"].alias("item_type")))
    return spus.join(g, "spu", "left").select("spu", F.lit(version).alias("version"), F.lit(command).alias("command"), F.struct("crawlid", "spiderid").alias("trace"), "items", refs.alias("references"))


def roll_up(records: DataFrame, depth: int = 3) -> DataFrame:
    """Records with a `path` (/a#1/b#2) and a `value`: children are listed under their parent, last level first.

    The children of one parent become one JSON list, ordered by path; at most `depth` levels. A top record is one text: for parents with very
    many children see roll_up_chunks().
    """
    r = records.withColumn("level", F.size(F.split("path", "/")) - 1).withColumn("parent", F.regexp_replace("path", "/[^/]*$", ""))
    below = None
    for level in range(depth, 0, -1):
        here = r.filter(F.col("level") == level)
        if below is not None:
            here = here.join(below, here["path"] == below["up"], "left").drop("up")
        else:
            here = here.withColumn("children", F.lit(None).cast("string"))
        text = F.concat(F.lit('{"path":"'), F.col("path"), F.lit('","value":"'), F.col("value"), F.lit('","children":['), F.coalesce("children", F.lit("")), F.lit("]}"))
        here = here.withColumn("json", text)
        below = here.groupBy(F.col("parent").alias("up")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "json"))), lambda x: x["json"]), ",").alias("children"))
    return here.select("path", "json")


def _child_chunks(children: DataFrame, size: int, entry: list[str]) -> DataFrame:
    """Rows (parent, path, chunk, weight, …) gathered by parent in numbered chunks of about `size` nodes: up, chunk, chunks, children (entries by path), weight.

    A parent's chunks are as many as its nodes need, and its children are dealt to them by a hash, so that no task and no row has all children of a
    hot parent. Only parents with more than one chunk are joined.
    """
    wide = children.groupBy("parent").agg(F.ceil(F.sum("weight") / size).cast("long").alias("__chunks")).filter("__chunks > 1").withColumnRenamed("parent", "__up")
    x = children.join(wide, F.col("parent") == F.col("__up"), "left").withColumn("__chunks", F.coalesce("__chunks", F.lit(1)))
    name = F.concat("path", F.lit("#"), F.col("chunk").cast("string")) if "chunk" in children.columns else F.col("path")
    at = F.pmod(F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long"), F.col("__chunks"))
    x = x.withColumn("__at", at)
    return x.groupBy(F.col("parent").alias("up"), F.col("__at").alias("chunk")).agg(F.max("__chunks").alias("chunks"), F.array_sort(F.collect_list(F.struct(*entry))).alias("children"), F.sum("weight").alias("below"))


def roll_up_chunks(records: DataFrame, depth: int = 3, size: int = 10_000) -> DataFrame:
    """E11 as nested arrays: path, value, chunk, chunks, children of each top record, its children in numbered chunks of about `size` nodes.

    A child is a struct of path, value and, above the last level, chunk, chunks and children of its own: a record whose children take several chunks stands once for each of
    them, in whichever chunks of its parent. No text is built, and a record with very many children is many rows. Records without their parent's record are dropped, as in roll_up().
    """
    r = records.select("path", "value").withColumn("level", F.size(F.split("path", "/")) - 1).withColumn("parent", F.regexp_replace("path", "/[^/]*$", ""))
    here, entry = r.filter(F.col("level") == depth).select("parent", "path", "value", F.lit(1).cast("long").alias("weight")), ["path", "value"]
    for level in range(depth - 1, 0, -1):
        below = _child_chunks(here, size, entry)
        none = lambda c, kind=None: F.coalesce(F.col(c), F.lit(0 if c == "chunk" else 1)).cast("long").alias(c)
        here = r.filter(F.col("level") == level).join(below, F.col("path") == F.col("up"), "left").select("parent", "path", "value", none("chunk"), none("chunks"), F.coalesce("children", F.array().cast(below.schema["children"].dataType)).alias("children"), (F.coalesce("below", F.lit(0)) + 1).alias("weight"))
        entry = ["path", "value", "chunk", "chunks", "children"]
    return here.select(*entry)


def group_in_order(rows: DataFrame, outer: str, key: str, value: str, order: str) -> DataFrame:
    """Equal keys merge even if not adjacent; groups stand in the order of their first member."""
    g = rows.groupBy(outer, key).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("v"))
    g = g.select(outer, key, F.col("v")[0][order].alias("first"), F.transform("v", lambda x: x[value]).alias("values"))
    return g.withColumn("group_pos", F.row_number().over(Window.partitionBy(outer).orderBy("first")))


def image_plan(images: DataFrame, n: int = 6) -> DataFrame:
    """Each main image is padded to n entries with derived ids, types and paths (rows only)."""
    missing = images.filter("is_main").withColumn("i", F.explode(F.expr(f"if(image_count < {n}, sequence(1, {n} - image_count), cast(array() as array<int>))")))
    return missing.select("image_id", F.concat("image_id", F.lit("_"), "i").alias("derived_id"), F.concat("kind", F.lit("_"), "i").alias("kind"), F.concat(F.lit("/plan/"), F.sha1(F.encode(F.concat("url", F.lit("#"), F.col("i").cast("string")), "UTF-8")), F.lit(".jpg")).alias("path"))


def choose_main(images: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of a colour's images the one whose kind ranks best; the first found is the fallback.

    The images are dealt out before the ranking: Spark ranks where the rows are, then once more by colour, and a task would else sort all that it reads. A hot colour is dealt out as well.
    """
    c = images.repartition("product_id", "color", "pos").join(candidates, "kind", "left")
    w = Window.partitionBy("product_id", "color").orderBy(F.col("rank").asc_nulls_last(), "pos")
    return c.withColumn("n", F.row_number().over(w)).filter("n = 1").select("product_id", "color", "url", "rank")


def keyed_last(rows: DataFrame, outer: str, key: str, value: str, order: str) -> DataFrame:
    """A map by key from a list of records; of equal keys the last wins."""
    last = rows.groupBy(outer, key).agg(F.max_by(value, order).alias(value))
    return last.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("by_key"))


def merge_maps(maps: Column) -> Column:
    """The maps of an array as one; later entries win."""
    return F.aggregate(maps, F.expr("cast(map() as map<string,string>)"), lambda a, m: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(m, k)), m))


def concat_lists(lists: Column) -> Column:
    return F.flatten(lists)


def bullets(products: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Product columns as text rows with an id by content; empty ones go. `features` may hold <span> items."""
    pairs = F.array(*[F.struct(F.lit(name).alias("kind"), F.coalesce(F.expr(sql), F.lit("")).alias("text")) for name, sql in fields.items()])
    x = products.select("spu", F.explode(pairs).alias("b")).select("spu", "b.kind", "b.text").filter("text <> ''")
    return x.select(text_id(F.col("spu"), F.col("text")).alias("bullet_id"), "spu", "kind", "text")


def span_items(html: Column) -> Column:
    """The texts of <span> items as a JSON list, whose text is what is hashed."""
    return F.to_json(F.regexp_extract_all(html, F.lit("<span>([^<]*)</span>"), F.lit(1)))
