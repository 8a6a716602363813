"""Plans that chain operators from end to end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators.frontier import derived_priority, dispatch_plan, due_items, first_seen, latest_messages, redelay, refresh_batches
from ..operators.ledger import admission
from ..operators.pages import base_fields, extract_links
from ..operators.variants import SiteMapping
from ..sinks import route_topics


def discover(pages: DataFrame, per_minute: int = 60, minutes: int = 1) -> DataFrame:
    """Pages to a dispatch plan: base fields, links, first occurrence of each link, best requests by domain."""
    links = extract_links(pages).join(base_fields(pages).select("page_id", "domain"), "page_id")
    fresh = first_seen(links.select("domain", "link", "page_id", "pos"), ["link"], ["page_id", "pos"])
    requests = fresh.select(F.col("domain").alias("spiderid"), "link", derived_priority(F.lit("item"), F.lit(100) - F.col("pos")).alias("priority"), (F.col("page_id") * 1000 + F.col("pos")).alias("seq"))
    return dispatch_plan(requests, F.lit(per_minute), minutes)


def build_packages(products: DataFrame, skus: DataFrame, images: DataFrame, site: SiteMapping, version: str, topics: dict[str, str], default: str, at: int) -> tuple[DataFrame, DataFrame]:
    """Flat rows of products to one package a product, with the topic that it goes to, and the products that have no key.

    products: product_id, meta_id, site, crawlid, spiderid, command; skus: product_id, pos, sku_id, price, list_price, available, stock; images: product_id, color, url and what the site's
    image rules read. product_ids are taken as strings. Keys, prices that fall back, main images, ids, albums and references that are there once; the parts meet by the product's key alone.
    """
    products, skus, images = (x.withColumn("product_id", F.col("product_id").cast("string")) for x in (products, skus, images))
    keyed, without = C.spu_key(products)
    keys = keyed.select("product_id", "spu")
    sku = C.volatile(skus).join(keys, "product_id").withColumn("sku_id", C.sku_id(F.col("spu"), F.col("sku_id")))
    image = C.ensure_main(C.image_rows(images, site)).join(keys, "product_id")
    image = image.withColumn("image_id", C.image_id(F.col("spu"), F.col("color"), F.col("kind"), F.col("url")))
    album = C.albums(image)
    ref = lambda kind, item, pos: (F.lit(kind).alias("item_type"), F.col(item).alias("item_id"), pos.alias("pos"))
    refs = sku.select("spu", *ref("Sku", "sku_id", F.col("pos").cast("long"))).unionByName(album.select("spu", *ref("Album", "album_id", F.xxhash64("album_id")))).unionByName(image.filter("is_main").select("spu", *ref("Image::Product", "image_id", F.col("pos").cast("long"))))
    refs = C.unique_references(refs, ("spu", "item_type", "item_id")).groupBy("spu").agg(F.array_sort(F.collect_list(F.struct("item_type", "item_id"))).alias("references"))
    albums = album.groupBy("spu").agg(F.array_sort(F.collect_list(F.struct("album_id", "references"))).alias("albums"))
    packed = C.packages(keyed.select("spu", "crawlid", "spiderid"), sku.select("spu", "pos", "sku_id", "price", "stock"), version, "").drop("command", "references")
    whole = packed.join(keyed.select("spu", "command"), "spu").join(refs, "spu", "left").join(albums, "spu", "left").withColumn("timestamp", F.lit(at).cast("double"))
    return route_topics(whole, topics, default).drop("timestamp"), without


def refresh(messages: DataFrame, delays: DataFrame, requests: DataFrame, results: DataFrame, now: int, default: int, closed: dict[str, int], size: int, most: int, cycle: int, schedule: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """The refresh loop's round: the latest message of each item, those due, in chunks by site; a site with more than `most` waiting requests is passed over.

    messages: item_id, site, sec, seq, event, due_date; delays: site, update_interval; requests: spiderid, the site; results: item_id, ok. Returns item_id, site, chunk,
    sent and when the item is due next: what was sent and succeeded in the next cycle, what failed or had no answer at once, what wasn't sent when it was before.
    """
    batches = refresh_batches(due_items(latest_messages(messages, ["sec", "seq"]), delays, now, default), now, closed, size, schedule)
    full = admission(requests, most).filter("not admitted").select(F.col("spiderid").alias("site"))
    sent = batches.join(full, "site", "left_anti")
    again = redelay(sent.select("item_id"), results, now, cycle).select("item_id", F.col("due").alias("__next"))
    return batches.join(again, "item_id", "left").select("item_id", "site", "chunk", F.col("__next").isNotNull().alias("sent"), F.coalesce("__next", "due").alias("due"))
