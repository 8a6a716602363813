"""Variants of a product as rows: one operator for each shape of the site's record.

Products keep their variants in nested arrays and maps, so flattening needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SiteMapping:
    """How a site's record becomes catalog rows. Each rule is SQL text over the exploded row.

    is_main, image_type and position are the image rules (E3); process is what a site does with its SKU rows at the end.
    """

    site: str
    currency: str = "USD"
    sku_id: str = "sku_id"
    price: str = "price"
    list_price: str = "list_price"
    stock: str = "stock"
    available: str = "true"
    color: str = "''"
    size: str = "''"
    is_main: str = "url like '%MAIN%'"
    image_type: str = "regexp_extract(url, '_([A-Za-z0-9]+)', 1)"
    position: str = "pos"
    extra: dict[str, str] = field(default_factory=dict)
    process: Callable[[DataFrame], DataFrame] | None = None

    def columns(self) -> list[Column]:
        named = {"sku_id": self.sku_id, "color": self.color, "size": self.size, "price": self.price, "list_price": self.list_price, "stock": self.stock, "available": self.available} | self.extra
        return [*[F.expr(v).alias(k) for k, v in named.items()], F.lit(self.currency).alias("currency")]

    def image_rules(self) -> dict[str, Column]:
        """E3's columns: is_main, kind (MAIN where the rule finds none) and pos."""
        kind = F.coalesce(F.nullif(F.expr(self.image_type), F.lit("")), F.lit("MAIN"))
        return {"is_main": F.expr(self.is_main), "kind": kind, "pos": F.expr(self.position)}

    def finish(self, skus: DataFrame) -> DataFrame:
        return skus if self.process is None else self.process(skus)


def merge_attributes(products: DataFrame) -> DataFrame:
    """Colour and size options by variant id; where a product has sizes, what lacks either is dropped. No shuffle: a product is one row, whose id is not null.

    An option without a variant id meets none.
    """
    has = F.coalesce(F.size("sizes"), F.lit(0)) > 0
    colors = products.filter("product_id is not null").select("product_id", "sizes", has.alias("has"), F.explode("colors").alias("c"))
    met = F.filter("sizes", lambda x: x["variant"] == F.col("c.variant"))
    both = colors.select("product_id", "has", "c", F.explode_outer(met).alias("s"))  # a size without a colour would be dropped
    return both.filter("not has or (c.name is not null and s.name is not null)").select("product_id", "c.variant", F.col("c.name").alias("color"), F.col("s.name").alias("size"))


def complement_sizes(products: DataFrame) -> DataFrame:
    """Each colour with all listed sizes; those not stocked have price 0 and no stock. No shuffle.

    A stocked size that isn't listed stays, with a null size.
    """
    grid = products.select("product_id", "stocked", F.explode("colors").alias("color"), "sizes").select("product_id", "color", "stocked", F.explode("sizes").alias("size"))
    hit = F.filter("stocked", lambda x: (x["color"] == F.col("color")) & (x["size"] == F.col("size")))
    first = F.try_element_at(hit, F.lit(1))
    listed = grid.select("product_id", "color", "size", F.coalesce(first["price"], F.lit(0.0)).alias("price"), F.coalesce(first["stock"], F.lit(0)).alias("stock"))
    rest = products.select("product_id", "sizes", F.explode("stocked").alias("x")).filter("not array_contains(sizes, x.size)")
    return listed.unionByName(rest.select("product_id", "x.color", F.lit(None).cast("string").alias("size"), "x.price", "x.stock"))


def cartesian(products: DataFrame, axes: list[str], default: str = "default") -> DataFrame:
    """All combinations of the axes within each product; blank values go, an empty axis is `default`."""
    out = products
    for a in axes:
        full = F.filter(a, lambda x: F.trim(x) != "")
        values = F.when(F.coalesce(F.size(full), F.lit(0)) > 0, full).otherwise(F.array(F.lit(default)))
        out = out.select("product_id", *[c for c in out.columns if c not in ("product_id", a)], F.explode(values).alias(a))
    return out


def align(rows: DataFrame, key: str, *arrays: str) -> DataFrame:
    """Parallel arrays by position, cut to the shortest."""
    n = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    at = rows.filter(n > 0).select(key, *arrays, F.explode(F.sequence(F.lit(1), n)).alias("pos"))
    return at.select(key, F.col("pos").cast("int").alias("pos"), *[F.element_at(a, F.col("pos")).alias(a) for a in arrays])


def half_split(values: Column) -> Column:
    """The first half of an array as keys of its second half; of equal keys the last wins."""
    n = F.floor(F.size(values) / 2).cast("int")
    pairs = F.arrays_zip(F.slice(values, F.lit(1), n), F.slice(values, n + 1, n))
    keys = F.slice(values, F.lit(1), n)
    last = F.filter(F.transform(pairs, lambda x, i: F.struct(i.alias("i"), x["0"].alias("k"), x["1"].alias("v"))), lambda x: ~F.exists(F.slice(keys, x["i"] + 2, n), lambda k: k == x["k"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))


def single_sku(products: DataFrame, m: SiteMapping) -> DataFrame:
    """The product is its only SKU; its id is the part after `#`."""
    return m.finish(products.select("product_id", *m.columns()))


def sku_list(products: DataFrame, m: SiteMapping) -> DataFrame:
    """One row an entry of `skus`; a product with an empty list is its own entry if `self` is given."""
    rows = F.col("skus")
    if "self" in products.columns:
        rows = F.when(F.coalesce(F.size("skus"), F.lit(0)) > 0, F.col("skus")).otherwise(F.array("self"))
    return m.finish(products.select("product_id", F.posexplode(rows).alias("sku_pos", "sku")).select("product_id", "sku_pos", "sku.*").select("product_id", "sku_pos", *m.columns()))


def tenth_sizes(size: Column) -> Column:
    """A size of digits only is ten times too large at one site."""
    return F.when(size.rlike("^[0-9]+$"), (size.cast("double") / 10).cast("string")).otherwise(size)


def color_sizes(products: DataFrame, m: SiteMapping, outer: bool = True, skip_first: bool = False) -> DataFrame:
    """D3: colours, each with sizes; a colour without sizes is one SKU if outer. One site's first option is skipped."""
    c = products.select("product_id", F.explode("colors").alias("c")).select("product_id", F.col("c.color_id").alias("color_id"), F.col("c.sizes").alias("sizes"))
    sizes = F.expr("slice(sizes, 2, size(sizes))") if skip_first else F.col("sizes")
    s = c.select("product_id", "color_id", (F.explode_outer if outer else F.explode)(sizes).alias("s"))
    return m.finish(s.select("product_id", "color_id", "s.*").select("product_id", "color_id", *m.columns()))


def color_size_width(products: DataFrame, m: SiteMapping) -> DataFrame:
    """Maps of colour to size to width."""
    x = products.select("product_id", F.explode("variants").alias("color", "by_size"))
    x = x.select("product_id", "color", F.explode("by_size").alias("size", "by_width"))
    x = x.select("product_id", "color", "size", F.explode("by_width").alias("width", "sku"))
    return m.finish(x.select("product_id", "width", *[c for c in x.select("color", "size").columns], "sku.*").select("product_id", "width", *m.columns()))


def sizes_only(products: DataFrame, m: SiteMapping, separator: str = "_") -> DataFrame:
    """A list of size labels `<size>_<id>`; a price and a reason may stand in the label: `[$12 - reason]`."""
    x = products.select("product_id", F.posexplode("labels").alias("pos", "label"))
    parts = F.reverse(F.split(F.regexp_replace("label", r" *\[.*\]$", ""), separator))
    x = x.select("product_id", "pos", parts[0].alias("sku_id"), F.array_join(F.reverse(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))), separator).alias("size_text"), F.regexp_extract("label", r"\[\$?([0-9.]+)", 1).alias("price_text"), F.regexp_extract("label", r"- ([^\]]*)\]", 1).alias("reason"))
    return m.finish(x.select("product_id", "pos", "reason", *m.columns()))


def sku_map(products: DataFrame, m: SiteMapping) -> DataFrame:
    """A map by SKU id; colour and size ids from the key (split at -), names from `name` (split at `, `)."""
    x = products.select("product_id", F.explode("sku_map").alias("sku_key", "sku"))
    key, name = F.split("sku_key", "-"), F.split("sku.name", ", ")
    x = x.select("product_id", "sku_key", F.get(key, F.lit(0)).alias("c_id"), F.coalesce(F.get(key, F.lit(1)), F.lit("")).alias("s_id"), F.get(name, F.lit(0)).alias("c_name"), F.coalesce(F.get(name, F.lit(1)), F.lit("")).alias("s_name"), "sku.*")
    return m.finish(x.select("product_id", "c_id", "s_id", *m.columns()))


def spec_pairs(rows: DataFrame, key: str, fields: str) -> DataFrame:
    """The remaining map fields as pairs: falsy ones go, true becomes Yes, `_` in names becomes nothing."""
    full = F.map_filter(fields, lambda k, v: v.isNotNull() & ~v.isin("", "false", "0"))
    x = rows.select(key, F.explode(full).alias("name", "value"))
    return x.select(key, F.replace("name", F.lit("_"), F.lit("")).alias("name"), F.when(F.col("value") == "true", "Yes").otherwise(F.col("value")).alias("value"))
