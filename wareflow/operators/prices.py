"""Prices, stock, identifiers and other per-value rules, as column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_id(c: Column) -> Column:
    """ASCII letters and digits only."""
    return F.regexp_replace(c, "[^a-zA-Z0-9]", "")


def format_price(c: Column) -> Column:
    """EUR swaps its separators, commas go, the first run of digits and points; otherwise 0."""
    euro = F.regexp_replace(F.regexp_replace(c, "[.]", ""), ",", ".")
    plain = F.regexp_replace(F.when(c.contains("EUR"), euro).otherwise(c), ",", "")
    return F.coalesce(F.regexp_extract(plain, "([0-9.]+)", 1).try_cast("double"), F.lit(0.0))


#: How a reason begins when a product can be had.
AVAILABLE = ("in stock", "only", "usually ships", "available")


def availability(reason: Column, phrases=AVAILABLE) -> Column:
    """The reason begins, in any case, with one of the phrases."""
    return F.lower(reason).rlike("^(" + "|".join(phrases) + ")")


def stock(reason: Column, available: Column) -> Column:
    """The number before "in stock", where 0 and none mean 5; else 5 if available, else 0."""
    rule = r"([0-9]*)[^0-9]*[iI]n\s[sS]tock"
    n = F.nullif(F.coalesce(F.regexp_extract(reason, rule, 1).try_cast("int"), F.lit(0)), F.lit(0))
    return F.when(reason.rlike(rule), F.coalesce(n, F.lit(5))).otherwise(F.when(available, 5).otherwise(0)).cast("int")


def shipping_class(c: Column, free=("free", "gratis")) -> Column:
    """A free word means 0, a text with + stays, anything else is null."""
    return F.when(F.lower(c).rlike("|".join(free)), "0").when(c.contains("+"), c)


def take_first(values: Column) -> Column:
    """The first non-empty value, else the last one, null if there are none; strings are trimmed."""
    t = F.transform(values, lambda x: F.trim(x))
    return F.coalesce(F.try_element_at(F.filter(t, lambda x: x != ""), F.lit(1)), F.try_element_at(t, F.lit(-1)))


def choose_id(preferred: Column, others: list[Column]) -> Column:
    """The preferred identifier, else the last non-empty of the others, else empty."""
    full = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(full(preferred), *[full(c) for c in reversed(others)], F.lit(""))


def currency(url: Column, site: Column | None = None, constant: dict[str, str] | None = None) -> Column:
    """A site's constant currency, else by the URL: .com USD, .de EUR, else JPY."""
    by_url = F.when(url.contains(".com"), "USD").when(url.contains(".de"), "EUR").otherwise("JPY")
    for s, c in (constant or {}).items():
        by_url = F.when(site == s, c).otherwise(by_url)
    return by_url


def cap_size(width: Column, height: Column, most: int = 2000) -> tuple[Column, Column]:
    """The longest side is `most` at most; the other shrinks in proportion, rounded down."""
    long_ = F.greatest(width, height)
    fit = lambda x: F.when(long_ > most, F.floor(x * most / long_)).otherwise(x).cast("long")
    return fit(width), fit(height)


def base_price(price: Column, from_price: Column, offers: Column) -> Column:
    """`price` if the key is there, else from_price; a 0 or missing result goes to the first offer, then 0."""
    return F.coalesce(F.nullif(F.coalesce(price, from_price), F.lit(0.0)), F.try_element_at(offers, F.lit(1)), F.lit(0.0))


def condition(text: Column) -> tuple[Column, Column]:
    """(special, text) for a non-empty text, else (new, '')."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t != "", "special").otherwise("new"), t


def selected_option(options: Column) -> Column:
    """Of an array of structs with `selected`, the first selected entry, else the last."""
    return F.coalesce(F.try_element_at(F.filter(options, lambda x: x["selected"]), F.lit(1)), F.try_element_at(options, F.lit(-1)))


def offer_list(prices: Column, shipping: Column, merchants: Column) -> Column:
    """Parallel arrays aligned to the longest with ''; offers with a blank price go."""
    n = F.greatest(F.size(prices), F.size(shipping), F.size(merchants))
    at = lambda a, i: F.coalesce(F.try_element_at(a, i), F.lit(""))
    z = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(at(prices, i).alias("price"), at(shipping, i).alias("shipping"), at(merchants, i).alias("merchant"))))
    return F.filter(z, lambda x: F.trim(x["price"]) != "")


def priced(items: DataFrame) -> DataFrame:
    """Items with all price, stock and identifier columns, in one projection."""
    ok = availability(F.col("reason_text"))
    return items.select(
        "product_id", "site", format_price(F.col("price_text")).alias("price"), format_price(F.col("list_price_text")).alias("list_price"), ok.alias("available"), stock(F.col("reason_text"), ok).alias("stock"), shipping_class(F.col("shipping_text")).alias("shipping")
    )
