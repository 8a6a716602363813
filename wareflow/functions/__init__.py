"""Column functions that queries may use by themselves."""

from ..operators.pages import clean_html, fingerprint, next_page_arg, next_page_offset, next_page_path, resolve, storage_path
from ..operators.prices import availability, cap_size, choose_id, clean_id, currency, format_price, shipping_class, stock, take_first

__all__ = ["availability", "cap_size", "choose_id", "clean_html", "clean_id", "currency", "fingerprint", "format_price", "next_page_arg", "next_page_offset", "next_page_path", "resolve", "shipping_class", "stock", "storage_path", "take_first"]
