"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import canonical_url
from .text import strip


def _some(value: Column) -> Column:
    """The trimmed text, null if there is none."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def product_id(merchant: Column, platform_id: Column | None = None, handle: Column | None = None, url: Column | None = None) -> Column:
    """sha256 of the merchant and the first usable of platform id, handle and canonical URL; null
    (a mapping error) where there is none or no merchant."""
    none = F.lit(None).cast("string")
    pid, name, at = (_some(c) if c is not None else none for c in (platform_id, handle, url))
    tail = F.coalesce(F.concat(F.lit(":pid:"), pid), F.concat(F.lit(":handle:"), F.lower(name)), F.concat(F.lit(":url:"), F.nullif(canonical_url(at), F.lit(""))))
    return F.sha2(F.concat(F.lower(_some(merchant)), tail), 256)


def variant_id(product: Column, index: Column, barcode: Column | None = None, gtin: Column | None = None, sku: Column | None = None, platform_id: Column | None = None, size: Column | None = None, color: Column | None = None) -> Column:
    """sha256 of the product id and the first usable code, else of size and colour, else of the index."""
    options = [F.concat(F.lit(f":{label}:"), _some(c)) for label, c in (("barcode", barcode), ("gtin", gtin), ("sku", sku), ("pvid", platform_id)) if c is not None]
    part = lambda c: strip(F.coalesce(c.cast("string"), F.lit(""))) if c is not None else F.lit("")
    pair = F.regexp_replace(F.concat(part(size), F.lit("|"), part(color)), r"^\|+|\|+$", "")
    options.append(F.concat(F.lit(":sc:"), F.lower(F.nullif(pair, F.lit("")))))
    options.append(F.concat(F.lit(":idx:"), F.coalesce(index.cast("string"), F.lit("0"))))
    return F.sha2(F.concat(product, F.coalesce(*options)), 256)


def offer_key(url: Column, color: Column) -> Column:
    """The display form of an offer's key; joins use the two columns."""
    return F.concat(url, F.lit("||"), F.coalesce(color, F.lit("")))


def parse_offer_key(key: Column) -> Column:
    """The (product_url, color) of a display key, cut at the first ``||``; an empty colour is null."""
    at = F.locate("||", key)
    url = F.when(at > 0, F.substr(key, F.lit(1), at - 1)).otherwise(key)
    return F.struct(url.alias("product_url"), F.when(at > 0, F.nullif(F.substr(key, at + 2), F.lit(""))).alias("color"))
