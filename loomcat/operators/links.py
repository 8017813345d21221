"""Sitemap, robots and listing links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# The path of a marketplace product.
PRODUCT_PATH = r"(?i)/[a-z0-9][a-z0-9%-]+-\d{6,}\.html$"


#: Parts that a store's links are dealt to before a cap.
PARTS = 64


def sitemap_urls(pages: DataFrame, stores: DataFrame, sitemap_cap: int | None = None, product_cap: int | None = None) -> DataFrame:
    """C17: (source, kind, loc, position, at) of sitemap bodies (source, position, html): position is that of the page and
    at the place in it. Nested sitemaps are unique, products match the store's pattern. A cap (a store's crawl budget)
    leaves only the first so many of its kind for each store."""
    locs = pages.select("source", "position", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("at", "loc"))
    named = locs.join(F.broadcast(stores.select("source", "product_pattern")), "source")
    nested = F.lower("loc").endswith(".xml") | F.lower("loc").contains("sitemap")
    kind = F.when(nested, "sitemap").when(F.expr("loc RLIKE product_pattern"), "product")
    some = named.withColumn("kind", kind).select("source", "kind", "loc", F.struct("position", "at").alias("place"))
    sitemaps = some.where("kind = 'sitemap'").groupBy("source", "kind", "loc").agg(F.min("place").alias("place"))
    products = some.where("kind = 'product'")
    out = first_of_store(sitemaps, sitemap_cap).unionByName(first_of_store(products, product_cap))
    return out.select("source", "kind", "loc", "place.position", "place.at")


def first_of_store(links: DataFrame, cap: int | None) -> DataFrame:
    """The first cap links of each store, in two steps: first of each of a store's PARTS parts, then of what these leave. So no task
    gets more than a part of a store, or PARTS x cap links of it."""
    if cap is None:
        return links
    out = links.withColumn("part", F.pmod(F.xxhash64("loc", "place"), F.lit(PARTS)))
    for by in (("source", "part"), ("source",)):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("place", "loc"))).where(F.col("rank") <= cap).drop("rank")
    return out.drop("part")


def robots_sitemaps(pages: DataFrame) -> DataFrame:
    """(source, at, url) of the sitemap lines of robots files (source, html)."""
    lines = pages.select("source", F.posexplode(F.split("html", r"\R")).alias("at", "line"))
    return lines.select("source", "at", F.regexp_extract("line", r"(?i)^\s*sitemap:\s*(.*?)\s*$", 1).alias("url")).where("url <> ''")


def href(tag: Column) -> Column:
    return F.regexp_extract(tag, r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1)


def absolute(base: Column, link: Column) -> Column:
    """link joined to the scheme and host of base, or to its folder if it is relative."""
    root, scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*(?:/.*)?)/", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link).when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("/"), F.concat(root, link))
        .when(folder.rlike("://."), F.concat(folder, F.lit("/"), link)).otherwise(F.concat(root, F.lit("/"), link))
    )


def listing_links(pages: DataFrame, product_path: str = PRODUCT_PATH) -> DataFrame:
    """(source, url, at, link) of the distinct product links of listing pages: anchors of class core,
    else those inside articles."""
    core = F.transform(F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*\bclass\s*=\s*["'][^"']*core[^"']*["'][^>]*>"""), F.lit(0)), href)
    articles = F.array_join(F.regexp_extract_all("html", F.lit(r"(?is)<article\b.*?</article>"), F.lit(0)), "")
    inner = F.transform(F.regexp_extract_all(articles, F.lit(r"(?is)<a\b[^>]*>"), F.lit(0)), href)
    some = pages.select("source", "url", F.when(F.size(core) > 0, core).otherwise(inner).alias("links"))
    out = some.select("source", "url", F.posexplode(F.array_distinct(F.filter("links", lambda x: x != ""))).alias("at", "link"))
    out = out.select("source", "url", "at", absolute(F.col("url"), F.trim("link")).alias("link"))
    return out.where(F.regexp_replace("link", r"(?s)[?#].*$", "").rlike(product_path))
