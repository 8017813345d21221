"""Storefront products and catalog hits to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.functions import ids, rules
from loomcat.functions import normalize as N
from loomcat.functions.text import bound, html_text, merged_lists, once, strip
from loomcat.sources import schema

CODE_LENGTHS = (8, 12, 13, 14)


def tag_list(tags: Column) -> Column:
    """Tags from a JSON list or a comma text."""
    listed = F.from_json(tags, "array<string>")
    raw = F.when(tags.startswith("[") & listed.isNotNull(), listed).otherwise(F.split(F.coalesce(tags, F.lit("")), ","))
    return F.filter(F.transform(raw, strip), lambda t: t != "")


def option(variant: Column, names: Column, wanted: tuple[str, ...]) -> Column:
    """The value of the last option so named that has one."""
    out = F.lit(None).cast("string")
    for i in (1, 2, 3):
        value = F.nullif(variant[f"option{i}"], F.lit(""))
        out = F.coalesce(F.when(F.get(names, i - 1).isin(*wanted), strip(value)), out)
    return out


def variants_of(product: Column, names: Column, pid: Column) -> Column:
    """The variants, with sizes and colours from the named options."""

    def read(v: Column) -> Column:
        """What is used more than once of a variant."""
        return F.struct(
            v.alias("v"), option(v, names, rules.SIZE_OPTIONS).alias("size"), option(v, names, rules.COLOR_OPTIONS).alias("color"), N.to_decimal(v["price"]).alias("price"),
            N.to_decimal(v["compare_at_price"]).alias("was"), F.nullif(v["barcode"], F.lit("")).alias("barcode"), F.nullif(v["sku"], F.lit("")).alias("sku"),
        )

    def one(r: Column, i: Column) -> Column:
        v, size, color, price, was, barcode, sku = (r[c] for c in ("v", "size", "color", "price", "was", "barcode", "sku"))
        return schema.variant(
            variant_id=ids.variant_id(pid, i, barcode=barcode, sku=sku, platform_id=v["id"], size=size, color=color), platform_variant_id=v["id"], sku=sku, barcode=barcode, size=size,
            color=color, price=price, original_price=F.when(price.isNull() | (was > price), was), available=v["available"], inventory_quantity=v["inventory_quantity"],
        )

    return F.transform(F.transform(F.coalesce(product["variants"], F.array()), read), one)


def color_images(product: Column, names: Column) -> Column:
    """C14: images by canonical colour: those linked to a variant of the colour, the featured one first,
    then the unlinked ones. Empty without a colour option."""
    at = F.array_min(F.array_compact(F.array(*(F.when(F.get(names, i).isin(*rules.COLOR_OPTIONS), F.lit(i)) for i in range(3)))))
    value = lambda v: strip(F.nullif(F.when(at == 0, v["option1"]).when(at == 1, v["option2"]).when(at == 2, v["option3"]), F.lit("")))
    linked = F.filter(F.transform(F.coalesce(product["variants"], F.array()), lambda v: F.struct(v["id"].alias("id"), value(v).alias("color"), v["featured_image"]["src"].alias("featured"))), lambda v: v["id"].isNotNull() & v["color"].isNotNull())
    shown = F.filter(F.coalesce(product["images"], F.array()), lambda i: F.coalesce(i["src"], F.lit("")) != "")
    ids_of = lambda i: F.coalesce(i["variant_ids"], F.array().cast("array<bigint>"))
    loose = F.transform(F.filter(shown, lambda i: F.size(ids_of(i)) <= 0), lambda i: i["src"])

    def build(vs: Column) -> Column:
        """Each image gets the colours of its variants once; a colour then takes the images that have it."""
        raw = F.array_distinct(F.transform(vs, lambda v: v["color"]))
        colors_of = lambda i: F.array_distinct(F.transform(F.filter(vs, lambda v: F.array_contains(ids_of(i), v["id"])), lambda v: v["color"]))
        linked_images = F.transform(F.filter(shown, lambda i: F.size(ids_of(i)) > 0), lambda i: F.struct(i["src"].alias("src"), colors_of(i).alias("colors")))

        def bucket(images: Column, c: Column) -> Column:
            mine = F.transform(F.filter(images, lambda i: F.array_contains(i["colors"], c)), lambda i: i["src"])
            first = F.get(F.filter(vs, lambda v: (v["color"] == c) & (F.coalesce(v["featured"], F.lit("")) != "")), 0)["featured"]
            led = F.when(F.array_contains(mine, first), F.concat(F.array(first), F.filter(mine, lambda s: s != first))).otherwise(mine)
            return F.concat(F.coalesce(led, mine), loose)

        keyed = bound(linked_images, lambda images: F.transform(raw, lambda c: F.struct(N.color(c).alias("k"), bucket(images, c).alias("v"))))
        return merged_lists(keyed)

    return F.when(at.isNotNull(), bound(linked, build))


def single(variants: Column, field: str) -> Column:
    """The only distinct value of a field, null if there are several or none."""
    return bound(F.array_distinct(F.filter(F.transform(variants, lambda v: v[field]), lambda x: F.coalesce(x, F.lit("")) != "")), lambda xs: F.when(F.size(xs) == 1, xs[0]))


def rollups(df: DataFrame) -> DataFrame:
    """Price, original_price, availability, sku, barcode and gtin from ``variants``."""
    price = F.array_min(F.array_compact(F.transform("variants", lambda v: v["price"])))
    was = F.array_max(F.array_compact(F.transform("variants", lambda v: v["original_price"])))
    df = df.withColumns({"price": price, "original_price": F.when(price.isNull() | (was > price), was), "sku": single(F.col("variants"), "sku"), "barcode": single(F.col("variants"), "barcode")})
    return df.withColumns({
        "availability": N.availability(F.exists("variants", lambda v: F.coalesce(v["available"], F.lit(False)))),
        "gtin": F.when(F.col("barcode").rlike(r"^[0-9]+$") & F.length("barcode").isin(*CODE_LENGTHS), F.col("barcode")),
    })


def map_products(raw: DataFrame, currency: str = "EGP") -> DataFrame:
    """Rows (source, base_url, product, and scraped_at if there is one) to canonical rows."""
    p = F.col("product")
    base = F.regexp_replace(F.col("base_url"), "/+$", "")
    handle = F.coalesce(p["handle"], F.lit(""))
    kept = ["source", *(["scraped_at"] if "scraped_at" in raw.columns else [])]
    some = raw.select(
        *kept, p.alias("p"), F.when(handle != "", F.concat(base, F.lit("/products/"), handle)).otherwise(F.col("base_url")).alias("product_url"), handle.alias("handle"), strip(F.coalesce(p["title"], F.lit(""))).alias("title"),
        html_text(p["body_html"]).alias("description"), strip(F.coalesce(p["vendor"], F.lit(""))).alias("vendor"), F.coalesce(p["product_type"], F.lit("")).alias("product_type"), tag_list(p["tags"]).alias("tags"),
        F.transform(F.coalesce(p["options"], F.array()), lambda o: F.lower(strip(F.coalesce(o["name"], F.lit(""))))).alias("options"),
    )
    some = once(some.withColumn("product_id", ids.product_id(F.col("source"), F.col("p.id"), F.col("handle"), F.col("product_url"))), "product_id", "options")
    some = rollups(some.withColumn("variants", variants_of(F.col("p"), F.col("options"), F.col("product_id"))))
    tags = F.array_join("tags", " ")
    out = some.withColumns({
        "brand": F.col("vendor"), "brand_normalized": F.lower("vendor"), "category": N.category(F.col("product_type"), tags, F.col("title")), "subcategory": strip(F.col("product_type")),
        "gender": N.gender(F.col("product_type"), tags, F.col("title"), F.col("handle")), "currency": F.lit(currency), "image_urls": N.clean_list(F.transform(F.col("p.images"), lambda i: i["src"])),
        "material": N.materials(tags, F.col("description"), F.col("title")), "colors": N.colors(F.array_distinct(F.transform("variants", lambda v: v["color"]))), "color_images": color_images(F.col("p"), F.col("options")),
        "sizes": N.clean_list(F.transform("variants", lambda v: v["size"])), "source_updated_at": F.try_to_timestamp("p.updated_at"),
        "attributes": schema.attributes(platform=F.lit("shopify"), platform_product_id=F.col("p.id"), handle=F.col("handle"), product_type=F.col("product_type"), tags=F.col("tags"), variant_count=F.size("variants")),
    })
    return schema.with_defaults(out.withColumn("main_image", F.coalesce(F.get("image_urls", 0), F.lit(""))))


def map_hits(raw: DataFrame, url_format: str = "https://catalog.example/%s/%s/p/") -> DataFrame:
    """Rows (source, hit) to canonical rows; hits without sku or name are left out. url_format takes
    the slug and the sku. Zero and missing sale prices count as none."""
    h = F.col("hit")
    some = raw.select("source", h.alias("h"), strip(F.coalesce(F.nullif(h["sku"], F.lit("")), h["catalog_sku"], F.lit(""))).alias("sku"), strip(F.coalesce(h["name"], F.lit(""))).alias("title"), strip(F.coalesce(h["brand"], F.lit(""))).alias("brand"))
    some = some.where((F.col("sku") != "") & (F.col("title") != ""))
    money = lambda c: F.nullif(c.try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    sale, full = money(F.col("h.sale_price")), F.col("h.price").try_cast("decimal(18,2)")
    some = some.withColumn("product_url", F.format_string(url_format, F.coalesce("h.url", F.lit("")), F.col("sku")))
    listed = F.filter(F.coalesce("h.image_urls", F.array()), lambda u: F.coalesce(u, F.lit("")) != "")
    out = some.withColumns({
        "product_id": ids.product_id(F.col("source"), F.col("sku"), None, F.col("product_url")), "vendor": F.col("brand"), "brand_normalized": F.lower("brand"), "category": N.category(F.col("title")),
        "gender": N.gender(F.col("title")), "price": F.coalesce(sale, full), "original_price": F.when(sale.isNotNull(), full), "availability": F.when(F.col("h.is_buyable"), "in_stock").otherwise("out_of_stock"),
        "rating": N.to_decimal(F.col("h.product_rating.value")), "review_count": F.col("h.product_rating.count"),
        "image_urls": F.when(F.size("h.image_urls") > 0, listed).otherwise(F.array_compact(F.array(F.nullif(F.col("h.image_url"), F.lit(""))))),
        "attributes": schema.attributes(platform=F.lit("catalog_api"), offer_code=F.col("h.offer_code"), sku_config=F.col("h.sku_config"), store_name=F.col("h.store_name"), flags=F.coalesce("h.flags", F.array()), plp_specifications=F.coalesce("h.plp_specifications", F.create_map()), is_bestseller=F.col("h.is_bestseller")),
    })
    return schema.with_defaults(out.withColumn("main_image", F.coalesce(F.get("image_urls", 0), F.lit(""))))
