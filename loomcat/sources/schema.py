"""The canonical product row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
VARIANT_DDL = (
    "struct<variant_id:string,platform_variant_id:string,sku:string,barcode:string,size:string,color:string,"
    "price:decimal(18,2),original_price:decimal(18,2),currency:string,available:boolean,inventory_quantity:bigint>"
)
ATTRIBUTES_DDL = (
    "struct<platform:string,platform_product_id:string,handle:string,product_type:string,tags:array<string>,variant_count:int,"
    "schema_type:string,product_group_id:string,varies_by:string,mpn:string,offer_code:string,sku_config:string,store_name:string,"
    "flags:array<string>,plp_specifications:map<string,string>,is_bestseller:boolean,breadcrumbs:array<string>>"
)
SCOPE_DDL = "struct<is_supported:boolean,scope_type:string,rejection_reason:string>"
#: Field, type and default (SQL); null where none is given.
FIELDS = (
    ("product_id", "string", "''"), ("source", "string", "''"), ("vendor", "string", "''"), ("brand", "string", "''"), ("brand_normalized", "string", "''"),
    ("title", "string", "''"), ("description", "string", "''"), ("category", "string", "''"), ("subcategory", "string", "''"), ("gender", "string", "''"),
    ("price", MONEY, None), ("original_price", MONEY, None), ("currency", "string", "'EGP'"), ("availability", "string", "''"),
    ("sku", "string", None), ("barcode", "string", None), ("gtin", "string", None), ("rating", MONEY, None), ("review_count", "bigint", None),
    ("image_urls", "array<string>", "array()"), ("main_image", "string", "''"), ("product_url", "string", "''"), ("material", "array<string>", "array()"),
    ("colors", "array<string>", "array()"), ("color_images", "map<string,array<string>>", "map()"), ("sizes", "array<string>", "array()"),
    ("variants", f"array<{VARIANT_DDL}>", "array()"), ("attributes", ATTRIBUTES_DDL, None), ("content_hash", "string", "''"), ("scope", SCOPE_DDL, None),
    ("source_updated_at", "timestamp", None), ("first_seen", "timestamp", None), ("last_seen", "timestamp", None), ("scraped_at", "timestamp", None),
)
NAMES = tuple(f for f, _, _ in FIELDS)
PRODUCT_DDL = ", ".join(f"{f} {kind}" for f, kind, _ in FIELDS)

REQUIRED = ("title", "price", "image_urls", "product_url")
VARIANT_DEFAULTS = {"variant_id": "", "currency": "EGP"}


def with_defaults(df: DataFrame) -> DataFrame:
    """B1: every product field with its type, its default where the column is missing or null. Other
    columns are dropped."""
    have = set(df.columns)
    out = []
    for name, kind, default in FIELDS:
        value = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        if name == "variants" and name in have:
            value = with_variant_defaults(value)
        out.append((F.coalesce(value, F.expr(default).cast(kind)) if default else value).alias(name))
    return df.select(*out)


def variant(**fields: Column) -> Column:
    """B2: a variant struct of the given fields; the others take their defaults."""
    out = []
    for f in T.StructType.fromDDL("v " + VARIANT_DDL)[0].dataType.fields:
        value = fields.get(f.name, F.lit(None)).cast(f.dataType)
        default = VARIANT_DEFAULTS.get(f.name)
        out.append((F.coalesce(value, F.lit(default)) if default else value).alias(f.name))
    return F.struct(*out)


def with_variant_defaults(variants: Column) -> Column:
    """B2 for variants that were read: each field that has a default gets it where it is null; null elements go."""
    filled = lambda v: v.withField("variant_id", F.coalesce(v["variant_id"], F.lit(VARIANT_DEFAULTS["variant_id"]))).withField("currency", F.coalesce(v["currency"], F.lit(VARIANT_DEFAULTS["currency"])))
    return F.transform(F.filter(variants, lambda v: v.isNotNull()), filled)


def attributes(**fields: Column) -> Column:
    """The attributes struct of the given fields, the others null."""
    kinds = T.StructType.fromDDL("a " + ATTRIBUTES_DDL)[0].dataType.fields
    return F.struct(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds))


def ordered(df: DataFrame) -> DataFrame:
    """The columns in canonical order; other columns are dropped."""
    return df.select(*NAMES)


def missing_required() -> Column:
    """The required fields that are null, empty text or an empty list. A price of 0 is present."""
    gone = {
        "title": F.coalesce(F.col("title"), F.lit("")) == "",
        "price": F.col("price").isNull(),
        "image_urls": F.coalesce(F.size("image_urls"), F.lit(0)) <= 0,
        "product_url": F.coalesce(F.col("product_url"), F.lit("")) == "",
    }
    return F.array_compact(F.array(*(F.when(gone[n], F.lit(n)) for n in REQUIRED)))
