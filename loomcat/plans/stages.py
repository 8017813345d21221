"""The catalog pipeline (G1 to G8): one lazy plan with one shuffle, for the dedup, which comes before all costly work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcat.functions import normalize as N
from loomcat.functions.scope import classify_record, record_label, scope_of
from loomcat.functions.text import strip
from loomcat.operators.changes import content_hash
from loomcat.operators.report import pipeline_report
from loomcat.sources import schema


def clean(df: DataFrame) -> DataFrame:
    """G1: texts trimmed, lists cleaned, main image and normalised brand filled in."""
    df = df.withColumns({c: strip(F.coalesce(c, F.lit(""))) for c in ("title", "description", "vendor", "brand", "subcategory")})
    df = df.withColumns({**{c: N.clean_list(F.col(c)) for c in ("image_urls", "sizes", "material")}, "colors": N.colors(F.col("colors"))})
    filled = lambda c, other: F.when(F.coalesce(F.col(c), F.lit("")) == "", other).otherwise(F.col(c))
    return df.withColumns({"main_image": filled("main_image", F.coalesce(F.get("image_urls", 0), F.lit(""))), "brand_normalized": filled("brand_normalized", F.lower("brand"))})


def normalize_prices(df: DataFrame) -> DataFrame:
    """Prices of products and variants to two places, currencies to codes; an original price counts
    only above the price."""

    def was(price: Column, original: Column) -> Column:
        return F.when(price.isNull() | original.isNull() | (original > price), original)

    price, original = F.col("price").cast(schema.MONEY), F.col("original_price").cast(schema.MONEY)
    variants = F.transform("variants", lambda v: v.withField("currency", N.currency(v["currency"])).withField("original_price", was(v["price"], v["original_price"])))
    return df.withColumns({"price": price, "original_price": was(price, original), "currency": N.currency(F.col("currency")), "variants": variants})


def backfill_category(df: DataFrame) -> DataFrame:
    """Category from subcategory, title and tags, else from the description; gender likewise."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    tags = F.array_join("attributes.tags", " ")
    df = df.withColumn("category", F.when(empty("category"), N.category(F.col("subcategory"), F.col("title"), tags)).otherwise(F.col("category")))
    df = df.withColumn("category", F.when(empty("category"), N.category_from_description(F.col("description"))).otherwise(F.col("category")))
    return df.withColumn("gender", F.when(empty("gender"), N.gender(F.col("subcategory"), F.col("title"), tags)).otherwise(F.col("gender")))


def mark_duplicates(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """G4 with its rejects: ``arrival`` 1 for the first row of each product id in the given order; rows without an id are
    dropped. The order should end in a unique column."""
    first = Window.partitionBy("product_id").orderBy(*order)
    return df.where(F.coalesce("product_id", F.lit("")) != "").withColumn("arrival", F.row_number().over(first))


def dedup(df: DataFrame, order: tuple[str, ...] = ("scraped_at", "file_name", "seq"), counted: str | None = None) -> DataFrame:
    """The first row of each product id in the given order, and with ``counted`` how many came of it. Each task keeps one row of an id before
    anything is shuffled, so what moves does not grow with the repeats of a crawl. Rows without an id are dropped; nulls of the order come first."""
    some = df.where(F.coalesce("product_id", F.lit("")) != "")
    wanted = [F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_first"), *([F.count("*").alias(counted)] if counted else [])]
    # the key goes by another name: the whole row comes back in _first
    return some.groupBy(F.col("product_id").alias("_id")).agg(*wanted).select("_first.*", *([counted] if counted else []))


def add_scope(df: DataFrame) -> DataFrame:
    """The scope of each row; rejected ones carry their reason."""
    return df.withColumn("scope", classify_record())


def invalid(images_required: Column) -> Column:
    """The missing required fields; a store that needs no images may miss exactly those."""
    missing = schema.missing_required()
    only_images = missing == F.array(F.lit("image_urls"))
    return F.when(only_images & ~images_required, F.array().cast("array<string>")).otherwise(missing)


def stamp(df: DataFrame) -> DataFrame:
    """Content hash and the times of first and last sight."""
    return df.withColumns({"content_hash": content_hash(), "last_seen": F.col("scraped_at"), "first_seen": F.coalesce("first_seen", "scraped_at")})


def classify_rows(raw: DataFrame, stores: DataFrame | None = None, order: tuple[str, ...] = ("scraped_at", "file_name", "seq")) -> DataFrame:
    """G8 as one table: every row with ``reject_stage`` and ``reject_reason``, both null for accepted ones.

    Scope is judged after the dedup, so its counts are of products; later arrivals of a product (a crawl meets each some
    twenty times) keep the columns as they came and have no scope and no hash. stores: (source, require_images).
    """
    ranked = mark_duplicates(raw, order)  # its exchange serves both branches
    kept = _verdicts(ranked.where("arrival = 1"), stores)
    later = ranked.where("arrival > 1").withColumns({"label": F.lit(None).cast("string"), "reject_stage": F.lit("dedup"), "reject_reason": F.lit("duplicate")})
    # the struct is made above the union: one made below it is taken apart there
    return kept.unionByName(later).withColumn("scope", scope_of(F.col("label"))).drop("arrival", "label")


def _verdicts(firsts: DataFrame, stores: DataFrame | None) -> DataFrame:
    """First arrivals, cleaned and stamped, with label, reject_stage and reject_reason."""
    df = backfill_category(normalize_prices(clean(firsts))).withColumn("label", record_label())
    if stores is None:
        df = df.withColumn("require_images", F.lit(True))
    else:
        df = df.join(F.broadcast(stores.select("source", "require_images")), "source", "left")
    df = df.withColumn("missing", F.array_join(invalid(F.coalesce("require_images", F.lit(True))), ","))
    out = ~F.col("label").isin("footwear", "clothing")
    stage = F.when(out, "scope").when(F.col("missing") != "", "validate")
    reason = F.when(out, F.col("label")).when(F.col("missing") != "", F.col("missing"))
    return stamp(df).withColumns({"reject_stage": stage, "reject_reason": reason}).drop("require_images", "missing")


def classify_marked(rows: DataFrame, first: str, stores: DataFrame | None = None) -> DataFrame:
    """The verdicts of ``classify_rows`` for rows whose boolean column ``first`` tells first arrivals; that column goes. One branch, so that a
    stateful stream is not run once for each: other rows go through empty and get their columns back at the end."""
    columns = [c for c in rows.columns if c != first]
    # source stays: the stores are joined by it
    bare = rows.select(first, F.struct(*columns).alias("_came"), *(F.col(c) if c == "source" else F.when(F.col(first), F.col(c)).alias(c) for c in columns))
    df = _verdicts(bare, stores).withColumn("scope", scope_of(F.when(F.col(first), F.col("label"))))
    back = [F.when(F.col(first), F.col(c)).otherwise(F.col(f"_came.{c}")).alias(c) if c != "scope" else F.col(c) for c in columns]
    told = {"reject_stage": F.lit("dedup"), "reject_reason": F.lit("duplicate")}
    return df.select(*back, *(F.when(F.col(first), F.col(c)).otherwise(v).alias(c) for c, v in told.items()))


def map_errors(mapped: DataFrame) -> DataFrame:
    """The rows that no product id could be made for (no merchant, or neither platform id, handle nor URL), with the
    reason; the dedup leaves them out."""
    return mapped.where(F.coalesce("product_id", F.lit("")) == "").withColumns({"reject_stage": F.lit("map"), "reject_reason": F.lit("no product id")})


def run_pipeline(raw: DataFrame, stores: DataFrame | None = None, order: tuple[str, ...] = ("scraped_at", "file_name", "seq")) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in canonical order, rejected rows with stage and reason). Rows without an id are in neither: see map_errors."""
    rows = classify_rows(raw, stores, order)
    return schema.ordered(rows.where("reject_stage IS NULL")), rows.where("reject_stage IS NOT NULL")


def accepted_products(raw: DataFrame, stores: DataFrame | None = None, order: tuple[str, ...] = ("scraped_at", "file_name", "seq")) -> DataFrame:
    """The accepted rows of G8 where rejects are not wanted: repeats are left out before the shuffle."""
    rows = _verdicts(dedup(raw, order), stores).where("reject_stage IS NULL")
    return schema.ordered(rows.withColumn("scope", scope_of(F.col("label"))))


def write_pipeline(raw: DataFrame, path: str, stores: DataFrame | None = None, order: tuple[str, ...] = ("scraped_at", "file_name", "seq")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G8 as a write, with I2 from what was written: (accepted, rejected, report). The input is scanned and judged once; the rows go to a
    folder for each outcome below path, and the report reads back only their few narrow columns."""
    rows = classify_rows(raw, stores, order)
    rows.withColumn("outcome", F.coalesce("reject_stage", F.lit("accepted"))).write.mode("overwrite").partitionBy("outcome").parquet(path)
    back = raw.sparkSession.read.schema(T.StructType([*rows.schema, T.StructField("outcome", T.StringType())])).parquet(path)
    return schema.ordered(back.where("outcome = 'accepted'")), back.where("outcome <> 'accepted'").drop("outcome"), pipeline_report(back)
