"""Stored offers: one row for each product URL and colour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from loomcat.functions.text import strip, title_case
from loomcat.sources import versions

KEYS = ("product_url", "color")
OFFERS, IMAGES = "offers", "images"
OFFERS_DDL = "name string, price decimal(18,2), vendor string, category string, product_url string, color string, image_url string, data_hash string"
IMAGES_DDL = "product_url string, image_url string"


def offer_hash(title: Column, price: Column, image: Column, color: Column) -> Column:
    """H6: md5 of title, price, image and colour; a whole price has no decimals."""
    money = price.try_cast("decimal(18,2)")
    plain = F.when(money == F.floor(money), F.floor(money).cast("bigint").cast("string")).when(money.isNotNull(), money.cast("string")).otherwise(strip(F.coalesce(price.cast("string"), F.lit("None"))))
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.md5(F.concat_ws("_", F.lower(strip(text(title))), plain, strip(text(image)), F.lower(strip(text(color)))))


def color_entries(products: DataFrame) -> DataFrame:
    """H7: the products' columns with ``color`` (empty without colours), ``image_url`` and ``data_hash``, a row
    for each colour; rows without a URL are skipped."""
    some = products.where(F.coalesce("product_url", F.lit("")) != "")
    each = F.explode(F.when(F.size("colors") > 0, F.col("colors")).otherwise(F.array(F.lit(""))))
    named = some.withColumn("color", each)
    own = F.get(F.try_element_at("color_images", F.col("color")), 0)
    named = named.withColumn("image_url", F.coalesce(F.when(F.col("color") != "", own), F.get("image_urls", 0), F.lit("")))
    return named.withColumn("data_hash", offer_hash(F.col("title"), F.col("price"), F.col("image_url"), F.col("color")))


def stored_form(entries: DataFrame) -> DataFrame:
    """Entries with the columns of the store, and whether they are ``usable`` there: with title, image and price. vendor
    falls back to the file's name, category to Clothes."""
    stem = title_case(F.replace(F.regexp_replace(F.coalesce("file_name", F.lit("")), r"(_products)?\.[^.]*$", ""), F.lit("_"), F.lit(" ")))
    some = lambda c: F.nullif(strip(F.col(c)), F.lit(""))
    rows = entries.select(
        strip(F.col("title")).alias("name"), F.col("price").try_cast("decimal(18,2)").alias("price"), F.coalesce(some("brand"), some("vendor"), stem).alias("vendor"),
        F.coalesce(some("category"), F.lit("Clothes")).alias("category"), "product_url", F.nullif("color", F.lit("")).alias("color"), "image_url", "image_urls", "data_hash",
    )
    return rows.withColumn("usable", F.coalesce((F.col("name") != "") & (F.col("image_url") != "") & F.col("price").isNotNull(), F.lit(False)))


def store_rows(entries: DataFrame) -> DataFrame:
    """H8: the stored form of the usable entries."""
    return stored_form(entries).where("usable").drop("usable")


def _same(left: str = "l", right: str = "r") -> Column:
    return (F.col(f"{left}.product_url") == F.col(f"{right}.product_url")) & F.col(f"{left}.color").eqNullSafe(F.col(f"{right}.color"))


def restrict_to(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """H9: the rows whose (product_url, color) is among the keys."""
    return rows.alias("l").join(keys.select(*KEYS).alias("r"), _same(), "left_semi")


def delete_rows(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored rows that are not among the keys; an empty colour is null."""
    return stored.alias("l").join(keys.select("product_url", F.nullif("color", F.lit("")).alias("color")).alias("r"), _same(), "left_anti")


def insert_if_absent(stored: DataFrame, rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The rows to append: the first of each key in the given order, unless the key is stored."""
    first = Window.partitionBy(*KEYS).orderBy(*order)
    new = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return new.alias("l").join(stored.select(*KEYS).alias("r"), _same(), "left_anti")


def insert_images(stored_images: DataFrame, inserted: DataFrame) -> DataFrame:
    """The (product_url, image_url) of inserted rows that are not stored yet."""
    each = inserted.select("product_url", F.explode("image_urls").alias("image_url")).where("image_url IS NOT NULL").distinct()
    return each.join(stored_images.select("product_url", "image_url"), ["product_url", "image_url"], "left_anti")


def group_by_source(products: DataFrame) -> DataFrame:
    """(source, n) with unknown for a missing source."""
    return products.groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


def compared(stored: DataFrame, scraped: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """H7, H8 and H5 in one full outer join: the stored columns, ``now_`` columns of the scraped entry, and ``change``. Of repeated
    scraped keys the first in order counts. stored: one row a key, columns of ``store_rows`` without image_urls."""
    entries = color_entries(scraped).withColumn("color", F.nullif("color", F.lit("")))
    first = Window.partitionBy(*KEYS).orderBy(*order)
    entries = entries.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    now = stored_form(entries).select(*(F.col(c).alias(f"now_{c}") for c in (*stored.columns, "image_urls", "usable")))
    both = stored.withColumn("was_stored", F.lit(True)).join(now, (F.col("product_url") == F.col("now_product_url")) & F.col("color").eqNullSafe(F.col("now_color")), "full_outer")
    some = lambda c: F.coalesce(F.col(c), F.lit(""))
    change = (
        F.when(F.col("was_stored").isNull(), "new").when(F.col("now_usable").isNull(), "deleted")
        .when(some("data_hash") != some("now_data_hash"), "updated").otherwise("unchanged")
    )
    return both.withColumn("change", change)


def sync(stored: DataFrame, scraped: DataFrame, order: tuple[str, ...] = ("file_name", "seq")) -> tuple[DataFrame, DataFrame]:
    """(the new snapshot, (change, n) counts), both from one full outer join. For a dry run use the counts alone."""
    both = compared(stored, scraped, order)
    fresh = F.col("change").isin("new", "updated")
    snapshot = both.where((F.col("change") == "unchanged") | (fresh & F.col("now_usable")))
    return snapshot.select(*(F.when(fresh, F.col(f"now_{c}")).otherwise(F.col(c)).alias(c) for c in stored.columns)), both.groupBy("change").agg(F.count("*").alias("n"))


def create_store(offers: DataFrame, images: DataFrame, path: str, buckets: int = 64) -> None:
    """Writes offers and images as the next version of the tables at path, whatever they held."""
    spark = offers.sparkSession
    version = versions.current(spark, path)
    n = version.sizes.get(OFFERS, buckets)
    rows = offers.select(*(c.split()[0] for c in OFFERS_DDL.split(", ")))
    written = versions.write_buckets(path, OFFERS, rows, set(range(n)), n, "product_url")
    written |= versions.write_buckets(path, IMAGES, images.select("product_url", "image_url").distinct(), set(range(n)), n, "product_url")
    versions.commit(spark, path, versions.Version(version.number + 1, versions.with_buckets(version, written), version.logs, version.batches, {OFFERS: n, IMAGES: n} | version.sizes))


def read_offers(spark: SparkSession, path: str, version: versions.Version | None = None) -> DataFrame:
    """The stored offers at path."""
    return versions.read(spark, version or versions.current(spark, path), OFFERS, OFFERS_DDL)


def read_images(spark: SparkSession, path: str, version: versions.Version | None = None) -> DataFrame:
    """The stored images at path."""
    return versions.read(spark, version or versions.current(spark, path), IMAGES, IMAGES_DDL)


def sync_stored(scraped: DataFrame, path: str, order: tuple[str, ...] = ("file_name", "seq"), buckets: int = 64, dry_run: bool = False) -> dict[str, int]:
    """H12 as a write: brings the offers and images at path in step with a scraped catalog; the number of offers by change.

    One full outer join tells what changed and counts it on the way. Only buckets with a changed offer are written again (A9, then A7), and
    image buckets that get a new image (A8: images of inserted rows; those of deleted offers stay). Offers and images
    become visible together, by one manifest. A run that is repeated, or broken off before its manifest, changes nothing more."""
    spark = scraped.sparkSession
    version = versions.current(spark, path)
    n = version.sizes.get(OFFERS, buckets)
    counts = Observation("sync")
    kinds = ("new", "updated", "unchanged", "deleted")
    both = compared(read_offers(spark, path, version), scraped, order)
    both = both.observe(counts, *(F.count_if(F.col("change") == k).alias(k) for k in kinds))
    if dry_run:
        both.write.format("noop").mode("overwrite").save()
        return counts.get
    columns = read_offers(spark, path, version).columns
    inserted = F.col("change").isin("new", "updated") & F.col("now_usable")
    kept = both.where("change <> 'unchanged'").select(
        F.coalesce("product_url", "now_product_url").alias("product_url"), F.when(F.col("product_url").isNull(), F.col("now_color")).otherwise(F.col("color")).alias("color"),
        F.when(inserted, F.struct(*(F.col(f"now_{c}").alias(c) for c in columns))).alias("row"), F.when(inserted, F.col("now_image_urls")).alias("image_urls"),
    )
    changes = spark.read.schema(kept.schema).parquet(versions.append_log(path, "changes", kept))

    def touched_by(rows: DataFrame) -> set[int]:
        return {r.b for r in rows.select(versions.bucket_of(n, "product_url").alias("b")).distinct().collect()}  # at most n

    touched = touched_by(changes)
    if not touched:
        return counts.get
    offers_now = delete_rows(versions.read(spark, version, OFFERS, OFFERS_DDL, touched), changes).unionByName(changes.where("row IS NOT NULL").select("row.*"))
    written = versions.write_buckets(path, OFFERS, offers_now, touched, n, "product_url")
    rows = changes.where("row IS NOT NULL").select("product_url", "image_urls")
    added = insert_images(versions.read(spark, version, IMAGES, IMAGES_DDL, touched_by(rows)), rows)
    added = spark.read.schema(added.schema).parquet(versions.append_log(path, "added", added))
    if more := touched_by(added):
        images_now = versions.read(spark, version, IMAGES, IMAGES_DDL, more).unionByName(added)
        written |= versions.write_buckets(path, IMAGES, images_now, more, n, "product_url")
    versions.commit(spark, path, versions.Version(version.number + 1, versions.with_buckets(version, written), version.logs, version.batches, {OFFERS: n, IMAGES: n} | version.sizes))
    return counts.get
