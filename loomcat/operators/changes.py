"""Change tracking (H1 to H5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASHED = ("availability", "brand", "category", "description", "gender", "image_urls", "original_price", "price", "title")


def content_hash() -> Column:
    """H1: sha256 of the fields that matter to a shopper, variants included; nulls are kept apart from empties."""
    parts = F.transform("variants", lambda v: F.struct(v["available"].alias("available"), v["price"].alias("price"), v["sku"].alias("sku")))
    return F.sha2(F.to_json(F.struct(*HASHED, parts.alias("variants")), {"ignoreNullFields": "false"}), 256)


def known_hash(df: DataFrame, hash_col: str = "content_hash") -> Column:
    """The hash of df's rows: the given one, or where that is missing or empty the computed one, if df has the hashed columns; else null."""
    value = F.nullif(F.col(hash_col), F.lit("")) if hash_col in df.columns else F.lit(None).cast("string")
    return F.coalesce(value, content_hash()) if {*HASHED, "variants"} <= set(df.columns) else value


def detect_changes(previous: DataFrame, current: DataFrame, key: str = "product_id", hash_col: str = "content_hash") -> DataFrame:
    """H2: (key, change) with new, updated, unchanged or removed; empty ids are skipped. Both sides have one row for
    each id. A hash that is missing or empty is computed where the side has the hashed columns."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.coalesce(F.col(key), F.lit("")) != "").select(key, F.coalesce(known_hash(df, hash_col), F.lit("")).alias(name))

    both = side(previous, "was").join(side(current, "now"), key, "full_outer")
    change = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "updated").otherwise("unchanged")
    return both.select(key, change.alias("change"))


def change_summary(changes: DataFrame) -> DataFrame:
    """H3: (change, n) for all four kinds."""
    kinds = changes.sparkSession.range(1).select(F.explode(F.array(*(F.lit(k) for k in ("new", "updated", "unchanged", "removed")))).alias("change"))
    return kinds.join(changes.groupBy("change").agg(F.count("*").alias("n")), "change", "left").select("change", F.coalesce("n", F.lit(0)).alias("n"))


def update_state(state: DataFrame, records: DataFrame) -> DataFrame:
    """H4: (source, product_id, content_hash, first_seen, last_seen, high_water). Removed ids stay; high_water is the
    source's latest source_updated_at so far. A record without a hash gets the computed one. records: one row for each id."""
    seen = F.coalesce("last_seen", "scraped_at")
    now = records.where(F.coalesce("product_id", F.lit("")) != "").select("source", "product_id", known_hash(records).alias("hash"), F.coalesce("first_seen", seen).alias("first"), seen.alias("last"))
    merged = state.drop("high_water").join(now, ["source", "product_id"], "full_outer").select(
        "source", "product_id", F.coalesce("hash", "content_hash").alias("content_hash"), F.coalesce("first_seen", "first").alias("first_seen"), F.coalesce("last", "last_seen").alias("last_seen"),
    )
    marks = records.groupBy("source").agg(F.max("source_updated_at").alias("mark")).unionByName(state.groupBy("source").agg(F.max("high_water").alias("mark")))
    return merged.join(marks.groupBy("source").agg(F.max("mark").alias("high_water")), "source", "left")


def calculate_delta(old: DataFrame, new: DataFrame, keys: tuple[str, ...], hash_col: str, order: str) -> DataFrame:
    """H5: the rows of new with ``change`` new, updated or unchanged, and the keys of old that are gone with
    ``change`` deleted. Keys compare null-safe, rows whose first key is empty are skipped, a missing hash counts as empty.
    Of repeated old keys the last by ``order`` counts; each repeated new row is told apart."""
    some = lambda df: df.where(F.coalesce(F.col(keys[0]).cast("string"), F.lit("")) != "")
    last = F.max_by(F.coalesce(F.col(hash_col), F.lit("")), order)
    was = some(old).groupBy(*keys).agg(last.alias("_was")).select(*(F.col(k).alias(f"_{k}") for k in keys), "_was")
    now = some(new).withColumn("_now", F.coalesce(F.col(hash_col), F.lit("")))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = now.join(was, on, "full_outer")
    change = F.when(F.col("_was").isNull(), "new").when(F.col("_now").isNull(), "deleted").when(F.col("_was") != F.col("_now"), "updated").otherwise("unchanged")
    named = [F.when(F.col("_now").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in keys else F.col(c) for c in new.columns]
    return both.select(*named, change.alias("change"))


def last_per_key(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The last row of each key in the given order."""
    back = Window.partitionBy(key).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_n", F.row_number().over(back)).where("_n = 1").drop("_n")
