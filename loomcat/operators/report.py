"""Reports (I1 to I7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECTED = "rejected/"


def total(*keys: str) -> Column:
    """The sum of the values of the counters so named."""
    return F.coalesce(F.sum(F.when(F.col("key").isin(*keys), F.col("value"))), F.lit(0))


def health_report(stats: DataFrame) -> DataFrame:
    """One row for each store of stats (store, key, value); counters: scraped, requests, retries, exceptions,
    request_errors, missing_fields, duplicates, duration_ms, scope_seen, scope_accepted, scope_rejected and
    rejected/<reason>."""
    parts = stats.groupBy("store", "key").agg(F.sum("value").alias("value"))
    reasons = F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("key").startswith(REJECTED), F.struct(F.substr("key", F.lit(len(REJECTED) + 1)), "value")))))
    out = parts.groupBy("store").agg(
        total("scraped").alias("products_scraped"), total("requests").alias("requests"), total("retries").alias("retries"), total("exceptions", "request_errors").alias("failures"),
        total("missing_fields", "duplicates").alias("products_dropped"), F.round(total("duration_ms").cast("decimal(18,4)") / 1000, 2).cast("double").alias("duration_seconds"),
        total("scope_seen").alias("scope_seen"), total("scope_accepted").alias("scope_accepted"), total("scope_rejected").alias("scope_rejected"), reasons.alias("breakdown"),
    )
    rate = F.when(F.col("requests") == 0, F.lit(0.0)).otherwise(F.round(F.col("products_scraped").cast("decimal(18,6)") / F.col("requests"), 3).cast("double"))
    return out.withColumn("avg_products_per_request", rate)


def pipeline_report(rows: DataFrame) -> DataFrame:
    """The same counts for each source from ``classify_rows``, without runtime counters."""
    n = lambda c: F.count(F.when(c, 1))
    seen = F.col("reject_stage").isNull() | (F.col("reject_stage") != "dedup")
    return rows.groupBy("source").agg(
        n(F.col("reject_stage").isNull()).alias("products_scraped"), n(F.col("reject_stage").isin("dedup", "validate")).alias("products_dropped"), n(seen).alias("scope_seen"),
        n(seen & F.col("scope.is_supported")).alias("scope_accepted"), n(F.coalesce(F.col("reject_stage") == "scope", F.lit(False))).alias("scope_rejected"),
    )


def breakdown(rows: DataFrame, key: str = "store", reason: str = "reason") -> DataFrame:
    """(key, breakdown) text ``reason=n`` in order of reason."""
    counted = rows.where(F.col(reason).isNotNull()).groupBy(key, reason).agg(F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct(F.col(reason).alias("r"), "n")))
    return counted.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: F.concat(x["r"], F.lit("="), x["n"].cast("string"))), ", ").alias("breakdown"))


def format_report(report: DataFrame) -> DataFrame:
    """(store, text) lines of a health report, reasons in order."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.col(c).cast("string"))
    reasons = F.transform(F.array_sort(F.map_entries("breakdown")), lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), e["value"].cast("string")))
    lines = F.array(F.concat(F.lit("store: "), F.col("store")), line("products", "products_scraped"), line("requests", "requests"), line("retries", "retries"), line("failures", "failures"), line("dropped", "products_dropped"), line("seconds", "duration_seconds"), line("products per request", "avg_products_per_request"), line("rejected", "scope_rejected"))
    return report.select("store", F.array_join(F.concat(lines, reasons), "\n").alias("text"))


def yield_table(products: DataFrame, reports: DataFrame) -> DataFrame:
    """I4: products of each store with its report, most first, and a TOTAL row last."""
    counts = products.groupBy(F.col("source").alias("store")).agg(F.count("*").alias("products"))
    joined = counts.join(reports.select("store", "requests", "failures", "duration_seconds"), "store", "left")
    summed = joined.rollup("store").agg(F.sum("products").alias("products"), F.sum("requests").alias("requests"), F.sum("failures").alias("failures"), F.sum("duration_seconds").alias("duration_seconds"), F.grouping("store").alias("g"))
    named = summed.withColumn("store", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("store")))
    return named.orderBy("g", F.col("products").desc(), "store").drop("g")


def scope_audit(rows: DataFrame) -> DataFrame:
    """For each store of rows (store, is_supported, reason) and for TOTAL: total, retained, rejected,
    percentage retained and the reasons. The rollup is over (store, reason) counts, so it shuffles few rows."""
    counted = rows.groupBy("store", "reason").agg(F.count("*").alias("n"), F.count(F.when(F.col("is_supported"), 1)).alias("kept"))
    both = counted.unionByName(counted.withColumn("store", F.lit("TOTAL")))
    by_reason = both.groupBy("store", "reason").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"))
    listed = F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))))
    out = by_reason.groupBy("store").agg(
        F.sum("n").alias("total"), F.sum("kept").alias("retained"), F.array_join(F.transform(listed, lambda x: F.concat(x["reason"], F.lit("="), x["n"].cast("string"))), ", ").alias("breakdown")
    )
    pct = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.round(F.col("retained").cast("decimal(18,6)") * 100 / F.col("total"), 1).cast("double"))
    return out.select("store", "total", "retained", (F.col("total") - F.col("retained")).alias("rejected"), pct.alias("pct"), "breakdown")


def apply_scope(products: DataFrame, path: str) -> None:
    """Writes the rows in scope, by source; sources without rows here keep theirs. A source whose rows are all out of
    scope gets a file of one empty line, which readers of JSON Lines skip: its former rows must not stay."""
    kept = products.where("scope.is_supported")
    emptied = products.groupBy("source").agg(F.max(F.coalesce(F.col("scope.is_supported"), F.lit(False))).alias("any")).where("NOT any").select("source")
    rows = kept.select(F.col("source").alias("store"), F.to_json(F.struct(*kept.columns), {"ignoreNullFields": "false"}).alias("value"))
    rows = rows.unionByName(emptied.select(F.col("source").alias("store"), F.lit("").alias("value")))
    rows.write.option("partitionOverwriteMode", "dynamic").partitionBy("store").mode("overwrite").text(path)


def status_summary(profiles: DataFrame) -> DataFrame:
    """(status, n), with a row total."""
    n = profiles.rollup("status").agg(F.count("*").alias("n"), F.grouping("status").alias("g"))
    return n.select(F.when(F.col("g") == 1, "total").otherwise(F.col("status")).alias("status"), "n")
