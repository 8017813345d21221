"""Reading and writing catalogs, raw payloads, stored offers, reports and crawl state."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema

SHOPIFY_DDL = (
    "products array<struct<id:bigint,handle:string,title:string,body_html:string,vendor:string,product_type:string,tags:string,updated_at:string,"
    "options:array<struct<name:string>>,variants:array<struct<id:bigint,option1:string,option2:string,option3:string,price:string,compare_at_price:string,"
    "sku:string,barcode:string,available:boolean,inventory_quantity:bigint,featured_image:struct<src:string>>>,"
    "images:array<struct<src:string,variant_ids:array<bigint>>>>>"
)
HITS_DDL = (
    "hits array<struct<offer_code:string,catalog_sku:string,sku:string,sku_config:string,brand:string,name:string,plp_specifications:map<string,string>,"
    "price:string,sale_price:string,url:string,image_url:string,image_urls:array<string>,is_buyable:boolean,product_rating:struct<count:bigint,value:string>,"
    "flags:array<string>,store_name:string,is_bestseller:boolean>>, nbHits bigint, nbPages bigint"
)
REPORT_DDL = (
    "store string, products_scraped bigint, requests bigint, retries bigint, failures bigint, products_dropped bigint, duration_seconds double, "
    "avg_products_per_request double, scope_seen bigint, scope_accepted bigint, scope_rejected bigint, scope_rejected_breakdown map<string,bigint>"
)
STATE_DDL = "source string, product_id string, content_hash string, first_seen timestamp, last_seen timestamp, high_water timestamp"


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A1: all ``*_products.json`` array files, with file_name; order is by file_name where it matters. A file that
    holds no list, or is no JSON, is skipped.

    Files with a record on each line between the brackets (as catalogs are written) are read line by line, so a large file is split over
    many tasks; a line of theirs that is no JSON is dropped. A quick look at the lines tells which files are so;
    the others are read whole, each by one task."""
    at, record = f"{folder.rstrip('/')}/*_products.json", f"struct<{schema.PRODUCT_DDL.replace(' ', ':').replace(',:', ',')}>"
    named = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name")]
    lines = spark.read.text(at).select(F.trim("value").alias("value"), *named)
    bracket, line = F.col("value").isin("[", "]", ""), F.col("value").rlike(r"^\{.*\},?$")
    shape = lines.groupBy("_path").agg(F.count_if(F.col("value") == "[").alias("opens"), F.count_if(F.col("value") == "]").alias("closes"), F.count_if(~bracket & ~line).alias("others"))
    by_line = {r._path: r.opens == 1 and r.closes == 1 and not r.others for r in shape.collect()}  # a row for each file

    def of(wanted: bool) -> list[str]:
        return sorted(p for p, is_so in by_line.items() if is_so == wanted)

    out = spark.createDataFrame([], f"p {record}, file_name string")
    if paths := of(True):
        rows = spark.read.text(paths).select(F.trim("value").alias("value"), *named).where(line)
        read = F.from_json(F.regexp_replace("value", ",$", ""), f"{schema.PRODUCT_DDL}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
        out = out.unionByName(rows.select(read.alias("p"), "file_name").where("p._bad IS NULL").withColumn("p", F.col("p").dropFields("_bad")))
    if paths := of(False):
        files = spark.read.text(paths, wholetext=True).select("value", *named)
        out = out.unionByName(files.where(F.col("value").rlike(r"^\s*\[")).select(F.explode(F.from_json("value", f"array<{record}>")).alias("p"), "file_name"))
    return out.where("p IS NOT NULL").select("p.*", "file_name")


def read_jsonl(spark: SparkSession, path: str, ddl: str = schema.PRODUCT_DDL) -> DataFrame:
    """A2: one record for each line; blank and malformed lines are dropped."""
    return spark.read.schema(ddl).option("mode", "DROPMALFORMED").json(path)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A3: the keys and hashes of stored offers; filter and columns reach the scan."""
    return spark.read.parquet(path).where(F.col("product_url").isNotNull()).select("product_url", "color", "data_hash")


def read_raw_shopify(payloads: DataFrame, body: str = "body") -> DataFrame:
    """A4: a row for each product of each storefront payload, in ``product`` with its position; other
    columns stay. A payload that is no such object gives no rows. tags may be a list or a comma text."""
    parsed = payloads.withColumn("_p", F.from_json(body, SHOPIFY_DDL)["products"])
    out = parsed.where(F.col("_p").isNotNull()).select(*(c for c in payloads.columns if c != body), F.posexplode("_p").alias("position", "product"))
    return out.where(F.col("product").isNotNull())


def read_raw_hits(payloads: DataFrame, body: str = "body") -> DataFrame:
    """A5: a row for each hit of each catalog payload."""
    parsed = payloads.withColumn("_p", F.from_json(body, HITS_DDL)["hits"])
    out = parsed.where(F.col("_p").isNotNull()).select(*(c for c in payloads.columns if c != body), F.posexplode("_p").alias("position", "hit"))
    return out.where(F.col("hit").isNotNull())


def write_catalog(products: DataFrame, path: str) -> None:
    """JSON Lines in a folder for each source, nulls written out. A source without rows in this run keeps what it had."""
    named = schema.ordered(products).withColumn("store", F.col("source"))
    named.write.option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).partitionBy("store").mode("overwrite").json(path)


def read_written_catalog(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_catalog`` wrote, with its types."""
    return schema.ordered(spark.read.schema(schema.PRODUCT_DDL).json(path))


def read_crawl_reports(spark: SparkSession, path: str) -> DataFrame:
    """A10: one JSON document for each store."""
    return spark.read.schema(REPORT_DDL).option("multiLine", True).json(path)


def store_dimension(stores: DataFrame) -> DataFrame:
    """One row for each source; of several the one with the largest ``position`` wins."""
    last = stores.groupBy("source").agg(F.max_by(F.struct(*(c for c in stores.columns if c != "source")), "position").alias("s"))
    return last.select("source", "s.*").drop("position")


def confirmed_sources(stores: DataFrame) -> DataFrame:
    return store_dimension(stores).where("confirmed").select("source")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The crawl state of all sources; a missing table is an empty one."""
    try:
        return spark.read.schema(STATE_DDL).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STATE_DDL)


def write_state(state: DataFrame, path: str) -> None:
    """Writes the state by source; sources that are absent keep theirs."""
    state.write.option("partitionOverwriteMode", "dynamic").partitionBy("source").mode("overwrite").parquet(path)
