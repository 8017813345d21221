"""Registered queries of single steps: sources and sinks (each writes to a new shared folder and reads back), defaults,
JSON-LD parts, storefront parts, pipeline stages and streams, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat import catalog_queries as C
from loomcat.catalog_queries import PARTS_SQL, arrivals, parts, sql_parts, sql_rules, table
from loomcat.functions import rules, scope
from loomcat.functions.text import once
from loomcat.operators import changes, jsonld, offers, report, storefront
from loomcat.plans import stages
from loomcat.sources import io, schema, versions
from loomcat.sources.folder import new_path
from loomcat.streaming import pipeline

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def whole_files(texts: DataFrame, path: str) -> None:
    """A file for each row."""
    texts.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


# ---- sources and sinks -----------------------------------------------------------------------------


@query(f"WITH {PARTS_SQL} SELECT CAST(p_partkey AS VARCHAR) AS product_id, title, price, len(string_split(p_name, ' ')) AS n_colors FROM p")
def a1_read_catalog(spark, d):
    """A list for each brand; files with another kind of content beside them give nothing."""
    at = new_path(spark, "catalogs")
    row = F.struct(F.col("p_partkey").cast("string").alias("product_id"), "title", "price", F.split("p_name", " ").alias("colors"))
    whole_files(parts(spark, d).groupBy("p_brand").agg(F.to_json(F.collect_list(row)).alias("value")).select("value"), f"{at}/lists_products.json")
    whole_files(parts(spark, d).where("p_partkey <= 2").select(F.when(F.col("p_partkey") == 1, F.to_json(row)).otherwise("[{no json").alias("value")), f"{at}/other_products.json")
    return io.read_catalog(spark, at).select("product_id", "title", "price", F.size("colors").cast("long").alias("n_colors"))


@query(f"WITH {PARTS_SQL} SELECT CAST(p_partkey AS VARCHAR) AS product_id, title, price, len(string_split(p_name, ' ')) AS n_colors FROM p")
def a1_read_catalog_by_line(spark, d):
    """Files with a record on each line, as catalogs are written: read in splits."""
    at = new_path(spark, "catalogs")
    row = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("product_id"), "title", "price", F.split("p_name", " ").alias("colors")))
    lines = parts(spark, d).groupBy("p_brand").agg(F.array_join(F.collect_list(row), ",\n").alias("rows"))
    whole_files(lines.select(F.concat(F.lit("[\n"), "rows", F.lit("\n]")).alias("value")), f"{at}/lines_products.json")
    return io.read_catalog(spark, at).select("product_id", "title", "price", F.size("colors").cast("long").alias("n_colors"))


@query(f"WITH {PARTS_SQL} SELECT CAST(p_partkey AS VARCHAR) AS product_id, title, price FROM p WHERE p_partkey % 10 <> 0")
def a2_read_jsonl(spark, d):
    at = new_path(spark, "jsonl")
    row = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("product_id"), "title", "price"))
    parts(spark, d).select(F.when(F.col("p_partkey") % 20 == 0, "").when(F.col("p_partkey") % 10 == 0, "not json").otherwise(row).alias("value")).write.text(at)
    return io.read_jsonl(spark, at).select("product_id", "title", "price")


@query(f"WITH {C.STORED_SQL} SELECT product_url, color, data_hash FROM st")
def a3_read_stored(spark, d):
    at = new_path(spark, "stored")
    C.stored(spark, d).write.parquet(at)
    return io.read_stored(spark, at)


@query(f"WITH {C.LINES_SQL} SELECT l_partkey AS id, 'h-' || l_partkey AS handle, CAST(0 AS INTEGER) AS position, CAST(n AS INTEGER) AS n_variants FROM r JOIN part ON p_partkey = l_partkey")
def a4_read_raw_shopify(spark, d):
    junk = C.storefront_payloads(spark, d).withColumn("body", F.lit("[]"))
    got = io.read_raw_shopify(C.storefront_payloads(spark, d).unionByName(junk))
    return got.select("product.id", "product.handle", "position", F.size("product.variants").alias("n_variants"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS sku, CAST(i AS INTEGER) AS position, p_name AS name FROM part, (VALUES (0), (1)) AS v(i)")
def a5_read_raw_hits(spark, d):
    hit = F.struct(F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("name"))
    payload = table(spark, d, "part").select(F.lit("market").alias("source"), F.to_json(F.struct(F.array(hit, hit).alias("hits"))).alias("body"))
    return io.read_raw_hits(payload).select("hit.sku", "position", "hit.name")


CANONICAL_SQL = f"{PARTS_SQL} SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS source, title, price, 'EGP' AS currency, p_partkey % 4 = 0 AS no_gtin FROM p"


def canonical(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return schema.with_defaults(parts(spark, d).select(k.cast("string").alias("product_id"), F.col("p_brand").alias("source"), "title", "price", F.when(k % 4 != 0, "1").alias("gtin")))


@query(f"WITH {CANONICAL_SQL}")
def a6_write_catalog(spark, d):
    """Written twice: the second run has some sources only and must leave the others alone."""
    at = new_path(spark, "catalog")
    io.write_catalog(canonical(spark, d), at)
    io.write_catalog(canonical(spark, d).where("source < 'Brand#3'"), at)
    return io.read_written_catalog(spark, at).select("product_id", "source", "title", "price", "currency", F.col("gtin").isNull().alias("no_gtin"))


@query(f"WITH {C.HEALTH_SQL} SELECT store, products_scraped, requests, scope_rejected, accessory FROM h")
def a10_read_crawl_reports(spark, d):
    at = new_path(spark, "reports")
    r = report.health_report(C.stats(spark, d)).withColumnRenamed("breakdown", "scope_rejected_breakdown")
    whole_files(r.select(F.to_json(F.struct(*r.columns)).alias("value")), at)
    got = io.read_crawl_reports(spark, at)
    return got.select("store", "products_scraped", "requests", "scope_rejected", F.coalesce(F.try_element_at("scope_rejected_breakdown", F.lit("accessory")), F.lit(0)).alias("accessory"))


@query("SELECT event_type AS source, user_id % 2 = 0 AS confirmed FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def a11_store_dimension(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("source"), (F.col("user_id") % 2 == 0).alias("confirmed"), F.col("event_id").alias("position"))
    return io.store_dimension(rows)


STATE_SQL = C.ORACLE["h4_update_state"]


@query(STATE_SQL)
def a12_crawl_state(spark, d):
    """The state written, one source written again, and read."""
    at = new_path(spark, "state")
    state = C.h4_update_state(spark, d)
    io.write_state(state, at)
    io.write_state(state.where("source = 'view'").unionByName(io.read_state(spark, f"{at}/none")), at)
    return io.read_state(spark, at)


# ---- the canonical row -----------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS title, CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'EGP' END AS currency, 0 AS n_images, 0 AS n_variants, true AS no_sku FROM part")
def b1_with_defaults(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(k.cast("string").alias("product_id"), F.when(k % 2 == 0, F.col("p_name")).alias("title"), F.when(k % 3 == 0, "USD").alias("currency"))
    return schema.with_defaults(rows).select(F.col("product_id").cast("long").alias("p_partkey"), "title", "currency", F.size("image_urls").alias("n_images"), F.size("variants").alias("n_variants"), F.col("sku").isNull().alias("no_sku"))


@query("SELECT p_partkey, i AS at, CASE WHEN (p_partkey + i) % 2 = 0 THEN 'USD' ELSE 'EGP' END AS currency, '' AS variant_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part, (VALUES (0), (1)) AS v(i)")
def b2_with_variant_defaults(spark, d):
    """Variants that are read: a missing currency is filled in, a given one stays."""
    k = F.col("p_partkey")
    one = lambda i: F.struct(F.col("p_retailprice").cast("decimal(18,2)").alias("price"), F.when((k + i) % 2 == 0, "USD").alias("currency"))
    text = F.to_json(F.array(one(0), one(1)))
    read = table(spark, d, "part").select("p_partkey", F.posexplode(schema.with_variant_defaults(F.from_json(text, f"array<{schema.VARIANT_DDL}>"))).alias("at", "v"))
    return read.select("p_partkey", "at", "v.currency", "v.variant_id", "v.price")


@query(f"SELECT p_partkey, '{','.join(schema.NAMES)}' AS columns FROM part")
def b3_ordered(spark, d):
    """The names in the order in which a row's JSON has them, from columns in another order and one more."""
    rows = canonical(spark, d)
    out = schema.ordered(rows.select(F.lit(1).alias("extra"), *reversed(rows.columns)))
    keys = F.json_object_keys(F.to_json(F.struct(*out.columns), {"ignoreNullFields": "false"}))
    return out.select(F.col("product_id").cast("long").alias("p_partkey"), F.array_join(keys, ",").alias("columns"))


TEXT_FIELDS = [name for name, kind, _ in schema.FIELDS if kind == "string"]
KNOWN = {"product_id": "CAST(p_partkey AS VARCHAR)", "source": "p_brand", "title": "title", "currency": "'EGP'", "gtin": "CASE WHEN p_partkey % 4 <> 0 THEN '1' ELSE '-' END"}
DEFAULTS = {name: "'-'" if default is None else "''" for name, kind, default in schema.FIELDS}


@query(f"WITH {PARTS_SQL} SELECT p_partkey, concat_ws('|', {', '.join(KNOWN.get(n, DEFAULTS[n]) for n in TEXT_FIELDS)}) AS texts FROM p")
def b3_ordered_values(spark, d):
    """The values of all text fields by their place, from columns in another order: names and values stay together."""
    rows = canonical(spark, d)
    out = schema.ordered(rows.select(F.lit(1).alias("extra"), *reversed(rows.columns)))
    places = [i for i, (_, kind, _) in enumerate(schema.FIELDS) if kind == "string"]
    return out.select(F.col("product_id").cast("long").alias("p_partkey"), F.concat_ws("|", *(F.coalesce(out[i], F.lit("-")) for i in places)).alias("texts"))


# ---- JSON-LD parts ---------------------------------------------------------------------------------


def node(text: Column) -> Column:
    return F.parse_json(text)


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'http://i/1' WHEN 1 THEN 'http://i/1|http://i/2?a&b' WHEN 2 THEN 'http://c/' || p_partkey ELSE '' END AS images FROM part")
def c5_images(spark, d):
    k = F.col("p_partkey")
    text = (
        F.when(k % 4 == 0, '"http://i/1"').when(k % 4 == 1, '["http://i/1", {"@type": "ImageObject", "url": "http://i/2?a&amp;b"}, "http://i/1"]')
        .when(k % 4 == 2, F.concat(F.lit('{"contentUrl": "http://c/'), k.cast("string"), F.lit('", "url": "http://u"}'))).otherwise("null")
    )
    return table(spark, d, "part").select("p_partkey", F.array_join(jsonld.decoded_list(jsonld.images(node(text))), "|").alias("images"))


PRICE_2 = "CAST(p_retailprice AS DECIMAL(18,2))"


@query(f"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {PRICE_2} WHEN 1 THEN 10.50 END AS price, CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'SEK' END AS currency, CASE p_partkey % 3 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'out_of_stock' ELSE '' END AS availability, CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS n FROM part")
def c6_offers(spark, d):
    k = F.col("p_partkey")
    text = (
        F.when(k % 3 == 0, F.concat(F.lit('{"offers": {"price": "'), F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit('", "priceCurrency": "USD", "availability": "https://schema.org/InStock"}}')))
        .when(k % 3 == 1, '{"offers": [{"lowPrice": 20, "availability": ""}, {"price": "10,50", "priceCurrency": "SEK", "availability": "Sold Out"}]}').otherwise('{"name": "x"}')
    )
    return table(spark, d, "part").select("p_partkey", jsonld.offers(node(text)).alias("o")).select("p_partkey", "o.price", "o.currency", "o.availability", F.size("o.offers").alias("n"))


FORMS = ("https://schema.org/InStock", "in stock", "Out-of-Stock", "SoldOut", "Discontinued", "pre_order", "", "unknown")


@query("SELECT p_partkey, ['in_stock', 'in_stock', 'out_of_stock', 'out_of_stock', 'out_of_stock', 'preorder', '', ''][CAST(p_partkey % 8 + 1 AS INTEGER)] AS availability FROM part")
def c7_availability(spark, d):
    raw = F.get(F.array(*map(F.lit, FORMS)), (F.col("p_partkey") % 8).cast("int"))
    return table(spark, d, "part").select("p_partkey", jsonld.availability(raw).alias("availability"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(1000000 + p_partkey AS VARCHAR) WHEN 1 THEN '14' WHEN 2 THEN '8' END AS gtin FROM part")
def c8_gtin(spark, d):
    k = F.col("p_partkey")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit('{"gtin": "9", "gtin13": "'), (k + 1000000).cast("string"), F.lit('"}')))
        .when(k % 4 == 1, '{"gtin13": "", "gtin14": "14", "gtin8": "8"}').when(k % 4 == 2, '{"gtin8": 8, "gtin": "9"}').otherwise("{}")
    )
    return table(spark, d, "part").select("p_partkey", jsonld.gtin(node(text)).alias("gtin"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN 4.50 END AS rating, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS BIGINT) ELSE -1 END AS review_count FROM part")
def c9_rating(spark, d):
    k = F.col("p_partkey")
    text = (
        F.when(k % 3 == 0, F.concat(F.lit('{"aggregateRating": {"ratingValue": "4,50", "ratingCount": '), k.cast("string"), F.lit("}}")))
        .when(k % 3 == 1, '{"aggregateRating": {"ratingValue": 4.5, "reviewCount": "about 12"}}').otherwise("{}")
    )
    return table(spark, d, "part").select("p_partkey", jsonld.rating(node(text)).alias("r")).select("p_partkey", "r.rating", F.coalesce("r.review_count", F.lit(-1)).alias("review_count"))


DEEP_SQL = "SELECT 'http://p/' || p_partkey AS url, name FROM part, (VALUES ('in a graph of a graph'), ('in a nested list'), ('wrapper')) AS v(name)"


@query(DEEP_SQL)
def c2_nodes_of_nested_graphs(spark, d):
    """A wrapper whose graph holds a wrapper, and a list in a list."""
    text = '{"name": "wrapper", "@graph": [{"@graph": [{"name": "in a graph of a graph"}]}, [[{"name": "in a nested list"}]]]}'
    pages = C.spread(table(spark, d, "part")).select(F.lit("s").alias("source"), F.concat(F.lit("http://p/"), F.col("p_partkey").cast("string")).alias("url"), C.page(F.lit(text)).alias("html"))
    return jsonld.nodes(jsonld.blocks(pages)).select("url", jsonld.get(F.col("node"), "$.name").alias("name")).where("name IS NOT NULL")


@query("SELECT 'http://p/' || p_partkey AS url, CAST(p_partkey AS VARCHAR) AS sku, p_partkey % 12 + 1 AS n_nodes FROM part")
def c3_find_at_any_depth(spark, d):
    """A product under one to twelve wrappers, lists and graphs by turns, is found; each wrapper object is a node too."""
    k = F.col("p_partkey")
    deep = F.expr("""concat(array_join(transform(sequence(1, cast(p_partkey % 12 + 1 AS int)), i -> if(i % 2 = 0, '[{"@graph": [', '{"@graph": [')), ''), '{"@type": ["Thing", "PRODUCT"], "sku": ', p_partkey, '}',
      array_join(transform(sequence(cast(p_partkey % 12 + 1 AS int), 1), i -> if(i % 2 = 0, ']}]', ']}')), ''))""")
    pages = C.spread(table(spark, d, "part")).select(F.lit("s").alias("source"), F.concat(F.lit("http://p/"), k.cast("string")).alias("url"), C.page(deep).alias("html"))
    count = jsonld.nodes(jsonld.blocks(pages)).groupBy("url").agg((F.count("*") - 1).alias("n_nodes"))
    return jsonld.find(pages).select("url", jsonld.get(F.col("node"), "$.sku").alias("sku")).join(count, "url")


# ---- storefront parts ------------------------------------------------------------------------------

VARIANTS_SQL = f"{C.LINES_SQL}, v AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey, l_returnflag, lp) - 1 AS i FROM l)"


@query(f"WITH {VARIANTS_SQL} SELECT CAST(l_partkey * 1000 + i AS VARCHAR) AS platform_variant_id, l_returnflag AS color, 'M' AS size, lp AS price, CAST(lp + 10 AS DECIMAL(18,2)) AS original_price, CAST(l_suppkey AS VARCHAR) AS sku, l_returnflag = 'N' AS available, sha256(sha256('shop:pid:' || l_partkey) || ':sku:' || l_suppkey) AS variant_id FROM v JOIN part ON p_partkey = l_partkey")
def c13_variants(spark, d):
    out = once(storefront.map_products(io.read_raw_shopify(C.storefront_payloads(spark, d))).select("variants"), "variants").select(F.explode("variants").alias("v"))
    return out.select("v.platform_variant_id", "v.color", "v.size", "v.price", "v.original_price", "v.sku", "v.available", "v.variant_id")


@query(f"WITH {C.LINES_SQL} SELECT l_partkey, price, CASE WHEN was > price THEN was END AS original_price, CASE WHEN suppliers = 1 THEN CAST(supplier AS VARCHAR) END AS sku, '12345678' AS barcode, '12345678' AS gtin, CASE WHEN stock THEN 'in_stock' ELSE 'out_of_stock' END AS availability FROM r")
def c15_rollups(spark, d):
    each = F.transform("vs", lambda v: schema.variant(price=v["lp"], original_price=v["lp"] + 10, sku=v["l_suppkey"], barcode=F.lit("12345678"), available=v["l_returnflag"] == "N"))
    out = storefront.rollups(C.lines_of(spark, d).select("l_partkey", each.alias("variants")))
    return out.select("l_partkey", "price", "original_price", "sku", "barcode", "gtin", "availability")


# ---- scope, rules on texts that hit ----------------------------------------------------------------

NOUN_SQL = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN ' {n}'" for i, n in enumerate(C.NOUNS)) + " END"
HIT_TEXT = f"lower(coalesce(text, '') || ' ' || {NOUN_SQL})"


def with_nouns(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr(f"concat(coalesce(text, ''), ' ', {NOUN_SQL})").alias("text"))


@query(f"SELECT doc_id, {C.sql_match(HIT_TEXT, rules.FOOTWEAR)} AS footwear, {sql_rules(HIT_TEXT, C.N.DESCRIPTION_RULES, chr(39) * 2)} AS category, {sql_rules(HIT_TEXT, scope.DESCRIPTION, chr(39) + 'out_of_scope' + chr(39))} AS scope FROM documents")
def d1_d3_f2_on_texts_that_hit(spark, d):
    """Whole documents, each with a garment noun (or none) behind its text."""
    text = F.col("text")
    return with_nouns(spark, d).select("doc_id", C.keyword_match(F.lower(text), rules.FOOTWEAR).alias("footwear"), C.N.category_from_description(text).alias("category"), scope.scope_label(F.lit(""), text).alias("scope"))


RECORD_SQL = f"""{PARTS_SQL}, t AS (SELECT p_partkey, lower(CASE WHEN p_partkey % 4 = 0 THEN 'shoes' ELSE 'things' END || ' ' || p_name || CASE WHEN p_partkey % 4 = 1 THEN ' home headphones' ELSE '' END || CASE WHEN p_partkey % 4 = 2 THEN ' jacket' ELSE '' END) AS h FROM p),
f AS (SELECT p_partkey, {C.SCOPE_SQL} AS l FROM t), s AS (SELECT p_partkey, CASE WHEN l = 'out_of_scope' AND p_partkey % 3 = 0 THEN 'clothing' ELSE l END AS l FROM f)"""


@query(f"WITH {RECORD_SQL} SELECT p_partkey, l IN ('footwear', 'clothing') AS is_supported, CASE WHEN l IN ('footwear', 'clothing') THEN l END AS scope_type, CASE WHEN l NOT IN ('footwear', 'clothing') THEN l END AS reason FROM s")
def f3_classify_record(spark, d):
    """Category, title, breadcrumbs, tags and description of canonical rows."""
    k = F.col("p_partkey")
    some = schema.attributes(breadcrumbs=F.when(k % 4 == 1, F.array(F.lit("Home"), F.lit("Headphones"))), tags=F.when(k % 4 == 2, F.array(F.lit("Jacket"))))
    rows = parts(spark, d).select("p_partkey", F.when(k % 4 == 0, "shoes").otherwise("things").alias("category"), F.lit("").alias("subcategory"), F.col("p_name").alias("title"), some.alias("attributes"), F.when(k % 3 == 0, "a silk gown").alias("description"))
    return rows.select("p_partkey", scope.classify_record().alias("s")).select("p_partkey", "s.is_supported", "s.scope_type", F.col("s.rejection_reason").alias("reason"))


# ---- stages ----------------------------------------------------------------------------------------


def product_rows(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    raw = C.spread(parts(spark, d)).select(
        k.cast("string").alias("product_id"), F.concat(F.lit("Store#"), (k % 4).cast("string")).alias("source"), F.concat(F.lit("  "), "title", F.lit(" ")).alias("title"), F.when(k % 5 != 0, F.col("price")).alias("price"),
        F.when(k % 2 == 0, F.col("price")).otherwise(F.col("price") + 5).alias("original_price"), F.when(k % 3 == 0, "usd").when(k % 3 == 1, "??").alias("currency"), F.col("p_brand").alias("brand"),
        F.when(k % 7 != 0, F.array(F.lit(" http://i/1 "), F.lit(""), F.concat(F.lit("http://i/"), k.cast("string")), F.lit("HTTP://I/1"))).alias("image_urls"), F.array(F.lit("navy"), F.lit("GREY")).alias("colors"),
        F.concat(F.lit("http://p/"), k.cast("string")).alias("product_url"), F.when(k % 6 == 0, F.concat(F.lit("a "), F.lit("silk gown"))).alias("description"), F.timestamp_seconds(k).alias("scraped_at"),
    )
    return C.schema_plus(raw)


def key() -> Column:
    return F.col("product_id").cast("long").alias("p_partkey")

IMAGES_SQL = "CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey = 1 THEN 'http://i/1' ELSE 'http://i/1|http://i/' || p_partkey END"


@query(f"WITH {PARTS_SQL} SELECT p_partkey, title, {IMAGES_SQL} AS images, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'http://i/1' END AS main_image, lower(p_brand) AS brand_normalized, {C.sql_color(chr(39) + 'navy' + chr(39))} || '|' || {C.sql_color(chr(39) + 'GREY' + chr(39))} AS colors FROM p")
def g1_clean(spark, d):
    return stages.clean(product_rows(spark, d)).select(key(), "title", F.array_join("image_urls", "|").alias("images"), "main_image", "brand_normalized", F.array_join("colors", "|").alias("colors"))


@query(f"WITH {PARTS_SQL} SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN price END AS price, CASE WHEN p_partkey % 2 <> 0 THEN CAST(price + 5 AS DECIMAL(18,2)) WHEN p_partkey % 5 = 0 THEN price END AS original_price, CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'EGP' END AS currency, CASE WHEN p_partkey % 2 = 0 THEN 3.00 END AS variant_original, 'SEK' AS variant_currency FROM p")
def g2_normalize_prices(spark, d):
    v = schema.variant(price=F.lit(2), original_price=F.when(F.col("product_id").cast("long") % 2 == 0, 3).otherwise(2), currency=F.lit("sek"))
    out = stages.normalize_prices(product_rows(spark, d).withColumn("variants", F.array(v)))
    return out.select(key(), "price", "original_price", "currency", F.col("variants")[0]["original_price"].alias("variant_original"), F.col("variants")[0]["currency"].alias("variant_currency"))


CATEGORY_SQL = f"{PARTS_SQL}, c AS (SELECT *, {sql_rules('lower(title)', rules.CATEGORY_RULES, chr(39) * 2)} AS c1, {C.sql_gender('lower(title)')} AS gender FROM p)"
FILLED_SQL = "CASE WHEN c1 <> '' THEN c1 WHEN p_partkey % 6 = 0 THEN 'dresses' ELSE '' END"


@query(f"WITH {CATEGORY_SQL} SELECT p_partkey, {FILLED_SQL} AS category, gender FROM c")
def g3_backfill_category(spark, d):
    return stages.backfill_category(stages.clean(product_rows(spark, d))).select(key(), "category", "gender")


STAGE_SQL = f"{CATEGORY_SQL}, t AS (SELECT *, trim({FILLED_SQL} || ' ' || lower(title)) AS h FROM (SELECT * EXCLUDE (h) FROM c)), s AS (SELECT *, {C.SCOPE_SQL} AS l0 FROM t), g AS (SELECT *, CASE WHEN l0 = 'out_of_scope' AND p_partkey % 6 = 0 THEN 'clothing' ELSE l0 END AS l FROM s)"


def staged(spark, d) -> DataFrame:
    return stages.add_scope(stages.backfill_category(stages.normalize_prices(stages.clean(product_rows(spark, d)))))


@query(f"WITH {STAGE_SQL} SELECT p_partkey, l IN ('footwear', 'clothing') AS is_supported, CASE WHEN l NOT IN ('footwear', 'clothing') THEN l END AS reason FROM g")
def g5_scope(spark, d):
    return staged(spark, d).select(key(), "scope.is_supported", F.col("scope.rejection_reason").alias("reason"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 8 = 7 AND p_name = '' THEN 'title' END, CASE WHEN p_partkey % 5 = 0 THEN 'price' END, CASE WHEN p_partkey % 7 = 0 AND NOT (p_partkey % 2 = 0 AND p_partkey % 5 <> 0) THEN 'image_urls' END], lambda x: x IS NOT NULL), ',') AS missing FROM part")
def g6_validate(spark, d):
    """Stores of even keys need no images."""
    return stages.clean(product_rows(spark, d)).select(key(), F.array_join(stages.invalid(F.col("product_id").cast("long") % 2 != 0), ",").alias("missing"))


HASH_TEXT = """'{"availability":"","brand":"' || p_brand || '","category":"","description":' || CASE WHEN p_partkey % 6 = 0 THEN '"a silk gown"' ELSE '""' END || ',"gender":"","image_urls":'
|| CASE WHEN p_partkey % 7 = 0 THEN '[]' WHEN p_partkey = 1 THEN '["http://i/1"]' ELSE '["http://i/1","http://i/' || p_partkey || '"]' END || ',"original_price":' || CAST(CASE WHEN p_partkey % 2 = 0 THEN price ELSE price + 5 END AS VARCHAR)
|| ',"price":' || CASE WHEN p_partkey % 5 <> 0 THEN CAST(price AS VARCHAR) ELSE 'null' END || ',"title":"' || title || '","variants":[]}'"""


@query(f"WITH {PARTS_SQL} SELECT p_partkey, sha256({HASH_TEXT}) AS content_hash FROM p")
def h1_content_hash(spark, d):
    return stages.clean(product_rows(spark, d)).select(key(), changes.content_hash().alias("content_hash"))


@query(f"WITH {PARTS_SQL} SELECT p_partkey, sha256({HASH_TEXT}) AS content_hash, make_timestamp(CAST(p_partkey AS BIGINT) * 1000000) AS last_seen, CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2020-01-01' ELSE make_timestamp(CAST(p_partkey AS BIGINT) * 1000000) END AS first_seen FROM p")
def g7_stamp(spark, d):
    rows = stages.clean(product_rows(spark, d)).withColumn("first_seen", F.when(F.col("product_id").cast("long") % 2 == 0, F.lit("2020-01-01").cast("timestamp")))
    return stages.stamp(rows).select(key(), "content_hash", "last_seen", "first_seen")


@query("SELECT user_id % 3 AS kind, count(*) AS n FROM events WHERE user_id % 3 < 2 GROUP BY 1")
def e1_map_errors(spark, d):
    """Rows without an id, counted with a reason instead of vanishing in the dedup."""
    k = F.col("user_id")
    some = table(spark, d, "events").select("user_id", C.ids.product_id(F.when(k % 3 == 0, " ").otherwise("m"), F.when(k % 3 == 2, k.cast("string")), F.lit(""), F.lit(None).cast("string")).alias("product_id"))
    return stages.map_errors(some).groupBy((k % 3).alias("kind")).agg(F.count("*").alias("n"))


@query(f"WITH {STAGE_SQL} SELECT p_partkey, l AS scope_type, 'Store#' || (p_partkey % 4) AS source FROM g WHERE l IN ('footwear', 'clothing') AND p_partkey % 4 <> 1")
def i6_apply_scope(spark, d):
    """All rows are stored, then those in scope: a source that is wholly out of scope keeps none of its rows."""
    at = new_path(spark, "scope")
    judged = new_path(spark, "judged")
    schema.ordered(staged(spark, d)).write.parquet(judged)  # judged once for all that reads it
    rows = spark.read.parquet(judged)
    io.write_catalog(rows, at)
    out = F.struct(F.lit(False).alias("is_supported"), F.lit(None).cast("string").alias("scope_type"), F.lit("out_of_scope").alias("rejection_reason"))
    report.apply_scope(rows.withColumn("scope", F.when(F.col("source") == "Store#1", out).otherwise(F.col("scope"))), at)
    return io.read_written_catalog(spark, at).select(key(), "scope.scope_type", "source")


@query(f"WITH {C.ARRIVALS_SQL} SELECT CAST(user_id AS VARCHAR) AS product_id, ts AS scraped_at, CASE l WHEN 'footwear' THEN 'footwear' ELSE 'clothing' END AS scope_type FROM k WHERE stage IS NULL")
def g8_accepted(spark, d):
    """The accepted rows alone, without moving the repeats."""
    stores = C.store_flags(spark)
    return stages.accepted_products(arrivals(spark, d), stores, ("scraped_at", "seq")).select("product_id", "scraped_at", "scope.scope_type")


@query(C.ORACLE["i2_pipeline_report"])
def i2_report_of_written(spark, d):
    """The counts from the rows that one write of the pipeline left."""
    stores = C.store_flags(spark)
    return stages.write_pipeline(arrivals(spark, d), new_path(spark, "outcomes"), stores, ("scraped_at", "seq"))[2]


# ---- the stored tables -------------------------------------------------------------------------------


def synced_store(spark, d) -> str:
    """A store of offers without images, brought in step with the catalog."""
    at = new_path(spark, "store")
    have = C.stored(spark, d)
    offers.create_store(have, have.select("product_url", "image_url").where("false"), at, 16)
    offers.sync_stored(C.catalog(spark, d), at)
    return at


@query(C.ORACLE["h12_sync"])
def h12_sync_write(spark, d):
    """The offers after the write."""
    return offers.read_offers(spark, synced_store(spark, d))


@query(f"WITH {C.STORED_SQL} SELECT DISTINCT product_url, 'http://i/' || p_partkey AS image_url FROM g WHERE p_partkey % 2 = 1 OR p_partkey % 7 = 0")
def h12_sync_images(spark, d):
    """The images after the write: those of inserted and updated offers."""
    return offers.read_images(spark, synced_store(spark, d))


# ---- streams ---------------------------------------------------------------------------------------


def first_arrivals(spark, d) -> DataFrame:
    return schema.ordered(stages.dedup(arrivals(spark, d), ("scraped_at", "seq")))


@query(f"WITH {C.ARRIVALS_SQL} SELECT CAST(user_id AS VARCHAR) AS product_id, CASE l WHEN 'footwear' THEN 'footwear' ELSE 'clothing' END AS scope_type FROM k WHERE stage IS NULL")
def k1_streaming_pipeline(spark, d):
    """Each product's first arrival twice, as a stream, with the store flags of the batch pipeline."""
    at = new_path(spark, "stream")
    rows = first_arrivals(spark, d)
    rows.unionByName(rows).write.parquet(f"{at}/in")
    stores = C.store_flags(spark)
    out = pipeline.streaming_pipeline(spark.readStream.schema(rows.schema).parquet(f"{at}/in"), stores=stores)
    run = out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ck").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{at}/out").select("product_id", "scope.scope_type")


@query(C.ORACLE["g8_pipeline"])
def k1_classify_stream(spark, d):
    """All arrivals in two batches that mix early and late rows: each row's verdict is that of the batch pipeline."""
    at = new_path(spark, "verdicts")
    rows = arrivals(spark, d)
    stores = C.store_flags(spark)
    spark.conf.set(*pipeline.STATE_STORE)
    # a row of a later time: once it is there, what has been held back is let go
    closing = rows.limit(1).withColumns({"product_id": F.lit("closing"), "scraped_at": F.lit("2100-01-01").cast("timestamp")})
    for batch in (rows.where("seq % 3 = 2"), rows.where("seq % 3 <> 2").unionByName(closing)):
        batch.write.mode("append").parquet(f"{at}/in")
        told = pipeline.classify_stream(spark.readStream.schema(rows.schema).parquet(f"{at}/in"), "400 days", stores, ("scraped_at", "seq"))
        run = told.select(F.col("seq").alias("event_id"), F.col("reject_stage").alias("stage"), F.col("reject_reason").alias("reason"))
        run.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ck").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id bigint, stage string, reason string").parquet(f"{at}/out")


@query(f"SELECT source, product_id, content_hash, first_seen, CASE WHEN last_seen >= TIMESTAMP '{C.HALF}' THEN last_seen + INTERVAL 1 DAY ELSE last_seen END AS last_seen, high_water + INTERVAL 1 DAY AS high_water FROM ({STATE_SQL})")
def k2_state_compacted(spark, d):
    """Three batches, the last of which has no hashes and a later time; the second compacts the log; the first comes again."""
    at = new_path(spark, "state")
    none, seen = F.lit(None).cast("timestamp"), F.col("scraped_at")
    rec = lambda late: C.snapshot(spark, d, late).withColumns({"first_seen": none, "last_seen": none, "source_updated_at": seen})
    bare = C.snapshot(spark, d, True).withColumns({"content_hash": F.lit(None).cast("string"), "scraped_at": seen + F.expr("INTERVAL 1 DAY")})
    bare = bare.withColumns({"first_seen": none, "last_seen": none, "source_updated_at": F.col("scraped_at")})
    for n, batch in enumerate((rec(False), rec(True), bare)):
        pipeline.add_batch(batch, n, at, "crawl", buckets=8, most_entries=2)
    pipeline.add_batch(rec(False), 0, at, "crawl")
    versions.vacuum(spark, at)
    return pipeline.current_state(spark, at)


@query(STATE_SQL)
def k2_streaming_upsert(spark, d):
    """Two snapshots as two batches of a stream of records, and the state that their log holds."""
    at = new_path(spark, "upsert")
    none, seen = F.lit(None).cast("timestamp"), F.col("scraped_at")
    rec = lambda late: C.snapshot(spark, d, late).withColumns({"first_seen": none, "last_seen": none, "source_updated_at": seen})
    for late in (False, True):
        rows = rec(late)
        rows.write.mode("append").parquet(f"{at}/in")
        pipeline.upsert_state(spark.readStream.schema(rows.schema).parquet(f"{at}/in"), f"{at}/state", f"{at}/ck").awaitTermination()
    return pipeline.current_state(spark, f"{at}/state")
