"""Golden cases, edge cases, file round trips and streams of the catalog library."""

import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomcat.functions import embed, ids
from loomcat.functions import normalize as N
from loomcat.functions.scope import scope_label
from loomcat.functions.text import html_text, title_case
from loomcat.operators import changes, report
from loomcat.plans import stages
from loomcat.sources import io
from loomcat.streaming import pipeline

def none():
    return F.lit(None).cast("string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [("Maxi Skirt", "skirts"), ("denim overalls", "jumpsuits"), ("laptop", ""), ("orienteering", ""), ("graphic tees", "t-shirts"), ("قميص أبيض", "shirts"), ("", ""), (None, "")],
)
def test_category(spark, text, want):
    assert one(spark, N.category(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("BLUE / WHITE", "Blue"), ("off-whitish", "Off-Whitish"), ("it's", "It'S"), ("Grey", "Gray"), ("", ""), (None, ""), (" أسود ", "Black")])
def test_color(spark, text, want):
    assert one(spark, N.color(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(
    "text, want",
    [("1.234,50", "1234.50"), ("1,234.50", "1234.50"), ("1,50", "1.50"), ("1,234", "1234.00"), ("abc", None), ("1,234,50", None), ("L.E. 500", None), ("L.E 500", "0.50"), ("١٢٫٥", "125.00"), (None, None), ("", None), (".", None), ("12.", "12.00"), ("1.005", "1.01")],
)
def test_price(spark, text, want):
    assert one(spark, N.to_decimal(F.lit(text).cast("string"))) == (want and Decimal(want))


@pytest.mark.parametrize("text, want", [("LE", "EGP"), ("$", "USD"), ("sek", "SEK"), ("xx", "EGP"), (None, "EGP")])
def test_currency(spark, text, want):
    assert one(spark, N.currency(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("Men Women tee", "unisex"), ("boys tee", "kids"), ("women's dress", "women"), ("mens", "men"), ("comment", ""), (None, "")])
def test_gender(spark, text, want):
    assert one(spark, N.gender(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("url, want", [("http://a.com/b/?q=1#f", "http://a.com/b"), ("HTTP://a.com/", "http://a.com"), (None, ""), ("", ""), (" https://a.com/x// ", "https://a.com/x")])
def test_canonical_url(spark, url, want):
    assert one(spark, N.canonical_url(F.lit(url).cast("string"))) == want


@pytest.mark.parametrize("title, text, want", [("dress shoe", None, "footwear"), ("smartwatch", None, "electronics"), ("Vivienne", "a silk dress", "clothing"), ("Vivienne", None, "out_of_scope"), ("bootcut", "top players", "out_of_scope")])
def test_scope(spark, title, text, want):
    assert one(spark, scope_label(F.lower(F.lit(title)), F.lit(text).cast("string"))) == want


def test_small_functions(spark):
    assert one(spark, html_text(F.lit("<p>a &amp; b</p>\n <i>c&nbsp;d</i>"))) in ("a & b c d", "a & b c\xa0d")
    assert one(spark, html_text(none())) == ""
    assert one(spark, title_case(F.lit("off-white blue"))) == "Off-White Blue"
    assert one(spark, N.clean_list(F.array(F.lit(" a "), none(), F.lit("A"), F.lit("")))) == ["a"]
    assert one(spark, N.clean_list(F.lit(None).cast("array<string>"))) == []
    assert one(spark, ids.product_id(F.lit("m"), none(), none(), none())) is None
    assert one(spark, ids.parse_offer_key(F.lit("u||a||b"))) == ("u", "a||b")
    assert one(spark, embed.average_embeddings(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0)), strict=False)) is None
    with pytest.raises(Exception, match="lengths differ"):
        one(spark, embed.average_embeddings(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0))))
    text = embed.embedding_text(F.lit("men"), F.lit("hoodies"), none(), F.lit("Acme"), none(), F.lit("Oversized Cotton Hoodie"), F.array(F.lit("Black"), F.lit("Olive")), F.array(F.lit("cotton")), none())
    assert one(spark, text) == "men's hoodies. by Acme. Oversized Cotton Hoodie. color Black, Olive. material cotton"
    nothing = F.lit(None).cast("array<string>")
    assert one(spark, embed.embedding_text(none(), none(), none(), none(), none(), none(), nothing, nothing, F.lit("a b"))) == ". a b"


def test_delta_golden(spark):
    old = spark.createDataFrame([("1", "aaa111"), ("2", "bbb222"), ("3", "ccc333"), ("", "x")], "id string, h string")
    new = spark.createDataFrame([("1", "aaa111"), ("2", "bbb999"), ("4", "ddd444"), (None, "y")], "id string, h string")
    got = {r.id: r.change for r in changes.calculate_delta(old, new, ("id",), "h", "h").collect()}
    assert got == {"1": "unchanged", "2": "updated", "3": "deleted", "4": "new"}


def rows(spark, *items):
    base = spark.createDataFrame(list(items), "product_id string, source string, title string, price decimal(18,2), image_urls array<string>, product_url string, seq int")
    from loomcat.catalog_queries import schema_plus

    return schema_plus(base.withColumn("scraped_at", F.timestamp_seconds(F.col("seq"))), "seq")


def test_pipeline_edges(spark):
    raw = rows(
        spark, ("a", "s", " Blue  tee ", Decimal(5), ["i"], "u", 1), ("a", "s", "tee", Decimal(6), ["i"], "u", 2), ("b", "s", "laptop", Decimal(5), ["i"], "u", 3), ("c", "s", "tee", None, ["i"], "u", 4),
        ("d", "t", "tee", Decimal(0), None, "u", 5), (None, "s", "tee", Decimal(1), ["i"], "u", 6), ("e", None, None, None, None, None, 7),
    )
    stores = spark.createDataFrame([("t", False)], "source string, require_images boolean")
    good, bad = stages.run_pipeline(raw, stores, ("scraped_at", "seq"))
    assert {r.product_id for r in good.collect()} == {"a", "d"}
    assert {(r.product_id, r.reject_stage, r.reject_reason) for r in bad.collect()} == {("a", "dedup", "duplicate"), ("b", "scope", "electronics"), ("c", "validate", "price"), ("e", "scope", "out_of_scope")}
    assert stages.classify_rows(raw.limit(0), None, ("scraped_at", "seq")).count() == 0
    assert report.pipeline_report(stages.classify_rows(raw.limit(0), None, ("scraped_at", "seq"))).count() == 0


def test_catalog_round_trip(spark, tmp_path):
    path = str(tmp_path / "catalog")
    good = rows(spark, ("a", "s", "tee", Decimal("5.10"), ["i"], "u", 1), ("b", "t", "tee", Decimal(6), ["i"], "u", 2)).drop("seq")
    io.write_catalog(good, path)
    io.write_catalog(good.where("source = 's'").withColumn("title", F.lit("new")), path)
    got = {r.product_id: (r.title, r.price) for r in io.read_written_catalog(spark, path).collect()}
    assert got == {"a": ("new", Decimal("5.10")), "b": ("tee", Decimal("6.00"))}


def test_json_sources(spark, tmp_path):
    (tmp_path / "x_products.json").write_text('[{"product_id": "1", "title": "a"}, {"product_id": "2"}]')
    got = io.read_catalog(spark, str(tmp_path)).select("product_id", "title", "file_name").collect()
    assert {(r.product_id, r.title, r.file_name) for r in got} == {("1", "a", "x_products.json"), ("2", None, "x_products.json")}
    (tmp_path / "y.jsonl").write_text('{"product_id": "1"}\n\nnot json\n{"product_id": "2"}\n')
    assert {r.product_id for r in io.read_jsonl(spark, str(tmp_path / "y.jsonl")).collect()} == {"1", "2"}
    (tmp_path / "s_crawl_report.json").write_text('{"store": "s", "requests": 3, "scope_rejected_breakdown": {"accessory": 2}}')
    r = io.read_crawl_reports(spark, str(tmp_path / "*_crawl_report.json")).first()
    assert (r.store, r.requests, r.scope_rejected_breakdown) == ("s", 3, {"accessory": 2})
    bodies = spark.createDataFrame([("s", "[]"), ("s", "junk"), ("s", '{"products": [{"id": 1, "title": "t"}]}'), ("s", None)], "source string, body string")
    assert [r.product.id for r in io.read_raw_shopify(bodies).collect()] == [1]
    stores = spark.createDataFrame([("a", True, 1), ("a", False, 2), ("b", True, 3)], "source string, confirmed boolean, position int")
    assert {r.source for r in io.confirmed_sources(stores).collect()} == {"b"}


def test_stream_equals_batch(spark, tmp_path):
    raw = rows(spark, ("a", "s", "tee", Decimal(5), ["i"], "u", 1), ("b", "s", "laptop", Decimal(5), ["i"], "u", 2), ("c", "s", "hoodie", Decimal(5), ["i"], "u", 3)).drop("seq")
    raw.unionByName(raw).write.parquet(str(tmp_path / "in"))
    stream = pipeline.streaming_pipeline(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.product_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"a", "c"}
    records = spark.readStream.schema(spark.read.parquet(str(tmp_path / "out")).schema).parquet(str(tmp_path / "out"))
    pipeline.upsert_state(records, str(tmp_path / "state"), str(tmp_path / "ck2")).awaitTermination(120)
    assert {r.product_id for r in pipeline.current_state(spark, str(tmp_path / "state")).collect()} == {"a", "c"}
    assert io.read_state(spark, str(tmp_path / "nowhere")).count() == 0


def test_entry_without_llm(tmp_path):
    """The entry module imports and lists the catalog's queries when loomcat/llm and corpus_pipeline.py are gone."""
    import shutil

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "loomcat", tmp_path / "loomcat", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'i5_scope_audit' in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)


def test_apply_scope(spark, tmp_path):
    path = str(tmp_path / "kept")
    raw = rows(spark, ("a", "s", "tee", Decimal(5), ["i"], "u", 1), ("b", "s", "laptop", Decimal(5), ["i"], "u", 2), ("c", "t", "boots", Decimal(5), ["i"], "u", 3)).drop("seq")
    report.apply_scope(stages.add_scope(raw), path)
    got = {r.product_id: r.scope.scope_type for r in io.read_written_catalog(spark, path).collect()}
    assert got == {"a": "clothing", "c": "footwear"}


def test_defaults(spark):
    from loomcat.sources import schema

    r = schema.with_defaults(spark.createDataFrame([(None, 1.005, "x")], "title string, price double, other string")).first()
    assert (r.title, r.currency, r.image_urls, r.color_images, r.variants, r.sku) == ("", "EGP", [], {}, [], None)
    assert tuple(r.asDict()) == schema.NAMES


def test_missing_hashes_are_computed(spark):
    old = rows(spark, ("a", "s", "tee", Decimal(5), ["i"], "u", 1), ("b", "s", "tee", Decimal(5), ["i"], "u", 2), ("c", "s", "cap", Decimal(5), ["i"], "u", 3)).drop("seq")
    new = old.where("product_id <> 'c'").withColumn("title", F.when(F.col("product_id") == "b", "boots").otherwise(F.col("title")))
    hashed = new.withColumn("content_hash", changes.content_hash())
    for side in (new, hashed):
        got = {r.product_id: r.change for r in changes.detect_changes(old, side).collect()}
        assert got == {"a": "unchanged", "b": "updated", "c": "removed"}
    bare = spark.createDataFrame([("a", None), ("b", "h")], "product_id string, content_hash string")
    assert {r.product_id: r.change for r in changes.detect_changes(bare, bare).collect()} == {"a": "unchanged", "b": "unchanged"}


def test_delta_takes_the_last_of_repeated_old_rows(spark):
    old = spark.createDataFrame([("1", "zzz", 1), ("1", "aaa", 2)], "id string, h string, seq int")
    new = spark.createDataFrame([("1", "aaa", 1)], "id string, h string, seq int")
    assert [r.change for r in changes.calculate_delta(old, new, ("id",), "h", "seq").collect()] == ["unchanged"]


def test_state_log(spark, tmp_path):
    """A batch that is written again replaces itself; a state goes on from a compacted one."""
    ddl = "source string, product_id string, content_hash string, first_seen timestamp, last_seen timestamp, high_water timestamp"
    t = lambda n: F.timestamp_seconds(F.lit(n))
    row = lambda h, n: spark.range(1).select(F.lit("s").alias("source"), F.lit("p").alias("product_id"), F.lit(h).alias("content_hash"), t(n).alias("first_seen"), t(n).alias("last_seen"), t(n).alias("high_water"))
    assert row("x", 1).columns == [c.split()[0] for c in ddl.split(", ")]
    for batch, h, n in ((0, "x", 10), (1, "y", 20), (1, "y", 20)):
        row(h, n).write.mode("overwrite").parquet(f"{tmp_path}/log/batch={batch}")
    state = pipeline.current_state(spark, f"{tmp_path}/log")
    read = lambda df: [(r.content_hash, r.first_seen.timestamp(), r.last_seen.timestamp(), r.high_water.timestamp()) for r in df.collect()]
    assert [x[0] for x in read(state)] == ["y"] and read(state)[0][2] - read(state)[0][1] == 10
    row("z", 30).write.parquet(f"{tmp_path}/next/batch=0")
    after = pipeline.current_state(spark, f"{tmp_path}/next", base=state)
    assert [x[0] for x in read(after)] == ["z"] and read(after)[0][2] - read(after)[0][1] == 20
    assert pipeline.current_state(spark, f"{tmp_path}/none").count() == 0


def test_jsonld_choice(spark):
    """A group at any place beats a Product before it; a Product in a nested list or graph is found; other scripts are skipped."""
    from loomcat.operators import jsonld

    def page(*bodies):
        return "".join(f"<SCRIPT data-x='1' TYPE=application/ld+json >{b}</SCRIPT>" for b in bodies) + "<script>var type='application/ld+json'</script>"

    pages = [
        ("a", page('{"@type": "Product", "name": "p"}', '[[{"@type": "ProductGroup", "name": "g"}]]')), ("b", page("junk", '{"@graph": [{"@graph": [{"@type": ["Thing", "PRODUCT"], "name": "deep"}]}]}')),
        ("c", page('{"@type": "WebPage"}')), ("d", None), ("e", page('{"hasVariant": [{"sku": 1}], "name": "v"}')),
    ]
    df = spark.createDataFrame([("s", u, h) for u, h in pages], "source string, url string, html string")
    names = lambda mode: {r.url: r.name for r in jsonld.find(df, mode).select("url", jsonld.get(F.col("node"), "$.name").alias("name")).collect()}
    assert names("product_or_group") == {"a": "g", "b": "deep", "e": "v"}
    assert names("product") == {"a": "p", "b": "deep"} and names("graph") == {"b": "deep"}
    assert jsonld.map_pages(df.limit(0)).count() == 0


def test_entities_cut_short(spark):
    """A name is read whole: &ampp is no entity, though it begins with one."""
    from loomcat.functions.text import html_text

    cases = {
        "and&amp</title><style>p{}": "and&ampp{}", "a &amp b": "a & b", "?a=1&region=2&copy;": "?a=1&region=2©", "&AMP;&Eacute;&eacute;&#233;&#xE9;": "&Éééé", "&#128;|&#129;|&#129 ": "€||&#129",
        "&#xD800;x&#99999999999;y&nosuch;z&nosuch": "xyz&nosuch", "&amp;amp;": "&amp;",
    }
    rows = spark.createDataFrame(list(cases.items()), "html string, want string").select(html_text(F.col("html")).alias("got"), "want").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    cut = html_text(F.lit("<h1>a&am</h1>p &amp</h1>&amp;&amp <b>&copy;</b>"), closed=True)
    assert one(spark, cut) == "a&amp &amp&&amp ©"
