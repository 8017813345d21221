"""Every catalog query against its DuckDB SQL."""

import pytest
from conftest import SMALL

from loomcat import catalog_queries as C
from loomcat import step_queries as S

QUERIES, ORACLE = C.QUERIES | S.QUERIES, C.ORACLE | S.ORACLE


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, same, name):
    got = QUERIES[name](spark, SMALL)
    if name in ORACLE:
        same(got, duck.sql(ORACLE[name]))
    else:
        assert got.count() > 0


def test_counts_add_up(spark):
    r = C.i2_pipeline_report(spark, SMALL).collect()
    assert r and all(x.scope_seen == x.scope_accepted + x.scope_rejected for x in r)


def test_sync_then_delta_is_empty(spark):
    from loomcat.operators import offers

    after, _ = offers.sync(C.stored(spark, SMALL), C.catalog(spark, SMALL))
    kinds = {r.change for r in offers.sync(after, C.catalog(spark, SMALL))[1].collect()}
    assert kinds == {"unchanged"}


def test_sitemaps_beyond_a_crawl_budget(spark):
    from loomcat.operators import links

    body = "<loc>http://a/x.xml</loc><loc>http://a/product/1</loc>" + "".join(f"<loc>http://a/{i}.xml</loc>" for i in range(300))
    pages = spark.createDataFrame([("s", 2, body), ("s", 1, "<loc> http://a/x.xml </loc><loc>http://a/product/1</loc>")], "source string, position int, html string")
    stores = spark.createDataFrame([("s", "/product/")], "source string, product_pattern string")
    rows = links.sitemap_urls(pages, stores).collect()
    assert len(rows) == 303 and [(r.position, r.at) for r in rows if r.loc == "http://a/x.xml"] == [(1, 0)]
    capped = links.sitemap_urls(pages, stores, sitemap_cap=200, product_cap=1).collect()
    assert sorted(r.kind for r in capped) == ["product"] + ["sitemap"] * 200


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_variants_are_made_once(spark):
    """Neither again in a filter below the explode, nor a product id for each variant."""
    from pyspark.sql import functions as F

    from loomcat.operators import storefront
    from loomcat.sources import io

    assert plan_of(S.c13_variants(spark, SMALL)).count("variant_id, sha2(") == 1
    made = storefront.map_products(io.read_raw_shopify(C.storefront_payloads(spark, SMALL))).select(F.explode(F.array("variants")).alias("v"))
    assert "url:" not in next(line for line in plan_of(made).splitlines() if "variant_id, sha2(" in line)


def test_pages_are_dealt_over_all_tasks(spark):
    assert C.product_pages(spark, SMALL).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_nodes_need_no_schema_of_what_they_hold(spark):
    from pyspark.sql import functions as F

    from loomcat.operators import jsonld

    many = jsonld.nodes(jsonld.blocks(C.product_pages(spark, SMALL)))
    assert "schemaofvariant" not in plan_of(many).lower().replace("_", "")
    body = F.lit('<script type="application/ld+json">[{}, 1, null, "x", [], {":": [1]}, {"@graph": {"a": 1}}, {"@graph": [{"b": 1}, [{"c": 1}], 2]}]</script>')
    rows = jsonld.nodes(jsonld.blocks(spark.range(1).select(F.lit("s").alias("source"), F.lit("u").alias("url"), body.alias("html"))))
    got = [(r.j, r.graph) for r in rows.select("at", F.to_json("node").alias("j"), "graph").orderBy("at").collect()]
    assert got == [("{}", False), ('{":":[1]}', False), ('{"@graph":{"a":1}}', False), ('{"b":1}', True), ('{"c":1}', True), ('{"@graph":[{"b":1},[{"c":1}],2]}', False)]


def test_plain_prices_and_repeats(spark):
    from pyspark.sql import functions as F

    from loomcat.functions import normalize as N

    rows = spark.createDataFrame([("12.345",), ("12",), ("1e5",), ("1.2.3",), (" 7,50\n",), ("12\n",), ("٣.٥",), ("",), (None,)], "t string").select(N.to_decimal(F.col("t")).cast("string").alias("x"))
    assert [r.x for r in rows.collect()] == ["12.35", "12.00", "15.00", None, "7.50", "12.00", "3.50", None, None]
    listed = spark.range(1).select(N.clean_list(F.array(*map(F.lit, (" A", "a", "\tb\n", "B", "", " A")))).alias("c"), N.colors(F.array(*map(F.lit, ("navy", "NAVY", "navy", "odd", "ODD")))).alias("d")).first()
    assert listed.c == ["A", "b"] and len(listed.d) == 2
