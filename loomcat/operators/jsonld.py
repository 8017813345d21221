"""JSON-LD in pages (C1 to C3, C5 to C11): polymorphic nodes as VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcat.functions import ids
from loomcat.functions import normalize as N
from loomcat.functions.text import bound, decode_entities, html_text, merged_lists, once, strip
from loomcat.sources import schema

#: A script element with its attributes and its content; the type is looked for among the attributes.
ELEMENT = r"(?is)<script\b[^>]*>.*?</script\s*>"
ATTRIBUTES = r"(?is)^<script\b([^>]*)>"
CONTENT = r"(?is)^<script\b[^>]*>(.*)</script\s*>$"
LINKED_DATA = r"""(?i)\btype\s*=\s*["']?\s*application/ld\+json\b"""
#: Stands between texts that are decoded together; URLs do not hold it.
SEPARATOR = "\u001f"
NODES = "array<struct<node:variant,graph:boolean,open:boolean>>"


def get(node: Column, path: str, kind: str = "string") -> Column:
    """The value at a path, null where there is none of that shape."""
    return F.try_variant_get(node, path, kind)


def is_object(value: Column) -> Column:
    """Whether a variant is an object: a struct of none of its fields can be had of it. Its schema would be that of all it holds."""
    return get(value, "$", "struct<`:`:variant>").isNotNull()


def nodes_of(value: Column) -> Column:
    """The elements of a list, or the single object as a list of one; null: empty."""
    many, one = get(value, "$", "array<variant>"), value
    return F.when(many.isNotNull(), many).when(value.isNotNull() & ~F.is_variant_null(value), F.array(one)).otherwise(F.expr("cast(array() as array<variant>)"))


def payloads(html: Column) -> Column:
    """The (block, payload, levels) of each JSON-LD script of a page that can be parsed, in order; levels bounds how deep its lists are nested."""
    elements = F.filter(F.regexp_extract_all(html, F.lit(ELEMENT), F.lit(0)), lambda e: F.regexp_extract(e, ATTRIBUTES, 1).rlike(LINKED_DATA))
    found = F.transform(elements, lambda e: F.regexp_extract(e, CONTENT, 1))
    levels = lambda raw: F.length(raw) - F.length(F.replace(raw, F.lit("["), F.lit("")))  # no list is nested deeper
    numbered = F.transform(found, lambda raw, i: F.struct(i.alias("block"), F.try_parse_json(F.trim(raw)).alias("payload"), levels(raw).alias("levels")))
    return F.filter(numbered, lambda b: b["payload"].isNotNull())


def blocks(pages: DataFrame) -> DataFrame:
    """(source, url, block, payload, levels) of each parsable JSON-LD script."""
    return pages.select("source", "url", F.explode(payloads(F.col("html"))).alias("b")).select("source", "url", "b.*")


def nodes_in(value: Column, levels: Column) -> Column:
    """The objects of a payload as (node, graph), in reading order: elements of lists and members of @graph, members before
    their wrapper, at any depth. graph: a member of the @graph of a top-level object.

    The list of entries is rewritten until none is open: an open list gives way to its elements, an open object with a @graph to the
    members and then itself. That takes a step for each level; levels is an upper bound of those, and the steps over are idle."""
    none = F.lit(None).cast(NODES)
    empty = F.array().cast(NODES)
    entry = lambda node, graph, open_: F.struct(node.alias("node"), graph.alias("graph"), open_.alias("open"))

    def expanded(e: Column) -> Column:
        opened = lambda many, graph: F.transform(many, lambda v: entry(v, graph, F.lit(True)))
        below = opened(get(e["node"], '$["@graph"]', "array<variant>"), F.lit(True))
        own = F.array(entry(e["node"], e["graph"], F.lit(False)))
        listed = F.coalesce(opened(get(e["node"], "$", "array<variant>"), e["graph"]), empty)
        return F.when(~e["open"], F.array(e)).when(is_object(e["node"]), F.concat(F.coalesce(below, empty), own)).otherwise(listed)

    def step(state: Column, _: Column) -> Column:
        more = F.exists(state["list"], lambda e: e["open"])
        return F.when(state["more"] & more, F.struct(F.flatten(F.transform(state["list"], expanded)).alias("list"), F.lit(True).alias("more"))).otherwise(
            F.struct(state["list"].alias("list"), F.lit(False).alias("more"))
        )

    begin = F.struct(F.array(entry(value, F.lit(False), F.lit(True))).cast(NODES).alias("list"), F.lit(True).alias("more"))
    listed = F.aggregate(F.sequence(F.lit(0), levels), begin, step)["list"]
    return F.transform(F.coalesce(listed, none), lambda e: F.struct(e["node"].alias("node"), e["graph"].alias("graph")))


def page_nodes(html: Column) -> Column:
    """All nodes of a page as (block, at, node, graph), without leaving its row."""
    each = F.transform(payloads(html), lambda b: F.transform(nodes_in(b["payload"], b["levels"]), lambda n, i: F.struct(b["block"].alias("block"), i.alias("at"), n["node"].alias("node"), n["graph"].alias("graph"))))
    return F.flatten(each)


def nodes(parsed: DataFrame) -> DataFrame:
    """(source, url, block, at, node, graph) of each object of the payloads (source, url, block, payload, levels)."""
    return parsed.select("source", "url", "block", F.posexplode(nodes_in(F.col("payload"), F.col("levels"))).alias("at", "n")).select("source", "url", "block", "at", "n.node", "n.graph")


def has_type(node: Column, name: str) -> Column:
    """Whether @type is or holds the name, in any case."""
    kinds = F.coalesce(get(node, '$["@type"]', "array<string>"), F.array(get(node, '$["@type"]')))
    return F.exists(kinds, lambda k: F.coalesce(F.lower(k) == name, F.lit(False)))


def is_group(node: Column) -> Column:
    return has_type(node, "productgroup") | F.coalesce(F.size(get(node, "$.hasVariant", "array<variant>")) > 0, F.lit(False))


def chosen(many: Column, mode: str = "product_or_group") -> Column:
    """The one of a page's nodes that a mode wants, null if there is none."""
    product = lambda n: has_type(n["node"], "product")
    if mode == "product_or_group":
        return F.coalesce(F.get(F.filter(many, lambda n: is_group(n["node"])), 0), F.get(F.filter(many, product), 0))
    return F.get(F.filter(many, (lambda n: product(n) & n["graph"]) if mode == "graph" else product), 0)


def find(pages: DataFrame, mode: str = "product_or_group") -> DataFrame:
    """(source, url, node), one node for each page (source, url, html) that has one. ``product``: the first Product;
    ``product_or_group``: the first group at any place, else the first Product; ``graph``: the first Product of a @graph.
    All nodes of a page come from its row, so nothing is shuffled."""
    listed = pages.select("source", "url", F.explode(F.array(page_nodes(F.col("html")))).alias("many"))
    # one that is chosen or none: a filter on it would choose twice
    return listed.select("source", "url", F.explode(F.array_compact(F.array(chosen(F.col("many"), mode)))).alias("found")).select("source", "url", "found.node")


def texts(value: Column) -> Column:
    """A text or a list of texts as a list."""
    return F.coalesce(get(value, "$", "array<string>"), F.array_compact(F.array(get(value, "$"))))


def images(value: Column) -> Column:
    """Image URLs of texts, lists and ImageObjects, decoded and without repeats."""

    def of(v: Column) -> Column:
        content = F.coalesce(get(v, "$.contentUrl", "array<string>"), F.array_compact(F.array(F.nullif(get(v, "$.contentUrl"), F.lit("")))))
        named = F.when(F.size(content) > 0, content).otherwise(F.array_compact(F.array(F.nullif(get(v, "$.url"), F.lit("")))))
        return F.when(F.schema_of_variant(v) == "STRING", F.array(get(v, "$"))).otherwise(named)

    return F.flatten(F.transform(nodes_of(value), of))


def decoded_list(values: Column) -> Column:
    """Entities decoded in each text (joined by a separator that URLs do not hold), then D9."""
    return N.clean_list(F.split(decode_entities(F.array_join(values, SEPARATOR)), SEPARATOR))


def availability(text: Column) -> Column:
    """in_stock, out_of_stock, preorder or empty."""
    t = F.translate(F.lower(F.coalesce(text, F.lit(""))), " -_", "")
    gone = t.contains("outofstock") | t.contains("soldout") | t.contains("discontinued")
    return F.when(t.contains("instock"), "in_stock").when(gone, "out_of_stock").when(t.contains("preorder"), "preorder").otherwise("")


def gtin(node: Column) -> Column:
    """The first code that is there."""
    return F.coalesce(*(F.nullif(get(node, f"$.{k}"), F.lit("")) for k in ("gtin13", "gtin14", "gtin12", "gtin8", "gtin")))


def rating(node: Column) -> Column:
    """(rating, review_count); counts that are not all digits are null."""
    count = F.coalesce(F.nullif(get(node, "$.aggregateRating.reviewCount"), F.lit("")), get(node, "$.aggregateRating.ratingCount"))
    return F.struct(N.to_decimal(get(node, "$.aggregateRating.ratingValue")).alias("rating"), F.when(count.rlike(r"^[0-9]+$"), count).try_cast("bigint").alias("review_count"))


def offers(node: Column) -> Column:
    """(price, currency, availability, offers): least of price and lowPrice, first currency, first
    known availability."""

    def summary(many: Column) -> Column:
        prices = F.flatten(F.transform(many, lambda o: F.array(N.to_decimal(get(o, "$.price")), N.to_decimal(get(o, "$.lowPrice")))))
        first = lambda xs: F.get(F.filter(xs, lambda x: x.isNotNull() & (x != "")), 0)
        return F.struct(
            F.array_min(F.array_compact(prices)).alias("price"),
            first(F.transform(many, lambda o: get(o, "$.priceCurrency"))).alias("currency"),
            F.coalesce(first(F.transform(many, lambda o: availability(get(o, "$.availability")))), F.lit("")).alias("availability"),
            many.alias("offers"),
        )

    return bound(nodes_of(get(node, "$.offers", "variant")), summary)


def brand(node: Column) -> Column:
    return strip(F.coalesce(get(node, "$.brand.name"), F.when(F.schema_of_variant(get(node, "$.brand", "variant")) == "STRING", get(node, "$.brand")), F.lit("")))


def _common(found: DataFrame) -> DataFrame:
    node = F.col("node")
    got = found.select(
        "*", html_text(get(node, "$.name")).alias("title"), html_text(get(node, "$.description")).alias("description"), brand(node).alias("brand"),
        get(node, "$.category").alias("raw_category"), offers(node).alias("offer"), rating(node).alias("rate"), decoded_list(images(get(node, "$.image", "variant"))).alias("own_images"),
    )
    return got.select(
        "*", F.col("brand").alias("vendor"), F.lower("brand").alias("brand_normalized"), N.category(F.col("raw_category"), F.col("title")).alias("category"),
        html_text(F.col("raw_category")).alias("subcategory"), N.gender(F.col("raw_category"), F.col("title")).alias("gender"), F.col("rate.rating").alias("rating"),
        F.col("rate.review_count").alias("review_count"), F.col("url").alias("product_url"),
    )


def _mapped(found: DataFrame, grouped: Column, currency: str, normalize_keys: bool = False) -> DataFrame:
    """C10 and C11 in one pass: canonical rows of nodes (source, url, node), as groups where grouped says so, else as products. What one
    of them does not need is not computed for it."""
    node, group = F.col("node"), F.col("_grouped")
    either = lambda g, p: F.when(group, g).otherwise(p)
    none = F.expr("cast(array() as array<variant>)")
    variant_of = F.nullif(get(node, "$.isVariantOf.productGroupID"), F.lit(""))
    own_id = F.coalesce(variant_of, F.nullif(get(node, "$.productID"), F.lit("")), get(node, "$.sku"))
    group_id = F.coalesce(F.nullif(get(node, "$.productGroupID"), F.lit("")), get(node, "$.productID"))
    suggested = F.lower(get(node, "$.audience.suggestedGender"))
    fallback = F.when(suggested.isin("male", "men"), "men").when(suggested.isin("female", "women"), "women").when(suggested == "unisex", "unisex").otherwise("")
    some = _common(once(found.withColumn("_grouped", grouped), "_grouped")).withColumns({
        "product_id": ids.product_id(F.col("source"), either(group_id, own_id), None, F.col("url")),
        "gender": F.when(~group & (F.col("gender") == ""), fallback).otherwise(F.col("gender")),
        "parts": F.when(group, F.filter(F.coalesce(get(node, "$.hasVariant", "array<variant>"), none), is_object)).otherwise(none),
    })
    read = F.transform(
        "parts",
        lambda v, i: F.struct(
            i.alias("i"), offers(v).alias("offer"), F.nullif(strip(get(v, "$.sku")), F.lit("")).alias("sku"), gtin(v).alias("gtin"),
            F.nullif(get(v, "$.color"), F.lit("")).alias("color"), images(get(v, "$.image", "variant")).alias("raw_images"),
        ),
    )
    # the variants' images of a row are decoded together: a text a variant, cut apart again
    between = "\u001e"
    listed = F.array_join(F.transform(F.col("read"), lambda r: F.array_join(r["raw_images"], SEPARATOR)), between)
    some = some.withColumn("read", read).withColumn("decoded", F.split(decode_entities(listed), between))
    some = some.withColumn("read", F.zip_with("read", F.slice("decoded", 1, F.size("read")), lambda r, d: r.withField("images", N.clean_list(F.split(d, SEPARATOR)))))

    # of a product
    first_currency = N.currency(F.col("offer.currency"), currency)
    by_offer = F.transform(
        F.col("offer.offers"),
        lambda o, i: schema.variant(
            variant_id=ids.variant_id(F.col("product_id"), i, sku=get(o, "$.sku")), sku=get(o, "$.sku"), price=N.to_decimal(get(o, "$.price")),
            currency=N.currency(get(o, "$.priceCurrency"), first_currency),
            available=F.when(F.nullif(get(o, "$.availability"), F.lit("")).isNotNull(), availability(get(o, "$.availability")) == "in_stock"),
        ),
    )
    # of a group
    by_part = F.transform(
        "read",
        lambda r: schema.variant(
            variant_id=ids.variant_id(F.col("product_id"), r["i"], barcode=r["gtin"], sku=r["sku"], color=r["color"]), sku=r["sku"], barcode=r["gtin"], color=strip(r["color"]),
            price=r["offer"]["price"], currency=N.currency(r["offer"]["currency"], currency), available=F.when(r["offer"]["availability"] != "", r["offer"]["availability"] == "in_stock"),
        ),
    )
    key = (lambda r: N.color(r["color"])) if normalize_keys else (lambda r: strip(r["color"]))
    shown = F.filter("read", lambda r: r["color"].isNotNull() & (F.size(r["images"]) > 0))
    codes = F.filter(F.flatten(F.transform("read", lambda r: F.transform(r["offer"]["offers"], lambda o: N.currency(F.nullif(get(o, "$.priceCurrency"), F.lit("")), currency)))), lambda c: c != currency)

    some = some.withColumns({
        "colors": N.colors(either(F.transform("read", lambda r: r["color"]), texts(get(node, "$.color", "variant")))),
        "image_urls": either(F.array_distinct(F.concat("own_images", F.flatten(F.transform("read", lambda r: r["images"])))), F.col("own_images")),
    })
    of_product = ~group
    out = some.withColumns({
        "price": either(F.array_min(F.array_compact(F.transform("read", lambda r: r["offer"]["price"]))), F.col("offer.price")),
        "currency": either(F.coalesce(F.get(codes, 0), F.lit(currency)), first_currency),
        "availability": either(F.when(F.size("parts") == 0, "").otherwise(N.availability(F.exists("read", lambda r: r["offer"]["availability"] == "in_stock"))), F.col("offer.availability")),
        "sku": F.when(of_product, F.nullif(strip(get(node, "$.sku")), F.lit(""))), "barcode": F.when(of_product, gtin(node)), "gtin": F.when(of_product, gtin(node)),
        "main_image": F.coalesce(F.get("image_urls", 0), F.lit("")),
        "material": N.materials(F.when(of_product, get(node, "$.material")), F.col("description"), F.col("title")),
        "color_images": either(merged_lists(F.transform(shown, lambda r: F.struct(key(r).alias("k"), r["images"].alias("v")))), F.when((F.size("colors") == 1) & (F.size("own_images") > 0), F.create_map(F.col("colors")[0], F.col("own_images")))),
        "sizes": F.when(of_product, F.filter(F.transform(texts(get(node, "$.size", "variant")), strip), lambda s: s != "")),
        "variants": either(by_part, F.when(F.size("offer.offers") > 1, by_offer)),
        "attributes": schema.attributes(
            platform=F.lit("jsonld"), mpn=F.when(of_product, F.nullif(strip(get(node, "$.mpn")), F.lit(""))), schema_type=either(F.lit("ProductGroup"), get(node, '$["@type"]')),
            product_group_id=either(group_id, variant_of), varies_by=F.when(group, get(node, "$.variesBy")),
        ),
    })
    return schema.with_defaults(out)


def map_product(found: DataFrame, currency: str = "EGP") -> DataFrame:
    """Canonical rows of Product nodes (source, url, node)."""
    return _mapped(found, F.lit(False), currency)


def map_group(found: DataFrame, currency: str = "EGP", normalize_keys: bool = False) -> DataFrame:
    """C11: canonical rows of ProductGroup nodes, one variant for each of hasVariant. Colour keys of
    color_images are the trimmed raw colours, or with normalize_keys canonical ones."""
    return _mapped(found, F.lit(True), currency, normalize_keys)


def map_pages(pages: DataFrame, currency: str = "EGP") -> DataFrame:
    """Pages (source, url, html) to canonical rows, groups and plain products alike; each page is parsed once."""
    return _mapped(find(pages), is_group(F.col("node")), currency)
