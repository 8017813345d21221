"""Versioned tables, crawl state, the stored sync, streams with rejects, nested JSON-LD and the keyword scan, against brute force."""

import datetime as dt
import json
import random
import re
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomcat.catalog_queries import schema_plus
from loomcat.functions import rules, scope
from loomcat.functions import normalize as N
from loomcat.functions.text import first_rule, hit_table, word_pattern
from loomcat.operators import changes, jsonld, offers
from loomcat.plans import stages
from loomcat.sources import io, versions
from loomcat.streaming import pipeline

DDL = "k string, v int"
T0 = dt.datetime(2024, 1, 1)


def files_of(df) -> set[str]:
    return {Path(f).name for f in df.inputFiles()}


# ---- versioned tables ------------------------------------------------------------------------------


def put(spark, path, rows, version=None, n=4):
    version = version or versions.current(spark, path)
    df = spark.createDataFrame(rows, DDL)
    touched = {r.b for r in df.select(versions.bucket_of(n, "k").alias("b")).distinct().collect()}
    changed = versions.write_buckets(path, "t", df, touched, n, "k")
    return versions.Version(version.number + 1, versions.with_buckets(version, changed), version.logs, version.batches, {"t": n})


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    read = lambda v=None: {(r.k, r.v) for r in versions.read(spark, v or versions.current(spark, path), "t", DDL).collect()}
    assert versions.current(spark, path) == versions.Version() and read() == set()
    first = versions.commit(spark, path, put(spark, path, [(f"k{i}", i) for i in range(40)]))
    assert read() == {(f"k{i}", i) for i in range(40)} and versions.current(spark, path) == first
    pending = put(spark, path, [("k1", 100)])  # its folder is there, its manifest is not
    assert read() == read(first) == {(f"k{i}", i) for i in range(40)}
    second = versions.commit(spark, path, pending)
    assert ("k1", 100) in read() and ("k1", 1) in read(first)  # a reader of the old version is not disturbed
    untouched = [b for b in first.buckets if first.buckets[b] == second.buckets[b]]
    assert len(untouched) == 3
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        versions.commit(spark, path, pending)
    put(spark, path, [("k2", 5)])  # a write that was broken off
    assert versions.vacuum(spark, path, keep=1) >= 2
    assert read() == read(second) and ("k1", 100) in read()
    assert versions.vacuum(spark, path, keep=1) == 0
    gone = versions.write_buckets(path, "t", spark.createDataFrame([], DDL), {b for _, b in second.buckets}, 4, "k")
    assert set(gone.values()) == {None}
    versions.commit(spark, path, versions.Version(3, versions.with_buckets(second, gone), {}, {}, {"t": 4}))
    assert read() == set() and versions.current(spark, path).number == 3


# ---- crawl state -----------------------------------------------------------------------------------


def record(spark, *items):
    """Canonical rows of (product id, source, title, day, hash)."""
    base = spark.createDataFrame([(p, s, t, T0 + dt.timedelta(days=d), h, T0 + dt.timedelta(days=d)) for p, s, t, d, h in items], "product_id string, source string, title string, scraped_at timestamp, content_hash string, source_updated_at timestamp")
    return schema_plus(base)


def test_state_of_batches(spark, tmp_path):
    """Three batches, one compaction, hashes that are missing: the state is that of H4 after each of them."""
    path = str(tmp_path / "state")
    batches = [
        record(spark, ("a", "s", "tee", 1, "aaa"), ("b", "s", "hat", 1, None), ("c", "t", "cap", 1, "ccc"), (None, "s", "x", 1, "n"), ("", "s", "x", 1, "n")),
        record(spark, ("a", "s", "tee", 3, None), ("d", "t", "bag", 2, "")),
        record(spark, ("b", "s", "hat", 2, "given"), ("c", "t", "cap", 5, "ccc")),
    ]
    want = spark.createDataFrame([], io.STATE_DDL)
    for n, batch in enumerate(batches):
        version = pipeline.add_batch(batch, n, path, "w", buckets=4, most_entries=2)
        assert pipeline.add_batch(batch.limit(1), n, path, "w").number == version.number  # the batch again
        want = changes.update_state(want, batch)
        key = lambda df: sorted(map(tuple, df.select("source", "product_id", "content_hash", "first_seen", "last_seen", "high_water").collect()), key=str)
        assert key(pipeline.current_state(spark, path)) == key(want)
    hashes = {r.product_id: r.content_hash for r in pipeline.current_state(spark, path).collect()}
    computed = {r.title: r.h for r in batches[0].unionByName(batches[1]).select("title", changes.content_hash().alias("h")).collect()}
    assert hashes == {"a": computed["tee"], "b": "given", "c": "ccc", "d": computed["bag"]}
    version = versions.current(spark, path)
    assert len(version.logs["state"]) == 1 and version.batches == {"w": 2}  # two entries were merged, the third is open
    pipeline.compact_state(spark, path)
    assert key(pipeline.current_state(spark, path)) == key(want) and not versions.current(spark, path).logs
    before = versions.current(spark, path)
    assert pipeline.compact_state(spark, path) == before
    other = pipeline.add_batch(batches[0].limit(1), 0, path, "another writer")
    assert other.number == before.number + 1


def test_state_reads_stay_bounded(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in range(7):
        version = pipeline.add_batch(record(spark, ("a", "s", f"t{n}", n, f"h{n}")), n, path, "w", buckets=2, most_entries=3)
        assert len(version.logs.get("state", ())) < 3 and len(version.buckets) <= 2
    assert [(r.content_hash, r.first_seen, r.last_seen) for r in pipeline.current_state(spark, path).collect()] == [("h6", T0, T0 + dt.timedelta(days=6))]


def test_state_empty(spark, tmp_path):
    assert pipeline.current_state(spark, str(tmp_path / "none")).count() == 0
    assert pipeline.compact_state(spark, str(tmp_path / "none")).number == 0
    pipeline.add_batch(record(spark, (None, "s", "x", 1, "n")), 0, str(tmp_path / "s"), "w", most_entries=1)
    assert pipeline.current_state(spark, str(tmp_path / "s")).count() == 0


# ---- the stored sync -------------------------------------------------------------------------------


def catalog(spark, *items):
    """(url, title, price, colors, images)."""
    base = spark.createDataFrame([(u, t, None if p is None else Decimal(p), c, i, "x_products.json", n) for n, (u, t, p, c, i) in enumerate(items)], "product_url string, title string, price decimal(18,2), colors array<string>, image_urls array<string>, file_name string, seq int")
    return schema_plus(base, "file_name", "seq")


def test_sync_stored(spark, tmp_path):
    path = str(tmp_path / "store")
    many = [(f"u{i}", f"tee {i}", 5, ["Red"] if i % 2 else [], [f"i{i}", "shared"]) for i in range(30)]
    assert offers.sync_stored(catalog(spark, *many), path, buckets=8) == {"new": 30, "updated": 0, "unchanged": 0, "deleted": 0}
    offer = lambda v=None: {(r.product_url, r.color, r.name, r.image_url) for r in offers.read_offers(spark, path, v).collect()}
    image = lambda v=None: {(r.product_url, r.image_url) for r in offers.read_images(spark, path, v).collect()}
    assert offer() == {(u, c[0] if c else None, t, i[0]) for u, t, _, c, i in many}
    assert image() == {(u, x) for u, _, _, _, i in many for x in i}
    first = versions.current(spark, path)
    assert offers.sync_stored(catalog(spark, *many), path) == {"new": 0, "updated": 0, "unchanged": 30, "deleted": 0}
    assert versions.current(spark, path) == first  # nothing changed, nothing written
    # one insert, one update, one delete, one update that is not usable any more, one repeated key
    now = [r for r in many if r[0] != "u4"]
    now[0] = ("u0", "tee zero", 5, [], ["i0", "another"])
    now[7] = ("u8", "", 5, [], ["i8"])
    now += [("u99", "tee 99", 7, ["Blue", "Red"], ["i99"]), ("u99", "later", 7, ["Blue"], ["i98"])]
    dry = offers.sync_stored(catalog(spark, *now), path, dry_run=True)
    assert versions.current(spark, path) == first
    assert offers.sync_stored(catalog(spark, *now), path) == dry == {"new": 2, "updated": 2, "unchanged": 27, "deleted": 1}
    second = versions.current(spark, path)
    assert second.number == first.number + 1
    assert offer() == ({o for o in offer(first) if o[0] not in ("u0", "u4", "u8")} | {("u0", None, "tee zero", "i0"), ("u99", "Blue", "tee 99", "i99"), ("u99", "Red", "tee 99", "i99")})
    assert image() == image(first) | {("u0", "another"), ("u99", "i99")}  # images of deleted offers stay
    same = {k for k in first.buckets if first.buckets[k] == second.buckets.get(k)}
    assert same and files_of(versions.read(spark, second, "offers", offers.OFFERS_DDL, {b for n, b in same if n == "offers"})) <= files_of(offers.read_offers(spark, path, first))
    snapshot, _ = offers.sync(offers.read_offers(spark, path, first), catalog(spark, *now))
    assert {(r.product_url, r.color, r.name, r.image_url) for r in snapshot.collect()} == offer()
    assert offers.sync_stored(catalog(spark, *now).limit(0), path)["deleted"] == 30  # u4 and u8 had gone, two were new
    assert offer() == set() and image(second) == image()


# ---- streams with rejects --------------------------------------------------------------------------


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(pipeline.STATE_STORE[0])
    spark.conf.set(*pipeline.STATE_STORE)
    yield
    spark.conf.set(pipeline.STATE_STORE[0], before)


def run_stream(spark, at, batches, delay, **more):
    """The verdicts of a stream that reads the batches one after the other."""
    for rows in batches:
        rows.write.mode("append").parquet(f"{at}/in")
        told = pipeline.classify_stream(spark.readStream.schema(rows.schema).parquet(f"{at}/in"), delay, order=("scraped_at", "seq"), **more)
        q = told.select("seq", "title", "price", "scraped_at", "reject_stage", "reject_reason").writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(f"{at}/out")


def test_stream_verdicts(spark, tmp_path, rocks):
    """Batches with late rows and ties: verdicts, counts and values are those of the batch pipeline."""
    rng = random.Random(8)
    titles = ["tee", " Blue  hoodie ", "laptop", "running shoe", "", "model"]
    rows = [(rng.choice(["a", "b", "c", "d", "e", "f", "g", None, ""]), "s", rng.choice(titles), Decimal("5.25") if rng.random() < 0.7 else None, ["i"], "u", n, T0 + dt.timedelta(hours=rng.randrange(100), microseconds=rng.choice([0, 1, 7]))) for n in range(80)]
    ddl = "product_id string, source string, title string, price decimal(18,2), image_urls array<string>, product_url string, seq int, scraped_at timestamp"
    make = lambda xs: schema_plus(spark.createDataFrame(xs, ddl), "seq")
    rng.shuffle(rows)
    closing = ("z", "s", "tee", Decimal(1), ["i"], "u", 1000, T0 + dt.timedelta(days=400))
    got = run_stream(spark, str(tmp_path), [make(rows[:30]), make(rows[30:55]), make([*rows[55:], closing])], "10 days")
    want = stages.classify_rows(make(rows), order=("scraped_at", "seq")).select("seq", "title", "price", "scraped_at", "reject_stage", "reject_reason")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {r.reject_stage for r in got.collect()} == {None, "dedup", "scope", "validate"}


def test_stream_forgets(spark, tmp_path, rocks):
    """An id whose time is over passes again."""
    ddl = "product_id string, source string, title string, price decimal(18,2), image_urls array<string>, product_url string, seq int, scraped_at timestamp"
    day = lambda *xs: schema_plus(spark.createDataFrame([(p, "s", "tee", Decimal(1), ["i"], "u", n, T0 + dt.timedelta(days=d)) for p, n, d in xs], ddl), "seq")
    batches = [day(("a", 1, 0), ("a", 2, 0)), day(("x", 3, 20)), day(("a", 4, 21)), day(("y", 5, 60))]
    got = run_stream(spark, str(tmp_path), batches, "1 day", forget_ms=10 * 86_400_000)
    assert {(r.seq, r.reject_stage) for r in got.collect()} == {(1, None), (2, "dedup"), (3, None), (4, None)}


# ---- nested JSON-LD --------------------------------------------------------------------------------


def nodes_by_hand(payload, graph=False):
    if isinstance(payload, list):
        for x in payload:
            yield from nodes_by_hand(x, graph)
    elif isinstance(payload, dict):
        if isinstance(payload.get("@graph"), list):
            for x in payload["@graph"]:
                yield from nodes_by_hand(x, True)
        yield payload.get("n"), graph


def random_payload(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.15:
        return rng.choice([1, "text [ with [ brackets", None, {"n": rng.randrange(1000)}, []])
    below = [random_payload(rng, depth - 1) for _ in range(rng.randrange(1, 4))]
    if kind < 0.4:
        return below
    return {"n": rng.randrange(1000), "@graph": below if kind < 0.85 else rng.choice([{"n": 5}, "no list"]), "image": ["[", [1]]}


def test_nodes_at_any_depth(spark):
    rng = random.Random(4)
    payloads = [random_payload(rng, d) for d in (1, 2, 3, 5, 8, 12) for _ in range(6)]
    deep = {"n": 0}
    for i in range(1, 13):
        deep = {"n": i, "@graph": [deep]} if i % 2 else [{"n": i, "@graph": [[deep]]}]
    payloads += [deep, [], {}, [[[]]], "text"]
    pages = spark.createDataFrame([("s", str(i), f'<script type="application/ld+json">{json.dumps(p)}</script>') for i, p in enumerate(payloads)], "source string, url string, html string")
    rows = jsonld.nodes(jsonld.blocks(pages)).select(F.col("url").cast("int").alias("u"), "at", jsonld.get(F.col("node"), "$.n", "int").alias("n"), "graph").orderBy("u", "at").collect()
    got: dict = {}
    for r in rows:
        got.setdefault(r.u, []).append((r.n, r.graph))
    assert got == {i: x for i, p in enumerate(payloads) if (x := list(nodes_by_hand(p)))}


# ---- keywords --------------------------------------------------------------------------------------


def rule_by_hand(text, table):
    for name, words in table:
        edged, rest = [w for w in words if w.isascii()], [w for w in words if not w.isascii()]
        pattern = word_pattern(edged).replace(r"\p{L}\p{N}", r"\w") if edged else None
        if (pattern and re.search(pattern, text)) or any(w in text for w in rest):
            return name
    return None


@pytest.mark.parametrize("table", [rules.CATEGORY_RULES, N.DESCRIPTION_RULES, scope.PRIMARY, scope.DESCRIPTION])
def test_keyword_scan(spark, table):
    """Texts made of keywords, whole, cut and run together: the first rule is the one that a scan for each rule finds."""
    rng = random.Random(6)
    words = [w for _, ws in table for w in ws]
    texts = ["", " ", *words, *(w + e for w in words for e in ("s", "es", "x", "ss")), *("x" + w for w in words)]
    for _ in range(1500):
        parts = [rng.choice(["", "zzz", "été", "_", "9"]) + rng.choice(words)[rng.choice([0, 0, 0, 1]) :] + rng.choice(["", "s", "es", "z"]) for _ in range(rng.randrange(1, 5))]
        texts.append(rng.choice([" ", " ", "-", "", ", ", "\n"]).join(parts))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", first_rule(F.col("t"), table, F.lit(None).cast("string")).alias("r")).collect()
    wrong = [(r.t, r.r, rule_by_hand(r.t, table)) for r in got if r.r != rule_by_hand(r.t, table)]
    assert not wrong, wrong[:5]
    assert spark.range(1).select(first_rule(F.lit(None).cast("string"), table, F.lit("x")).alias("r")).first().r == "x"


def test_hits_within_hits():
    assert hit_table((("tank top",), ("tank",), ("top",), ("ta",)))["tank tops"] == [0, 1]
    assert hit_table((("قميص",), ("قم",)))["قميص"] == [0, 1]


# ---- catalogs by line, capped links, counters ------------------------------------------------------


def test_catalog_files_by_line(spark, tmp_path):
    """A large file is read by several tasks; other layouts are read whole; what holds no list is skipped."""
    rec = lambda i: json.dumps({"product_id": str(i), "title": f"{{tee}}, {i} [", "price": 1.5, "variants": [{"sku": f"s{i}"}]})
    (tmp_path / "big_products.json").write_text("[\n" + ",\n".join(rec(i) for i in range(3000)) + "\n]\n")
    (tmp_path / "pretty_products.json").write_text(json.dumps([json.loads(rec(i)) for i in range(5000, 5003)], indent=1))
    (tmp_path / "one_products.json").write_text(f"[{rec(6000)}, {rec(6001)}]")
    (tmp_path / "empty_products.json").write_text("[\n]\n")
    (tmp_path / "dict_products.json").write_text(rec(7000))
    (tmp_path / "lines_products.json").write_text(f"{rec(7001)}\n{rec(7002)}\n")
    (tmp_path / "bad_products.json").write_text(f"[\n{rec(8000)},\n{{no json}},\n{rec(8001)}\n]\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        got = io.read_catalog(spark, str(tmp_path))
        tasks = got.where("file_name = 'big_products.json'").select(F.spark_partition_id().alias("p")).distinct().count()
        rows = sorted((int(r.product_id), r.title, r.price, r.variants[0].sku, r.file_name) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 3
    files = {"big": range(3000), "pretty": range(5000, 5003), "one": (6000, 6001), "bad": (8000, 8001)}
    assert rows == sorted((i, f"{{tee}}, {i} [", Decimal("1.50"), f"s{i}", f"{n}_products.json") for n, ids in files.items() for i in ids)
    only = tmp_path / "none"
    only.mkdir()
    (only / "x_products.json").write_text("nothing")
    assert io.read_catalog(spark, str(only)).count() == 0


@pytest.mark.parametrize("cap", [1, 7, 500])
def test_capped_links(spark, cap):
    """A store with nearly all links: the first of each store, as one sort would give them."""
    from loomcat.operators import links

    rows = [("big", f"http://b/{i % 300}", (i // 10, i % 10)) for i in range(3000)] + [("small", f"http://s/{i}", (0, i)) for i in range(5)]
    df = spark.createDataFrame([(s, u, p) for s, u, p in rows], "source string, loc string, place struct<position:int,at:int>")
    got = sorted((r.source, r.loc, tuple(r.place)) for r in links.first_of_store(df, cap).collect())
    want = [r for s in ("big", "small") for r in sorted((x for x in rows if x[0] == s), key=lambda x: (x[2], x[1]))[:cap]]
    assert got == sorted(want)


def test_written_pipeline(spark, tmp_path):
    """One write gives accepted rows, rejects and the report."""
    rows = [(p, s, t, None if p == "d" else Decimal(1), ["i"], "u", n) for n, (p, s, t) in enumerate([("a", "s", "tee"), ("a", "s", "tee"), ("b", "s", "laptop"), ("c", "t", "hoodie"), ("d", "t", "hoodie")])]
    ddl = "product_id string, source string, title string, price decimal(18,2), image_urls array<string>, product_url string, seq int"
    raw = schema_plus(spark.createDataFrame(rows, ddl).withColumn("scraped_at", F.timestamp_seconds("seq")), "seq")
    good, bad, told = stages.write_pipeline(raw, str(tmp_path / "out"), order=("scraped_at", "seq"))
    assert {r.product_id for r in good.collect()} == {"a", "c"}
    assert sorted((r.product_id, r.reject_stage) for r in bad.collect()) == [("a", "dedup"), ("b", "scope"), ("d", "validate")]
    from loomcat.operators import report

    want = report.pipeline_report(stages.classify_rows(raw, order=("scraped_at", "seq")))
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, want.collect()))
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "image_urls" not in plan and "description" not in plan  # narrow columns only


def test_dedup_before_the_shuffle(spark):
    """The rows that a rank would pick, ties by the last column, nulls first; each task sends one row of an id."""
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", None, ""]), "s", f"t{n}", Decimal(n), ["i"], "u", n) for n in range(400)]
    ddl = "product_id string, source string, title string, price decimal(18,2), image_urls array<string>, product_url string, seq int"
    day = F.when(F.col("seq") % 7 != 0, F.timestamp_seconds(F.col("seq") % 5))
    raw = schema_plus(spark.createDataFrame(rows, ddl).withColumn("scraped_at", day), "seq").repartition(4)
    got = stages.dedup(raw, ("scraped_at", "seq"), counted="n")
    want = stages.mark_duplicates(raw, ("scraped_at", "seq")).where("arrival = 1").drop("arrival")
    assert got.columns == [*raw.columns, "n"]
    assert sorted(map(str, got.drop("n").collect())) == sorted(map(str, want.collect()))
    assert got.agg(F.sum("n")).first()[0] == sum(1 for r in rows if r[0])
    assert "partial_min_by" in got._jdf.queryExecution().executedPlan().toString()
    assert stages.dedup(raw.limit(0), ("scraped_at", "seq")).count() == 0
