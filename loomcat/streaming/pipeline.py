"""The pipeline on streams (K1, K2)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from loomcat.operators.changes import known_hash
from loomcat.plans import stages
from loomcat.sources import io, schema, versions

STATE = "state"
#: Buckets of a new state table, and log entries before they are merged into them.
BUCKETS, MOST_ENTRIES = 64, 16
#: Keyed state of ``classify_stream`` lives in RocksDB, on disk beside the executor: set this before the query starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def streaming_pipeline(raw: DataFrame, watermark: str | None = None, stores: DataFrame | None = None) -> DataFrame:
    """K1: accepted products of a stream of canonical rows. Each product id passes once: for ever (state
    grows with the ids), or with a watermark on scraped_at within its delay (state is bounded). stores: a static
    (source, require_images) as in the batch pipeline. Which of a batch's rows of one id passes is open, and what is rejected is
    dropped: see ``classify_stream`` for both."""
    df = raw.where(F.coalesce("product_id", F.lit("")) != "")
    df = df.withWatermark("scraped_at", watermark).dropDuplicatesWithinWatermark(["product_id"]) if watermark else df.dropDuplicates(["product_id"])
    df = stages.backfill_category(stages.normalize_prices(stages.clean(df)))
    df = stages.add_scope(df).where("scope.is_supported")
    needed = F.lit(True)
    if stores is not None:
        df = df.join(F.broadcast(stores.select("source", "require_images")), "source", "left")
        needed = F.coalesce("require_images", F.lit(True))
    return schema.ordered(stages.stamp(df.where(F.size(stages.invalid(needed)) == 0)))


class FirstArrivals(StatefulProcessor):
    """Per product id: keeps the earliest row until the watermark has passed it, and then lets it through as the first; every other row
    goes on as a later one. A row ``forget_ms`` after the first one (0: never) may be a first one again; by then the id's state is gone."""

    def __init__(self, forget_ms: int):
        self.forget_ms = forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "place string, row string, at bigint")
        self.passed = handle.getValueState("passed", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        later: list[str] = []
        until = None  # rows before this time come after a first one that has passed
        if self.passed.exists():
            until = self.passed.get()[0] + self.forget_ms if self.forget_ms else float("inf")
        had = best = tuple(self.held.get()) if self.held.exists() else None
        for part in rows:
            for place, row, at in zip(part["place"], part["row"], part["at"], strict=True):
                if until is not None and at < until:
                    later.append(row)
                elif best is None or place < best[0]:
                    later += [best[1]] if best else []
                    best = (place, row, int(at))
                else:
                    later.append(row)
        if best != had:
            self.held.update(best)
            if had is not None and had[2] != best[2]:
                self.handle.deleteTimer(had[2])
            self.handle.registerTimer(best[2])
        if later:
            yield pd.DataFrame({"row": later, "first": [False] * len(later)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.passed.exists() and self.forget_ms and self.passed.get()[0] + self.forget_ms <= now:
            self.passed.clear()
        if self.held.exists() and self.held.get()[2] <= now:
            _, row, at = self.held.get()
            self.held.clear()
            self.passed.update((at,))
            if self.forget_ms:
                self.handle.registerTimer(at + self.forget_ms)
            yield pd.DataFrame({"row": [row], "first": [True]})

    def close(self) -> None:
        pass


def _place(raw: DataFrame, order: tuple[str, ...]) -> Column:
    """A text that sorts as the order's columns (times, whole numbers, texts) do, nulls first."""
    parts = []
    for c in order:
        kind, value = raw.schema[c].dataType, F.col(c)
        if not isinstance(kind, T.StringType):
            whole = F.unix_micros(value) if isinstance(kind, T.TimestampType) else value.cast("bigint")
            value = F.lpad((whole.cast("decimal(20,0)") + F.expr("10000000000000000000BD")).cast("string"), 20, "0")
        parts.append(F.coalesce(F.concat(F.lit("+"), value), F.lit("")))
    return F.concat_ws("\u0001", *parts)


def classify_stream(raw: DataFrame, delay: str, stores: DataFrame | None = None, order: tuple[str, ...] = ("scraped_at", "file_name", "seq"), forget_ms: int = 0) -> DataFrame:
    """K1 with rejects: ``stages.classify_rows`` on a stream of canonical rows. The first row of each product id in the
    given order passes when the watermark (``delay`` behind the latest scraped_at) has gone beyond it, so rows may come late by up to the
    delay and in any batch; every other row is a reject of the dedup, at once. Rows that come later than that are
    left out, and counted by the query's progress (``numRowsDroppedByWatermark``). State: one row while an id waits, then its time
    only, for ``forget_ms`` (0: for ever). Rows without an id or a scraped_at are left out. Set ``STATE_STORE`` before the query starts."""
    some = raw.where((F.coalesce("product_id", F.lit("")) != "") & F.col("scraped_at").isNotNull())
    kept = some.withWatermark("scraped_at", delay).select(
        "product_id", "scraped_at", _place(raw, order).alias("place"), F.to_json(F.struct(*raw.columns), _EXACT).alias("row"), F.unix_millis("scraped_at").alias("at"),
    )
    told = kept.groupBy("product_id").transformWithStateInPandas(FirstArrivals(forget_ms), "row string, first boolean", "append", "EventTime")
    rows = told.select(F.from_json("row", raw.schema, _EXACT).alias("r"), "first").select("r.*", "first")
    return stages.classify_marked(rows, "first", stores)


def _batch_state(batch: DataFrame) -> DataFrame:
    """A row for each product of a batch of records: the hash of its last record, computed where the record has none."""
    seen = F.coalesce("last_seen", "scraped_at")
    some = batch.where(F.coalesce("product_id", F.lit("")) != "").withColumn("content_hash", known_hash(batch))
    last = F.max_by(F.struct("content_hash", seen.alias("last_seen")), F.struct("scraped_at", "content_hash"))
    rows = some.groupBy("source", "product_id").agg(last.alias("r"), F.min(F.coalesce("first_seen", seen)).alias("first_seen"), F.max("source_updated_at").alias("high_water"))
    return rows.select("source", "product_id", "r.content_hash", "first_seen", "r.last_seen", "high_water")


def _merged(rows: DataFrame) -> DataFrame:
    """One row for each product of rows with ``entry``: the newest entry's hash and last sight, each unless it is null, the first sight and
    the latest mark."""
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("entry"))).alias(c)
    return rows.groupBy("source", "product_id").agg(newest("content_hash"), F.min("first_seen").alias("first_seen"), newest("last_seen"), F.max("high_water").alias("high_water"))


def _all_rows(spark: SparkSession, version: versions.Version, buckets: set[int] | None = None) -> DataFrame:
    base = versions.read(spark, version, STATE, io.STATE_DDL, buckets).withColumn("entry", F.lit(-1).cast("long"))
    return base.unionByName(versions.read_log(spark, version, STATE, io.STATE_DDL))


def add_batch(batch: DataFrame, n: int, path: str, writer: str, buckets: int = BUCKETS, most_entries: int = MOST_ENTRIES) -> versions.Version:
    """Adds a batch of records to the state at path as one log entry. A batch that this writer has added already changes nothing.
    With ``most_entries`` entries the log is merged into the buckets that its products are in."""
    spark = batch.sparkSession
    version = versions.current(spark, path)
    if version.batches.get(writer, -1) >= n:
        return version
    folder, number = versions.append_log(path, STATE, _batch_state(batch)), version.number + 1
    logs = (*version.logs.get(STATE, ()), (number, folder))
    version = versions.commit(spark, path, versions.Version(number, version.buckets, {**version.logs, STATE: logs}, {**version.batches, writer: n}, {STATE: buckets} | version.sizes))
    return compact_state(spark, path) if len(logs) >= most_entries else version


def compact_state(spark: SparkSession, path: str) -> versions.Version:
    """Merges the log of the state at path into its buckets; those without products of the log stay as they are."""
    version = versions.current(spark, path)
    if not version.logs.get(STATE):
        return version
    n = version.sizes[STATE]
    mine = versions.bucket_of(n, "source", "product_id")
    touched = {r.b for r in versions.read_log(spark, version, STATE, io.STATE_DDL).select(mine.alias("b")).distinct().collect()}
    changed = versions.write_buckets(path, STATE, _merged(_all_rows(spark, version, touched)), touched, n, "source", "product_id")
    return versions.commit(spark, path, versions.Version(version.number + 1, versions.with_buckets(version, changed), {k: v for k, v in version.logs.items() if k != STATE}, version.batches, version.sizes))


def upsert_state(records: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS, most_entries: int = MOST_ENTRIES) -> StreamingQuery:
    """K2: keeps the crawl state at path up to date. A batch costs what its own products cost, and now and then a compaction;
    a batch that is retried has no effect. The checkpoint names the writer."""

    def apply(batch: DataFrame, n: int) -> None:
        add_batch(batch, n, path, checkpoint, buckets, most_entries)

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _plain_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a state that was written before there were manifests: folders ``batch=<n>``."""
    return spark.read.schema(f"{io.STATE_DDL}, batch bigint").parquet(path).withColumnRenamed("batch", "entry")


def current_state(spark: SparkSession, path: str, base: DataFrame | None = None) -> DataFrame:
    """The state as of the newest version: of each product the last hash, the first and the last sight, and its source's
    high-water mark. It reads the buckets and at most the log entries since the last compaction; an empty state where none was written.
    A plain log of ``batch=<n>`` folders is read too. base: an older state that this one continues."""
    version = versions.current(spark, path)
    plain = not version.number and versions.there(spark, path) and not versions.there(spark, f"{path}/data")
    rows = _plain_log(spark, path) if plain else _all_rows(spark, version)
    if base is not None:
        rows = rows.unionByName(base.withColumn("entry", F.lit(-2).cast("long")))
    merged = _merged(rows).withColumnRenamed("high_water", "mark")
    marks = merged.groupBy("source").agg(F.max("mark").alias("high_water"))
    return merged.drop("mark").join(marks, "source", "left").select("source", "product_id", "content_hash", "first_seen", "last_seen", "high_water")
