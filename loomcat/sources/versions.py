"""Tables in hash buckets under a versioned manifest: whole writes, readers that see one version, bounded reads.

A path holds one or more named tables. Their files are in folders that never change once they are written:

    <path>/data/<name>-<uuid>/bucket=<b>/...   rows of one bucket of a table
    <path>/data/<name>-<uuid>/...              a log entry: rows of a table that have not been put into buckets yet
    <path>/manifest/version=<n>/               one file: the folders that make up version n

A writer first writes its folders and then the manifest, a single file that appears at once. Until then readers see the version before;
folders that no manifest names are never read. A bucket that a write does not touch keeps its folder, so its files keep their
names. There is one writer at a time for a path.

A manifest has a row for each bucket of each table (at most ``buckets``), each log entry (few after a compaction) and each
writer (the last batch it wrote, so a batch that comes again has no effect). These rows are all that reaches the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_DDL = "kind string, name string, bucket int, folder string, number bigint"


@dataclass(frozen=True)
class Version:
    """What a manifest says. buckets: folder of each (table, bucket); logs: (number, folder) of each table's entries, oldest first;
    batches: the last batch of each writer; sizes: into how many buckets each table is dealt, fixed by its first write."""

    number: int = 0
    buckets: dict[tuple[str, int], str] = field(default_factory=dict)
    logs: dict[str, tuple[tuple[int, str], ...]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)


def bucket_of(n: int, *keys: str) -> Column:
    """The bucket of a row among n, by its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def current(spark: SparkSession, path: str) -> Version:
    """The newest version; version 0, with nothing in it, where none was written."""
    if not there(spark, f"{path}/manifest"):
        return Version()
    rows = spark.read.schema(f"{MANIFEST_DDL}, version bigint").parquet(f"{path}/manifest")
    newest = rows.agg(F.max("version")).first()[0]  # folders' names
    if newest is None:
        return Version()
    out = Version(newest)
    for r in rows.where(F.col("version") == newest).orderBy("number").collect():
        if r.kind == "bucket":
            out.buckets[r.name, r.bucket] = r.folder
        elif r.kind == "log":
            out.logs[r.name] = (*out.logs.get(r.name, ()), (r.number, r.folder))
        elif r.kind == "writer":
            out.batches[r.name] = r.number
        elif r.kind == "size":
            out.sizes[r.name] = r.number
    return out


def commit(spark: SparkSession, path: str, version: Version) -> Version:
    """Makes version the newest one, in a single file. Fails if that number is taken."""
    rows = [("bucket", name, b, folder, None) for (name, b), folder in version.buckets.items()]
    rows += [("log", name, None, folder, n) for name, logs in version.logs.items() for n, folder in logs]
    rows += [("writer", name, None, None, n) for name, n in version.batches.items()]
    rows += [("size", name, None, None, n) for name, n in version.sizes.items()]
    rows = rows or [("empty", None, None, None, None)]
    spark.createDataFrame(rows, MANIFEST_DDL).coalesce(1).write.parquet(f"{path}/manifest/version={version.number}")
    return version


def read(spark: SparkSession, version: Version, name: str, ddl: str, buckets: set[int] | None = None) -> DataFrame:
    """Rows of a table's buckets: all, or some."""
    folders = [f for (n, b), f in version.buckets.items() if n == name and (buckets is None or b in buckets)]
    return spark.read.schema(ddl).parquet(*folders) if folders else spark.createDataFrame([], ddl)


def read_log(spark: SparkSession, version: Version, name: str, ddl: str) -> DataFrame:
    """Rows of a table's log with ``entry``, the number of the version that wrote them."""
    out = spark.createDataFrame([], f"{ddl}, entry bigint")
    for n, folder in version.logs.get(name, ()):
        out = out.unionByName(spark.read.schema(ddl).parquet(folder).withColumn("entry", F.lit(n).cast("long")))
    return out


def write_buckets(path: str, name: str, rows: DataFrame, touched: set[int], n: int, *keys: str) -> dict[tuple[str, int], str | None]:
    """Writes the new rows of the touched buckets, each by one task; the folder of each, None where nothing is left."""
    folder = f"{path}/data/{name}-{uuid.uuid4().hex}"
    spark = rows.sparkSession
    rows.withColumn("bucket", bucket_of(n, *keys)).repartition(max(1, len(touched)), "bucket").write.partitionBy("bucket").parquet(folder)
    kept = {b for b in touched if there(spark, f"{folder}/bucket={b}")}
    return {(name, b): f"{folder}/bucket={b}" if b in kept else None for b in touched}


def with_buckets(version: Version, changed: dict[tuple[str, int], str | None]) -> dict[tuple[str, int], str]:
    """version's buckets with the changed ones in their place."""
    return {k: f for k, f in (version.buckets | changed).items() if f is not None}


def append_log(path: str, name: str, rows: DataFrame) -> str:
    folder = f"{path}/data/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return folder


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes folders that none of the newest ``keep`` versions names, and older manifests; how many. Run it when no
    reader uses an older version and no write is under way."""
    newest = current(spark, path).number
    kept = spark.read.schema(f"{MANIFEST_DDL}, version bigint").parquet(f"{path}/manifest").where(F.col("version") > newest - keep)
    used = {r.folder for r in kept.where("folder IS NOT NULL").select("folder").distinct().collect()}
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    tail = lambda p: p.rstrip("/").rsplit("/data/", 1)[-1]
    used = {tail(f) for f in used}
    roots = {f.split("/")[0] for f in used}
    gone = 0

    def inside(p) -> list:
        return [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []

    for folder in inside(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")):
        name = folder.getName()
        if name in used:
            continue
        if name not in roots:
            gone += fs.delete(folder, True)
            continue
        for part in inside(folder):
            if part.getName().startswith("bucket=") and f"{name}/{part.getName()}" not in used:
                gone += fs.delete(part, True)
    for folder in inside(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")):
        number = folder.getName().removeprefix("version=")
        if number.isdigit() and int(number) <= newest - keep:
            gone += fs.delete(folder, True)
    return gone
