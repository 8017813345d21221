"""Tables written into the folder that driver and executors share, to cut lineage; names; the package for the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from loomcat.sources.folder import new_path, shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts lineage and survives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to be none of the taken ones (upper and lower case are one)."""
    low = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in low:
            name = f"_{name}"
        low.add(name.lower())
        out.append(name)
    return out


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a narrow table."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each Spark context (what --py-files does). The archive is
    made on the driver, whose file server hands it out: executors never read the driver's folder."""
    sc = spark.sparkContext
    if getattr(sc, "_loomcat_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "loomcat.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._loomcat_shipped = True
