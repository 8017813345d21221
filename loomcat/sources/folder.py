"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local session (tests, a laptop) gets a new temporary
    folder, which is then also its checkpoint folder; on a cluster that is an error, as no other machine would see it."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_loomcat_dir", None)
    if not at:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(at)
        sc._loomcat_dir = at
    return at


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark).rstrip('/')}/loomcat-{name}-{uuid.uuid4().hex}"
