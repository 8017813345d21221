import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import IntegralType

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


def plain(x):
    if x is None or x is pd.NA or x != x:
        return None
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, list):
        return str([plain(y) for y in x])
    if isinstance(x, float):
        return repr(round(x, 6))
    if hasattr(x, "is_finite"):
        return repr(round(float(x), 6))
    return str(x)


def rows_of(frame):
    """Rows of a pandas frame by column name, ready to compare without order."""
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(v) for v in r) for r in frame.astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="session")
def same():
    def check(spark_frame, duck_frame):
        a, b = spark_frame.toPandas(), duck_frame.df()
        for f in spark_frame.schema:  # whole numbers with nulls come as floats
            if isinstance(f.dataType, IntegralType):
                a[f.name] = a[f.name].astype("Int64")
        assert sorted(a.columns) == sorted(b.columns)
        assert rows_of(a) == rows_of(b)

    return check
