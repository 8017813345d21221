"""Connected components of an edge table, and fixed-size bitmaps. Joins and aggregates only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of edges (a, b): root is the smallest node it is linked with.

    Alternating large-star and small-star rounds, each a shuffle of the edges with a reliable
    checkpoint; the number of rounds grows with the logarithm of the longest chain.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        e = cut(small.where("a <> b").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def bitmap(df: DataFrame, value: Column, bits: int = 23) -> np.ndarray:
    """A bitmap of 2 ** bits bits with one set for each value (its low bits). What reaches the driver
    is the bitmap itself, at most 2 ** (bits - 6) words, whatever the table's size."""
    low = value.bitwiseAND(F.lit((1 << bits) - 1))
    words = df.select(F.shiftright(low, 6).alias("word"), F.expr("1L").alias("one"), low.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    rows = words.groupBy("word").agg(F.expr("bit_or(shiftleft(one, bit))").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().astype(np.int64).view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & np.uint64(len(bits) * 64 - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
