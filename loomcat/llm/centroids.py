"""Operator 13, centroid clustering with Ptolemaic pivots. Exact.

Vectors become integers, ``floor(1024 * x)``. Centroids begin as the vectors of smallest hash. A round assigns every vector to
its nearest centroid and replaces each centroid by the floor of its vectors' mean; an empty one stays.

For points x, c and pivots p, s, Ptolemy's inequality gives ``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``. Pivots are
fixed: ``PIVOTS`` vectors of a bounded sample, each as far as can be from those before. Every vector's distances to them are computed once and kept
with it. In a round the centroids' distances to the pivots are computed once for all; a vector's best bound over all pivot pairs is
taken for each centroid, rounded down by more than floating point can err. The centroid of the smallest bound is checked
first, exactly, in integers; another is checked only if its bound does not exceed that distance, so ties are never lost.

A round is one scan of the kept table and a sum for each (cluster, component): what is shuffled and what reaches the driver are
clusters x components numbers, whatever the number of vectors. No assignment is kept between rounds, so a lost task is only read again.

Defined results: a vector of another length, or with a null or non-finite component, or a null one, is left out. Rows that repeat
an id are vectors of their own; of equal hashes the smaller components come first; null ids come last (and hash as ``3:``). With fewer
kept vectors than clusters each is a centroid; an empty table gives no rows. Components beyond 2**26 in size (after scaling) are worked out in Python integers, and a distance
or inertia that no long holds is an error. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .textops import give_back

DIM, CLUSTERS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3:"
PIVOTS = 8
#: Rows that pivots are chosen from.
SAMPLE = 2048
#: Components up to this size are safe in 64-bit sums of squares.
SAFE = 1 << 26
#: Part of a bound that is given up for rounding; errors are a few times 2**-53 of the products.
SLACK = 1e-9
ROWS = 4096


def scaled(values: np.ndarray, scale: int) -> np.ndarray | None:
    """floor(scale * x) of finite doubles as int64; None where a component is too large for that."""
    with np.errstate(over="ignore"):
        out = np.floor(values * scale)
    return out.astype(np.int64) if len(out) == 0 or np.abs(out).max() <= SAFE else None


def exact_scaled(values: list[float], scale: int) -> list[int]:
    return [math.floor(x * scale) if abs(x) < 2.0**60 else int(x) * scale for x in values]


class Vectors:
    """Integer vectors of a batch: int64 where that is safe, else Python integers."""

    def __init__(self, ints: np.ndarray):
        self.ints = ints

    def to(self, rows: np.ndarray, point: list[int]) -> np.ndarray:
        """Exact squared distances of rows to a point."""
        mine = self.ints[rows]
        if mine.dtype == object or max(map(abs, point), default=0) > SAFE:
            diff = mine.astype(object) - np.array(point, object)
        else:
            diff = mine - np.array(point, np.int64)
        return (diff * diff).sum(axis=1)


def _root(squares) -> np.ndarray:
    return np.sqrt(np.asarray(squares).astype(np.float64))


def bounds(near: np.ndarray, far: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, vectors x centroids, from distances to the pivots: near of vectors, far of centroids, between pivots."""
    best = np.zeros((len(near), len(far)))
    for p, s in combinations(range(near.shape[1]), 2):
        if between[p, s] == 0:
            continue
        a, b = np.outer(near[:, p], far[:, s]), np.outer(near[:, s], far[:, p])
        np.maximum(best, (np.abs(a - b) - SLACK * (a + b)) / (between[p, s] * (1 + SLACK)), out=best)
    return best * best * (1 - SLACK)


def nearest(v: Vectors, near: np.ndarray, centroids: list[list[int]], pivots: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, distances computed) of each vector; of equal ones the smaller number."""
    n = len(v.ints)
    far = np.array([_root([sum((a - b) ** 2 for a, b in zip(c, p, strict=True)) for p in pivots]) for c in centroids])
    between = np.array([_root([sum((a - b) ** 2 for a, b in zip(p, s, strict=True)) for s in pivots]) for p in pivots])
    low = bounds(near, far, between)
    first = low.argmin(axis=1)
    found, best = np.zeros(n, np.int64), np.zeros(n, v.ints.dtype)
    checked = n
    for c, point in enumerate(centroids):
        rows = np.flatnonzero(first == c)
        if len(rows):
            d = v.to(rows, point)
            if d.dtype == object and best.dtype != object:
                best = best.astype(object)
            found[rows], best[rows] = c, d
    top = best.astype(np.float64)
    for c, point in enumerate(centroids):
        rows = np.flatnonzero((first != c) & (low[:, c] <= top))
        if not len(rows):
            continue
        checked += len(rows)
        d = v.to(rows, point)
        if d.dtype == object and best.dtype != object:
            best = best.astype(object)
        wins = (d < best[rows]) | ((d == best[rows]) & (c < found[rows]))
        rows, d = rows[wins], d[wins]
        found[rows], best[rows], top[rows] = c, d, d.astype(np.float64)
    return found, best, checked


def _decoded(batch: pa.RecordBatch, dim: int, pivots: int) -> Iterator[tuple[pa.Array, Vectors, np.ndarray]]:
    """(ids, vectors, distances to the pivots): rows of 64-bit integers and rows of long ones apart."""
    ids, ints, texts, near = (batch.column(i) for i in range(4))
    wide = np.asarray(pa.compute.is_valid(texts))
    for rows, made in ((np.flatnonzero(~wide), lambda r: np.frombuffer(b"".join(ints.take(r).to_pylist()), "<i8").reshape(-1, dim)), (np.flatnonzero(wide), lambda r: np.array([[int(x) for x in t.split(",")] for t in texts.take(r).to_pylist()], object))):
        if len(rows):
            r = pa.array(rows)
            yield ids.take(r), Vectors(made(r)), np.frombuffer(b"".join(near.take(r).to_pylist()), "<f8").reshape(len(rows), pivots)


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """(id, ints, wide): kept vectors as little-endian 64-bit integers, or as decimal text if they are too large for that."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                ids, lists = batch.column(0).slice(lo, ROWS), batch.column(1).slice(lo, ROWS)
                rows = np.flatnonzero(np.asarray(pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(lists), dim), False)))
                flat = lists.take(pa.array(rows)).flatten()
                values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim) if len(rows) else np.zeros((0, dim))
                good = np.isfinite(values).all(axis=1)  # a null is NaN by now
                rows, values = rows[good], values[good]
                ints = scaled(values, scale)
                if ints is None:
                    each = [scaled(v, scale) for v in values]
                    small = [None if v is None else v.astype("<i8").tobytes() for v in each]
                    wide = [None if e is not None else ",".join(map(str, exact_scaled(v.tolist(), scale))) for e, v in zip(each, values, strict=True)]
                else:
                    small, wide = [v.astype("<i8").tobytes() for v in ints], [None] * len(ints)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(small, pa.binary()), pa.array(wide, pa.string())], ["id", "ints", "wide"])

    return vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).mapInArrow(run, f"id {kind}, ints binary, wide string")


def _points(rows: list) -> list[list[int]]:
    return [np.frombuffer(r.ints, "<i8").tolist() if r.wide is None else [int(x) for x in r.wide.split(",")] for r in rows]


def spread(points: list[list[int]], n: int) -> list[list[int]]:
    """n points, each as far as can be from those before (the first of equals); fewer if there are not as many different ones."""
    if not points:
        return []
    out = [points[0]]
    v = Vectors(np.array(points, object if max(abs(x) for p in points for x in p) > SAFE else np.int64))
    away = v.to(np.arange(len(points)), out[0])
    while len(out) < n and away.max() > 0:
        out.append(points[int(away.argmax())])
        away = np.minimum(away, v.to(np.arange(len(points)), out[-1]))
    return out


def with_pivots(rows: DataFrame, pivots: list[list[int]], dim: int) -> DataFrame:
    """rows with ``near``, each vector's distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blank = pa.array([b""] * batch.num_rows, pa.binary())
            for ids, v, _ in _decoded(pa.RecordBatch.from_arrays([*batch.columns, blank], ["id", "ints", "wide", "near"]), dim, 0):
                all_ = np.arange(len(v.ints))
                near = np.stack([_root(v.to(all_, p)) for p in pivots], axis=1)
                wide = v.ints.dtype == object
                own = [None] * len(ids) if wide else [x.tobytes() for x in v.ints.astype("<i8")]
                text = [",".join(map(str, x)) for x in v.ints] if wide else [None] * len(ids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.binary()), pa.array(text, pa.string()), pa.array([x.tobytes() for x in near.astype("<f8")], pa.binary())], ["id", "ints", "wide", "near"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ints binary, wide string, near binary")


def means(table: DataFrame, centroids: list[list[int]], pivots: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centroids), dim), object), [0] * len(centroids)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                for _, v, near in _decoded(batch.slice(lo, ROWS), dim, len(pivots)):
                    found, _, _ = nearest(v, near, centroids, pivots)
                    for c in np.unique(found):
                        mine = v.ints[found == c]
                        total[c] += mine.sum(axis=0).astype(object)
                        count[c] += len(mine)
        rows = [(c, j, str(total[c, j]), count[c]) for c in range(len(centroids)) if count[c] for j in range(dim)]
        c, j, s, n = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(j, pa.int32()), pa.array(s, pa.string()), pa.array(n, pa.int64())], ["c", "j", "s", "n"])

    sums = table.mapInArrow(run, "c int, j int, s string, n long").groupBy("c", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = [list(c) for c in centroids]
    for r in sums.collect():  # clusters x components rows
        out[r.c][r.j] = int(r.s) // r.n
    return out


def assigned(table: DataFrame, centroids: list[list[int]], pivots: list[list[int]], dim: int) -> DataFrame:
    """(id, cluster, distance, checked): checked counts the distances computed for the row's batch, on its first row."""
    kind = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                for ids, v, near in _decoded(batch.slice(lo, ROWS), dim, len(pivots)):
                    found, best, checked = nearest(v, near, centroids, pivots)
                    work = np.zeros(len(found), np.int64)
                    work[:1] = checked
                    yield pa.RecordBatch.from_arrays([ids, pa.array(found.astype(np.int32)), pa.array([int(x) for x in best], pa.int64()), pa.array(work)], ["id", "cluster", "distance", "checked"])
        give_back()

    return table.mapInArrow(run, f"id {kind}, cluster int, distance long, checked long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = SALT) -> tuple[DataFrame, list[list[int]]]:
    """((id_col, cluster, distance, checked) of each kept vector, the final centroids)."""
    rows = written(integer_rows(vectors, id_col, vec_col, dim, scale), "vectors")
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    centroids = _points(rows.orderBy(F.col("id").isNull(), digest, "wide", "ints").limit(clusters).collect())
    # a pseudo-random sample of bounded size; pivots only change what the bounds spare, never a result
    pivots = spread(_points(rows.orderBy(F.xxhash64("id", "ints", "wide")).limit(SAMPLE).collect()), PIVOTS)
    if not pivots:
        empty = rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("checked"))
        return empty.where("false"), []
    table = written(with_pivots(rows, pivots, dim), "pivots")
    for _ in range(rounds):
        new = means(table, centroids, pivots, dim)
        if new == centroids:
            break
        centroids = new
    return written(assigned(table, centroids, pivots, dim).withColumnRenamed("id", id_col), "clusters"), centroids


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digests = [(c, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for c, p in enumerate(centroids)]
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # at most one row for each cluster
    total = each.agg(F.sum("cluster_inertia").alias("inertia"))
    per = each.join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster").join(F.broadcast(total))
    return found.drop("checked").join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The rounds one after the other, each over the vectors in long form."""
    flat = ", ".join(f"c{r} AS MATERIALIZED ({{}})" for r in range(ROUNDS + 1))
    first = f"SELECT row_number() OVER (ORDER BY sha256('{SALT}' || CAST(vec_id AS VARCHAR))) - 1 AS k, v FROM v ORDER BY sha256('{SALT}' || CAST(vec_id AS VARCHAR)) LIMIT {CLUSTERS}"
    near = "SELECT vec_id, any_value(v) AS v, min(d) % 1000 AS k, min(d) // 1000 AS d FROM (SELECT v.vec_id, v.v, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) * 1000 + c.k AS d FROM v CROSS JOIN c{r} AS c) GROUP BY vec_id"
    mean = (
        "SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} AS c LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v "
        "FROM (SELECT k, j, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(len(v))) AS j FROM ({near})) GROUP BY k, j) GROUP BY k) AS m ON m.k = c.k"
    )
    steps = [first] + [mean.format(r=r, near=near.format(r=r)) for r in range(ROUNDS)]
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
{flat.format(*steps)},
a AS MATERIALIZED ({near.format(r=ROUNDS)})
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a JOIN c{ROUNDS} AS c ON c.k = a.k
"""


QUERIES = {"op13_centroids": op13_centroids}
ORACLE = {"op13_centroids": _oracle()}
