"""Operator 11, periodic run detection by scale-tiled distribution. Exact.

A run is a longest stretch of words with smallest period q and at least ``max(LEAST, 3 q)`` words. In a run, word i equals
word i + q over at least ``max(LEAST, 3 q) - q`` places: its matches.

1. Octaves: the first holds periods under 16 and has borders 8 words apart, each further one holds the periods from B to under 2 B and has
   borders B apart. A run's matches always cover a whole block between two borders, so at one border the next B words occur again
   q words on. Rolling hashes find the borders where that holds: one comparison for each word and octave.
2. Tiles: neighbouring borders of that kind make a tile with the words around them, from B before the first to 4 B after the last, so tiles
   overlap. A document's tiles of all octaves become rows of their own, dealt out evenly whatever the document.
3. In a tile, the Z-function of the words after a border gives for each period how far the matches go on, and the one of the reversed words before it how
   far they go back. Periods whose first q words are themselves repetitions are left to the smaller period. What is found is cut at
   the tile's ends.
4. Fragments are shuffled by document and period and stitched: those that touch are one stretch of matches. Stretches that are long enough are runs.
5. Documents that had no tile take no part in this: they are read again and pass through.

Hashes only choose tiles; words are compared as words. Defined results: a null or empty text has no words; rows that repeat an id, or have none,
are documents of their own, ids may be of any type; an empty table gives an empty one; other columns are ignored, whatever their names. A text
needs some 80 bytes of memory for each of its bytes in its task, its tiles none.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .repeats import spaced
from .shared import written
from .textops import Ranges, Words, give_back, pieces

LEAST = 24
FIRST = 8
TILE_WORDS = 4096
TILE = "octave:int,lo:bigint,first:int,borders:int,ids:binary"


def borders(w: Words) -> dict[int, np.ndarray]:
    """For each octave the borders (word indexes of the batch) whose next words occur again at a period of the octave."""
    size = w.per_text
    most = int(size.max()) if len(size) else 0
    if most < LEAST:
        return {}
    rolling = Ranges(w.hashes())
    of = w.text_of()
    out = {}
    octave = FIRST
    while most >= max(LEAST, 3 * octave) or octave == FIRST:
        texts = np.flatnonzero(size >= (LEAST if octave == FIRST else 3 * octave))
        i = np.flatnonzero(np.isin(of, texts)) if len(texts) < len(size) else np.arange(len(w))
        local = i - w.first[of[i]]
        block = local + octave <= size[of[i]]  # a whole block begins here
        i, local = i[block], local[block]
        key = rolling.raw(i, i + octave)
        at = np.zeros(len(w), np.int64)
        at[i] = np.arange(len(i))
        if octave == FIRST:
            q = (local - 1) % octave + 1
            tries = [q, q + octave]
        else:
            tries = [local % octave + octave]
        found = []
        for q in tries:
            ok = local >= q
            b = i[ok] - q[ok]
            found.append(b[key[at[b]] == key[ok]])
        out[octave] = np.unique(np.concatenate(found))
        octave *= 2
    return {o: b for o, b in out.items() if len(b)}


def cut_tiles(ids: np.ndarray, where: dict[int, np.ndarray]) -> list[dict]:
    """The tiles of a document: ids of its words, and its borders by octave."""
    out = []
    for octave, found in where.items():
        most = max(4, TILE_WORDS // octave)
        breaks = np.flatnonzero(np.diff(found) != octave) + 1
        for chain in np.split(found, breaks):
            for k in range(0, len(chain), most):
                part = chain[k : k + most]
                lo, hi = max(0, int(part[0]) - octave), min(len(ids), int(part[-1]) + 4 * octave)
                out.append({"octave": octave, "lo": lo, "first": int(part[0]) - lo, "borders": len(part), "ids": zlib.compress(ids[lo:hi].astype("<i4").tobytes(), 1)})
    return out


def z_function(s: list[int], upto: int) -> list[int]:
    """z[i]: how many values from i on equal those from 0 on, for i under upto."""
    n = len(s)
    z = [0] * min(upto, n)
    lo = hi = 0
    for i in range(1, len(z)):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        if i + k >= hi:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            lo, hi = i, i + k
        z[i] = k
    return z


def solve(ids: list[int], octave: int, first: int, borders: int) -> dict[int, list[list[int]]]:
    """Stretches [start, stop) of matches at a tile's borders, by period."""
    out: dict[int, list[list[int]]] = {}
    least = 1 if octave == FIRST else octave
    for b in range(first, first + borders * octave, octave):
        z = z_function(ids[b : b + 4 * octave], 2 * octave)
        periods = [q for q in range(least, len(z)) if z[q] >= octave]
        if not periods:
            continue
        reach, starts = [], []  # prefixes of up to reach words have the period start
        for i in range(1, len(z)):
            if not reach or i + z[i] > reach[-1]:
                reach.append(i + z[i])
                starts.append(i)
        back = None
        for q in periods:
            p = starts[bisect_left(reach, q)]
            if p < q and q % p == 0:
                continue
            if back is None:
                lo, hi = max(0, b - octave), min(len(ids), b + 2 * octave)
                pattern = ids[lo:b][::-1]
                back = z_function([*pattern, -1, *ids[lo:hi][::-1]], len(pattern) + 1 + hi - lo)
            start, stop = b - back[len(pattern) + 1 + hi - b - q] if b > lo else b, b + min(z[q], 2 * octave)
            mine = out.setdefault(q, [])
            if mine and start <= mine[-1][1]:
                mine[-1][1] = max(stop, mine[-1][1])
            else:
                mine.append([start, stop])
    return out


def scan(docs: DataFrame, tiled: bool) -> DataFrame:
    """tiled: (id, words, tiles) of the documents with tiles. Else (id, words) of the others. docs: (id, text); words are joined by one space."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Words(piece.column(1))
                where = borders(w)
                of = w.text_of()
                has = np.zeros(piece.num_rows, bool)
                for found in where.values():
                    has[of[found]] = True
                rows = np.flatnonzero(has == tiled)
                data, start, end = spaced(w)
                text = [b"" if w.first[r] == w.first[r + 1] else data[start[w.first[r]] : end[w.first[r + 1] - 1]].tobytes() for r in rows]
                out = [piece.column(0).take(pa.array(rows)), pa.array([t.decode() for t in text], pa.string())]
                if not tiled:
                    yield pa.RecordBatch.from_arrays(out, ["id", "words"])
                    continue
                tiles = []
                for r, t in zip(rows, text, strict=True):
                    known: dict[bytes, int] = {}
                    ids = np.array([known.setdefault(x, len(known)) for x in t.split(b" ")], np.int64)
                    lo, hi = w.first[r], w.first[r + 1]
                    tiles.append(cut_tiles(ids, {o: f[np.searchsorted(f, lo) : np.searchsorted(f, hi)] - lo for o, f in where.items() if np.searchsorted(f, lo) < np.searchsorted(f, hi)}))
                each = pa.list_(pa.struct([("octave", pa.int32()), ("lo", pa.int64()), ("first", pa.int32()), ("borders", pa.int32()), ("ids", pa.binary())]))
                yield pa.RecordBatch.from_arrays([*out, pa.array(tiles, each)], ["id", "words", "tiles"])
        give_back()

    return docs.mapInArrow(run, f"id {kind}, words string" + (f", tiles array<struct<{TILE}>>" if tiled else ""))


def fragments(tiles: DataFrame) -> DataFrame:
    """(row, period, start, stop): stretches of matches in each tile; tiles: (row, octave, lo, first, borders, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for t in batch.to_pylist():
                ids = np.frombuffer(zlib.decompress(t["ids"]), "<i4").tolist()
                for q, found in solve(ids, t["octave"], t["first"], t["borders"]).items():
                    rows += [(t["row"], q, t["lo"] + a, t["lo"] + b) for a, b in found]
            cols = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "period", "start", "stop"])

    return tiles.mapInArrow(run, "row long, period long, start long, stop long")


def stitch(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, start, length, period) of each run: fragments of a document and period that touch are one."""
    by = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = found.withColumn("new", (before.isNull() | (F.col("start") > before)).cast("int"))
    whole = new.withColumn("stretch", F.sum("new").over(by)).groupBy("row", "period", "stretch").agg(F.min("start").alias("start"), (F.max("stop") - F.min("start") + F.col("period")).alias("length"))
    return whole.where((F.col("length") >= 3 * F.col("period")) & (F.col("length") >= least)).select("row", "start", "length", "period")


def tiled_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, words, tiles) of the documents with tiles, written once; row names a document."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return written(scan(named, True).withColumn("row", F.monotonically_increasing_id()), "tiles")


def runs_of(rows: DataFrame) -> DataFrame:
    """(row, start, length, period) of each run of rows from tiled_rows."""
    tiles = rows.select("row", F.explode("tiles").alias("t")).select("row", "t.*")
    return stitch(fragments(tiles.repartition("row", "octave", "lo")))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, period) of each run; start is a word number from 0."""
    rows = tiled_rows(docs, id_col, text_col)
    return runs_of(rows).join(rows.select("row", F.col("id").alias(id_col)), "row").select(id_col, "start", "length", "period")


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, runs): of each run only the first period stays, words are joined by one space; runs are sorted by start and period."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = tiled_rows(docs, id_col, text_col)
    runs = runs_of(rows).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    joined = rows.select("row", "id", "words").join(runs, "row", "left").select("id", "words", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for words, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if found:
                    words = words.split(" ")
                    step = np.zeros(len(words) + 1, np.int64)
                    for r in found:
                        step[r["start"] + r["period"]] += 1
                        step[r["start"] + r["length"]] -= 1
                    words = " ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])
                texts.append(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2)], ["id", "text", "runs"])

    shape = "array<struct<start:bigint,period:bigint,length:bigint>>"
    with_runs = joined.mapInArrow(run, f"id {kind}, text string, runs {shape}")
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    clean = scan(named, False).select("id", F.col("words").alias("text"), F.expr(f"cast(null as {shape})").alias("runs"))
    return with_runs.unionByName(clean).select(F.col("id").alias(id_col), "text", F.coalesce("runs", F.expr(f"cast(array() as {shape})")).alias("runs"))


WORD = r"[^\x20\x09-\x0D]+"


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts after the query's own rule, by which a tenth of the documents repeat themselves from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    # words, n, g, a, p: each bound once by a transform over one value
    rule = f"""
      transform(array(regexp_extract_all(text, r'{WORD}', 0)), ws ->
        transform(array(named_struct('a', int(g % size(ws)), 'n', size(ws))), s ->
          transform(array(int(1 + floor((s.n - s.a) / (3 + g % 8)))), p ->
            array_join(transform(sequence(0, s.n - 1), i -> if(i < s.a, ws[i], ws[s.a + (i - s.a) % p])), ' '))[0])[0])[0]"""
    some = F.col("text").rlike(WORD) & (h % 10 == 0)
    return docs.select("doc_id", "text", F.floor(h / 10).alias("g"), some.alias("some")).select("doc_id", F.when(F.col("some"), F.expr(rule)).otherwise(F.col("text")).alias("text"))


def best_run(runs: Column) -> Column:
    """The run of greatest exponent (length / period); of equals the first, then that of the smallest period."""

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(x != y, F.when(x > y, -1).otherwise(1)).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, order), F.lit(0))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = collapse_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    text = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best_run(F.col("runs")).alias("r"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
    milli = F.expr("r.length * 1000 div r.period")
    return out.select("doc_id", "n_runs", F.col("r.start").alias("start"), F.col("r.length").alias("length"), F.col("r.period").alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
#: Plain SQL, by another way: equal 8-word phrases of a document propose periods, then all its matches of a period are lined up.
ORACLE = {
    "op11_periodic_runs": r"""
WITH tab AS (SELECT list(v ORDER BY k) AS t FROM (SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, s: xor(c >> 1, (c & 1) * 3988292384)) AS v FROM range(256) AS x(k))),
w0 AS (SELECT doc_id, crc AS h, crc // 10 AS g, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM (SELECT doc_id, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, tab)),
w1 AS (SELECT *, CASE WHEN len(ws) > 0 THEN g % len(ws) END AS a FROM w0),
w AS MATERIALIZED (SELECT doc_id, CASE WHEN h % 10 = 0 AND len(ws) > 0
    THEN list_transform(range(len(ws)), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (len(ws) - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws FROM w1),
i AS MATERIALIZED (SELECT doc_id, len(ws) AS n, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w WHERE len(ws) >= 24),
p8 AS MATERIALIZED (SELECT doc_id, i, n, hash(word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d, lead(word, 5) OVER d, lead(word, 6) OVER d, lead(word, 7) OVER d) AS p
  FROM i WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
q AS MATERIALIZED (SELECT DISTINCT a.doc_id, b.i - a.i AS q FROM p8 AS a JOIN p8 AS b ON a.doc_id = b.doc_id AND a.p = b.p AND b.i > a.i AND 3 * (b.i - a.i) <= a.n WHERE a.i % 8 = 0),
m AS (SELECT a.doc_id, q.q, a.i, a.i - row_number() OVER (PARTITION BY a.doc_id, q.q ORDER BY a.i) AS island FROM q JOIN i AS a ON a.doc_id = q.doc_id JOIN i AS b ON b.doc_id = a.doc_id AND b.i = a.i + q.q AND b.word = a.word),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM m GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
r AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.i) AS text FROM (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w) AS a ANTI JOIN dropped AS d ON d.doc_id = a.doc_id AND d.i = a.i GROUP BY a.doc_id),
best AS (SELECT doc_id, start, length, period FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length // period DESC, (length % period) * 1000000000000 // period DESC, start, period) AS k FROM r) WHERE k = 1),
n AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN best ON best.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
}
