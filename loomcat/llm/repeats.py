"""Operator 5, substring dedup by repeated-phrase automata. Exact.

A word is removed if a window of ``WINDOW`` words that covers it occurs more than once in the corpus.

1. Anchors: every window has one anchor, the ``GRAM``-word phrase in it with the smallest hash (leftmost of
   equals), so equal windows have equal anchors. Neighbouring windows share theirs: about one word in
   fourteen is an anchor. Counting anchors leaves those that recur, kept as a fixed-size bitmap.
2. Regions: the words of the windows around each recurring anchor, written once.
3. Confirmed passages: windows of regions are counted by (anchor, digest); those that recur are confirmed.
4. Automata: anchors are dealt to shards of bounded size by their hash, frequent ones to several. Each shard compiles its
   confirmed passages (windows that begin one after the other) into an Aho-Corasick automaton over words, and every region that can hold one of them streams through them: what an
   automaton matches, and nothing else, is covered. A document's other words are around anchors that occur once, so no confirmed
   window is among them, and each document is covered without being sent to each shard.
5. The covered word ranges return to their documents.

Defined results: a null text has no words; the hash of no words' text is that of the empty string; rows
that repeat an id are documents of their own; fewer than WINDOW words: nothing is removed; an empty table gives an empty
one; other columns are ignored, whatever their names. A text needs some 80 bytes of memory for each of its bytes in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import bitmap, in_bitmap
from .shared import written
from .textops import U64, Ranges, Words, pieces

WINDOW = 35
GRAM = 8
BITS = 25
SHARD_ROWS = 20_000
#: Words of the phrases of one automaton; there are 1,112,000 characters.
PHRASE_WORDS = 1_000_000
HOT_ROWS = 5_000


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, at, hash) of each anchor of a batch: it is the anchor of the windows that begin at words
    lo to hi, and itself begins at word at."""
    i = w.windows(WINDOW)
    if not len(i):
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, U64)
    n = len(w) - GRAM + 1
    value = Ranges(w.hashes()).hash(np.arange(n), np.arange(n) + GRAM)
    place = np.arange(n)
    gram = value
    span, most = 1, WINDOW - GRAM + 1

    def leftmost(step: int) -> None:
        nonlocal value, place
        a, b = value[:-step], value[step:]
        right = b < a
        value, place = np.where(right, b, a), np.where(right, place[step:], place[:-step])

    while span * 2 <= most:
        leftmost(span)
        span *= 2
    if span < most:
        leftmost(most - span)
    at = place[i]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (i[1:] != i[:-1] + 1)])
    last = np.r_[new[1:] - 1, len(i) - 1]
    return i[new], i[last], at[new], gram[at[new]]


def spaced(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes with one space after each, and each word's start and end there."""
    size = w.end - w.start
    start = np.cumsum(size + 1) - size - 1
    data = np.full(int(size.sum()) + len(size), 32, np.uint8)
    data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = w.data[w.word_mask]
    return data, start, start + size


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    from .bpe import gather

    length = end - start
    at = np.zeros(len(start) + 1, np.int32)
    np.cumsum(length, out=at[1:])
    flat = gather(data, start, length)
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(flat.tobytes())])


def recurring_anchors(docs: DataFrame) -> np.ndarray:
    """Bitmap of the anchors that occur twice or more; docs: (id, h, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(anchors(Words(piece.column(0)))[3].view(np.int64))], ["anchor"])

    found = docs.select("text").mapInArrow(run, "anchor long")
    return bitmap(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), F.col("anchor"), BITS)


def regions(docs: DataFrame, recurring: np.ndarray, id_kind: str) -> DataFrame:
    """(id, h, lo, anchor, words): the words of all windows around each recurring anchor; lo is the
    place of the first one in its document."""
    shared = docs.sparkSession.sparkContext.broadcast(recurring)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Words(piece.column(2))
                lo, hi, _, h = anchors(w)
                keep = in_bitmap(shared.value, h)
                lo, hi, h = lo[keep], hi[keep], h[keep]
                of = w.text_of()[lo] if len(lo) else lo
                data, start, end = spaced(w)
                text = _strings(data, start[lo], end[hi + WINDOW - 1])
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays([piece.column(0).take(take), piece.column(1).take(take), pa.array(lo - w.first[of]), pa.array(h.view(np.int64)), text], ["id", "h", "lo", "anchor", "words"])

    return docs.select("id", "h", "text").mapInArrow(run, f"id {id_kind}, h long, lo long, anchor long, words string")


def window_digests(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, digest) of each window."""
    i = w.windows(WINDOW)
    return i, Ranges(w.hashes() * U64(0x9FB21C651E98DF25)).hash(i, i + WINDOW)


def confirmed(found: DataFrame) -> DataFrame:
    """(anchor, digest) of each window that occurs twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "words"):
                w = Words(piece.column(1))
                i, digest = window_digests(w)
                anchor = np.asarray(piece.column(0))[w.text_of()[i]] if len(i) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(digest.view(np.int64))], ["anchor", "digest"])

    rows = found.select("anchor", "words").mapInArrow(run, "anchor long, digest long")
    return rows.groupBy("anchor", "digest").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "digest")


def phrases_of(w: Words, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each confirmed passage: the words of confirmed windows that begin one word after the other."""
    i, digest = window_digests(w)
    i = i[np.isin(digest.view(np.int64), digests)]
    if not len(i):
        return i, i
    breaks = np.flatnonzero(np.diff(i) != 1)
    of = w.text_of()
    breaks = np.union1d(breaks, np.flatnonzero(of[i[1:]] != of[i[:-1]]))
    return i[np.r_[0, breaks + 1]], i[np.r_[breaks, len(i) - 1]] + WINDOW


def compiled(phrases: list[str]):
    """The automaton of the phrases; a match tells the phrase's length."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for p in phrases:
        automaton.add_word(p, len(p))
    if phrases:
        automaton.make_automaton()
    return automaton


def found_words(w: Words, start: np.ndarray, stop: np.ndarray, compile_=compiled) -> np.ndarray:
    """Which words an occurrence of a phrase covers; start, stop: the words of each phrase. The automaton reads words, not letters: each word of
    the phrases is a character of its own, every other word one character that no phrase has. Phrases of ``PHRASE_WORDS`` words at
    a time have fewer words than there are characters. A text that repeats is read once."""
    cover = np.zeros(len(w) + 1, np.int64)
    word = _strings(w.data, w.start, w.end).dictionary_encode()
    ids, n = np.asarray(word.indices), len(word.dictionary)
    upto = np.cumsum(stop - start)
    for k in range(int(upto[-1] // PHRASE_WORDS) + 1 if len(upto) else 0):
        part = upto // PHRASE_WORDS == k
        marks = np.zeros(len(w) + 1, np.int64)
        np.add.at(marks, start[part], 1)
        np.subtract.at(marks, stop[part], 1)
        used = np.unique(ids[np.cumsum(marks[:-1]) > 0])
        code = np.full(n, 1, np.uint32)
        code[used] = np.arange(2, len(used) + 2)
        code[code >= 0xD800] += 0x800  # no surrogates
        text = code[ids].astype("<u4").tobytes().decode("utf-32-le")
        automaton = compile_(list(dict.fromkeys(text[a:b] for a, b in zip(start[part].tolist(), stop[part].tolist(), strict=True))))
        if not len(automaton):
            continue
        seen: dict[str, list[tuple[int, int]]] = {}
        begins, ends = [], []
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            t = text[a:b]
            if (hits := seen.get(t)) is None:
                hits = seen[t] = [(end + 1 - size, end + 1) for end, size in automaton.iter(t)]
            begins += [a + s for s, _ in hits]
            ends += [a + e for _, e in hits]
        np.add.at(cover, np.array(begins, np.int64), 1)
        np.subtract.at(cover, np.array(ends, np.int64), 1)
    return np.cumsum(cover[:-1]) > 0


def locate(found: DataFrame, passages: DataFrame, id_kind: str) -> DataFrame:
    """(id, h, start, stop): word ranges covered by confirmed windows, by sharded automata."""
    spark = found.sparkSession
    counts = found.groupBy("anchor").agg(F.count("*").alias("n"))
    hot = written(counts.where(F.col("n") > HOT_ROWS).select("anchor", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("copies")), "hot")
    small = hot.count() <= 100_000  # at most one row for each HOT_ROWS regions
    shards = max(1, -(-found.count() // SHARD_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def dealt(df: DataFrame, salted) -> DataFrame:
        df = df.join(F.broadcast(hot) if small else hot, "anchor", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
        df = df.withColumn("salt", salted)
        return df.withColumn("shard", F.pmod(F.xxhash64("anchor", "salt"), F.lit(shards))).drop("copies", "salt")

    streamed = dealt(found, F.pmod(F.xxhash64("h", "lo"), F.col("copies")).cast("int"))
    phrases = dealt(passages, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def run(key: tuple, text: pa.Table, known: pa.Table) -> pa.Table:
        schema = pa.schema([("id", text.schema.field("id").type), ("h", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
        if not known.num_rows or not text.num_rows:
            return schema.empty_table()
        text = text.filter(pa.array(np.isin(text.column("anchor").to_numpy(), known.column("anchor").to_numpy())))
        w = Words(text.column("words"))
        first = w.first
        inside = np.r_[False, found_words(w, *phrases_of(w, known.column("digest").to_numpy())), False]
        # ranges end with their region
        edge = np.zeros(len(w) + 1, bool)
        edge[first] = True
        begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        of = w.text_of()[begins] if len(begins) else begins
        shift = text.column("lo").to_numpy()[of] - first[of]
        rows = text.select(["id", "h"]).take(pa.array(of))
        return pa.table([rows.column("id"), rows.column("h"), pa.array(begins + shift), pa.array(ends + shift)], schema=schema)

    return streamed.groupBy("shard").cogroup(phrases.groupBy("shard")).applyInArrow(run, f"id {id_kind}, h long, start long, stop long")


def repeated_ranges(docs: DataFrame, id_kind: str) -> DataFrame:
    """(id, h, ranges): the removable word ranges of each document that has any; docs: (id, h, text)."""
    found = written(regions(docs, recurring_anchors(docs), id_kind), "regions")
    spans = locate(found, written(confirmed(found), "confirmed"), id_kind)
    return spans.distinct().groupBy("id", "h").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): id and the text's hash name a document, so rows may repeat an id."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


def remove_repeats(docs: DataFrame, out_ddl: str, finish, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """finish(ids, words, gone) makes the Arrow batch of a piece: gone tells for each word if it is removed."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = keyed(docs, id_col, text_col)
    ranges = repeated_ranges(texts, kind).select(F.col("id").alias("rid"), F.col("h").alias("rh"), "ranges")
    joined = texts.join(ranges, F.col("id").eqNullSafe(F.col("rid")) & (F.col("h") == F.col("rh")), "left").select("id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = Words(piece.column(1))
                spans = piece.column(2)
                of = pa.compute.list_parent_indices(spans).to_numpy()
                flat = spans.flatten()
                step = np.zeros(len(w) + 1, np.int64)
                if len(flat):
                    np.add.at(step, w.first[of] + flat.field("start").to_numpy(), 1)
                    np.subtract.at(step, w.first[of] + flat.field("stop").to_numpy(), 1)
                yield finish(piece.column(0), w, np.cumsum(step[:-1]) > 0)

    return joined.mapInArrow(run, out_ddl)


def kept_texts(ids: pa.Array, w: Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words and removed words of each text, and the kept words joined by one space."""
    from .bpe import gather

    total = np.zeros(len(w) + 1, np.int64)
    np.cumsum(gone, out=total[1:])
    removed = total[w.first[1:]] - total[w.first[:-1]]
    data, start, end = spaced(w)
    keep = ~gone
    size = (end - start + 1)[keep]
    flat = gather(data, start[keep], size).tobytes()
    upto = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=upto[1:])
    cut = upto[w.first - total[w.first]]
    return w.per_text, removed, [flat[a : max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def dedup_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, n_words, n_removed): texts of the kept words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(ids: pa.Array, w: Words, gone: np.ndarray) -> pa.RecordBatch:
        n, removed, texts = kept_texts(ids, w, gone)
        return pa.RecordBatch.from_arrays([ids, pa.array([t.decode() for t in texts], pa.string()), pa.array(n), pa.array(removed)], ["id", "text", "n_words", "n_removed"])

    return remove_repeats(docs, f"id {kind}, text string, n_words long, n_removed long", finish, id_col, text_col).withColumnRenamed("id", id_col)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    def finish(ids: pa.Array, w: Words, gone: np.ndarray) -> pa.RecordBatch:
        n, removed, texts = kept_texts(ids, w, gone)
        return pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(removed), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id long, n_words long, n_removed long, kept_sha256 string", finish)


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
ORACLE = {
    "op5_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
g AS (SELECT doc_id, i, sha256(array_to_string(list_slice(ws, i, i + 34), ' ')) AS g FROM i),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM t),
a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT a.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY a.p) AS kept FROM a LEFT JOIN p ON p.doc_id = a.doc_id AND p.p = a.p WHERE p.p IS NULL GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
"""
}
