"""Operator 4, benchmark decontamination: CGK walks, bit-sampling LSH, exact edit verification.

Words are the symbols: A-Z lowered, punctuation cut off both ends, words of punctuation alone dropped. A document
holds an item of n words if some stretch of it is within ``floor(n / 5)`` word edits of the item (edit
similarity 0.8). Exact for each candidate; candidates come from LSH with a measured recall.

The CGK embedding walks over a string: at step j it writes the symbol under it and moves on by one random bit of
(j, symbol), so strings with few edits agree again soon after each edit and edit distance becomes Hamming
distance. Here the embedding of an item-sized window is the list of walks of ``STEPS`` steps restarted at each of
its words (a restart ends the drift that a long walk keeps after an edit). One repetition samples ``SAMPLES``
steps of each walk; its keys are compared for all words of all documents with those of all words of all items
(the walk from a document's word serves every window that holds the word), and a match proposes the window
that puts the item there. There are ``REPEATS`` repetitions with bits of their own. Keys are probed symbol by
symbol, so most positions are given up after one or two of the sampled steps.

Items are dealt to blocks of about ``BLOCK_BYTES`` and each block is broadcast to one pass over the documents; with
several blocks the result of each is written before the next one is broadcast, so one block is held at a time. Nothing about
documents is collected or shuffled.

Items under ``SHORT`` words have too few walks, so they are cut into one segment more than the edits allowed: whatever the
edits, one segment stays whole, and each place of a segment is a candidate. Their recall is 1 by construction.

Defined results: null or empty texts hold nothing and null items or items without words are in no document; repeated rows
give rows of their own, and of a repeated item id the smallest distance counts; ids may be of any type and missing; an
empty table of documents or items gives no leaks, and then all documents stay; other columns are ignored by ``leaks`` and
carried by ``drop_contaminated``, whatever their names. A text needs some 60 bytes of memory for each of its bytes in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import written
from .textops import PUNCT, U64, Words, freed, mix, pieces

STEPS = 16
SAMPLES = 5
REPEATS = 4
LEAST_MOVE = 4
SHORT = 32
BLOCK_BYTES = 16 << 20
#: A table of buckets has so many times the keys in it, and 2 ** 12 to 2 ** 22 buckets: what it takes, in each task, follows the block.
TABLE_ROOM = 32
TABLE_BITS = range(12, 23)
#: Which steps each repetition samples; the first word of a walk is always one.
SAMPLED = tuple(np.sort(np.r_[0, np.random.default_rng(500 + r).choice(np.arange(2, STEPS), SAMPLES - 1, replace=False)]) for r in range(REPEATS))


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word (n + 1))."""
    w = Words(texts, lower=True)
    start, end = w.trimmed(PUNCT)
    keep = start < end
    upto = np.zeros(len(w) + 1, np.int64)
    np.cumsum(keep, out=upto[1:])
    return w.bytes_hash().hash(start[keep], end[keep]), upto[w.first]


def most_edits(n: int) -> int:
    return n // 5


def segments(n: int) -> list[tuple[int, int]]:
    """An item of n words in most_edits(n) + 1 parts of about one length: (offset, length)."""
    parts = most_edits(n) + 1
    cuts = [n * j // parts for j in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def gram_keys(h: np.ndarray, m: int) -> np.ndarray:
    """A hash of each m words in a row."""
    key = np.full(max(0, len(h) - m + 1), U64(m))
    for j in range(m):
        key = (key ^ h[j : j + len(key)]) * U64(0x9E3779B97F4A7C15)
        key ^= key >> U64(29)
    return key


def bucket(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The bucket of each key, by its high bits; a table has 2 ** bits buckets."""
    return (keys >> U64(65 - len(table).bit_length())).astype(np.int64)


def walk_keys(h: np.ndarray, repeat: int, tables: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The walks from every position of h: (positions, their keys after each sampled step, where they end). With tables,
    a position is given up as soon as its key's bucket is empty. h ends with STEPS words that are never begun at."""
    at = np.arange(len(h) - STEPS)
    cur = at
    key = np.full(len(at), U64(repeat + 1))
    keys = []
    for j in range(STEPS):
        if j in SAMPLED[repeat]:
            key = (key ^ h[cur]) * U64(0x9E3779B97F4A7C15)
            key ^= key >> U64(29)
            keys.append(key)
            if len(keys) == SAMPLES:
                break
            if tables is not None:
                table = tables[len(keys) - 1]
                ok = table[bucket(key, table)]
                at, cur, key = at[ok], cur[ok], key[ok]
                keys[-1] = key
        cur = cur + ((h[cur] >> U64(STEPS * repeat + j)) & U64(1)).astype(np.int64)
    return at, keys, cur


class Items:
    """A block of items and the LSH keys of all their words."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        h, first = symbols(pa.array(texts, pa.string()))
        self.words = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.lists = [x.tolist() for x in self.words]
        pad = mix(np.arange(1, STEPS + 1, dtype=U64) * U64(0xABCDEF123))
        self.tables, self.keys, self.owner, self.offset = [], [], [], []
        room = TABLE_ROOM * sum(len(x) for x in self.words if len(x) >= SHORT)
        bits = min(max(room.bit_length(), TABLE_BITS[0]), TABLE_BITS[-1])
        for r in range(REPEATS):
            found = [np.zeros(1 << bits, bool) for _ in range(SAMPLES - 1)]
            last, owner, offset = [], [], []
            for i, x in enumerate(self.words):
                if len(x) < SHORT:
                    continue
                at, keys, end = walk_keys(np.r_[x, pad], r)
                # a walk that runs out of the item reads what the document has there: of no use
                # and one that hardly moved says too little
                inside = (at <= len(x) - STEPS) & (end - at >= LEAST_MOVE)
                for t, k in zip(found, keys, strict=False):
                    t[bucket(k[inside], t)] = True
                last.append(keys[-1][inside])
                owner.append(np.full(inside.sum(), i))
                offset.append(at[inside])
            key = np.concatenate(last) if last else np.zeros(0, U64)
            order = np.argsort(key, kind="stable")
            self.tables.append(found)
            self.keys.append(key[order])
            self.owner.append(np.concatenate(owner)[order] if owner else np.zeros(0, np.int64))
            self.offset.append(np.concatenate(offset)[order] if owner else np.zeros(0, np.int64))
        # short items by their segments: for each length, sorted keys with item and offset
        grams: dict[int, list[tuple[int, int, int]]] = {}
        for i, x in enumerate(self.words):
            if 0 < len(x) < SHORT:
                for offset, m in segments(len(x)):
                    grams.setdefault(m, []).append((int(gram_keys(x[offset : offset + m], m)[0]), i, offset))
        self.grams = {m: (np.array([g[0] for g in some], U64), np.array([g[1:] for g in some], np.int64)) for m, some in ((m, sorted(g)) for m, g in grams.items())}

    def candidates(self, h: np.ndarray, first: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, about where the item would begin in the text's words)."""
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        padded = np.r_[h, np.zeros(STEPS, U64)]
        out: set[tuple[int, int, int]] = set()
        for r in range(REPEATS):
            at, keys, _ = walk_keys(padded, r, self.tables[r])
            if len(keys) < SAMPLES or not len(at):
                continue
            lo = np.searchsorted(self.keys[r], keys[-1], "left")
            n = np.searchsorted(self.keys[r], keys[-1], "right") - lo
            hit = np.flatnonzero(n)
            which = np.repeat(lo[hit] - (np.cumsum(n[hit]) - n[hit]), n[hit]) + np.arange(n[hit].sum())
            p = np.repeat(at[hit], n[hit])
            begin = p - self.offset[r][which] - first[text_of[p]]
            out.update(zip(text_of[p].tolist(), self.owner[r][which].tolist(), (begin // 4 * 4).tolist(), strict=True))
        for m, (known, of) in self.grams.items():
            keys = gram_keys(h, m)
            lo = np.searchsorted(known, keys, "left")
            hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == keys)
            hit = hit[hit + m <= first[text_of[hit] + 1]]
            n = np.searchsorted(known, keys[hit], "right") - lo[hit]
            which = np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            p = np.repeat(hit, n)
            begin = p - of[which, 1] - first[text_of[p]]
            out.update(zip(text_of[p].tolist(), of[which, 0].tolist(), (begin // 4 * 4).tolist(), strict=True))
        return out


def substring_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least edit distance of item to any stretch of text, end of the first such stretch)."""
    j = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, x in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != x))
        row = np.minimum.accumulate(new - j) + j
    end = int(row.argmin())
    return int(row[end]), end


def leaks_in(h: np.ndarray, first: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(text, item, distance, end) of each item that a text holds, at its best place."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for t, i, begin in sorted(items.candidates(h, first)):
        item = items.words[i]
        most = most_edits(len(item))
        if best.get((t, i), (1, 0))[0] == 0:
            continue
        text = h[first[t] : first[t + 1]]
        lo = max(0, begin - most - 4)
        stretch = text[lo : begin + len(item) + most + 8]
        if sum(map(set(stretch.tolist()).__contains__, items.lists[i])) < len(item) - most:  # each word it lacks is an edit
            continue
        d, end = substring_distance(item, stretch)
        if d <= most and (d, lo + end) < best.get((t, i), (d + 1, 0)):
            best[t, i] = (d, lo + end)
    return [(t, i, d, end) for (t, i), (d, end) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str], int]]:
    """The items, in blocks of about block_bytes of text, dealt by hash, and how many blocks there are."""
    narrow = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    total = narrow.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    for b in range(blocks):
        rows = narrow.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        rows.sort(key=lambda r: (r["t"], str(r["i"])))
        yield [r["i"] for r in rows], [r["t"] for r in rows], blocks


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, item_col, distance, end_word) of each item that a document holds."""
    spark = docs.sparkSession
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType), T.StructField("distance", T.IntegerType()), T.StructField("end_word", T.LongType())])
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = []
    for ids, texts, blocks in item_blocks(benchmark, item_col, block_bytes=block_bytes):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                for piece in pieces(batch, "text"):
                    h, first = symbols(piece.column(1))
                    found = leaks_in(h, first, items)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array([f[0] for f in found], pa.int64())), pa.array([items.ids[f[1]] for f in found], item_type), pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int64())],
                        ["id", "item", "distance", "end_word"],
                    )

        parts.append(_one_block(narrow.mapInArrow(freed(run), kind), shared, blocks))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "distance", "end_word")


def _one_block(found: DataFrame, shared, blocks: int) -> DataFrame:
    """found, written and its broadcast freed if there are more blocks."""
    if blocks == 1:
        return found
    found = written(found, "leaks")
    shared.unpersist()
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that hold no item, with all their columns; no join and no shuffle."""
    spark = docs.sparkSession
    for ids, texts, blocks in item_blocks(benchmark, block_bytes=block_bytes):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value)
            for batch in batches:
                for piece in pieces(batch, text_col):
                    h, first = symbols(piece.column(piece.schema.get_field_index(text_col)))
                    clean = np.ones(piece.num_rows, bool)
                    clean[[f[0] for f in leaks_in(h, first, items)]] = False
                    yield piece.filter(pa.array(clean))

        docs = _one_block(docs.mapInArrow(freed(run), docs.schema), shared, blocks)
    return docs


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


QUERIES = {"op4_decontamination": op4_decontamination}
ORACLE: dict[str, str] = {}
