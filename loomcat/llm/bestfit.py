"""Operator 12, best-fit packing with a swap-based local search: as few sequences as the search can reach.

1. Texts become ids, an end id follows each. Documents longer than a sequence are cut into pieces that fill one; what
   is over is the first piece. Only pieces shorter than a sequence have to be packed.
2. Each task packs windows of about ``WINDOW_TOKENS`` tokens best fit decreasing, then searches: the least filled
   sequence gives its pieces away. A piece moves to the sequence that it fits best, or it changes places with a
   smaller piece, with two smaller ones, or two of its sequence change places with one. Each exchange moves tokens from a
   less to a more filled sequence, so the sum of squared fills grows, and the search ends. An emptied sequence is gone.
3. Full sequences stay as they are. Underfull ones of all windows are written, dealt out again in groups of
   ``GROUP`` sequences, packed and searched again, and so on until one group is left or a round saves less than
   ``LEAST_SAVED`` of what it was given. So only underfull sequences are ever shuffled, and no task holds more than a
   window or a group.

A sequence has ``ids`` (little-endian unsigned 32-bit), ``segments`` (for each piece in order: ``doc_id``, ``piece``, ``start`` in
its document, ``length``) and ``fill``. Nothing is padded.

Defined results: a null or empty text is one piece that holds only the end id; repeated rows and null ids are packed like
any others; ids may be of any type; an empty table gives no rows; other columns are ignored, whatever their names. Equal lengths are
taken in the order of the window. A very long text must fit in its task once, with some forty bytes for each of its tokens.

Ids equal those of the tokenizers library for the JSON file; they are made by tiktoken from the ranks in it, which takes a seventh
of the time. Special tokens that a text spells out are found, as that library does.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, StructField, StructType

from .bpe import vocabulary_path
from .packing import pack
from .shared import new_path
from .textops import give_back

SEQ_LEN = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
WINDOW_TOKENS = 8 << 20
GROUP = 8192
LEAST_SAVED = 0.002
#: The search ends after so many sources in a row that could not be emptied.
TRIES = 24
ROWS = 256


@lru_cache(maxsize=1)
def encoder(path: str):
    """The function from a text to its ids."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # the printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others count on from 256
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    return encode


class Packing:
    """Sequences under a local search: pieces by number, lengths fixed."""

    def __init__(self, lengths: list[int], rows: list[list[int]], cap: int):
        self.lengths, self.cap = lengths, cap
        self.rows = [list(r) for r in rows]
        self.fill = [sum(lengths[i] for i in r) for r in self.rows]
        self.emptied = 0

    def _sizes(self, r: int) -> dict[int, list[int]]:
        """The pieces of a sequence by length."""
        out: dict[int, list[int]] = defaultdict(list)
        for i in self.rows[r]:
            out[self.lengths[i]].append(i)
        return out

    @staticmethod
    def _pairs(sizes: dict[int, list[int]]) -> list[tuple[int, int]]:
        """Pairs of lengths of a sequence; pieces of one length are alike."""
        s = sorted(sizes)
        return [(a, b) for k, a in enumerate(s) for b in s[k + (len(sizes[a]) < 2) :]]

    def search(self) -> None:
        """Exchanges until no source can be emptied."""
        tried: set[int] = set()
        failed = 0
        open_ = {r for r, f in enumerate(self.fill) if 0 < f < self.cap}
        while failed < TRIES:
            sources = [r for r in open_ if r not in tried]
            if not sources:
                break
            source = min(sources, key=lambda r: (self.fill[r], r))
            room = sum(self.cap - self.fill[r] for r in open_) - (self.cap - self.fill[source])
            tried.add(source)
            if room < self.fill[source]:  # no exchange can empty it, nor any that is fuller
                break
            if self._empty(source, open_ - {source}):
                failed, tried = 0, set()
                self.emptied += 1
            else:
                failed += 1
            open_ = {r for r in open_ if 0 < self.fill[r] < self.cap}

    def _empty(self, source: int, others: set[int]) -> bool:
        """Gives away what it can of source; true if nothing is left."""
        targets = np.array(sorted(others), np.int64)
        sizes = {int(r): self._sizes(int(r)) for r in targets}
        one = [(a, r) for r in sizes for a in sizes[r]]
        two = [(a + b, a, b, r) for r in sizes for a, b in self._pairs(sizes[r])]
        one_size, one_row = (np.array(x, np.int64) for x in (zip(*one, strict=True) if one else ((), ())))
        two_size, two_row = np.array([t[0] for t in two], np.int64), np.array([t[3] for t in two], np.int64)
        room = np.zeros(len(self.rows), np.int64)
        room[targets] = self.cap - np.array([self.fill[r] for r in targets], np.int64) if len(targets) else 0
        fill = np.array(self.fill, np.int64)
        fresh = np.ones(len(self.rows), bool)  # sequences whose lists above still hold
        while self.rows[source] and len(targets):
            own = self._sizes(source)
            best: tuple[int, int, tuple, tuple] | None = None  # (tokens that leave, row, lengths given, lengths taken)

            def better(d: np.ndarray, rows: np.ndarray, give: tuple, take) -> None:
                """The exchange that moves most tokens; among equals the one that leaves the least room."""
                nonlocal best
                good = (d > 0) & (d <= room[rows]) & fresh[rows] & (fill[rows] + d > fill[source])
                if good.any():
                    at = int(np.argmax(np.where(good, d * 4096 - room[rows], -1 << 60)))
                    if best is None or d[at] > best[0]:
                        best = (int(d[at]), int(rows[at]), give, take(at))

            for a in own:
                better(np.full(len(targets), a), targets, (a,), lambda at: ())
            if best is None:
                for a in own:
                    better(a - one_size, one_row, (a,), lambda at: (int(one_size[at]),))
                    better(a - two_size, two_row, (a,), lambda at: two[at][1:3])
                for a, b in self._pairs(own):
                    better(a + b - one_size, one_row, (a, b), lambda at: (int(one_size[at]),))
            if best is None:
                stale = np.flatnonzero(~fresh)
                if not len(stale):
                    return False
                # exchanged sequences take part again, with their present pieces
                keep1, keep2 = ~np.isin(one_row, stale), ~np.isin(two_row, stale)
                new = {int(r): self._sizes(int(r)) for r in stale if room[r] > 0}
                more1 = [(a, r) for r in new for a in new[r]]
                more2 = [(a + b, a, b, r) for r in new for a, b in self._pairs(new[r])]
                one_size, one_row = np.r_[one_size[keep1], [m[0] for m in more1]].astype(np.int64), np.r_[one_row[keep1], [m[1] for m in more1]].astype(np.int64)
                two = [t for t, k in zip(two, keep2, strict=True) if k] + more2
                two_size, two_row = np.array([t[0] for t in two], np.int64), np.array([t[3] for t in two], np.int64)
                fresh[:] = True
                continue
            moved, row, give, take = best
            for lengths, here, there in ((give, source, row), (take, row, source)):
                for n in lengths:
                    i = next(i for i in self.rows[here] if self.lengths[i] == n)
                    self.rows[here].remove(i)
                    self.rows[there].append(i)
            self.fill[source] -= moved
            self.fill[row] += moved
            fill[source], fill[row] = self.fill[source], self.fill[row]
            room[row] -= moved
            fresh[row] = False
            if not room[row]:
                targets = targets[targets != row]
        return not self.rows[source]


def squeezed(lengths: list[int], cap: int, rows: list[list[int]] | None = None) -> list[list[int]]:
    """Sequences of pieces, each by its index: best fit decreasing or rows, whichever are fewer, after the search."""
    packed = pack(lengths, cap)
    if rows is not None and len(rows) < len(packed):
        packed = rows
    search = Packing(lengths, packed, cap)
    search.search()
    return [r for r in search.rows if r]


def _segment_type(kind: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([("doc_id", kind), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32())]))


class Window:
    """Pieces gathered for one packing: segments and their ids."""

    def __init__(self, cap: int, kind: pa.DataType):
        self.cap, self.kind = cap, kind
        self.segments: list[dict] = []
        self.ids: list[np.ndarray] = []
        self.rows: list[list[int]] = []
        self.held = 0

    def add(self, segment: dict, ids: np.ndarray) -> None:
        self.segments.append(segment)
        self.ids.append(ids)
        self.held += len(ids)

    def batches(self, rows: list[list[int]]) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(rows), ROWS):
            part = rows[lo : lo + ROWS]
            ids = [b"".join(self.ids[i].tobytes() for i in r) for r in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array([[self.segments[i] for i in r] for r in part], _segment_type(self.kind)), pa.array([len(x) // 4 for x in ids], pa.int32())],
                ["ids", "segments", "fill"],
            )

    def packed(self) -> Iterator[pa.RecordBatch]:
        lengths = [len(x) for x in self.ids]
        small = [i for i, n in enumerate(lengths) if n < self.cap]
        where = {i: k for k, i in enumerate(small)}
        given = [[where[i] for i in r] for r in self.rows] or None
        rows = [[small[k] for k in r] for r in squeezed([lengths[i] for i in small], self.cap, given)] if small else []
        yield from self.batches([[i] for i, n in enumerate(lengths) if n == self.cap] + rows)


def _ddl(kind: str) -> str:
    return f"ids binary, segments array<struct<doc_id:{kind},piece:int,start:bigint,length:int>>, fill int"


def first_round(docs: DataFrame, seq_len: int, path: str, end: int, kind: str, arrow: pa.DataType) -> DataFrame:
    """Sequences of each task's windows; docs: (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        window = Window(seq_len, arrow)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end)
                ids = np.array(ids, "<u4")
                at = 0
                for piece in range(-(-len(ids) // seq_len)):
                    n = (len(ids) - at - 1) % seq_len + 1 if piece == 0 else seq_len
                    window.add({"doc_id": doc, "piece": piece, "start": at, "length": n}, ids[at : at + n])
                    at += n
                if window.held >= WINDOW_TOKENS:
                    yield from window.packed()
                    window = Window(seq_len, arrow)
        yield from window.packed()
        give_back()

    return docs.mapInArrow(run, _ddl(kind))


def next_round(underfull: DataFrame, groups: int, seq_len: int, kind: str, arrow: pa.DataType) -> DataFrame:
    """The pieces of underfull sequences in new ones, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = Window(seq_len, arrow)
        for batch in batches:
            for row in batch.select(["ids", "segments"]).to_pylist():
                ids, at, made = np.frombuffer(row["ids"], "<u4"), 0, []
                for s in row["segments"]:
                    made.append(len(window.segments))
                    window.add(s, ids[at : at + s["length"]])
                    at += s["length"]
                window.rows.append(made)
            if len(window.rows) >= 2 * GROUP:  # where groups came out uneven
                yield from window.packed()
                window = Window(seq_len, arrow)
        yield from window.packed()
        give_back()

    return underfull.repartition(groups).mapInArrow(run, _ddl(kind))


def _stored(df: DataFrame, seq_len: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(full, underfull) sequences, written to the shared folder in a folder each."""
    spark: SparkSession = df.sparkSession
    path = new_path(spark, name)
    df.withColumn("full", F.col("fill") == seq_len).write.option("compression", "zstd").partitionBy("full").parquet(path)
    kept = spark.read.schema(StructType([*df.schema, StructField("full", BooleanType())])).parquet(path)
    return kept.where("full").drop("full"), kept.where("not full").drop("full")


def pack_documents(docs: DataFrame, seq_len: int = SEQ_LEN, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END) -> DataFrame:
    """(sequence_id, ids, segments, fill): docs in as few sequences of at most seq_len ids as the search reaches."""
    path = path or vocabulary_path(VOCABULARY)
    kind, arrow = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    full, underfull = _stored(first_round(named, seq_len, path, end, kind, arrow), seq_len, "sequences")
    done, before = [full], underfull.count()
    while before > 1:
        groups = -(-before // GROUP)
        full, underfull = _stored(next_round(underfull, groups, seq_len, kind, arrow), seq_len, "sequences")
        done.append(full)
        after = full.count() + (left := underfull.count())
        if groups == 1 or before - after < LEAST_SAVED * before:
            break
        before = left
    out = underfull
    for d in done:
        out = out.unionByName(d)
    return out.select(F.monotonically_increasing_id().alias("sequence_id"), "ids", "segments", "fill")


def read_pieces(sequences: DataFrame) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of each piece, read back from the sequences."""
    before = F.expr("transform(sequence(0, size(segments) - 1), i -> aggregate(slice(segments, 1, i), 0L, (n, s) -> n + s.length))")
    each = sequences.select("sequence_id", "ids", F.explode(F.arrays_zip("segments", before.alias("offset"))).alias("p"))
    s = F.col("p.segments")
    return each.select(
        s["doc_id"].alias("doc_id"), s["piece"].alias("piece"), s["start"].alias("start"), s["length"].cast("long").alias("length"),
        F.substring("ids", F.col("p.offset").cast("int") * 4 + 1, s["length"] * 4).alias("ids"), "sequence_id", F.col("p.offset").alias("offset"),
    )


def op12_best_fit(spark, sf_dir: str) -> DataFrame:
    """Packs all documents; each piece as read back from the sequences."""
    pieces = read_pieces(pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {"op12_best_fit": op12_best_fit}
ORACLE: dict[str, str] = {}
