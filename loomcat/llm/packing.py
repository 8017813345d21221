"""Operator 7, token-id output: best-fit-decreasing packing into fixed-length rows.

Texts are tokenised, an end-of-text id follows each, and the ids are packed into rows of ``seq_len``
slots. A document longer than a row is split without loss: all but its last segment fill whole rows. Segments
are placed in order of falling length, each into the row with the least room that still holds it; a segment tree
over the room of the open rows finds it in log(seq_len) steps. Packing is done on windows of about
``WINDOW_TOKENS`` tokens of a task's documents, so memory is bounded and nothing is shuffled; only the last
rows of a window can be poorly filled.

A packed row has ``ids`` (a seq_len row of the id matrix, little-endian unsigned 32-bit), ``cu_seqlens`` (0, then the
end of each segment, then of the padding if there is any), ``position_ids`` (restarting at 0 with each
segment), and for each segment ``doc_id``, ``segment`` (number in its document) and ``start`` (first token in
its document). ``write_packed`` writes these rows as Parquet through Spark's committer.

Defined results: a null or empty text is one segment that holds only the end-of-text id; repeated rows
and null ids are packed like any others; ids may be of any type; an empty table gives no rows; other columns are ignored,
whatever their names. A very long text is split over rows; it must fit in its task once, with four bytes a token.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import load_ranks, vocabulary_path
from .shared import new_path

SEQ_LEN = 2048
WINDOW_TOKENS = 4 << 20
END_OF_TEXT = 50256
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACKED_DDL = "ids binary, cu_seqlens array<int>, position_ids binary, segments array<struct<doc_id:{kind},segment:int,start:bigint,length:int>>, padding int"


class RoomTree:
    """Segment tree over room sizes 0..most: how many rows have that much room, and the smallest size
    of at least x that any row has."""

    def __init__(self, most: int):
        self.size = 1 << max(1, most.bit_length())
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least need; it is taken out."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and not (at % 2 == 0 and self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def pack(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Best-fit decreasing: the segments of each row, by index into lengths (none over seq_len)."""
    tree = RoomTree(seq_len)
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        found = tree.take(need)
        if found is None:
            rows.append([i])
            room, row = seq_len, len(rows) - 1
        else:
            room, row = found
            rows[row].append(i)
        if room > need:
            tree.add(room - need, row)
    return rows


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})


class Window:
    """Documents gathered for one packing."""

    def __init__(self, seq_len: int, id_type: pa.DataType):
        self.seq_len, self.id_type, self.docs, self.ids, self.held = seq_len, id_type, [], [], 0

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.ids.append(ids)
        self.held += len(ids)

    def batches(self) -> Iterator[pa.RecordBatch]:
        segs = [(d, s, at, min(self.seq_len, len(ids) - at)) for d, ids in enumerate(self.ids) for s, at in enumerate(range(0, len(ids), self.seq_len))]
        rows = pack([s[3] for s in segs], self.seq_len)
        for lo in range(0, len(rows), 256):
            out: dict[str, list] = {"ids": [], "cu_seqlens": [], "position_ids": [], "segments": [], "padding": []}
            for row in rows[lo : lo + 256]:
                ids = np.full(self.seq_len, END_OF_TEXT, "<u4")
                pos = np.empty(self.seq_len, "<u4")
                at, cuts, named = 0, [0], []
                for i in row:
                    d, s, start, n = segs[i]
                    ids[at : at + n] = self.ids[d][start : start + n]
                    pos[at : at + n] = np.arange(n)
                    at += n
                    cuts.append(at)
                    named.append({"doc_id": self.docs[d], "segment": s, "start": start, "length": n})
                pad = self.seq_len - at
                if pad:
                    pos[at:] = np.arange(pad)
                    cuts.append(self.seq_len)
                for k, v in zip(out, (ids.tobytes(), cuts, pos.tobytes(), named, pad), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["ids"], pa.binary()), pa.array(out["cu_seqlens"], pa.list_(pa.int32())), pa.array(out["position_ids"], pa.binary()),
                 pa.array(out["segments"], pa.list_(pa.struct([("doc_id", self.id_type), ("segment", pa.int32()), ("start", pa.int64()), ("length", pa.int32())]))), pa.array(out["padding"], pa.int32())],
                list(out),
            )


def packed(docs: DataFrame, seq_len: int = SEQ_LEN, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """The packed rows of docs."""
    path = path or vocabulary_path(VOCABULARY)
    kind, id_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path).encode_to_numpy
        window = Window(seq_len, id_type)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "", disallowed_special=())
                window.add(doc, np.append(ids, np.uint32(END_OF_TEXT)).astype("<u4"))
                if window.held >= WINDOW_TOKENS:
                    yield from window.batches()
                    window = Window(seq_len, id_type)
        yield from window.batches()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PACKED_DDL.format(kind=kind))


def write_packed(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the packed rows as Parquet. Position ids compress to next to nothing."""
    packed(docs, seq_len, id_col, text_col).write.option("compression", "zstd").parquet(path)


def read_segments(rows: DataFrame) -> DataFrame:
    """(doc_id, segment, start, length, padding, row_segments, ids_sha256) of each segment of packed rows; fails
    where ids, lengths and position resets of a row do not agree."""

    each = rows.schema["segments"].dataType.elementType["doc_id"].dataType
    id_type = to_arrow_type(each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, pos = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4")
                cuts = r["cu_seqlens"]
                if len(ids) != len(pos) or cuts[-1] != len(ids) or np.flatnonzero(pos == 0).tolist() != cuts[:-1]:
                    raise ValueError("a packed row's position resets do not match its segments")
                for i, s in enumerate(r["segments"]):
                    part = ids[cuts[i] : cuts[i + 1]]
                    if len(part) != s["length"]:
                        raise ValueError("a packed row's lengths do not match its segments")
                    out.append({**s, "padding": r["padding"], "row_segments": len(r["segments"]), "ids_sha256": hashlib.sha256(part.tobytes()).hexdigest()})
            kind = pa.schema([("doc_id", id_type), ("segment", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("padding", pa.int32()), ("row_segments", pa.int32()), ("ids_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(out, kind)

    return rows.mapInArrow(run, f"doc_id {each.simpleString()}, segment int, start long, length int, padding int, row_segments int, ids_sha256 string")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Packs all documents, writes the rows, and returns each segment as read back from them."""
    path = new_path(spark, "packed")
    write_packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_segments(spark.read.parquet(path))


QUERIES = {"op7_packing": op7_packing}
ORACLE: dict[str, str] = {}
