"""Operator 2, byte-level BPE encoding and decoding over a global table of distinct words.

1. ``split_blocks`` cuts texts into pre-tokens with the public pattern. Documents are handled in blocks of
   about ``BLOCK_BYTES``: a block has its distinct pre-tokens once, numbered by how often they occur, and each
   document's pre-tokens as a sequence of numbers (their place in it is their position). The distinct words are
   dealt to buckets by their hash and packed. This is written to the shared folder once.
2. The packs are shuffled by bucket, so that all rows of a word meet: each distinct word of the corpus is
   encoded once and its ids are joined to every block that has it.
3. The ids of a block's words meet the block's sequences again by block, and every document's ids are
   put together by position.

Decoding joins ids with the token-byte table, ``decode_table``, one row for each of the vocabulary's ids (so its size is
bounded by the vocabulary). ``decode`` does so for any table of ids. Where ids were just put together (the query, and
``encode_texts`` with ``with_decoded``), the same join is made within the task, by position in the table, which saves a
shuffle of every token.

A word occurs at most once in each block, so frequent words make no hot key. Defined results: a null text is an empty
one (no ids, no bytes); repeated rows each get a row; an empty table gives an empty one; other columns are left out, and
clash with nothing. Ids may be of any type. A single text longer than a block is a block of its own, and must fit in a task.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, new_path, written
from .textops import U64, bytes_hash, freed, give_back, text_bytes

BLOCK_BYTES = 24 << 20
LEVEL = 9
ESCAPE = 240
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def splitter(pattern: str):
    """The public pattern for the regex library. Its \\s holds four separators (U+001C to U+001F) that
    are no white space to the tokenizer, so the class is spelt by its Unicode property."""
    import regex

    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
    return regex.compile(pattern).findall


@lru_cache(maxsize=2)
def encoder(path: str):
    """Encodes one pre-token."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})._encode_single_piece


class TokenBytes:
    """The token-byte table: the bytes of each id, in one buffer."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values(), default=-1) + 1
        by_id: list[bytes] = [b""] * n
        for token, i in ranks.items():
            by_id[i] = token
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.start[ids], self.length[ids]).tobytes()


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ranges start:start + length of flat, one after the other."""
    total = int(length.sum())
    if not total:
        return flat[:0]
    to = np.cumsum(length) - length
    return flat[np.repeat(start - to, length) + np.arange(total)]


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    return TokenBytes(load_ranks(path))


def decode_table(spark, path: str | None = None) -> DataFrame:
    """(token_id, token) of the vocabulary."""
    rows = [(i, bytearray(t)) for t, i in load_ranks(path or vocabulary_path()).items()]
    return spark.createDataFrame(rows, "token_id int, token binary")


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """rows with ``decoded`` binary beside the array column of ids: ids are exploded with their positions, joined with the
    token-byte table (a row for each id of the vocabulary, broadcast) and put together again by position. An id outside the
    vocabulary, or a missing one, makes the row's ``decoded`` null, as a null array does; an empty array gives no bytes."""
    row, ids, at, parts, n = fresh([*rows.columns, "token_id", "token"], "row", "ids", "at", "parts", "n")
    named = written(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
    each = named.select(row, F.posexplode(ids_col).alias(at, "token_id"))
    joined = each.join(F.broadcast(decode_table(rows.sparkSession, path)), "token_id", "left")
    whole = joined.groupBy(row).agg(F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), F.struct(at, F.hex("token").alias("token"))))).alias(parts), F.count("*").alias(n))
    text = F.when(F.size(parts) == F.col(n), F.unhex(F.array_join(F.transform(parts, lambda p: p["token"]), "")))
    out = named.join(whole, row, "left")
    return out.select(*rows.columns, F.when(F.size(ids_col) == 0, F.lit(b"")).otherwise(text).alias("decoded"))


BLOCK_DDL = "block long, bucket int, packed binary"
SEQUENCE = -1


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(len(z).to_bytes(8, "little") + z for z in (zstandard.ZstdCompressor(LEVEL).compress(a.tobytes()) for a in arrays))


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + n]), kind))
        at += 8 + n
    return out


def _planes(x: np.ndarray) -> list[np.ndarray]:
    """The low three bytes of each number apart: the high ones compress to little."""
    each = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    return [np.ascontiguousarray(each[:, b]) for b in range(3)]


def number_codes(x: np.ndarray) -> list[np.ndarray]:
    """Small, frequent numbers as a byte each; others as a byte of their high bits (from ESCAPE up) and
    two bytes kept apart, so that each stream compresses by its own kind. Numbers from about 2 ** 20 (one
    very long text) make it four plain byte streams."""
    if len(x) and int(x.max()) - ESCAPE >= (256 - ESCAPE) << 16:
        each = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        return list(each)
    code = x.astype(np.uint8)
    big = x >= ESCAPE
    rest = (x[big] - ESCAPE).astype(np.uint32)
    code[big] = (ESCAPE + (rest >> 16)).astype(np.uint8)
    return [code, (rest >> 8).astype(np.uint8), rest.astype(np.uint8), np.zeros(0, np.uint8)]


def numbers_of(code: np.ndarray, mid: np.ndarray, low: np.ndarray, top: np.ndarray) -> np.ndarray:
    out = code.astype(np.uint32)
    if len(top):
        return out | mid.astype(np.uint32) << 8 | low.astype(np.uint32) << 16 | top.astype(np.uint32) << 24
    big = code >= ESCAPE
    out[big] = ((out[big] - ESCAPE) << 16) + (mid.astype(np.uint32) << 8) + low + ESCAPE
    return out


def split_blocks(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """For each block a row with its documents' pre-tokens by number (bucket SEQUENCE), and a row for each
    bucket of words: the distinct words that hash there, with their numbers.

    docs: (row long, text). A block ends with a task's input at the latest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern)
        number: dict[str, int] = {}
        rows: list[int] = []
        sizes: list[int] = []
        seq: list[np.ndarray] = []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            block = uuid.uuid4().int >> 65  # a retried task makes new blocks; only those of the committed one are written
            flat = np.concatenate(seq)
            # frequent words get small numbers: short codes once compressed
            order = np.argsort(-np.bincount(flat, minlength=len(number)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            yield _row(block, SEQUENCE, _pack(np.array(rows, np.int64), np.array(sizes, np.int32), *number_codes(rank[flat])))
            data, at = text_bytes(pa.array(list(number), pa.large_string()))
            dealt = (bytes_hash(data).hash(at[:-1], at[1:]) % U64(buckets)).astype(np.int64)
            by_bucket = order[np.argsort(dealt[order], kind="stable")]
            cut = np.searchsorted(dealt[by_bucket], np.arange(buckets + 1))
            for b in range(buckets):
                mine = by_bucket[cut[b] : cut[b + 1]]
                if len(mine):
                    length = at[mine + 1] - at[mine]
                    yield _row(block, b, _pack(np.diff(rank[mine], prepend=0).astype("<i4"), length.astype("<u4"), gather(data, at[mine], length)))

        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                found = find(text)
                seq.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
                rows.append(row)
                sizes.append(len(found))
                held += len(text)
                if held >= BLOCK_BYTES or len(number) >= 1 << 19:
                    yield from close()
                    number, rows, sizes, seq, held = {}, [], [], [], 0
        if rows:
            yield from close()

    return docs.mapInArrow(freed(run), BLOCK_DDL)


def _row(block: int, bucket: int, packed: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([packed], pa.binary())], ["block", "bucket", "packed"])


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """The ids of the words of each (block, bucket), dealt by bucket: all of the corpus's rows of a word
    are in one task, which encodes it once and joins its ids to each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        ids_of: dict[bytes, bytes] = {}
        for batch in batches:
            for block, bucket, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                number, length, data = _unpack(packed, "<i4", "<u4", np.uint8)
                ends = np.cumsum(length).tolist()
                data = data.tobytes()
                found = []
                for start, end in zip([0, *ends[:-1]], ends, strict=True):
                    word = data[start:end]
                    ids = ids_of.get(word)
                    if ids is None:
                        # white space runs and the like are one pre-token: the piece is encoded without splitting it again
                        ids = ids_of[word] = np.array(encode(word.decode()), "<u4").tobytes()
                    found.append(ids)
                sizes = np.array([len(x) // 4 for x in found], "<u4")
                yield _row(block, bucket, _pack(number, sizes, *_planes(np.frombuffer(b"".join(found), "<u4"))))

    return words.mapInArrow(freed(run), BLOCK_DDL)


def encode_rows(docs: DataFrame, out_ddl: str, finish, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """docs: (row, text). finish(rows, ids, cut) makes the Arrow batch of some of a block's documents
    from the row numbers, all ids one after the other, and where each row's ids begin (n + 1)."""
    import public_tokenizers

    spark = docs.sparkSession
    path, pattern = path or vocabulary_path(), pattern or public_tokenizers.PATTERN
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = new_path(spark, "blocks")
    split_blocks(docs, pattern, max(16, tasks)).write.option("compression", "uncompressed").parquet(at)  # packed already
    blocks = spark.read.schema(BLOCK_DDL).parquet(at)
    ids = encode_words(blocks.where(F.col("bucket") != SEQUENCE).repartition(tasks, "bucket"), path)

    def of_block(sequences: pa.Table, words: pa.Table) -> list[pa.RecordBatch]:
        parts, upto = [], 0
        numbers, starts, lengths = [], [], []
        for packed in words.column("packed"):
            step, size, a, b, c = _unpack(packed.as_py(), "<i4", "<u4", np.uint8, np.uint8, np.uint8)
            size = size.astype(np.int64)
            numbers.append(np.cumsum(step))
            starts.append(upto + np.cumsum(size) - size)
            lengths.append(size)
            parts.append(_joined(a, b, c))
            upto += len(a)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        count = sum(map(len, numbers))
        start, length = np.zeros(count, np.int64), np.zeros(count, np.int64)
        for n, x, y in zip(numbers, starts, lengths, strict=True):
            start[n], length[n] = x, y
        rows, sizes, *codes = _unpack(sequences.column("packed")[0].as_py(), np.int64, np.int32, np.uint8, np.uint8, np.uint8, np.uint8)
        seq = numbers_of(*codes)
        edges = np.cumsum([0, *sizes])
        out, lo = [], 0
        while lo < len(rows):  # some hundred thousand tokens at a time
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + (1 << 19), "right")) - 1)
            s = seq[edges[lo] : edges[hi]]
            n = length[s]
            total = np.zeros(len(s) + 1, np.int64)
            np.cumsum(n, out=total[1:])
            out.append(finish(rows[lo:hi], gather(flat, start[s], n), total[edges[lo : hi + 1] - edges[lo]]))
            lo = hi
        return out

    def put_together(key: tuple, sequences: pa.Table, words: pa.Table) -> pa.Table:
        give_back()  # what the block before was returned in
        out = of_block(sequences, words)
        give_back()  # what this one was made of
        return pa.Table.from_batches(out)

    sequences = spark.read.schema(BLOCK_DDL).parquet(at).where(F.col("bucket") == SEQUENCE)
    return sequences.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(put_together, out_ddl)


def _joined(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32) | (b.astype(np.uint32) << 8) | (c.astype(np.uint32) << 16)


def encode_texts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None, with_decoded: bool = False) -> DataFrame:
    """(id_col, ids array<int>) of each row, and with_decoded the text decoded from the ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    path = path or vocabulary_path()

    def finish(rows: np.ndarray, ids: np.ndarray, cut: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(rows), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32)))]
        names = ["row", "ids"]
        if with_decoded:
            table = token_bytes(path)
            columns.append(pa.array([table.decode(ids[a:b]).decode() for a, b in zip(cut[:-1], cut[1:], strict=True)]))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(columns, names)

    rows, names = _numbered(docs, id_col, text_col)
    out = encode_rows(rows, "row long, ids array<int>" + ", decoded string" * with_decoded, finish, path)
    if names is not None:
        return out.join(names, "row").select(F.col("id").alias(id_col), *out.columns[1:])
    return out.withColumn("row", F.when(F.col("row") != NO_ID, F.col("row")).cast(kind)).withColumnRenamed("row", id_col)


#: Stands for a null id while rows are packed.
NO_ID = -(2**63) + 1
INTEGERS = ("bigint", "int", "smallint", "tinyint")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(row, text), and where ids are no integers, rows are numbered instead: (row, id)."""
    if docs.schema[id_col].dataType.simpleString() in INTEGERS:
        return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("row"), F.col(text_col).alias("text")), None
    named = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), "numbered")
    return named.select("row", "text"), named.select("row", "id")


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = vocabulary_path()

    def finish(rows: np.ndarray, ids: np.ndarray, cut: np.ndarray) -> pa.RecordBatch:
        table = token_bytes(path)
        data = memoryview(ids.astype("<u4").tobytes())
        id_hex = [hashlib.sha256(data[4 * a : 4 * b]).hexdigest() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        size = table.length[ids]
        text = memoryview(gather(table.flat, table.start[ids], size).tobytes())
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        text_hex = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ends[cut[:-1]].tolist(), ends[cut[1:]].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.diff(cut)), pa.array(id_hex), pa.array(text_hex)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = encode_rows(_numbered(docs, "doc_id", "text")[0], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", finish, path)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


QUERIES = {"op2_bpe": op2_bpe}
ORACLE: dict[str, str] = {}
