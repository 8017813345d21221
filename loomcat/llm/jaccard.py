"""Operator 6, n-gram Jaccard join by set-relation skipping. Exact.

A document's set is its distinct k-word shingles (64-bit hashes). Equal sets become one set. Two sets
link when ``den * |x & y| >= num * |x | y|``; documents of linked sets form components.

1. ``sets``: prefix filter. Tokens are ordered by (hot, hash); hot tokens are those of many
   sets, counted over all documents in a fixed-size table. Any fixed order is right; this one keeps
   common lines, and what large groups of copies share, out of the index.
2. Similar sets: sets that share a min-hash compare with one leader (the most copied set), unless parity bitmaps show that
   they can't link. Overlaps are computed once, stored as answers, and give the first components.
3. Index lists: the entries of one token are grouped into blocks by component, with the range of
   set sizes and the smallest position. A pair of blocks is skipped when no sizes and positions in it could
   reach the threshold, and a block never meets itself.
4. Answers derived: an answer of step 2 keeps what a set lacks of its leader and what it has beside it. Pairs that
   survive are bounded by parity bitmaps; those with a leader in common get their overlap from its size and these two
   small differences, ``|x & y| = |l| - |gone_x | gone_y| + |extra_x & extra_y|``; only the others are compared in full.

The result is components. A set is known by its 128-bit digest, never by a document's id, so ids may be of any type, missing or repeated.
Defined results: null or empty texts have an empty set and link with nothing (component: themselves); fewer than k words: the
whole sequence is the one shingle; repeated rows each get a row; rows with a null id belong to their set, and a component's id
is the smallest id that is not null (null if it has none); an empty table gives an empty one; other columns are ignored by
``similar`` and carried by ``keep_one``, whatever their names. A text needs some 40 bytes of memory for each of its bytes in its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import bitmap, components, in_bitmap
from .shared import fresh, written
from .textops import U64, Ranges, Words, freed, mix, pieces

HOT = 64
SKETCH_BITS = 23
TOKEN_BITS = 25
KEYS = 4


def shingles(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, lower=True)
    ranges = Ranges(w.hashes())
    at = w.windows(k)
    h = ranges.hash(at, at + k)
    cut = np.searchsorted(at, w.first)
    out = []
    for i, n in enumerate(w.per_text.tolist()):
        if n >= k:
            out.append(np.unique(h[cut[i] : cut[i + 1]]))
        elif n:
            out.append(ranges.hash(w.first[i : i + 1], w.first[i + 1 : i + 2]))
        else:
            out.append(np.zeros(0, U64))
    return out


def digests(flat: np.ndarray, first: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each set's digest; flat: all sets one after the other, some: which are not empty."""
    k1, k2 = np.zeros(len(some), U64), np.zeros(len(some), U64)
    if len(flat):
        k1[some] = np.add.reduceat(mix(flat + U64(0x1234567)), first[some])
        k2[some] = np.add.reduceat(mix(flat * U64(0xD6E8FEB86659FD93) + U64(9)), first[some])
    return k1, k2


def prefix_length(n: int, num: int, den: int) -> int:
    return n - (num * n + den - 1) // den + 1 if n else 0


def parity_bits(n: np.ndarray) -> np.ndarray:
    """The width of a set's parity bitmap: a power of two of about half its size, 512 at least."""
    return np.left_shift(1, np.maximum(9, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) - 1))


def parity_apart(x: bytes, y: bytes) -> int:
    """Bits in which two parity bitmaps differ: at most the size of the sets' symmetric difference.
    Positions are low hash bits, so a wider bitmap folds onto a narrower one."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    sizes = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, U64)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat.view(np.int64)))


def _prefix(s: np.ndarray, hot: np.ndarray | None, num: int, den: int) -> np.ndarray:
    p = prefix_length(len(s), num, den)
    if hot is None:
        return s[:p]
    flag = in_bitmap(hot, s)
    cold = s[~flag]
    return cold[:p] if len(cold) >= p else np.concatenate([cold, s[flag][: p - len(cold)]])


def set_rows(docs: DataFrame, k: int, num: int, den: int, hot: np.ndarray | None, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, h, prefix, keys, parity): k1 and k2 are a 128-bit digest of the set, h is the text's hash."""
    salts = [mix(np.array([i + 1], U64))[0] for i in range(KEYS)]
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingles(piece.column(1), k)
                n = np.array([len(s) for s in sets])
                flat = np.concatenate(sets)
                first = np.cumsum([0, *n])[:-1]
                some = n > 0
                key = [np.zeros(len(n), U64) for _ in range(KEYS)]
                k1, k2 = digests(flat, first, some)
                bits = parity_bits(n)
                if len(flat):
                    for j in range(KEYS):
                        key[j][some] = np.minimum.reduceat(mix(flat ^ salts[j]), first[some])
                base = np.cumsum(bits) - bits
                at = np.repeat(base, n) + (mix(flat).astype(U64) & np.repeat(bits - 1, n).astype(U64)).astype(np.int64)
                odd = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)).tobytes()
                parity = [odd[x // 8 : (x + y) // 8] for x, y in zip(base.tolist(), bits.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), piece.column(2),
                     _lists([_prefix(s, hot, num, den) for s in sets]), _lists(list(np.stack(key, 1))), pa.array(parity, pa.binary())],
                    ["id", "n", "k1", "k2", "h", "prefix", "keys", "parity"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    return narrow.mapInArrow(freed(run), f"id {kind}, n long, k1 long, k2 long, h long, prefix array<long>, keys array<long>, parity binary")


def hot_tokens(docs: DataFrame, k: int, text_col: str) -> np.ndarray:
    """Bitmap of 2 ** SKETCH_BITS buckets of tokens that occur in many sets.

    All sets of all documents are counted in a fixed-size table of buckets for each task, cut into
    segments that are summed across tasks. A bucket is hot from HOT plus three times the mean count. A
    cold token in a hot bucket is merely indexed later than need be.
    """
    segments, width = 256, (1 << SKETCH_BITS) // 256

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for piece in pieces(batch, "text"):
                np.add.at(counts, (np.concatenate(shingles(piece.column(0), k)) & U64(len(counts) - 1)).astype(np.int64), 1)
        for j in range(segments):
            part = counts[j * width : (j + 1) * width]
            if part.any():
                planes = np.ascontiguousarray(part.view(np.uint8).reshape(-1, 4).T)  # high bytes are mostly zero
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([zstandard.ZstdCompressor(3).compress(planes.tobytes())], pa.binary())], ["segment", "counts"])
        counts = None

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for x in batch.column(1):
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), np.uint8).reshape(4, -1)
                total += np.ascontiguousarray(planes.T).view(np.uint32).ravel()
        hot = np.packbits(total >= HOT + 3 * total.mean(), bitorder="little")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([hot.tobytes()], pa.binary())], ["segment", "hot"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(freed(count), "segment long, counts binary")
    out = np.zeros((1 << SKETCH_BITS) // 64, U64)
    for row in counted.groupBy("segment").applyInArrow(merge, "segment long, hot binary").toLocalIterator():  # 256 rows at most
        words = np.frombuffer(bytes(row["hot"]), U64)
        out[row["segment"] * len(words) : (row["segment"] + 1) * len(words)] = words
    return out


def shared_entries(sets: DataFrame, shared: np.ndarray) -> DataFrame:
    """(id, n, root, pos, token) of the prefix tokens in the bitmap; sets: (id, n, root, prefix)."""
    bits = sets.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            of = pa.compute.list_parent_indices(lists).to_numpy()
            flat = np.asarray(lists.flatten())
            size = np.bincount(of, minlength=batch.num_rows)
            pos = np.arange(len(flat)) - (np.cumsum(size) - size)[of]
            keep = in_bitmap(bits.value, flat.view(U64))
            take = pa.array(of[keep])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(3)), pa.array(pos[keep].astype(np.int32)), pa.array(flat[keep])], ["id", "n", "root", "pos", "token"])

    return sets.select("id", F.col("n").cast("int").alias("n"), "root", "prefix").mapInArrow(freed(run), "id long, n int, root long, pos int, token long")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int, text_col: str) -> DataFrame:
    """(id, tokens) of the sets wanted (id, k1, k2, h): a bitmap of the hashes h of their texts lets through few others, a
    task makes the set of each text once, and digests decide which set it is; no text is shuffled."""
    hashes = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, F.col("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            h = np.asarray(batch.column(1))
            keep = in_bitmap(hashes.value, h.view(U64))
            for i in np.flatnonzero(keep).tolist():
                if h[i] in seen:
                    keep[i] = False
                seen.add(int(h[i]))
            for piece in pieces(batch.filter(pa.array(keep)), "text"):
                sets = shingles(piece.column(0), k)
                n = np.array([len(s) for s in sets])
                k1, k2 = digests(np.concatenate(sets), np.cumsum([0, *n])[:-1], n > 0)
                yield pa.RecordBatch.from_arrays([pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())], ["k1", "k2", "tokens"])

    narrow = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    return narrow.mapInArrow(freed(run), "k1 long, k2 long, tokens binary").join(wanted.select("id", "k1", "k2"), ["k1", "k2"]).select("id", "tokens").dropDuplicates(["id"])


def overlaps(docs: DataFrame, sets: DataFrame, pairs: DataFrame, k: int, text_col: str) -> DataFrame:
    """pairs (a, b) of sets with the size of their intersection, and a's difference from b: what it lacks (gone) and what it
    has beside it (extra)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = written(sets.select("id", "k1", "k2", "h").join(ids, "id", "left_semi"), "wanted")
    full = written(full_sets(docs, wanted, k, text_col), "full")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, gone, extra = [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                in_y = in_sorted(y, x)
                both.append(int(in_y.sum()))
                extra.append(x[~in_y].tobytes())
                gone.append(y[~in_sorted(x, y)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(gone, pa.binary()), pa.array(extra, pa.binary())], ["a", "b", "both", "gone", "extra"])

    left = full.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = full.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(freed(run), "a long, b long, both long, gone binary, extra binary")


def within_parity(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose parity bitmaps allow that they link, with their sizes: no set is needed to rule out the others."""
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"parity_{c}")), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = [parity_apart(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5), strict=True)]
            size = np.asarray(batch.column(2)) + np.asarray(batch.column(3))
            keep = (num + den) * np.array(d, np.int64) <= (den - num) * size
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep))

    return pairs.select("a", "b", "na", "nb", "parity_a", "parity_b").mapInArrow(freed(run), "a long, b long, na long, nb long")


def in_sorted(among: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values are among the sorted ones."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def derived(n: int, gone: tuple[bytes, bytes], extra: tuple[bytes, bytes]) -> int:
    """The overlap of two sets from their differences from one leader of n tokens."""
    g, e = ([np.frombuffer(x, U64) for x in pair] for pair in (gone, extra))
    return n - len(np.union1d(*g)) + len(np.intersect1d(*e, assume_unique=True))


def clusters(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents (id, n, k1, k2, h) and the component of each set (k1, k2, root, component_id)."""
    rows = written(set_rows(docs, k, num, den, hot_tokens(docs, k, text_col), id_col, text_col), "sets")
    # equal sets are one, with a number of its own
    sets = (
        rows.where("n > 0").groupBy("k1", "k2")
        .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.any_value("n").alias("n"), F.any_value(F.struct("prefix", "keys", "parity", "h")).alias("s"))
        .select(F.monotonically_increasing_id().alias("id"), "least", "copies", "n", "s.prefix", "s.keys", "s.parity", "s.h", "k1", "k2")
    )
    sets = written(sets, "distinct")
    sides = num + den

    def compatible(n1: Column, n2: Column) -> Column:
        return (F.lit(den) * n1 >= F.lit(num) * n2) & (F.lit(den) * n2 >= F.lit(num) * n1)

    # leaders: within one min-hash and size class, the most copied set
    grade = F.log(F.col("n").cast("double")) / float(np.log(1.25))
    keyed = sets.select("id", "n", "copies", F.posexplode("keys").alias("j", "key")).withColumn("size", F.floor(grade + F.when(F.col("j") % 2 == 1, 0.5).otherwise(0.0)))
    leaders = keyed.groupBy("j", "key", "size").agg(F.min(F.struct((-F.col("copies")).alias("c"), "id", "n")).alias("l"), F.count("*").alias("many")).where("many > 1").select("j", "key", "size", F.col("l.id").alias("lead"), F.col("l.n").alias("n_lead"))
    star = keyed.join(leaders, ["j", "key", "size"]).where((F.col("id") != F.col("lead")) & compatible(F.col("n"), F.col("n_lead")))
    star = star.select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct()
    # sets meet by chance in the min-hash of a frequent shingle, the more the larger the corpus: those are never read in full
    star = written(within_parity(star, sets, num, den), "star")
    linked = F.lit(den) * F.col("both") >= F.lit(num) * (F.col("na") + F.col("nb") - F.col("both"))
    # only links are kept: their differences are a small part of the sets
    answers = written(overlaps(docs, sets, star, k, text_col).join(star, ["a", "b"]).where(linked), "answers")
    first = written(components(answers.select("a", "b")), "first")

    # index lists in blocks of one component; tokens of a single component are left out first
    rooted = written(sets.select("id", "n", "prefix").join(first.withColumnRenamed("node", "id"), "id", "left").select("id", "n", F.coalesce("root", "id").alias("root"), "prefix"), "rooted")
    tokens = rooted.select("root", F.explode("prefix").alias("token")).groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    entries = written(shared_entries(rooted, bitmap(tokens.where("lo <> hi"), F.col("token"), TOKEN_BITS)), "index")
    blocks = entries.groupBy("token", "root").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos"), F.count("*").alias("m"), F.min("id").alias("id"))
    one, two = (blocks.select("token", *(F.col(c).alias(f"{c}{i}") for c in ("root", "lo", "hi", "pos", "m", "id"))) for i in (1, 2))
    reach = (F.lit(den) * F.col("hi1") - F.lit(sides) * F.col("pos1") >= F.lit(num) * F.col("lo2")) & (F.lit(den) * F.col("hi2") - F.lit(sides) * F.col("pos2") >= F.lit(num) * F.col("lo1"))
    met = written(one.join(two, "token").where((F.col("root1") < F.col("root2")) & reach), "blocks")
    single = met.where("m1 = 1 AND m2 = 1").select("id1", "id2")
    grown = met.where("m1 > 1 OR m2 > 1").select("token", "root1", "root2")
    e1 = entries.select("token", F.col("root").alias("root1"), F.col("id").alias("id1"), F.col("n").alias("n1"), F.col("pos").alias("p1"))
    e2 = entries.select("token", F.col("root").alias("root2"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("pos").alias("p2"))
    near = (F.lit(den) * F.col("n1") - F.lit(sides) * F.col("p1") >= F.lit(num) * F.col("n2")) & (F.lit(den) * F.col("n2") - F.lit(sides) * F.col("p2") >= F.lit(num) * F.col("n1"))
    expanded = grown.join(e1, ["token", "root1"]).join(e2, ["token", "root2"]).where(near).select("id1", "id2")
    pairs = single.unionByName(expanded).distinct()

    # the parity bound, then answers derived from those of a leader in common
    pairs = within_parity(pairs.toDF("a", "b"), sets, num, den).toDF("id1", "id2", "n1", "n2")
    pairs = written(pairs, "pairs")
    known = answers.select(F.col("a").alias("id"), F.col("b").alias("lead"), F.col("nb").alias("n_lead"), "gone", "extra")
    known = known.unionByName(known.select(F.col("lead").alias("id"), "lead", "n_lead", F.lit(b"").alias("gone"), F.lit(b"").alias("extra")).distinct())
    k1, k2 = (known.select(F.col("id").alias(f"id{i}"), "lead", F.col("gone").alias(f"gone{i}"), F.col("extra").alias(f"extra{i}"), *(["n_lead"] if i == 1 else [])) for i in (1, 2))
    ids = known.select("id", "lead")
    common = pairs.join(ids.withColumnRenamed("id", "id1"), "id1").join(ids.withColumnRenamed("id", "id2"), ["id2", "lead"]).groupBy("id1", "id2", "n1", "n2").agg(F.min("lead").alias("lead"))
    common = written(common, "common")

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [derived(r["n_lead"], (r["gone1"], r["gone2"]), (r["extra1"], r["extra2"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both, pa.int64())], ["a", "b", "na", "nb", "both"])

    answered = common.join(k1, ["id1", "lead"]).join(k2, ["id2", "lead"]).select("id1", "id2", "n1", "n2", "n_lead", "gone1", "gone2", "extra1", "extra2")
    answered = answered.mapInArrow(freed(derive), "a long, b long, na long, nb long, both long").where(linked).select("a", "b")
    open_ = pairs.join(common.select("id1", "id2"), ["id1", "id2"], "left_anti").select(F.col("id1").alias("a"), F.col("id2").alias("b"), F.col("n1").alias("na"), F.col("n2").alias("nb"))
    compared = overlaps(docs, sets, open_, k, text_col).join(open_, ["a", "b"]).where(linked).select("a", "b")
    links = answered.unionByName(compared).unionByName(first.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = sets.select("id", "least", "k1", "k2").join(components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("id", "n", "k1", "k2", "h"), named.join(least, "root").select("k1", "k2", "root", "component_id")


def similar(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) of each row of docs."""
    rows, by_set = clusters(docs, k, num, den, id_col, text_col)
    some = rows.where("n > 0").join(by_set, ["k1", "k2"]).select("id", "n", "component_id")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.unionByName(empty).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one row of each component: that with the smallest id (a missing id comes last), of several
    rows with that id that with the smallest text hash, of equal ones any. Texts without words all stay."""
    rows, by_set = clusters(docs, k, num, den, id_col, text_col)
    found = rows.where("n > 0").join(by_set, ["k1", "k2"]).groupBy("root", "id", "h").agg(F.count("*").alias("n"))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("b"))
    stays = F.col("id").eqNullSafe(F.col("b.id")) & (F.col("h") == F.col("b.h"))
    # rows that go, and those that stay once of several equal ones; all others are not named
    i, h, once, mine = fresh(docs.columns, "i", "h", "once", "mine")
    named = written(found.join(best, "root").where(~stays | (F.col("n") > 1)).select(F.col("id").alias(i), F.col("h").alias(h), stays.alias(once)), "verdicts")
    joined = docs.withColumn(mine, F.xxhash64(text_col)).join(named, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(mine) == F.col(h)), "left")
    kept = joined.where(F.col(once).isNull())
    if not named.where(once).isEmpty():
        kept = kept.unionByName(joined.where(once).dropDuplicates([id_col, mine]))
    return kept.select(*docs.columns)


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SIMILAR_SQL = """
sw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM {docs}),
si AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {k1}, 1) + 1)) AS i FROM sw WHERE len(ws) > 0),
sg AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + {k1}), ' ') AS g FROM si),
sn AS (SELECT doc_id, count(*) AS n FROM sg GROUP BY doc_id),
sl AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n FROM sg x JOIN sg y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
se AS (SELECT a, b FROM sl JOIN sn p ON p.doc_id = a JOIN sn q ON q.doc_id = b WHERE {den} * both_n >= {num} * (p.n + q.n - both_n)),
sb AS (SELECT a, b FROM se UNION SELECT b, a FROM se),
sr AS (SELECT doc_id AS node, doc_id AS seen FROM {docs} UNION SELECT sr.node, sb.b FROM sr JOIN sb ON sb.a = sr.seen),
sc AS (SELECT node AS doc_id, min(seen) AS component_id FROM sr GROUP BY node)
"""
QUERIES = {"op6_jaccard_join": op6_jaccard_join}
ORACLE = {
    "op6_jaccard_join": "WITH RECURSIVE " + SIMILAR_SQL.format(docs="documents", k1=2, num=90, den=100)
    + " SELECT d.doc_id, coalesce(sn.n, 0) AS n_shingles, sc.component_id FROM documents d JOIN sc ON sc.doc_id = d.doc_id LEFT JOIN sn ON sn.doc_id = d.doc_id"
}
