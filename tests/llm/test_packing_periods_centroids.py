"""Operators 11 to 13 against brute force, the public tokenizer and lower bounds."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcat.llm import bestfit, bpe, centroids, periods, registry

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, id string, words string, row int"


# ---- 11 --------------------------------------------------------------------------------------------


def runs_by_force(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, period, length) of every run."""
    known: dict[str, int] = {}
    x = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(x) // 3 + 1):
        edge = np.flatnonzero(np.diff(np.r_[0, (x[:-q] == x[q:]).astype(np.int8), 0]))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a + q >= max(24, 3 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((a, q, n) for (a, n), q in found.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def period_texts() -> list[str | None]:
    rng = random.Random(5)
    word = lambda k: f"w{rng.randrange(k)}"
    out: list[str | None] = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "a " * 25, "a b " * 12, "x " + "a b " * 12 + "a y", "a b c d e f g h " * 3, "a b c d e f g h i " * 2, "for " * 5000]
    for q in (1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 127, 128, 129, 300):
        for e in (2.9, 3, 3.1, 4.5, 9):
            base = [word(10**9) for _ in range(q)]
            n = math.ceil(q * e)
            head, tail = [word(10**9) for _ in range(rng.randrange(40))], [word(10**9) for _ in range(rng.randrange(40))]
            out.append(" ".join([*head, *(base[i % q] for i in range(n)), *tail]))
    for _ in range(120):  # few words: runs within and beside runs
        out.append(" ".join(word(rng.choice([1, 2, 2, 3])) for _ in range(rng.randrange(1, 400))))
    inner = " ".join(["a"] * 30 + ["b"])  # a run in each period of a longer one
    out += [" ".join([inner] * 5), " ".join([inner] * 3 + ["c"] * 40 + [inner] * 4), f"{'p q r ' * 20}{'p q s ' * 20}"]
    return out


def test_period_runs(spark):
    texts = period_texts()
    rows = [(i, t, "other", "column", 1) for i, t in enumerate(texts)] + [(5, texts[5], "o", "c", 2), (None, "a " * 30, "o", "c", 3), (5, "b " * 40, "o", "c", 4)]
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    got = sorted(((r.doc_id, r.text, [(x.start, x.period, x.length) for x in r.runs]) for r in periods.collapse_runs(docs).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        words = WORDS.findall(t or "")
        runs = runs_by_force(words)
        want.append((i, collapsed(words, runs), runs))
    assert got == sorted(want, key=str)
    assert sum(len(w[2]) for w in want) > 80
    found = periods.find_runs(docs).where("doc_id = 7").collect()
    assert [(r.start, r.length, r.period) for r in found] == [(0, 24, 2)]
    assert periods.collapse_runs(docs.limit(0)).count() == 0
    named = periods.find_runs(docs.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body")), "name", "body")
    assert named.columns == ["name", "start", "length", "period"] and named.where("name = '7'").count() == 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=140), st.integers(1, 40), st.integers(0, 200))
def test_period_tiles(head, q, n):
    """Tiles of one document solved apart and stitched by hand give the runs."""
    import pyarrow as pa

    from loomcat.llm.textops import Words

    x = head + [head[i % min(q, len(head))] for i in range(n)]
    words = [f"v{i}" for i in x]
    where = periods.borders(Words(pa.array([" ".join(words)])))
    spans: dict[int, list[tuple[int, int]]] = {}
    for t in periods.cut_tiles(np.array(x), where):
        ids = np.frombuffer(zlib.decompress(t["ids"]), "<i4").tolist()
        for p, found in periods.solve(ids, t["octave"], t["first"], t["borders"]).items():
            spans.setdefault(p, []).extend((t["lo"] + a, t["lo"] + b) for a, b in found)
    runs = []
    for p, found in spans.items():
        whole: list[list[int]] = []
        for a, b in sorted(found):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        runs += [(a, p, b - a + p) for a, b in whole if b - a + p >= max(24, 3 * p)]
    assert sorted(runs) == runs_by_force(words)


def test_period_very_long_text(spark):
    """A text of 400,000 words with one period of 100,001 words and one of 3."""
    base = [f"w{i}" for i in range(100_001)]
    text = " ".join([*(base[i % len(base)] for i in range(310_000)), *(["x", "y", "z"] * 30_000)])
    got = periods.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sorted((r.start, r.length, r.period) for r in got) == [(0, 310_000, 100_001), (310_000, 90_000, 3)]


def test_period_best(spark):
    runs = [(9, 2, 30), (3, 2, 30), (3, 4, 60), (0, 3, 44)]
    df = spark.createDataFrame([([*map(lambda r: dict(zip(("start", "period", "length"), r)), runs)],), ([],)], "runs array<struct<start:bigint,period:bigint,length:bigint>>")
    assert sorted([r.b and (r.b.start, r.b.period) for r in df.select(periods.best_run(F.col("runs")).alias("b")).collect()], key=str) == [(3, 2), None]


def test_period_query(spark):
    """The query, its planting included."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d in docs:
        words = WORDS.findall(d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_force(words)
        best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
        text = "".join(f"{a},{m},{q}\n" for a, q, m in runs)
        want[d.doc_id] = (len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in registry.queries()["op11_periodic_runs"](spark, SMALL).collect()}
    assert got == want
    odd = spark.createDataFrame([(None, "a b c"), (1, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in periods.planted(odd).collect()) == [("1", None), ("None", "a b c")]


# ---- 12 --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))


def lower_bound(lengths, cap):
    """At least this many sequences are needed: pieces over half meet in none, and the rest fill what is left."""
    s = np.array(lengths)
    best = 0
    for k in range(cap // 2 + 1):
        large, middle, small = s > cap - k, s[(s <= cap - k) & (2 * s > cap)], s[(2 * s <= cap) & (s >= k)]
        best = max(best, int(large.sum()) + len(middle) + max(0, -(-int(small.sum() - (len(middle) * cap - middle.sum())) // cap)))
    return best


def check_sequences(pieces, want: dict, cap: int) -> int:
    """Every piece once, in its place; the number of sequences."""
    by: dict[int, list] = {}
    docs: dict = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append(r)
        docs.setdefault(r.doc_id, []).append(r)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= cap
    assert docs.keys() == want.keys()
    for d, ids in want.items():
        at, rows = 0, sorted(docs[d], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(-(-len(ids) // cap)))
        for k, r in enumerate(rows):
            assert r.start == at and (r.length == cap or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return len(by)


def test_best_fit_query(spark, tokenizer):
    want = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    n = check_sequences(registry.queries()["op12_best_fit"](spark, SMALL).collect(), want, 1024)
    lengths = [x for ids in want.values() for x in [1024] * (len(ids) // 1024) + [len(ids) % 1024] if x]
    assert n <= 1.01 * lower_bound(lengths, 1024) + 1


def test_best_fit_rounds(spark, tokenizer, monkeypatch):
    """Many small windows and groups: what one leaves underfull goes to the next."""
    texts = [" ".join(["word"] * random.Random(i).randrange(0, 90)) + "<|endoftext|>" * (i % 7 == 0) + "\x1c é　" for i in range(400)] + [None, "", "x " * 900]
    docs = spark.createDataFrame([(f"d{i}", t, 1, "s") for i, t in enumerate(texts)], "doc_id string, text string, piece int, ids string").repartition(8)
    sequences = bestfit.pack_documents(docs, 64)
    pieces = bestfit.read_pieces(sequences).withColumn("ids_crc32", F.crc32("ids")).collect()
    want = {f"d{i}": [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    n = check_sequences(pieces, want, 64)
    lengths = [x for ids in want.values() for x in [64] * (len(ids) // 64) + [len(ids) % 64] if x]
    assert n <= 1.03 * lower_bound(lengths, 64) + 1
    assert bestfit.pack_documents(docs.limit(0)).count() == 0
    twins = spark.createDataFrame([(None, "same"), (None, "same"), (1, "same")], "doc_id long, text string")
    assert [len(r.segments) for r in bestfit.pack_documents(twins).collect()] == [3]


def fewest(lengths, cap):
    """The least number of sequences, by trying everything."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= lengths[k]}):
            rest = list(rooms)
            rest[rest.index(r)] -= lengths[k]
            place(k + 1, rest)
        place(k + 1, [*rooms, cap - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=11))
def test_best_fit_search(lengths):
    rows = bestfit.squeezed(lengths, 20)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= 20 for r in rows)
    assert len(rows) <= fewest(lengths, 20) + 1
    again = bestfit.squeezed(lengths, 20, [[i] for i in range(len(lengths))])
    assert len(again) <= len(rows) + 1


def test_best_fit_search_helps():
    """Exchanges empty sequences that best fit decreasing leaves, one for one, two for one and one for two."""
    rng = random.Random(3)
    for lo, hi in ((300, 400), (100, 300), (250, 520)):
        lengths = [rng.randint(lo, hi) for _ in range(1500)]
        assert len(bestfit.squeezed(lengths, 1024)) < len(bestfit.pack(lengths, 1024))
    for start, lengths in (([[0, 1], [2, 3]], [5, 4, 6, 2]), ([[0], [1, 2]], [7, 3, 4])):
        search = bestfit.Packing(lengths, start, 10)
        before = sum(f * f for f in search.fill)
        search.search()
        assert sum(f * f for f in search.fill) >= before
        assert search.fill == [sum(lengths[i] for i in r) for r in search.rows]


def test_best_fit_ids(tokenizer):
    encode = bestfit.encoder(bpe.vocabulary_path("byte_bpe_50k.json"))
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for k in range(0, len(points), 64 * 97):  # a spread of code points, in every kind of place
        text = "".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}\n .{chr(c)}'s" for c in points[k : k + 64])
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    text = "".join(rng.choice(["<|endoftext|>", " ", "a", "\x1c", "\x85", "\n\n", "'ll", "٣", "😀"]) for _ in range(500))
    assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


# ---- 13 --------------------------------------------------------------------------------------------


def clusters_by_force(rows, dim, clusters, rounds):
    kept = [(i, tuple(math.floor(Fraction(x) * 1024) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, digest(r[0])))
    centers = [list(v) for _, v in order[:clusters]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((away(v, c), k) for k, c in enumerate(centers))
    for _ in range(rounds):
        mine: dict[int, list] = {}
        for _, v in kept:
            mine.setdefault(near(v)[1], []).append(v)
        for k, vs in mine.items():
            centers[k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centers


def odd_vectors(dim):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(dim)]) for i in range(90)]
    rows += [(100, None), (101, [1.0] * (dim - 1)), (102, [1.0] * (dim + 1)), (103, [*[1.0] * (dim - 1), None]), (104, [*[1.0] * (dim - 1), float("nan")]), (105, [*[1.0] * (dim - 1), float("inf")]), (106, [])]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (200, rows[6][1]), (201, rows[6][1]), (202, [-1e-9] * dim), (203, [1e6] * dim), (204, [-(2.0**17) - 0.5] + [0.0] * (dim - 1))]
    return rows


def test_centroids(spark):
    rows = odd_vectors(4)
    ddl = "vec_id long, embedding array<double>, id string, near int"
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], ddl).repartition(3)
    found, centers = centroids.cluster(df, clusters=5, rounds=6, dim=4)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str)
    want, want_centers = clusters_by_force(rows, 4, 5, 6)
    assert got == want and centers == want_centers
    few, centers = centroids.cluster(df.where("vec_id = 7"), clusters=5, rounds=2, dim=4)
    assert [(r.cluster, r.distance) for r in few.collect()] == [(0, 0)] and len(centers) == 1
    none, centers = centroids.cluster(df.limit(0), dim=4)
    assert none.count() == 0 and centers == [] and none.columns == ["vec_id", "cluster", "distance", "checked"]
    text, _ = centroids.cluster(df.select(F.col("vec_id").cast("string").alias("n"), F.col("embedding").cast("array<float>").alias("v")), "n", "v", clusters=2, rounds=1, dim=4)
    assert text.count() == len(want)


def test_centroids_all_equal(spark):
    df = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(40)], "vec_id long, embedding array<double>")
    found, _ = centroids.cluster(df, clusters=3, rounds=3, dim=2)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.sampled_from([3, 1000, 2**26]))
def test_centroid_bounds(seed, k, top):
    """No bound exceeds the distance, and the nearest centroid is found, ties included."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-top, top, (50, 5), endpoint=True)
    centers, pivots = [r.tolist() for r in x[:k]], centroids.spread([r.tolist() for r in x[k : k + 20]], 4)
    v = centroids.Vectors(x)
    all_ = np.arange(len(x))
    near = np.stack([np.sqrt(v.to(all_, p).astype(float)) for p in pivots], axis=1)
    exact = np.stack([v.to(all_, c) for c in centers], axis=1)
    far = np.array([[math.sqrt(sum((a - b) ** 2 for a, b in zip(c, p, strict=True))) for p in pivots] for c in centers])
    between = np.array([[math.sqrt(sum((a - b) ** 2 for a, b in zip(c, p, strict=True))) for p in pivots] for c in pivots])
    assert (centroids.bounds(near, far, between) <= exact).all()
    found, best, checked = centroids.nearest(v, near, centers, pivots)
    assert (found == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all() and len(x) <= checked <= exact.size


def test_centroid_bounds_spare_work():
    rng = np.random.default_rng(4)
    middle = rng.normal(0, 4000, (8, 64))
    x = np.floor(middle[rng.integers(0, 8, 2000)] + rng.normal(0, 300, (2000, 64))).astype(np.int64)
    centers = [m.astype(np.int64).tolist() for m in middle]
    pivots = centroids.spread([r.tolist() for r in x[:500]], centroids.PIVOTS)
    v = centroids.Vectors(x)
    near = np.stack([np.sqrt(v.to(np.arange(len(x)), p).astype(float)) for p in pivots], axis=1)
    assert centroids.nearest(v, near, centers, pivots)[2] < 0.3 * len(x) * len(centers)


# ---- 5: the automaton decides ----------------------------------------------------------------------


def test_repeats_need_their_automaton():
    """Confirmed windows are found by the automaton alone: all of them, and nothing without its phrases."""
    import ahocorasick
    import pyarrow as pa

    from loomcat.llm import repeats
    from loomcat.llm.textops import Words

    rng = random.Random(1)
    base = [f"w{rng.randrange(3000)}" for _ in range(2000)]
    texts = []
    for k in range(200):
        at = rng.randrange(1900)
        texts.append(" ".join([*(f"u{k}_{rng.randrange(999)}" for _ in range(rng.randrange(60))), *base[at : at + rng.randrange(20, 90)], f"v{k}"]))
    w = Words(pa.array(texts))
    i, digest = repeats.window_digests(w)
    known, n = np.unique(digest, return_counts=True)
    recurring = known[n > 1].view(np.int64)
    want = np.zeros(len(w), bool)
    for s in i[np.isin(digest.view(np.int64), recurring)]:
        want[s : s + repeats.WINDOW] = True
    start, stop = repeats.phrases_of(w, recurring)
    assert len(start) and (stop - start >= repeats.WINDOW).all()
    assert (repeats.found_words(w, start, stop) == want).all() and want.any()
    assert not repeats.found_words(w, start, stop, lambda phrases: ahocorasick.Automaton()).any()
    assert not repeats.found_words(w, start[:0], stop[:0]).any()
    half = repeats.found_words(w, start, stop, lambda phrases: repeats.compiled(phrases[::2]))
    assert half.any() and not half[~want].any()


def test_repeats_phrases_in_parts(monkeypatch):
    import pyarrow as pa

    from loomcat.llm import repeats
    from loomcat.llm.textops import Words

    w = Words(pa.array([" ".join(f"p{i}" for i in range(90))] * 2 + ["x " + " ".join(f"p{i}" for i in range(50))]))
    start, stop = repeats.phrases_of(w, repeats.window_digests(w)[1].view(np.int64))
    assert (stop - start).tolist() == [90, 90, 51]
    whole = repeats.found_words(w, start, stop)
    monkeypatch.setattr(repeats, "PHRASE_WORDS", 100)
    assert (repeats.found_words(w, start, stop) == whole).all() and whole.sum() == 231
