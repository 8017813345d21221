"""Operators of loomcat.llm against DuckDB SQL, brute force, round trips and held-out accuracy."""

import base64
import hashlib
import random
import re
import weakref
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcat.llm import bpe, chat, decontaminate, jaccard, lines, packing, quality, registry, repeats, textops, toxicity, warc

LONG = " ".join(f"w{i % 700}" for i in range(5000))
SHARED = " ".join(f"shared{i}" for i in range(60))
EDGE = [
    (1, "a b c d e f g h i j k l m n o p q r s t u v"), (2, None), (3, ""), (4, " \n\t "), (5, "one"), (6, "one"), (7, "two words"), (8, f"x {SHARED} y"), (9, f"{SHARED}"), (10, f"{SHARED} {SHARED}"),
    (11, LONG), (12, LONG), (13, LONG.replace("w5 ", "v5 ")), (14, "Ünï çödé wörds " * 12), (None, "one"), (None, None), (5, "one"), (5, "other text of the same id"), (15, "a\na\nb\n\n  \na"), (16, "for " * 50),
    (17, "x\x1cy\x0bz w   end"), (18, "| a | b | c |\n| a | b | d |"),
]
DDL = "doc_id long, text string, id string, h string, row int"


@pytest.fixture(scope="module")
def edge(spark):
    """Texts of every odd kind, with other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "other", "column", 1) for i, t in EDGE], DDL)


@pytest.fixture(scope="module")
def edge_duck(edge):
    c = duckdb.connect()
    c.register("documents", edge.toPandas().assign(doc_id=lambda x: x.doc_id.astype("Int64")))
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, same, name):
    same(registry.queries()[name](spark, SMALL), duck.sql(registry.oracle_sql()[name]))


# ---- 1 ---------------------------------------------------------------------------------------------


def test_chat_escapes_round_trip(spark):
    texts = ["", "<|im_end|>", "␛0<|␛|<␛|", "<<|||>", "a\nb", "%%\\", "<", "|", "<␛|im_start|>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape(chat.escape(F.col("t"), True), True).alias("r"), chat.escape(F.col("t")).contains("<|").alias("bad")).collect()
    assert all(r.t == r.u == r.r and not r.bad for r in got)


def test_chat_trees(spark):
    edges = [("a", None, "user", "q", 1.0), ("b", "a", "assistant", "x", 1.0), ("c", "a", "assistant", "y", 5.0), ("d", "c", None, None, None), ("e", "gone", "user", "lone", 0.0), ("x", "y", "user", "cycle", 1.0), ("y", "x", "user", "cycle", 1.0), ("z", "y", "user", "tail", 1.0)]
    nodes = spark.createDataFrame(edges, "node string, parent string, role string, text string, score double").withColumn("tree", F.lit("t"))
    paths = chat.reply_paths(nodes)
    got = defaultdict(list)
    for r in paths.collect():
        got[r.leaf].append((r.up, r.node))
    assert {k: [n for _, n in sorted(v, reverse=True)] for k, v in got.items()} == {"b": ["a", "b"], "d": ["a", "c", "d"], "e": ["e"]}
    ranked = chat.rank_paths(paths, nodes.select("node", "tree", "score"), top=2)
    assert [(r.leaf, r.rank) for r in ranked.orderBy("rank").collect()] == [("d", 1), ("b", 2)]
    text = {r.leaf: (r.formatted, [(s.start, s.length) for s in r.loss_spans]) for r in chat.format_paths(paths, nodes, ranked).collect()}
    assert text["b"] == ("<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n", [(52, 1)])  # 29 characters of the first turn, 22 of the second head; counted from 1
    assert chat.reply_paths(nodes.limit(0)).count() == 0


def test_chat_null_conversation(spark):
    rows = spark.createDataFrame([(None, 1, "user", "a"), (None, 1, "user", "a"), (7, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.formatted.count("<|im_start|>") for r in chat.format_conversations(rows).collect()}
    assert got == {None: 2, 7: 1}


# ---- 2 ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.vocabulary_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tokenizer(spark, edge, tokenizer):
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in bpe.encode_texts(edge, with_decoded=True).collect()), key=str)
    want = sorted(((i, tokenizer.encode_ordinary(t or ""), t or "") for i, t in EDGE), key=str)
    assert got == want
    assert bpe.encode_texts(edge.limit(0)).count() == 0
    rows = [(1, tokenizer.encode_ordinary("héllo wörld")), (2, None), (3, []), (4, [10**8]), (5, [None]), (1, tokenizer.encode_ordinary("x" * 3000))]
    back = bpe.decode(spark.createDataFrame([(*r, "t", 0) for r in rows], "row int, ids array<int>, token string, at int"))
    assert back.columns == ["row", "ids", "token", "at", "decoded"]
    assert sorted((r.row, r.decoded and bytes(r.decoded).decode()) if r.decoded is not None else (r.row, "none") for r in back.collect()) == [(1, "héllo wörld"), (1, "x" * 3000), (2, "none"), (3, b""), (4, "none"), (5, "none")]
    table = {r.token_id: bytes(r.token) for r in bpe.decode_table(spark).collect()}
    assert b"".join(table[i] for i in tokenizer.encode_ordinary("a b")) == b"a b"


def test_bpe_query(spark, tokenizer):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in registry.queries()["op2_bpe"](spark, SMALL).collect():
        ids = tokenizer.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a1 \t\n\r'sé\x1c\x1f\x85\xa0 ​.,!😀", max_size=30))
def test_bpe_pieces(text):
    import public_tokenizers

    assert "".join(bpe.splitter(public_tokenizers.PATTERN)(text)) == text


@pytest.mark.parametrize("top", [0, 239, 240, 70000, 1 << 20, (1 << 20) + 300, 1 << 24])
def test_bpe_number_codes(top):
    x = np.r_[np.random.default_rng(top).integers(0, top + 1, 300), [top]].astype(np.int32)
    assert (bpe.numbers_of(*bpe.number_codes(x)) == x).all()


# ---- 3, 5, 6 on odd texts --------------------------------------------------------------------------


def test_quality_edges(edge):
    w = re.compile(r"[^\x20\x09-\x0D]+")
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.measure(edge).collect())
    want = []
    for i, t in EDGE:
        ws = w.findall(t or "")
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if w.search(line):
                dup += line in seen
                seen.add(line)
        where = defaultdict(list)
        for k in range(len(ws) - 7):
            where[tuple(ws[k : k + 8])].append(k)
        cover = {p for ks in where.values() if len(ks) > 1 for k in ks for p in range(k, k + 8)}
        want.append((i or 0, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(cover)))
    assert got == sorted(want)
    assert quality.measure(edge.limit(0)).count() == 0


def test_quality_ledger(spark, edge):
    rows = quality.ledger(edge)
    kept = quality.keep_good(edge)
    assert kept.columns == edge.columns
    assert kept.count() == quality.apply_policy(rows, quality.STANDARD).where("kept").count()
    bits = [r.fail_bits for r in rows.collect()]
    for r in quality.ablations(rows, quality.STANDARD).collect():
        assert r.n_failed == sum(bool(b & r.bit) for b in bits)
        assert r.n_failed_only_this == sum(b & quality.STANDARD.mask == r.bit for b in bits)


def brute_kept(texts, k=35):
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    where = defaultdict(list)
    for d, w in enumerate(ws):
        for i in range(len(w) - k + 1):
            where[tuple(w[i : i + k])].append((d, i))
    gone = [set() for _ in ws]
    for at in where.values():
        if len(at) > 1:
            for d, i in at:
                gone[d].update(range(i, i + k))
    return [(" ".join(x for p, x in enumerate(w) if p not in g), len(w), len(g)) for w, g in zip(ws, gone, strict=True)]


def test_repeats_edges(spark, edge):
    rng = random.Random(3)
    more = [(100 + j, " ".join(rng.choice("abc") for _ in range(rng.randrange(30, 200)))) for j in range(40)]
    more += [(200, "for " * 36), (201, "for " * 35), (202, " ".join(f"u{i}" for i in range(35))), (203, "lead " + " ".join(f"u{i}" for i in range(35)))]
    docs = edge.unionByName(spark.createDataFrame([(i, t, "", "", 0) for i, t in more], DDL))
    got = sorted(((r.doc_id or 0, r.text, r.n_words, r.n_removed) for r in repeats.dedup_text(docs).collect()), key=str)
    texts = EDGE + more
    want = sorted(((i or 0, *x) for (i, _), x in zip(texts, brute_kept([t for _, t in texts]), strict=True)), key=str)
    assert got == want
    assert repeats.dedup_text(edge.limit(0)).count() == 0


def brute_components(items, k, num, den):
    sets = []
    for _, t in items:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    comp = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    least = defaultdict(list)
    for (i, _), c in zip(items, comp, strict=True):
        if i is not None:
            least[c].append(i)
    return [(i, len(s), (min(least[c]) if least[c] else None) if s else i) for (i, _), s, c in zip(items, sets, comp, strict=True)]


def variants(n, edits, seed, words=150, start=1000):
    """Near copies of one text: chains of links and pairs just below the threshold."""
    rng = random.Random(seed)
    base = [f"t{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for j in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((start + j, " ".join(w)))
    return out


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (5, 4, 5)])
def test_jaccard_edges(spark, edge, k, num, den):
    more = variants(40, 9, 1) + variants(30, 14, 2, start=2000) + variants(12, 60, 3, words=3000, start=3000)
    docs = edge.unionByName(spark.createDataFrame([(i, t, "", "", 0) for i, t in more], DDL))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar(docs, k, num, den).collect()), key=str)
    assert got == sorted(brute_components(EDGE + more, k, num, den), key=str)
    kept = jaccard.keep_one(docs, k, num, den)
    assert kept.columns == docs.columns
    gone = {i for i, _, c in got if i is not None and i != c}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in EDGE + more} - gone
    assert jaccard.similar(edge.limit(0), k, num, den).count() == 0


def test_jaccard_reads_no_chance_pairs(spark, monkeypatch):
    """Sets that share min-hashes (a passage in common) but can't link are ruled out without being read in full."""
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    items = [(n, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(60)])) for n in range(40)]
    items.append((100, items[7][1] + " more"))
    docs = spark.createDataFrame(items, "doc_id long, text string")
    asked, overlaps = [], jaccard.overlaps

    def counted(docs, sets, pairs, *rest):
        asked.extend(tuple(sorted((r.a, r.b))) for r in pairs.select("a", "b").collect())
        return overlaps(docs, sets, pairs, *rest)

    monkeypatch.setattr(jaccard, "overlaps", counted)
    got = {r.doc_id: r.component_id for r in jaccard.similar(docs).collect()}
    assert got == {n: 7 if n == 100 else n for n, _ in items} and len(set(asked)) == 1


def test_jaccard_ids(spark):
    """Ids that are missing, repeated or texts: sets are told apart by what they hold."""
    base = [f"t{n}" for n in range(150)]
    near = lambda *at: " ".join(f"x{p}" if p in at else w for p, w in enumerate(base))
    other = " ".join(f"u{n}" for n in range(150))
    items = [(None, near()), (7, near(3)), (5, near(60)), (5, other), (8, other.replace("u9 ", "v ")), (8, other.replace("u9 ", "v ")), (None, "lone words here"), (None, None), (9, "")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "doc_id long, text string, h string, once int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar(df).collect()), key=str)
    assert got == sorted(brute_components(items, 3, 90, 100), key=str)
    kept = jaccard.keep_one(df, 3, 90, 100)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(5, near(60)), (5, other), (None, "lone words here"), (None, None), (9, "")], key=str)
    names = df.withColumn("doc_id", F.concat(F.lit("n"), F.col("doc_id").cast("string")))
    assert {(r.doc_id, r.component_id) for r in jaccard.similar(names).collect()} == {(i and f"n{i}", c and f"n{c}") for i, _, c in got}
    twice = spark.createDataFrame([(4, other), (4, other), (4, other)], "doc_id long, text string")
    assert [r.doc_id for r in jaccard.keep_one(twice).collect()] == [4]


def test_derived_overlap():
    rng = random.Random(1)
    for _ in range(50):
        lead = set(rng.sample(range(300), 100))
        x, y = (set(rng.sample(sorted(lead), 90)) | set(rng.sample(range(300), 20)) for _ in range(2))
        pack = lambda s: np.array(sorted(s), np.uint64).tobytes()
        assert jaccard.derived(len(lead), (pack(lead - x), pack(lead - y)), (pack(x - lead), pack(y - lead))) == len(x & y)


def test_parity_bounds_difference():
    rng = np.random.default_rng(4)
    for n, m in ((100, 120), (2000, 1900), (5000, 4600)):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.r_[a[: n // 2], rng.integers(0, 2**63, m - n // 2, dtype=np.uint64)]

        def parity(x):
            bits = int(jaccard.parity_bits(np.array([len(x)]))[0])
            return np.packbits((np.bincount((textops.mix(x) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()

        assert jaccard.parity_apart(parity(a), parity(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


# ---- 4 ---------------------------------------------------------------------------------------------


def sellers(item, text):
    row = list(range(0, 1)) + [0] * len(text)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=8), st.lists(st.integers(0, 4), max_size=20))
def test_substring_distance(item, text):
    assert decontaminate.substring_distance(np.array(item, np.uint64), np.array(text, np.uint64))[0] == sellers(item, text)


def test_leaks_recall(spark):
    """All verbatim passages, and 0.9 of those with edits up to the limit, against brute force."""
    rng = random.Random(9)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs, found_by_brute = [], set()
    for n in range(120):
        i, text = rng.choice(items)
        w = text.split()
        for _ in range(rng.randrange(0, len(w) // 5 + 2)):
            w[rng.randrange(len(w))] = f"zz{rng.randrange(10**6)}"
        filler = [f"f{rng.randrange(10**5)}" for _ in range(60)]
        at = rng.randrange(60)
        docs.append((n, " ".join(filler[:at] + w + filler[at:]), None))
    docs += [(900, None, None), (901, "", None), (902, "clean words only here " * 20, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item string")
    h, first = decontaminate.symbols(pa.array([t for _, t, _ in docs]))
    ih, ifirst = decontaminate.symbols(pa.array([t for _, t in items]))
    for d, (n, _, _) in enumerate(docs):
        for i, (item, _) in enumerate(items):
            words = ih[ifirst[i] : ifirst[i + 1]]
            if decontaminate.substring_distance(words, h[first[d] : first[d + 1]])[0] <= len(words) // 5:
                found_by_brute.add((n, item))
    bench = spark.createDataFrame([*items, (None, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    assert got <= found_by_brute and len(got) >= 0.9 * len(found_by_brute) and len(found_by_brute) > 80
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench, block_bytes=2000).collect()}
    assert blocks == got
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {n for n, _, _ in docs} - {n for n, _ in got}
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0 and decontaminate.leaks(df.limit(0), bench).count() == 0


def test_short_items(spark):
    df = spark.createDataFrame([(1, "say hello big world now"), (2, "hello big"), (3, "one two")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "Hello, big world!"), (6, "one"), (7, "...")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()} == {(1, 5), (3, 6)}


@pytest.mark.parametrize("n", [5, 8, 10, 15, 16, 17, 18, 20, 24, 28, 31, 32])
def test_recall_by_length(n):
    """Copies with random edits up to the limit: all of short items are found, 0.9 of others; none without edits is missed."""
    rng = random.Random(n)
    words = [f"w{i}" for i in range(n)]
    found = 0
    for _ in range(60):
        w = list(words)
        for e in range(rng.randrange(1, n // 5 + 1)):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + (kind > 0)] = [f"z{e}"] if kind < 2 else []
        w = [f"f{rng.randrange(10**5)}" for _ in range(rng.randrange(30))] + w + [f"g{rng.randrange(10**5)}" for _ in range(rng.randrange(30))]
        h, first = decontaminate.symbols(pa.array(["other text", " ".join(w)]))
        leak = decontaminate.leaks_in(h, first, decontaminate.Items([1], [" ".join(words)]))
        assert {x[0] for x in leak} <= {1}
        found += bool(leak)
    assert found == 60 if n < decontaminate.SHORT else found >= 54


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("d1", "say hello big world now"), (None, "hello big world"), ("d3", None)], "doc_id string, text string")
    bench = spark.createDataFrame([("i5", "Hello, big world!"), (None, "say hello"), ("i6", None)], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {("d1", "i5"), (None, "i5"), ("d1", None)}
    assert sorted(((r.doc_id, r.decoded) for r in bpe.encode_texts(docs, with_decoded=True).collect()), key=str) == sorted([("d1", "say hello big world now"), (None, "hello big world"), ("d3", "")], key=str)
    assert sorted(str(s.doc_id) for r in packing.packed(docs).collect() for s in r.segments) == ["None", "d1", "d3"]
    assert sorted(str(r.doc_id) for r in packing.read_segments(packing.packed(docs)).collect()) == ["None", "d1", "d3"]


def test_trimmed():
    w = textops.Words(pa.array(["((((word)))) \"a-b\" ...", "", None, "!!", "x", "((y z))))))"]))
    start, end = w.trimmed(textops.PUNCT)
    assert [bytes(w.data[a:b]).decode() for a, b in zip(start, end, strict=True)] == ["word", "a-b", "", "", "x", "y", "z"]
    w = textops.Words(pa.array(["... !!"]))
    assert (w.trimmed(textops.PUNCT)[0] == w.trimmed(textops.PUNCT)[1]).all()


def test_first_word_changed():
    item = [f"w{i}" for i in range(16)]
    h, first = decontaminate.symbols(pa.array([" ".join(["a", "zz", *item[1:], "b"])]))
    assert [x[:3] for x in decontaminate.leaks_in(h, first, decontaminate.Items([1], [" ".join(item)]))] == [(0, 0, 1)]


def test_memory_given_back(monkeypatch):
    """Before a task's first batch, and after its last one when nothing holds it."""
    alive, seen = [], []
    monkeypatch.setattr(textops, "give_back", lambda: seen.append(len(alive) and alive[-1]() is not None))

    def run(batches):
        for batch in batches:
            alive.append(weakref.ref(batch))
            yield len(batch)

    assert list(textops.freed(run)(np.arange(n) for n in (3, 4))) == [3, 4]
    assert seen == [0, False]


def test_decontamination_tables_follow_the_block(monkeypatch):
    """What a task holds beside the items grows with them; tables of any size give the same leaks."""
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 60)) for _ in range(40)]
    items = decontaminate.Items(list(range(40)), texts)
    assert sum(t.nbytes for found in items.tables for t in found) < 8 << 20
    h, first = decontaminate.symbols(pa.array([f"{a} x {b}" for a, b in zip(texts, texts[1:], strict=False)] + ["nothing of it " * 30]))
    want = decontaminate.leaks_in(h, first, items)
    assert {x[:3] for x in want} >= {(n, n + j, 0) for n in range(39) for j in range(2)}
    for bits in (1, 22):
        monkeypatch.setattr(decontaminate, "TABLE_BITS", range(bits, bits + 1))
        assert decontaminate.leaks_in(h, first, decontaminate.Items(list(range(40)), texts)) == want


# ---- 7 ---------------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_pack(lengths):
    rows = packing.pack(lengths, 64)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    room: list[int] = []  # plain best fit
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(64 - n)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(room)


def test_packing_round_trip(spark, edge, tokenizer):
    rows = packing.packed(edge, seq_len=64).collect()
    docs = defaultdict(dict)
    for r in rows:
        ids, pos = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.position_ids, "<u4")
        assert len(ids) == len(pos) == 64 and r.cu_seqlens[-1] == 64 and np.flatnonzero(pos == 0).tolist() == r.cu_seqlens[:-1]
        for a, b, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.segments, strict=False):
            docs[s.doc_id].setdefault(s.segment, []).append((s.start, ids[a:b].tolist()))
    got = sorted(x for d in docs.values() for parts in d.values() for _, x in parts)
    want = []
    for _, t in EDGE:
        ids = [*tokenizer.encode_ordinary(t or ""), packing.END_OF_TEXT]
        want += [ids[a : a + 64] for a in range(0, len(ids), 64)]
    assert got == sorted(want)
    assert packing.packed(edge.limit(0)).count() == 0


def test_packing_query(spark, tokenizer):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {(r.doc_id, r.segment): (r.start, r.length, r.ids_sha256) for r in registry.queries()["op7_packing"](spark, SMALL).collect()}
    want = {}
    for d, t in docs.items():
        ids = np.array([*tokenizer.encode_ordinary(t), packing.END_OF_TEXT], "<u4")
        for s, a in enumerate(range(0, len(ids), packing.SEQ_LEN)):
            part = ids[a : a + packing.SEQ_LEN]
            want[d, s] = (a, len(part), hashlib.sha256(part.tobytes()).hexdigest())
    assert got == want


# ---- 8 ---------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    big = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    got = registry.queries()["op8_toxicity"](spark, big).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    hit, flagged, real = sum(a and b for a, b in held), sum(b for _, b in held), sum(a for a, _ in held)
    assert hit / flagged > 0.95 and hit / real > 0.75


def test_toxicity_pairs():
    """An insult alone or a group alone is harmless, both together are not: only the pair term can tell."""
    rng = random.Random(2)
    texts, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.4, rng.random() < 0.4
        w = [f"n{rng.randrange(60)}" for _ in range(6)] + ["insulting"] * a + ["grouping"] * b
        rng.shuffle(w)
        texts.append(" ".join(w))
        y.append(float(a and b))
    of, h = toxicity.terms(pa.array(texts))
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    m = toxicity.train([h[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], np.array(y), epochs=20)
    p = m.score(pa.array(["n1 insulting", "n1 grouping", "n1 insulting grouping", "n2 n3"]))
    assert p[2] > 0.7 and max(p[0], p[1], p[3]) < 0.5


def test_toxicity_naive():
    """Scores against the sum over all pairs of terms, and with a vocabulary limit of its own."""
    rng = random.Random(4)
    texts = [" ".join(f"word{rng.randrange(40)}" for _ in range(rng.randrange(1, 12))) for _ in range(300)] + ["", "unknown"]
    of, h = toxicity.terms(pa.array(texts))
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    each = [h[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    y = np.array([float("word7" in t.split() and "word9" in t.split() or rng.random() < 0.2) for t in texts])
    for most in (50_000, 10):
        m = toxicity.train(each, y, most_terms=most)
        assert len(m.known) <= most and (np.diff(m.known.astype(float)) > 0).all()
        place = {int(k): i for i, k in enumerate(m.known)}
        for t, got in zip(each, m.score(pa.array(texts)), strict=True):
            i = [place[int(x)] for x in t if int(x) in place]
            z = m.bias + sum(float(m.weight[a]) for a in i) + sum(float(np.dot(m.factor[a].astype(float), m.factor[b].astype(float))) for n, a in enumerate(i) for b in i[:n])
            assert abs(got - 1 / (1 + np.exp(-min(max(z, -30), 30)))) < 1e-4


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        got = toxicity.score(edge, toxicity.fit(edge, lab)).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)


# ---- 9 ---------------------------------------------------------------------------------------------


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def distance(a, b):
    """levenshtein, a row at a time."""
    codes = {x: i for i, x in enumerate(dict.fromkeys([*a, *b]))}
    b, at = np.array([codes[x] for x in b], np.int64), np.arange(len(b) + 1)
    row = at
    for i, x in enumerate(a):
        new = np.r_[i + 1, np.minimum(row[1:] + 1, row[:-1] + (b != codes[x]))]
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def edit_similar(a, b):
    if len(a) > lines.LONG_CHARS and len(b) > lines.LONG_CHARS:
        a, b = a.split(" "), b.split(" ")
    most = max(len(a), len(b)) // 5
    return abs(len(a) - len(b)) <= most and distance(a, b) <= most


def line_occurrences(items):
    occ = defaultdict(list)
    for n, (i, t) in enumerate(items):
        for at, line in enumerate((t or "").split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
            if w:
                occ[" ".join(w)].append((i, at, n))
    return occ


def brute_lines(items):
    """The removed (row, line) by edit similarity alone, without any SimHash. Pairs with fewer than a third of their words in
    common are not compared."""
    occ = line_occurrences(items)
    norms = list(occ)
    words = [set(s.split(" ")) for s in norms]
    comp = list(range(len(norms)))
    for i in range(len(norms)):
        for j in range(i):
            a, b = norms[i], norms[j]
            if min(len(a), len(b)) < lines.NEAR_CHARS or 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)) or 3 * len(words[i] & words[j]) < len(words[i]):
                continue
            if comp[i] != comp[j] and edit_similar(a, b):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    groups = defaultdict(list)
    for s, c in zip(norms, comp, strict=True):
        groups[c] += occ[s]
    gone = set()
    for at in groups.values():
        gone.update((n, line) for _, line, n in sorted(at, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))[1:])
    return gone


def removed_lines(before, after):
    """The (row, line) that differ, for rows of unique ids."""
    out = set()
    for n, (i, t) in enumerate(before):
        kept, at = (after[i] or "").split("\n"), 0
        for k, line in enumerate((t or "").split("\n")):
            if at < len(kept) and kept[at] == line:
                at += 1
            else:
                out.add((n, k))
    return out


def without(items, gone):
    return [(i, t if not any(m == n for m, _ in gone) else "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone)) for n, (i, t) in enumerate(items)]


def test_lines_brute_force(spark):
    rng = random.Random(6)
    base = [f"word{rng.randrange(10**5)}" for _ in range(120)]
    items = [(1, "Same  Line of five words\nshort one\n" + " ".join(base)), (2, "same line\tof FIVE words\nshort one"), (3, None), (4, ""), (5, "\n\n")]
    for n in range(25):  # many variants of one long line, most of one SimHash
        w = list(base)
        w[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        if n % 3 == 0:
            w[rng.randrange(120)] = f"y{rng.randrange(1000)}"
        items.append((10 + n, "intro\n" + " ".join(w)))
    w = list(base)
    rng.shuffle(w)  # the same words, another text
    items += [(50, " ".join(w)), (51, "| a | b | c |\n| d | e | f |\n| g | h | i |"), (52, " ".join(base))]
    df = spark.createDataFrame([(i, t, "x") for i, t in items], "doc_id long, text string, line string")
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(without(items, brute_lines(items)), key=str)
    assert lines.dedup_lines(df.limit(0)).count() == 0


def test_lines_of_few_words(spark):
    items = [(1, "All rights reserved.\nchapter 1\n\n你好世界你好世界"), (2, "all  rights reserved.\nchapter 2\n\n你好世界你好世界"), (3, " \n*")]
    out = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert out == {1: items[0][1], 2: "chapter 2\n", 3: " \n*"}


def test_lines_recall(spark):
    """Of lines with a word replaced, 0.9 go, against a brute force without the SimHash condition."""
    rng = random.Random(8)
    items, pairs = [], 0
    for n in range(150):
        w = [f"{rng.choice('bcdfgklm')}{rng.randrange(10**4)}" for _ in range(rng.choice([6, 8, 12, 20, 40]))]
        v = list(w)
        v[rng.randrange(len(v))] = f"x{rng.randrange(10**3)}"
        a, b = " ".join(w), " ".join(v)
        pairs += 5 * levenshtein(a, b) <= max(len(a), len(b))
        items += [(2 * n, a), (2 * n + 1, b)]
    df = spark.createDataFrame(items, "doc_id long, text string")
    gone = {r.doc_id for r in lines.dedup_lines(df).collect() if r.text == ""}
    assert all(n % 2 for n in gone) and len(gone) <= pairs and len(gone) >= 0.9 * pairs and pairs > 120


def brute_blocks(norm):
    """The two longs of each block by counting bit by bit; None where a class has eight words or more."""
    x = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in dict.fromkeys(norm.split(" "))]
    level = max(2, int(np.floor(np.log2(len(x) / 4)))) if len(x) >= lines.FEW_WORDS else 0
    out = {}
    for j in range(lines.BLOCKS):
        own = [h >> 3 for h in x if (h & ((1 << level) - 1) if level else (h - (h >> 63 << 64)) % lines.BLOCKS) == j]
        bits = [sum(1 << (3 * i + 2) for i in range(20) if 2 * sum(h >> (s + 3 * i) & 1 for h in own) > len(own)) for s in lines.SHIFTS]
        out[j] = bits if len(own) < 8 else None
    return level, out


def test_blocks(spark):
    """SimHash votes, from a few words to a hundred thousand; nothing overflows."""
    texts = [" ".join(f"w{n}x{i}" for i in range(n)) for n in (10, 16, 40, 127, 128, 254, 255, 256, 1000)] + [" ".join(["|", "a"] * 50_000), " ".join(f"v{i}" for i in range(100_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lines.sketches(lines.line_rows(df, "doc_id", "text"))
    assert got.where("main").count() == len(texts)
    for r in got.where("main").collect():
        level, want = brute_blocks(texts[r.id])
        assert r.level == level
        for j, bits in want.items():
            if bits is not None:
                have = [(r.sim1, r.sim2)[j // 3] >> (j % 3 + 3 * i) & 1 for i in range(20)]
                assert have == [bits[0] >> (3 * i + 2) & 1 for i in range(20)]


def test_edit_similarity(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(150):
        w = [f"{rng.choice('abcdef')}{rng.randrange(500)}" for _ in range(rng.choice([1, 4, 12, 70, 130]))]
        v = [x if rng.random() > 0.2 else rng.choice([x[::-1], f"q{rng.randrange(99)}"]) for x in w if rng.random() > 0.05]
        pairs.append((" ".join(w), " ".join(v) or "x"))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.in_units(F.col("a"), F.col("b")).alias("u")).select("a", "b", lines.within_a_fifth(F.col("u.x"), F.col("u.y")).alias("yes")).collect()
    assert [r.yes for r in got] == [edit_similar(r.a, r.b) for r in got] and 20 < sum(r.yes for r in got) < 140


def test_lines_columns(spark):
    """Columns that are called as those within, in any case."""
    names = ["doc_id", "text", "rid", "RH", "removed", "h", "keep", "line", "key", "_removed"]
    df = spark.createDataFrame([(1, "a line of text\nx", *"abcdefgh"), (2, "y\nA  line of text", *"abcdefgh"), (3, None, *"abcdefgh")], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names[2:]))
    out = lines.dedup_lines(df)
    assert out.columns == df.columns and sorted(((r.doc_id, r.text, r[9]) for r in out.collect()), key=str) == [(1, "a line of text\nx", "h"), (2, "y", "h"), (3, None, "h")]


def test_line_query(spark):
    """The query on the small table against brute force: all exact copies go, and nothing that edit similarity would keep."""
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = {(r.doc_id, int(k)) for r in registry.queries()["op9_line_dedup"](spark, SMALL).collect() for k in r.removed_lines.split(",") if k}
    want = {(docs[n][0], k) for n, k in brute_lines(docs)}
    assert got <= want
    exact = {(i, k) for at in line_occurrences(docs).values() for i, k, _ in sorted(at)[1:]}
    assert exact <= got


def test_lines_edges(spark, edge):
    out = lines.dedup_lines(edge).collect()
    assert len(out) == len(EDGE) and sum(r.text is None for r in out) == 2
    assert {r.doc_id: r.text for r in out}[12] == ""  # an exact copy of document 11


# ---- 10 --------------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), max_size=8).map(sorted), max_size=9))
def test_loser_tree(runs):
    assert list(warc.LoserTree([list(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_warc_edges(spark, tmp_path):
    page = "<p>" + "é" * 100 + "WARC/1.1\r\n\r\nContent-Length: 3\r\n" + "</p>"
    rows = [(1, "http://www.A.com:80/x?y#z", page), (2, "http://a.com/x?y", page), (3, None, None), (4, "u\r\nv", ""), (5, "http://b.a.com/", "short"), (6, "http://b.a.com/", "short"), (None, "http://c/", page), (1, "http://a.com/", page)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, records_per_archive=2)
    history = warc.capture_history(spark, path, rows_per_range=2)
    got = history.orderBy("position").collect()
    keys = [(r.url_key, r.captured_at, -1 if r.page_id is None else r.page_id) for r in got]
    assert keys == sorted(keys) and [r.position for r in got] == list(range(len(rows)))
    kinds = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted([(1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (0, "revisit", 1)], key=str)
    assert {r.payload_digest for r in got if r.page_id in (1, 2)} == {hashlib.sha256(page.encode()).hexdigest()}
    assert warc.url_key("http://www.A.com:80/x?y#z") == "com,a)/x?y"
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
