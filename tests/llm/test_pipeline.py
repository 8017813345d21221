"""The pipeline's stages against brute force, each on its own input."""

import duckdb
import pytest
from conftest import SMALL
from test_operators import brute_components, brute_lines, line_occurrences, removed_lines

import corpus_pipeline as P
from loomcat.llm import decontaminate, quality


@pytest.fixture(scope="module")
def inputs(spark):
    """The input of each stage and the last result."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(P.written(stage(spark, out[-1], SMALL), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(inputs):
    assert all(x.columns == inputs[0].columns for x in inputs[:-1])
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "benchmark_decontamination", "bpe_encoding"]


def test_quality_stage(inputs):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    sql = f"WITH {quality.MEASURE_SQL.format(docs='documents')} SELECT doc_id FROM m WHERE ({quality.BITS_SQL}) = 0"
    assert set(rows(inputs[1])) == {r[0] for r in c.sql(sql).fetchall()}


def test_line_stage(inputs):
    """Only lines go that edit similarity alone would take, all exact copies and nine of ten others among them."""
    before = sorted((r.doc_id, r.text) for r in inputs[1].collect())
    got, want = removed_lines(before, {d: r.text for d, r in rows(inputs[2]).items()}), brute_lines(before)
    exact = {(n, k) for at in line_occurrences(before).values() for _, k, n in sorted(at)[1:]}
    assert got <= want and exact <= got and len(got - exact) >= 0.9 * len(want - exact)


def test_jaccard_stage(inputs):
    before = [(r.doc_id, r.text) for r in inputs[2].collect()]
    assert set(rows(inputs[3])) == {i for i, _, c in brute_components(before, 5, 4, 5) if i == c}


def test_decontamination_stage(spark, inputs):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    import pyarrow as pa

    before = inputs[3].collect()
    h, first = decontaminate.symbols(pa.array([r.text for r in before]))
    ih, ifirst = decontaminate.symbols(pa.array(items))
    held = set()
    for d, r in enumerate(before):
        for i in range(len(items)):
            words = ih[ifirst[i] : ifirst[i + 1]]
            if decontaminate.substring_distance(words, h[first[d] : first[d + 1]])[0] <= len(words) // 5:
                held.add(r.doc_id)
    gone = set(rows(inputs[3])) - set(rows(inputs[4]))
    assert gone <= held and len(gone) >= 0.9 * len(held)


def test_encoding_stage(inputs):
    assert {d: r.decoded for d, r in rows(inputs[5]).items()} == {d: r.text for d, r in rows(inputs[4]).items()}


ODD = ("i", "H", "once", "mine", "rid", "rh", "removed", "n_words", "fail_bits", "kept", "doc", "row", "keep", "_h", "_measures", "gone")


def test_stages_on_odd_tables(spark):
    """Each stage on empty tables, on nulls in all columns, and with columns called as its own within."""
    long = " ".join(f"w{i}" for i in range(60))
    base = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, long, "en", "s", 5), (1, long, "en", "s", 5), (None, None, None, None, None), (2, "", "en", "s", 0), (3, None, None, "s", None), (None, f"{long} more", None, None, None)], base)
    odd = docs.select("*", *(docs["source"].alias(c) for c in ODD))
    for name, stage in P.STAGES:
        out = stage(spark, odd, SMALL)
        if name != "bpe_encoding":
            assert out.columns == odd.columns, name
        got = out.collect()
        assert got, name
        if name != "bpe_encoding":
            assert all(r[c] == r["source"] for r in got for c in ODD), name
        assert stage(spark, odd.limit(0), SMALL).count() == 0, name


def test_run(spark, inputs):
    assert sorted(r.doc_id for r in P.run(spark, SMALL).collect()) == sorted(rows(inputs[5]))
