"""Operator 3, quality rules: a rule bitmask ledger.

``measure`` takes one pass over the texts and returns raw measurements. ``ledger`` evaluates every
rule once and stores its failures as bits beside the measurements. ``apply_policy`` and
``ablations`` read only the ledger: a policy is a versioned bit mask, so trying another policy costs
no pass over the texts.

Defined results: a null text counts as an empty one (no words, hence base_failed); repeated rows are
each measured; other columns are ignored by ``measure`` and carried unchanged by ``keep_good``, whatever their names and
their values. An empty table gives an empty table. A text needs some 60 bytes of memory for each of its bytes in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textops import LEAD, U64, Ranges, Words, covered, freed, mix, pieces, repeated, sums

WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Rules by bit: name and the SQL condition under which a document fails. Integer arithmetic only,
#: so that every engine gives the same bits.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(BIT))
LENIENT = Policy("lenient", 1, ("too_few_words", "repeated_windows", "many_symbols"))


def measurements(texts: pa.Array) -> dict[str, np.ndarray]:
    """The raw measurements of each text."""
    w = Words(texts)
    data, at, first = w.data, w.at, w.first
    in_word = np.zeros(len(data) + 1, np.int64)
    np.cumsum(w.word_mask & LEAD[data], out=in_word[1:])
    symbol = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbol[1:])
    rolling = w.bytes_hash()
    # lines: cut at \n and at the ends of texts
    breaks = np.flatnonzero(data == 10)
    text_of_break = np.searchsorted(at, breaks, "right") - 1
    starts = np.concatenate([at[:-1], breaks + 1])
    owner = np.concatenate([np.arange(len(at) - 1), text_of_break])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.empty_like(starts)
    ends[:-1] = np.where(owner[1:] == owner[:-1], starts[1:] - 1, at[owner[:-1] + 1])
    ends[-1:] = at[owner[-1:] + 1]
    has_word = in_word[ends] > in_word[starts]
    starts, ends, owner = starts[has_word], ends[has_word], owner[has_word]
    key = rolling.hash(starts, ends) ^ mix(owner.astype(U64) + U64(1))
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[earliest] = False
    n = len(at) - 1
    # windows of eight words that occur twice in their text
    at_word = w.windows(WINDOW)
    window = Ranges(rolling.hash(w.start, w.end)).hash(at_word, at_word + WINDOW)
    window ^= mix(w.text_of()[at_word].astype(U64) + U64(1))
    twice = at_word[repeated(window)]
    return {
        "n_words": np.diff(first),
        "word_chars": in_word[at[1:]] - in_word[at[:-1]],
        "n_symbols": symbol[at[1:]] - symbol[at[:-1]],
        "n_dup_lines": np.bincount(owner[again], minlength=n),
        "n_repeat_words": sums(covered(len(w), twice, WINDOW), first),
        "n_lines": np.bincount(owner, minlength=n),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                m = measurements(piece.column(1))
                yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(m[c].astype(np.int64)) for c in MEASURES)], ["id", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = narrow.mapInArrow(freed(run), f"id {kind}, " + ", ".join(f"{c} long" for c in MEASURES))
    return out.withColumnRenamed("id", id_col)


def failure_bits() -> Column:
    """The bits of the failed rules, from the measurements."""
    bits = F.lit(0).cast("long")
    for name, rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` of each document: every rule is evaluated once, here."""
    return measure(docs, id_col, text_col).withColumn("fail_bits", failure_bits())


def apply_policy(rows: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """Adds whether the policy keeps each document; only the ledger's bits are read."""
    return rows.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail nothing else of the policy (a
    run without the rule would keep them), and bits seen together with it. One aggregation."""
    masked = rows.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("b"))
    by_bits = masked.groupBy("b").agg(F.count("*").alias("n"))  # at most 2 ** rules rows
    named = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules))
    return (
        by_bits.select("b", "n", F.explode(named).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
        .agg(
            F.sum(F.when(F.expr("b & r.bit") != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.expr("b = r.bit"), F.col("n")).otherwise(0)).alias("n_failed_only_this"),
            F.bit_or(F.when(F.expr("b & r.bit") != 0, F.expr("b & ~r.bit")).otherwise(F.lit(0).cast("long"))).alias("seen_with"),
        )
    )


def ledger_of_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The ledger beside whole rows: ``doc``, a struct of all columns, the measurements and ``fail_bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                m = measurements(piece.column(piece.schema.get_field_index(text_col)))
                doc = pa.StructArray.from_arrays(piece.columns, fields=list(piece.schema))
                yield pa.RecordBatch.from_arrays([doc, *(pa.array(m[c].astype(np.int64)) for c in MEASURES)], ["doc", *MEASURES])

    schema = T.StructType([T.StructField("doc", docs.schema), *(T.StructField(c, T.LongType()) for c in MEASURES)])
    return docs.mapInArrow(freed(run), schema).withColumn("fail_bits", failure_bits())


def keep_good(docs: DataFrame, policy: Policy = STANDARD, text_col: str = "text") -> DataFrame:
    """The rows that the policy keeps, with all their columns; no shuffle and no join."""
    return apply_policy(ledger_of_rows(docs, text_col), policy).where("kept").select("doc.*")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The ledger and two policies applied to it; ``one_rule``: the standard policy without one of its rules would keep it."""
    rows = apply_policy(apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")), STANDARD), LENIENT, "kept_lenient")
    failed = F.col("fail_bits").bitwiseAND(F.lit(BASE.mask)) != 0
    alone = F.bit_count(F.col("fail_bits").bitwiseAND(F.lit(STANDARD.mask))) == 1
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "fail_bits", "kept_lenient", alone.alias("one_rule"))


#: Windows are compared as lists of words, lines as texts: the exact values behind the hashes.
MEASURE_SQL = r"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, coalesce(text, '') AS text FROM {docs}),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
wi AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
wk AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g FROM wi),
wt AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wk) WHERE n > 1),
rw AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM wt) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN lc ON lc.doc_id = w.doc_id LEFT JOIN rw ON rw.doc_id = w.doc_id)
"""
BITS_SQL = " + ".join(f"(CASE WHEN {rule} THEN {BIT[name]} ELSE 0 END)" for name, rule in RULES)

QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE = {
    "op3_quality_rules": f"WITH {MEASURE_SQL.format(docs='documents')} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, "
    f"(n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, ({BITS_SQL}) = 0 AS kept, CAST({BITS_SQL} AS BIGINT) AS fail_bits, "
    f"(({BITS_SQL}) & {LENIENT.mask}) = 0 AS kept_lenient, bit_count({BITS_SQL}) = 1 AS one_rule FROM m"
}
