"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Between stages the result is written as
Parquet and read again; ``run`` does so in the shared folder. All but the last return the columns of documents.

In every stage other columns are carried, whatever their names, rows that repeat an id are documents of their own, and so are rows
without one, an empty table gives an empty one, and a text of any length is read whole by one task. What a stage does with
null and empty texts and with ties is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomcat.llm import bpe, decontaminate, jaccard, lines, quality
from loomcat.llm.registry import shipped
from loomcat.llm.shared import written


@shipped
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the standard policy rejects. A null or empty text has no words, so it fails the rule on their number
    and goes; equal texts fare alike."""
    return quality.keep_good(docs, quality.STANDARD)


@shipped
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated and near-repeated lines out of the texts; every document stays, if with an empty text. Null texts stay null, lines without a
    word stay. Of equal lines the one of the smallest id, then line number, then text hash stays."""
    return lines.dedup_lines(docs)


@shipped
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more. Null and empty texts are in no group and stay;
    a text of fewer than five words is near its equals only. Of a group the smallest id stays (a missing one
    comes last), of equal ids the smallest text hash, of equal rows one."""
    return jaccard.keep_one(docs, k=5, num=4, den=5)


@shipped
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item within a fifth of its words in edits, that limit included. Null and empty texts hold none and
    stay; null and empty items are held by none; equal items count once."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@shipped
def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and the text decoded from them. A null text is an empty one: no ids; equal texts get equal ids."""
    return bpe.encode_texts(docs, with_decoded=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]
#: SimHash lines, CGK candidates and BPE have no SQL; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
