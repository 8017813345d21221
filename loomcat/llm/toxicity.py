"""Operator 8, toxicity: a factorization machine over hashed terms.

Terms of a document are its distinct words (A-Z lowered, punctuation cut off both ends) and their
first four bytes, each as a 64-bit hash. The model has a weight and a vector of ``FACTORS`` numbers
for each term it has learned, so a pair of terms (an insult and a group) can score more than the
sum of both. Terms are known by their whole 64-bit hash: none is lost to another one, and a rare word cannot pass for
a learned one. A bitmap of ``2 ** SLOT_BITS`` low hash bits goes first, so most words of a text cost one look.

Training reads at most ``sample`` labelled rows (a documented bound, the smallest hashes of their ids); scoring reads every
whole text. The model learns the terms of three or more of these rows; its size is a parameter: at most ``most_terms`` of
them, those whose label odds lie the most standard errors from none. Defined results: a null or empty text has no terms and
gets the model's bias; several labels of one id: the largest counts; repeated rows are scored each; without two classes to
learn from, every score is the share of positive labels (0 without any); an empty table gives an empty one; other columns
are ignored, whatever their names. A text needs some 60 bytes of memory for each of its bytes in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import PUNCT, U64, Words, mix, pieces

SAMPLE = 10_000
FACTORS = 8
SLOT_BITS = 21
MOST_TERMS = 50_000
SURE = 3.3
PREFIX_BYTES = 4
THRESHOLD = 0.7


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 64-bit term hash) of each distinct term of each text, in order of text."""
    w = Words(texts, lower=True)
    start, end = w.trimmed(PUNCT)
    keep = start < end
    of, start, end = w.text_of()[keep], start[keep], end[keep]
    rolling = w.bytes_hash()
    whole = rolling.hash(start, end)
    long = end - start >= PREFIX_BYTES
    head = mix(rolling.hash(start[long], start[long] + PREFIX_BYTES) + U64(77))
    of = np.concatenate([of, of[long]])
    h = np.concatenate([whole, head])
    order = np.lexsort((h, of)) if len(h) else np.zeros(0, np.int64)
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    return of[new], h[new]


@dataclass
class Model:
    bias: float
    known: np.ndarray  # uint64, the terms' hashes in order
    slots: np.ndarray  # bool, which low bits they have
    weight: np.ndarray  # float32 (rows,)
    factor: np.ndarray  # float32 (rows, FACTORS)

    def rows(self, h: np.ndarray) -> np.ndarray:
        """The row of each term, -1 if it was not learned."""
        out = np.full(len(h), -1, np.int64)
        if len(self.known):
            some = np.flatnonzero(self.slots[(h & U64(len(self.slots) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.known, h[some]), len(self.known) - 1)
            out[some] = np.where(self.known[at] == h[some], at, -1)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        w = Words(texts, lower=True)
        of, row = self._known(w)
        return self.probability(of, row, len(texts))

    def _known(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, row) of the distinct learned terms: looked up before they are made distinct."""
        start, end = w.trimmed(PUNCT)
        keep = start < end
        of, start, end = w.text_of()[keep], start[keep], end[keep]
        rolling = w.bytes_hash()
        whole = self.rows(rolling.hash(start, end))
        long = end - start >= PREFIX_BYTES
        head = self.rows(mix(rolling.hash(start[long], start[long] + PREFIX_BYTES) + U64(77)))
        pair = np.concatenate([of[whole >= 0] * len(self.weight) + whole[whole >= 0], of[long][head >= 0] * len(self.weight) + head[head >= 0]])
        pair = np.unique(pair)
        return pair // max(1, len(self.weight)), pair % max(1, len(self.weight))

    def probability(self, of: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        y = np.full(n, self.bias)
        if len(row):
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            v = self.factor[row]
            s = np.add.reduceat(v, first, axis=0)
            q = np.add.reduceat((v * v).sum(1), first)
            y[of[first]] += np.add.reduceat(self.weight[row], first) + 0.5 * ((s * s).sum(1) - q)
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def train(docs_terms: list[np.ndarray], labels: np.ndarray, epochs: int = 8, rate: float = 0.1, seed: int = 11, most_terms: int = MOST_TERMS) -> Model:
    """Fits the machine by mini-batch AdaGrad on the logistic loss."""
    n = len(labels)
    share = float(labels.mean()) if n else 0.0
    if n:
        known, at = np.unique(np.concatenate(docs_terms), return_inverse=True)
        of = np.repeat(labels, [len(t) for t in docs_terms])
        df, pos = np.bincount(at, minlength=len(known)), np.bincount(at, of, len(known))
        ok = df >= 3
        known, df, pos = known[ok], df[ok], pos[ok]
        # log odds of the label with the term, and how many standard errors they lie from 0
        odds = np.log((pos + 0.5) / (labels.sum() + 1)) - np.log((df - pos + 0.5) / (n - labels.sum() + 1))
        z = odds / np.sqrt(1 / (pos + 0.5) + 1 / (df - pos + 0.5))
        top = np.sort(np.lexsort((known, -df, -np.abs(z)))[:most_terms])
        known, odds, z = known[top], odds[top], z[top]
    else:
        known = np.zeros(0, U64)
    m = Model(0.0, known, np.zeros(1 << SLOT_BITS, bool), np.zeros(len(known), np.float32), np.zeros((len(known), FACTORS), np.float32))
    m.slots[(known & U64((1 << SLOT_BITS) - 1)).astype(np.int64)] = True
    rng = np.random.default_rng(seed)
    p0 = min(max(share, 1e-9), 1 - 1e-9)
    m.bias = float(np.log(p0 / (1 - p0)))
    if not len(known) or share in (0.0, 1.0):
        return m
    m.factor = rng.normal(0, 0.01, (len(known), FACTORS)).astype(np.float32)
    m.weight = np.where(np.abs(z) > SURE, odds, 0).astype(np.float32)  # where training starts
    rows = [r[r >= 0] for r in (m.rows(t) for t in docs_terms)]
    gw, gv, gb = np.full(len(known), 1e-2), np.full((len(known), FACTORS), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 128):
            batch = order[lo : lo + 128]
            sizes = np.array([len(rows[i]) for i in batch])
            row = np.concatenate([rows[i] for i in batch])
            of = np.repeat(np.arange(len(batch)), sizes)
            v = m.factor[row]
            s = np.stack([np.bincount(of, v[:, f], len(batch)) for f in range(FACTORS)], 1)
            q = np.bincount(of, (v * v).sum(1), len(batch))
            y = m.bias + np.bincount(of, m.weight[row], len(batch)) + 0.5 * ((s * s).sum(1) - q)
            err = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[batch]
            touched, at = np.unique(row, return_inverse=True)
            dw = np.bincount(at, err[of], len(touched)) + 1e-4 * m.weight[touched]
            each = err[of][:, None] * (s[of] - v)
            dv = np.stack([np.bincount(at, each[:, f], len(touched)) for f in range(FACTORS)], 1) + 1e-3 * m.factor[touched]
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            gb += err.sum() ** 2
            m.weight[touched] -= rate * dw / np.sqrt(gw[touched])
            m.factor[touched] -= 0.1 * rate * dv / np.sqrt(gv[touched])
            m.bias -= float(rate * err.sum() / np.sqrt(gb))
    return m


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, most_terms: int = MOST_TERMS) -> Model:
    """Fits on at most ``sample`` labelled rows, those with the smallest hash of their id.

    What reaches the driver is the bounded sample's term hashes, never its texts.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                of, h = terms(piece.column(1))
                cut = np.searchsorted(of, np.arange(piece.num_rows + 1))
                data = [h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(data, pa.binary())], ["y", "terms"])

    got = texts.mapInArrow(run, "y int, terms binary").toArrow()
    ys = got.column("y").to_numpy().astype(float)
    each = [np.frombuffer(b.as_py(), U64) for b in got.column("terms")]
    order = sorted(range(len(ys)), key=lambda i: (ys[i], len(each[i]), each[i].tobytes()[:64]))  # the same order in every run
    return train([each[i] for i in order], ys[order], most_terms=most_terms)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** SLOT_BITS slots and most_terms rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(m.score(piece.column(1)))], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}
