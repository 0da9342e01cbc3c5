"""Quality classifier: hashed n-gram logistic regression, trained by FTRL.

Tokens are lower-cased words and runs of symbols; the features are their 1- and
2-grams (and repetitions of a token) hashed to ``BUCKETS`` places, with the value count / sqrt(grams of the
text). The weights are trained by follow-the-regularised-leader updates
(per-coordinate rates, L1 and L2) over at most ``TRAIN_ROWS`` labelled
documents, the first in the order of a seeded hash of their ids; the bound
keeps training in one task, whatever the size of the corpus. A score is a
sparse dot product through the logistic function; the trained weights are a
fixed-size array and go to every task.

Every row gets a score. Null and empty texts have no feature and get the
score of the bias alone. Labels with null ``doc_id`` or null label, and
labels without a document, are not learned; of repeated labels for one
document the larger counts, of repeated documents each row is learned. With
no label of either kind every score is one half. An empty table gives an empty
result. Only ``doc_id`` and ``text`` (and the label) are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import mix, small_batches
from tessera.llm.features import tokens

BUCKETS = 1 << 18
TRAIN_ROWS = 8192
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
KEEP_SCORE = 0.3
SEED = 9


def fold(doc_id: Column, modulus: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus).cast("long"))


def gram_buckets(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, text index)`` of all 1- and 2-grams of a slice. A 2-gram of
    the same token twice, and a token that stands two places after itself,
    also count as one shared gram each, whatever the token."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    one = hashes >> shift
    inside = doc[1:] == doc[:-1]
    two = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[inside] >> shift
    again = [doc[k:][(hashes[k:] == hashes[:-k]) & (doc[k:] == doc[:-k])] for k in (1, 2)]
    fixed = [np.full(len(rows), mix(np.full(1, k + 1, np.uint64))[0] >> shift) for k, rows in enumerate(again)]
    return np.concatenate([one, two, *fixed]).astype(np.int64), np.concatenate([doc, doc[1:][inside], *again])


def sample_rows(labels: DataFrame, label: str, keep: Column, limit: int, seed: int) -> DataFrame:
    """``(doc_id, label, order)`` of at most ``limit`` labelled ids: the
    first by a seeded hash."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & keep)
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
            .withColumn("order", F.xxhash64(F.lit(seed), "doc_id"))
            .orderBy("order", "doc_id").limit(limit))


def training_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled documents' texts; the sample has at most its limit's rows,
    so it may be broadcast."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")


def training_set(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``(order, label, bucket, value)``: arrays of distinct buckets and values."""
    def run(batches):
        for b in batches:
            index, value = [], []
            for i, j, h, doc, *_ in tokens(b.column("text")):
                bucket, row = gram_buckets(h, doc)
                pair, count = np.unique(row * BUCKETS + bucket, return_counts=True)
                owner = pair // BUCKETS
                total = np.bincount(row, minlength=j - i)
                cut = np.searchsorted(owner, np.arange(1, j - i))
                index += np.split((pair % BUCKETS).astype(np.int32), cut)
                value += np.split((count / np.sqrt(np.maximum(total[owner], 1))).astype(np.float32), cut)
            yield pa.RecordBatch.from_arrays(
                [b.column("order"), b.column("label"), pa.array([x.tobytes() for x in index], pa.binary()),
                 pa.array([x.tobytes() for x in value], pa.binary())], ["order", "label", "bucket", "value"])

    rows = training_texts(docs, sample).select("order", "label", "text")
    return rows.mapInArrow(run, "order long, label int, bucket binary, value binary")


def ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after ``epochs`` passes in the given order."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(epochs):
        for label, bucket, value in examples:
            w = weights(bucket)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            step = (np.sqrt(n[bucket] + g * g) - np.sqrt(n[bucket])) / ALPHA
            z[bucket] += g - step * w
            n[bucket] += g * g
    return weights(slice(None)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None,
          limit: int = TRAIN_ROWS) -> np.ndarray:
    """Trained weights, ``BUCKETS + 1`` numbers."""
    small_batches(docs.sparkSession)

    def fit(batches):
        rows = [(o, y, np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
                for b in batches for o, y, i, v in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: (r[0], r[2].tobytes()))
        bias = np.array([BUCKETS], np.int64), np.ones(1, np.float32)
        w = ftrl([(y, np.concatenate([i, bias[0]]), np.concatenate([v, bias[1]])) for _, y, i, v in rows])
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["i", "w"])

    keep = F.lit(True) if keep is None else keep
    found = training_set(docs, sample_rows(labels, label, keep, limit, SEED))
    # at most ``limit`` documents meet in this one task
    rows = found.repartition(1).mapInArrow(fit, "i long, w float").collect()
    out = np.zeros(BUCKETS + 1, np.float32)
    for r in rows:
        out[r.i] = r.w
    return out


def score_texts(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1 of a text column."""
    out = np.full(len(column), float(weights[BUCKETS]))
    for i, j, h, doc, *_ in tokens(column):
        bucket, row = gram_buckets(h, doc)
        total = np.bincount(row, minlength=j - i)
        dot = np.bincount(row, weights=weights[bucket], minlength=j - i)
        out[i:j] += dot / np.sqrt(np.maximum(total, 1))
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def with_scores(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``rows`` with the score of their last column, a text, in its place."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(weights)   # about 1 MB, fixed

    def run(batches):
        for b in batches:
            s = pa.array(score_texts(b.column(b.num_columns - 1), shared.value))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], s], [*b.schema.names[:-1], "score"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` with the fold of crc32 mod 5
    equal to 0 held out of training."""
    weights = train(docs, labels, "quality", fold(F.col("doc_id"), 5) != 0)
    scored = with_scores(docs.select("doc_id", F.col("text").cast("string").alias("text")), weights)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = KEEP_SCORE) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; every label
    may be learned."""
    weights = train(docs, labels)
    # the whole row as one column: no name of it can clash with those used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("text").cast("string").alias("text"))
    return with_scores(rows, weights).filter(F.col("score") >= threshold).select("_row.*")
