"""Toxic spans by a linear-chain conditional random field.

Texts are cut into sentences (at ``.``, ``!``, ``?`` and line breaks, and
after 256 words at the latest), and each sentence is a chain of its
lower-cased words with the states clean and toxic. A word's state score is the
sum of the weights of its hash and of the hashes of its first 5, 6 and 7 bytes
(of a longer word); neighbouring states have transition scores. Forward and
backward passes give every word's marginal probability of being toxic; words
at one half or more form the spans, and a document's score is a logistic
function of the largest marginal, the sum of all marginals and their share.

The labels are per document, so the labelled tokens come from them: a word of
a toxic document is labelled toxic if one of its hashes is held by a share of
the toxic documents that is above the clean ones' share beyond doubt (the log
of the ratio less ``SIGMAS`` standard errors is over ``MIN_LOG_RATIO``), every
other word clean. The field is fitted
to those tokens by gradient steps on the conditional likelihood, the score to
the documents' labels by Newton steps, in one task over at most ``TRAIN_ROWS``
labelled documents, the first by a seeded hash of their ids.

Every row gets a score; null and empty texts have no word and get that of
marginals 0. Labels with null ``doc_id`` or label are not learned; of repeated
labels for one document the larger counts, equal texts of one label are
learned once. Without any label the score is one half. An empty table gives
an empty result. Only ``doc_id`` and ``text`` (and the label) are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prefix_hash, small_batches, span_hash
from tessera.llm.features import KIND, tokens
from tessera.llm.quality import fold, sample_rows, training_texts

BUCKETS = 1 << 18
TRAIN_ROWS = 4096
CHAIN = 256
PREFIXES = (5, 6, 7)
SIGMAS, MIN_LOG_RATIO = 3.0, 0.7
STEPS, RATE, L2 = 40, 0.5, 0.02
KEEP_SCORE = 0.3
SEED = 10

ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[list(b".!?\n\r")] = True

#: Parameters after the bucket weights: bias, transitions 0-1, 1-0, 1-1, and the
#: weights of the score's features.
EXTRA = 8


def chains(column: pa.Array):
    """Yield ``(first row, last row + 1, buckets, text index, chain starts,
    starts, ends, offsets)`` of the words of slices of a text column; a word
    has one bucket for each of its hashes, the last place if too short."""
    for i, j, h, doc, starts, ends, data, off in tokens(column):
        word = KIND[data[starts]] == 1 if len(starts) else np.zeros(0, bool)
        h, doc, starts, ends = h[word], doc[word], starts[word], ends[word]
        stops = np.concatenate([[0], np.cumsum(ENDS_SENTENCE[data])])
        new = np.ones(len(starts), bool)
        if len(starts) > 1:
            new[1:] = (doc[1:] != doc[:-1]) | (stops[starts[1:]] > stops[ends[:-1]])
        first = np.flatnonzero(new)
        place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
        first = np.flatnonzero(new | (place % CHAIN == 0))
        sums = prefix_hash(data)
        hashes = [h, *(np.where(ends - starts > k, span_hash(sums, starts, np.minimum(starts + k, ends))
                                * np.uint64(2 * k + 1), np.uint64((1 << 64) - 1)) for k in PREFIXES)]
        bucket = (np.stack(hashes) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
        yield i, j, bucket, doc, first, starts, ends, off


def forward_backward(score: np.ndarray, first: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(forward odds, backward odds, marginals)`` of the toxic state for all
    words of all chains, which advance together. ``move``: exp of the
    transition scores, 2 x 2."""
    n = len(score)
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), "right")
    e = np.exp(np.clip(score, -30, 30))
    fore, back = e.copy(), np.ones(n)
    for t in range(1, longest):
        at = first[:active[t]] + t
        r = fore[at - 1]
        fore[at] = np.clip(e[at] * (move[0, 1] + r * move[1, 1]) / (move[0, 0] + r * move[1, 0]), 1e-15, 1e15)
    last = first + size - 1
    for t in range(1, longest):
        at = last[:active[t]] - t
        r = e[at + 1] * back[at + 1]
        back[at] = np.clip((move[1, 0] + move[1, 1] * r) / (move[0, 0] + move[0, 1] * r), 1e-15, 1e15)
    odds = fore * back
    return fore, back, odds / (1 + odds)


def transition_matrix(extra: np.ndarray) -> np.ndarray:
    return np.exp(np.array([[0.0, extra[1]], [extra[2], extra[3]]]))


def fit_field(bucket: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and extra parameters that maximise the penalised conditional
    likelihood of the labelled words (gradient steps with per-parameter rates)."""
    w, extra = np.zeros(BUCKETS), np.zeros(EXTRA)
    extra[0] = -2.0
    gw, ge = np.full(BUCKETS, 1e-3), np.full(4, 1e-3)
    inner = np.ones(bucket.shape[1], bool)
    inner[first] = False
    to = np.flatnonzero(inner)          # words with a predecessor in their chain
    pair = toxic[to - 1] * 2 + toxic[to]
    seen = np.bincount(pair, minlength=4).astype(float)
    for _ in range(STEPS):
        score, move = w[bucket].sum(axis=0) + extra[0], transition_matrix(extra)
        fore, back, p = forward_backward(score, first, move)
        left, right = fore[to - 1], np.exp(np.clip(score[to], -30, 30)) * back[to]
        mass = np.stack([np.full(len(to), move[0, 0]), move[0, 1] * right, move[1, 0] * left,
                         move[1, 1] * left * right])
        expected = (mass / mass.sum(axis=0)).sum(axis=1)
        grad = sum(np.bincount(b, weights=toxic - p, minlength=BUCKETS) for b in bucket) - L2 * w
        grad[-1] = 0    # the place of missing prefixes
        some = np.array([(toxic - p).sum(), *(seen - expected)[1:]]) - L2 * extra[:4]
        gw += grad * grad
        ge += some * some
        w += RATE * grad / np.sqrt(gw)
        extra[:4] += RATE * some / np.sqrt(ge)
    return w, extra


def document_features(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per text: 1, the largest marginal, log(1 + sum of the marginals) and
    log(1 + marginals per hundred words)."""
    top = np.zeros(n)
    np.maximum.at(top, doc, p)
    total = np.bincount(doc, weights=p, minlength=n)
    share = 100 * total / np.maximum(np.bincount(doc, minlength=n), 1)
    return np.stack([np.ones(n), top, np.log1p(total), np.log1p(share)], axis=1)


def fit_score(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    c = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(c))
        c = c + np.linalg.solve(hess, x.T @ (y - p) - 0.1 * c)
    return c


def fit(texts: pa.Array, label: np.ndarray) -> np.ndarray:
    """All parameters from texts and their 0/1 labels."""
    parts, words = [], 0
    for i, j, bucket, doc, first, *_ in chains(texts):
        parts.append((bucket, doc + i, first + words))
        words += len(doc)
    bucket, doc, first = (np.concatenate(x, axis=-1) for x in zip(*parts))
    n, total = len(label), np.bincount(label, minlength=2)
    held = np.zeros((2, BUCKETS))
    for b in bucket:
        pair = np.unique(doc * BUCKETS + b.astype(np.int64))
        for k in (0, 1):
            held[k] += np.bincount((pair % BUCKETS)[label[pair // BUCKETS] == k], minlength=BUCKETS)
    ratio = np.log((held[1] + 0.5) / (total[1] + 1)) - np.log((held[0] + 0.5) / (total[0] + 1))
    lexicon = ratio - SIGMAS * np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 0.5)) > MIN_LOG_RATIO
    lexicon[-1] = False
    toxic = (lexicon[bucket].any(axis=0) & (label[doc] == 1)).astype(np.int64)
    w, extra = fit_field(bucket, first, toxic)
    _, _, p = forward_backward(w[bucket].sum(axis=0) + extra[0], first, transition_matrix(extra))
    extra[4:] = fit_score(document_features(p, doc, n), label)
    return np.concatenate([w, extra]).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None,
          limit: int = TRAIN_ROWS) -> np.ndarray:
    """Trained parameters, ``BUCKETS + EXTRA`` numbers."""
    small_batches(docs.sparkSession)

    def run(batches):
        rows = {t: y for b in batches for _, y, t in sorted(
            zip(*(c.to_pylist() for c in b.columns)), key=lambda r: (r[0], r[2] or "")) if t}
        rows = sorted(rows.items())
        if not rows:
            return
        out = fit(pa.array([t for t, _ in rows], pa.string()), np.array([y for _, y in rows], np.int64))
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["i", "w"])

    keep = F.lit(True) if keep is None else keep
    sample = training_texts(docs, sample_rows(labels, label, keep, limit, SEED)).groupBy("text").agg(
        F.min("order").alias("order"), F.max("label").alias("label"))
    # at most ``limit`` documents meet in this one task
    rows = sample.select("order", "label", "text").repartition(1).mapInArrow(run, "i long, w float").collect()
    out = np.zeros(BUCKETS + EXTRA, np.float32)
    for r in rows:
        out[r.i] = r.w
    return out


def tag_texts(column: pa.Array, model: np.ndarray) -> tuple[np.ndarray, list]:
    """``(scores, spans)``; spans are byte offsets into the UTF-8 text."""
    w, extra = model[:BUCKETS], model[BUCKETS:].astype(float)
    move = transition_matrix(extra)
    score, spans = np.zeros(len(column)), [[] for _ in range(len(column))]
    for i, j, bucket, doc, first, starts, ends, off in chains(column):
        _, _, p = forward_backward(w[bucket].sum(axis=0) + extra[0], first, move)
        score[i:j] = document_features(p, doc, j - i) @ extra[4:]
        border = np.zeros(len(doc), bool)
        border[first] = True
        previous = -2
        for k in np.flatnonzero(p >= 0.5).tolist():
            own = spans[i + doc[k]]
            base = int(off[doc[k]])
            if previous == k - 1 and not border[k]:
                own[-1]["end"] = int(ends[k]) - base
            else:
                own.append({"start": int(starts[k]) - base, "end": int(ends[k]) - base})
            previous = k
    return 1 / (1 + np.exp(-np.clip(score, -35, 35))), spans


def tag_documents(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``(doc_id, score, spans)`` for every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)   # about 1 MB, fixed
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            score, spans = tag_texts(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(spans, span)],
                                             ["doc_id", "score", "spans"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<start:int,end:int>>")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted, spans)`` with the fold of crc32
    mod 4 equal to 2 held out of training."""
    model = train(docs, labels, "toxic", fold(F.col("doc_id"), 4) != 2)
    return tag_documents(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"), "spans")
