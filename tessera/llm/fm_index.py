"""Exact passage dedup with a compressed full-text index per shard.

Text shared between documents is brought together in shards
(:mod:`tessera.llm.repeats`). Each shard's word sequence is indexed as an
FM-index: the Burrows-Wheeler transform of the sequence in a wavelet matrix,
whose bit vectors are packed and carry a running count per 64 bits, so it
takes about as many bits per word as the vocabulary needs. The shard's
documents are then streamed against it: backward search extends a match to
the left from every end position, for all positions at once, and yields its
matching statistic (length and interval of the index). Matches that reach
the threshold are reported; the smallest document of an interval decides.

``dedup`` removes each word covered by a window of 13 consecutive words whose
sequence also starts in a document with a smaller ``doc_id``. Words are runs
of non-space bytes, unchanged. Null text has no words; a null ``doc_id`` is
larger than all others; rows with equal ``doc_id`` do not affect each other;
texts under 13 words stay whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import unpack
from tessera.llm.repeats import Grain, cover_of, find_cover, join_cover
from tessera.llm.suffix_array import rank_order

WINDOW = 13
GRAM = 4


class BitVector:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bits.dtype)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def ones(self, upto: np.ndarray) -> np.ndarray:
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Index of a sequence of symbols ``0 .. sigma - 1``; symbol 0 separates
    texts and never matches."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.order = rank_order(sequence)
        row = sequence[self.order - 1]          # the symbol before the first suffix is a separator
        count = np.bincount(sequence, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.levels, self.zeros = [], []
        for b in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bits = (row >> b) & 1
            self.levels.append((b, BitVector(bits.astype(np.uint8))))
            self.zeros.append(int(len(bits) - bits.sum()))
            row = np.concatenate([row[bits == 0], row[bits == 1]])
        every = np.arange(sigma)
        self.base = self._descend(every, np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for (b, vector), zeros in zip(self.levels, self.zeros):
            ones = vector.ones(at)
            at = np.where((symbol >> b) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        start = self.first[symbol] - self.base[symbol]
        return start + both[:len(symbol)], start + both[len(symbol):]


def matching_statistics(index: FMIndex, stream: np.ndarray, ends: np.ndarray,
                        limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(length, lo, hi)`` of the longest match, up to ``limit`` symbols, that
    ends with each symbol ``stream[ends]``."""
    length = np.zeros(len(ends), np.int64)
    lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), int(index.first[-1]), np.int64)
    rows = np.arange(len(ends))
    for k in range(limit):
        place = ends[rows] - k
        rows, place = rows[place >= 0], place[place >= 0]
        rows, place = rows[stream[place] > 0], place[stream[place] > 0]
        if not len(rows):
            break
        a, b = index.extend(stream[place], lo[rows], hi[rows])
        rows, a, b = rows[a < b], a[a < b], b[a < b]
        lo[rows], hi[rows], length[rows] = a, b, k + 1
    return length, lo, hi


def smallest_holder(content: list[bytes], least: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """``(run, window)`` of the windows that a document below the run's own holds."""
    number: dict[bytes, int] = {}
    split = [c.split() for c in content]
    sizes = np.array([len(w) for w in split], np.int64)
    begin = np.cumsum(sizes + 1) - sizes
    sequence = np.zeros(int((sizes + 1).sum()) + 1, np.int64)
    run = np.repeat(np.arange(len(content)), sizes)
    at = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sequence[begin[run] + at] = np.fromiter(
        (number.setdefault(w, len(number) + 1) for words in split for w in words), np.int64, len(run))
    index = FMIndex(sequence, len(number) + 1)
    # the shard's own texts are the stream; only ends of whole windows can reach the threshold
    whole = at >= window - 1
    run, at = run[whole], at[whole]
    length, lo, hi = matching_statistics(index, sequence, begin[run] + at, window)
    owner = np.append(least, np.iinfo(np.int64).max)[np.searchsorted(begin, index.order, "right") - 1]
    keep = length >= window
    run, at, lo, hi = run[keep], at[keep], lo[keep], hi[keep]
    if not len(run):
        return run, at
    # intervals of equal length are equal or disjoint
    start, which = np.unique(lo, return_inverse=True)
    stop = np.zeros(len(start), np.int64)
    stop[which] = hi
    border = np.stack([start, stop], axis=1).ravel()
    smallest = np.minimum.reduceat(np.append(owner, 0), border)[::2]
    below = smallest[which] < least[run]
    return run[below], at[below] - window + 1


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, spans)``; ``spans`` are the
    removed runs of words."""
    grain = Grain(words=True, window=window, gram=min(GRAM, window))
    cover = find_cover(docs, grain, lambda content, least: smallest_holder(content, least, window))

    def cut(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = []
            for text, lists in zip(map(unpack, b.column(1).to_pylist()), b.column(2).to_pylist()):
                words, spans = text.split(), cover_of(lists)
                kept, at = [], 0
                for lo, hi in spans.tolist():
                    kept += words[at:lo]
                    at = hi
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                             [{"start": lo, "end": hi} for lo, hi in spans.tolist()]))
            n, removed, digest, spans = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(spans, kind)], ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return join_cover(docs, cover, cut, ["doc_id"], f"doc_id {kind}, n_words long, n_removed long, "
                      "kept_sha256 string, spans array<struct<start:long,end:long>>")
