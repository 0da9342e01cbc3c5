"""Exact substring dedup over suffix arrays built by induced sorting.

Text shared between documents is brought together in shards
(:mod:`tessera.llm.repeats`); each shard gets a suffix array by induced
sorting: suffixes are classified, the leftmost-smaller (LMS) substrings are
put in order by one induction, named, the string of their names is ordered,
and a second induction yields the array. Both inductions go bucket by bucket
over whole arrays. The reduced string is ordered by rank doubling and not by
a further induction, since its alphabet is too large for one pass per bucket.
Permuted common prefixes (each suffix against its predecessor in the array,
in text order, counted up to the window's length) split the array into classes
of equal windows, of which the smallest document is taken.

``dedup`` removes each byte covered by a 50-byte string that also starts in a
document with a smaller ``doc_id``. Null text is empty; a null ``doc_id`` is
larger than all others; rows with equal ``doc_id`` do not affect each other;
texts under 50 bytes stay whole. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import unpack
from tessera.llm.repeats import Grain, cover_of, find_cover, join_cover

WINDOW = 50
GRAM = 16


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor (type S); the empty
    suffix after the end is the smallest, so the last one is type L."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    step[-1] = -1
    place = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(place[::-1])[::-1]    # next change, for runs of one symbol
    return step[following] > 0


def _append(sa, heads, code, rows, kind, sign):
    """Put those of ``rows`` that have the type ``kind`` (0: L, 1: S) into their buckets,
    in order, from the front (or the back). ``code``: twice the symbol, plus the type."""
    symbol = code.take(rows)
    mine = symbol & 1 == kind
    rows, symbol = rows[mine], symbol[mine] >> 1
    if not len(rows):
        return
    order = np.argsort(symbol, kind="stable")
    count = np.bincount(symbol, minlength=len(heads))
    # of the n-th row in order: the bucket's head and the rows of the bucket before it
    first = heads - sign * (np.cumsum(count) - count)
    sa[np.repeat(first, count) + sign * np.arange(len(rows))] = rows.take(order)
    heads += sign * count


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Suffix array from LMS suffixes in the given order (within buckets)."""
    n, sigma = len(s), len(count)
    code = s.astype(np.uint16 if sigma <= 1 << 15 else np.int64) * 2 + small
    start = np.cumsum(count) - count
    stop = start + count
    sa = np.full(n, -1, np.int64)
    lms_count = np.bincount(s[lms], minlength=sigma)
    order = np.argsort(s[lms], kind="stable")
    by_symbol = lms[order]
    lms_start = np.cumsum(lms_count) - lms_count
    heads = start.copy()
    sa[heads[s[n - 1]]] = n - 1
    heads[s[n - 1]] += 1
    for c in np.flatnonzero(count):
        done = start[c]
        while done < heads[c]:          # waves: what this bucket puts into itself
            upto = heads[c]
            rows = sa[done:upto] - 1
            rows = rows[rows >= 0]
            _append(sa, heads, code, rows, 0, 1)
            done = upto
        rows = by_symbol[lms_start[c]:lms_start[c] + lms_count[c]] - 1
        _append(sa, heads, code, rows, 0, 1)
    tails = stop - 1
    large_stop = heads
    for c in np.flatnonzero(count)[::-1]:
        done = stop[c] - 1
        while done > tails[c]:
            upto = tails[c]
            rows = sa[upto + 1:done + 1][::-1] - 1
            rows = rows[rows >= 0]
            _append(sa, tails, code, rows, 1, -1)
            done = upto
        rows = sa[start[c]:large_stop[c]][::-1] - 1
        rows = rows[rows >= 0]
        _append(sa, tails, code, rows, 1, -1)
    return sa


def rank_order(names: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Order of the suffixes of a string of integers, by rank doubling; only
    groups that are still tied are sorted again. ``order``: places in order of
    names, if known."""
    n = len(names)
    order = np.argsort(names, kind="stable") if order is None else order.copy()
    ordered = names[order]
    head = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    h = 1
    while True:
        tied = ~(head & np.append(head[1:], True))
        place = np.flatnonzero(tied)
        if not len(place):
            return order
        rows = order.take(place)
        second = rank.take(np.minimum(rows + h, n))
        # both ranks as one number: one sort instead of two
        key = rank.take(rows) * (n + 1) + second + 1
        again = np.argsort(key)
        order[place] = rows[again]
        key = key[again]
        new = np.append(True, key[1:] != key[:-1])
        head[place] = new
        rank[order[place]] = place[np.flatnonzero(new)][np.cumsum(new) - 1]
        h *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of a string of small non-negative integers."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    count = np.bincount(s)
    small = suffix_types(s)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms)
    if not len(lms):
        return induce(s, small, lms, count)
    sa = induce(s, small, lms, count)
    ordered = sa[is_lms.take(sa)]                 # LMS substrings in order
    size = np.diff(np.append(lms, n))
    length = np.zeros(n, np.int64)
    length[lms] = size + 1                        # each ends with the next one's first symbol
    name = np.concatenate([[0], np.cumsum(~same_substrings(s, ordered[:-1], ordered[1:], length))])
    number = np.empty(n, np.int64)
    number[ordered] = name
    reduced = number[lms]
    if name[-1] + 1 == len(lms):
        in_order = ordered
    else:
        in_order = lms[rank_order(reduced, (np.cumsum(is_lms) - 1).take(ordered))]
    return induce(s, small, in_order, count)


def same_substrings(s: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the substrings of the given lengths at ``a`` and ``b`` are equal;
    one that runs over the end equals no other."""
    size, other = length.take(a), length.take(b)
    same = (size == other) & (a + size <= len(s)) & (b + size <= len(s))
    rows, k = np.flatnonzero(same), 0
    a, b, size = a[rows], b[rows], size[rows]
    if len(s) and s.max() < 1 << 16:      # four symbols at a time
        four = np.ndarray((len(s),), np.dtype("<u8"), np.append(s, [0, 0, 0]).astype("<u2"), strides=(2,)).copy()
        while len(rows):
            ahead = np.uint64(16) * np.maximum(4 - (size - k), 0).astype(np.uint64)     # bits beyond the end
            equal = (four.take(a + k) ^ four.take(b + k)) << ahead == 0
            same[rows[~equal]] = False
            k += 4
            going = equal & (k < size)
            rows, a, b, size = rows[going], a[going], b[going], size[going]
        return same
    while len(rows):
        equal = s[a + k] == s[b + k]
        same[rows[~equal]] = False
        k += 1
        going = equal & (k < size)
        rows, a, b, size = rows[going], a[going], b[going], size[going]
    return same


def permuted_prefixes(data: np.ndarray, room: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For every suffix, in text order, its common prefix with the suffix before
    it in the array, counted up to ``limit`` (0 for the first) and no farther than
    ``room`` bytes, where its run ends. Eight bytes are compared at a time. Bytes
    outside the runs (``room`` 0) are zero."""
    n = len(sa)
    before = np.zeros(n, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([data, np.zeros(limit + 16, np.uint8)])
    eight = np.ndarray((n + limit + 8,), np.dtype("<u8"), padded, strides=(1,)).copy()
    most = np.minimum(room, limit)
    if ((data == 0) & (room > 0)).any():      # else the end of the other run differs from this one's bytes
        most = np.minimum(most, room.take(before))
    differ = eight[:n] ^ eight.take(before)
    out = np.minimum(most, _equal_bytes(differ)).astype(np.int32)
    rows = np.flatnonzero((differ == 0) & (most > 8))
    other, most = before.take(rows), most.take(rows)
    for k in range(8, limit, 8):
        differ = eight.take(rows + k) ^ eight.take(other + k)
        out[rows] = np.minimum(most, k + _equal_bytes(differ))
        going = (differ == 0) & (most > k + 8)
        rows, other, most = rows[going], other[going], most[going]
    out[sa[:1]] = 0
    return out


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Bytes before the first that differs: the lowest set bit lies in it, 8 if none is set."""
    return np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3


def smallest_holder(content: list[bytes], least: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """``(run, window)`` of the windows that a document below the run's own holds."""
    sizes = np.array([len(c) for c in content], np.int64)
    data = np.frombuffer(b"\0".join(content), np.uint8)
    joined = data.astype(np.uint16) + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    separators = begin[1:] - 1
    joined[separators] = 0
    sa = suffix_array(joined)
    run = np.repeat(np.arange(len(content)), sizes + 1)[:len(joined)]
    at = np.arange(len(joined)) - begin[run]
    prefix = permuted_prefixes(data, sizes[run] - at, sa, window)
    new = (prefix < window).take(sa)
    # a window equals the one before it only if both are whole: others are classes of their own
    rows = np.flatnonzero(~(new & np.append(new[1:], True)))
    if not len(rows):
        return run[:0], at[:0]
    member, new = sa.take(rows), new.take(rows)
    owner = least.take(run.take(member))
    smallest = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    found = member[smallest < owner]
    return run[found], at[found]


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``; ``spans``
    are the removed runs of bytes."""
    grain = Grain(words=False, window=window, gram=min(GRAM, window))
    cover = find_cover(docs, grain, lambda content, least: smallest_holder(content, least, window))

    def cut(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = []
            for text, lists in zip(map(unpack, b.column(1).to_pylist()), b.column(2).to_pylist()):
                spans = cover_of(lists)
                kept, at = hashlib.sha256(), 0
                for lo, hi in spans.tolist():
                    kept.update(text[at:lo])
                    at = hi
                kept.update(text[at:])
                rows.append((len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(),
                             [{"start": lo, "end": hi} for lo, hi in spans.tolist()]))
            n, removed, count, digest, spans = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(spans, kind)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return join_cover(docs, cover, cut, ["doc_id"], f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, "
                      "kept_sha256 string, spans array<struct<start:long,end:long>>")
