"""Hashed token features of Arrow text columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm.common import LOWER, prefix_hash, span_hash, text_slices

#: 0 space, 1 part of a word (letters, digits, bytes of non-ASCII letters), 2 symbol.
KIND = np.full(256, 2, np.uint8)
KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    KIND[_a:_b] = 1


def tokens(column: pa.Array):
    """Yield ``(first row, last row + 1, hashes, text index, starts, ends,
    bytes, offsets)`` over slices: lower-cased runs of word bytes and runs of
    symbol bytes are the tokens."""
    for i, j, data, off in text_slices(column):
        if not len(data):
            z = np.zeros(0, np.int64)
            yield i, j, z.astype(np.uint64), z, z, z, data, off
            continue
        data = LOWER[data]
        kind = KIND[data]
        change = np.concatenate([[True], kind[1:] != kind[:-1], [True]])
        change[off[off < len(data)]] = True
        marks = np.flatnonzero(change)
        starts, ends = marks[:-1], marks[1:]
        solid = kind[starts] > 0
        starts, ends = starts[solid], ends[solid]
        doc = np.searchsorted(off, starts, "right") - 1
        yield i, j, span_hash(prefix_hash(data), starts, ends), doc, starts, ends, data, off
