"""Helpers shared by the operators: tables, checkpoints, and vectorised
access to the text of Arrow batches inside Python tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

#: The words of every operator here are the runs of bytes outside this set.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python task expands into arrays at once. A longer
#: text is still processed whole, alone in its slice.
SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB, so that a Python worker's memory does
    not depend on how long the texts of a batch are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and go on from
    there: a lost executor costs a reread, not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Rows of a table of a few short columns that may go to every task.
BROADCAST_ROWS = 500_000


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already written, a few short columns) for broadcast if it has at
    most ``limit`` rows; a larger one is joined by shuffling."""
    return F.broadcast(df) if df.count() <= limit else df


def pack(text: bytes) -> bytes:
    """Compressed text behind its length; texts cross the network packed."""
    return len(text).to_bytes(8, "little") + pa.Codec("zstd").compress(text, asbytes=True)


def unpack(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


def with_packed_text(rows: DataFrame) -> DataFrame:
    """``rows`` with ``packed`` (null text: the empty text) in place of their
    last column, a text."""
    def run(batches):
        for b in batches:
            texts = b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()
            packed = pa.array([pack(t or b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed], [*b.schema.names[:-1], "packed"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("packed", T.BinaryType())]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)
    return raw, off


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield ``(first row, last row + 1, bytes, offsets)`` over slices of whole
    texts of about ``limit`` bytes; offsets start at 0."""
    raw, off = text_buffers(column)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text index)`` of the words of concatenated texts;
    no word crosses a text's border."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = off[:-1][np.diff(off) > 0]
    first[edge] = solid[edge]
    edge = off[1:][np.diff(off) > 0] - 1
    last[edge] = solid[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


class _Cache(dict):
    """Travels empty when a task's code is pickled."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def powers(n: int, inverse: bool = False) -> np.ndarray:
    key = "inverse" if inverse else "power"
    have = _powers.get(key)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), _P_INV if inverse else _P, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 8 * SLICE_BYTES:
            _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)     # the first line made a new array
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums mod 2^64, from which any span's hash follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span ``[start, end)``."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts])


def gram_hash(sums: np.ndarray, gram: int) -> np.ndarray:
    """:func:`span_hash` of every span of ``gram`` symbols."""
    return mix((sums[gram:] - sums[:-gram]) * powers(len(sums), inverse=True)[:len(sums) - gram])


def words_of(column: pa.Array, lower: bool = False):
    """Yield ``(first row, last row + 1, word hashes, text index, starts,
    ends, bytes, offsets)`` over slices of a text column."""
    for i, j, data, off in text_slices(column):
        if lower:
            data = LOWER[data]
        starts, ends, doc = word_spans(data, off)
        yield i, j, span_hash(prefix_hash(data), starts, ends), doc, starts, ends, data, off
