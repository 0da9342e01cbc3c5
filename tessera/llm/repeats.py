"""Windows that occur in several documents, brought together for comparison.

Shared by the two operators on repeated text. A text is a sequence of symbols
(bytes or words); a window is ``window`` consecutive symbols. The anchor of a
window is the smallest hash among its ``gram``-symbol grams: equal windows
have equal anchors, and neighbouring windows mostly share theirs, so a text
falls into few runs of windows with one anchor each.

1. :func:`anchor_rows` hashes every text. Per batch of texts, an anchor that one
   document holds is sent once with that document, one that several hold once
   without; the documents of the latter know already that it is shared. The
   bytes of an anchor's distinct runs go along, unless they are few.
2. :func:`shared_anchors` finds the anchors of several documents, one hash
   range at a time, and tells their documents which those are.
3. :func:`run_rows` joins that to the texts, cuts out the runs with a shared
   anchor and sends each to the shard of its anchor. Runs equal, byte for byte,
   to one of a smaller document in the same batch are covered and stay behind. An anchor
   whose runs have more than ``HOT`` bytes is split further: they become single
   windows, dealt to shards by the windows' own hash.
4. The operator compares the runs of a shard by its method
   (:func:`covered_intervals`), and :func:`join_cover` brings the covered
   intervals back to the texts.

All exchanged rows are packed arrays of bounded size, texts compressed. Comparisons go by
``doc_id`` (null counts as larger than all); rows are told apart by a hash of
id and text, so identical rows count as one and rows that merely share an id
do not cover each other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (checkpointed, gram_hash, maybe_broadcast, mix, pack, prefix_hash, small_batches, span_hash,
                                text_slices, with_packed_text, word_spans)
from tessera.llm.common import unpack as unpack_text

PIECE = 64                  # windows in a run at most
ANCHOR_BITS = 48            # of an anchor's hash; a chance hit only costs work
BATCH_ANCHORS = 1 << 20     # anchors gathered before they are sent
BATCH_TEXTS = 60_000
BATCH_BYTES = 8 << 20       # run content gathered before it is sent
PART_BYTES = 24 << 20       # text per hash range of anchors
SHARD_BYTES = 6 << 20       # text per shard (a fraction of it is shared)
HOT = SHARD_BYTES           # of an anchor's runs, summed over batches, beyond which they are split up
FEW_BYTES = 256             # of an anchor's runs in a batch, up to which they count as this
LARGEST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Grain:
    """What a symbol is, and how long windows and grams are."""

    words: bool
    window: int
    gram: int


@dataclass
class Symbols:
    """A slice's symbols: where they begin and end in the bytes, where each
    text's begin, and hashes of the spans between symbols."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray      # offsets of the texts in symbols
    sums: np.ndarray      # prefix sums for span hashes over symbols


def symbols(grain: Grain, data: np.ndarray, off: np.ndarray) -> Symbols:
    if not grain.words:
        at = np.arange(len(data) + 1)
        return Symbols(data, at[:-1], at[1:], off, prefix_hash(data))
    starts, ends, doc = word_spans(data, off)
    hashes = span_hash(prefix_hash(data), starts, ends)
    return Symbols(data, starts, ends, np.searchsorted(doc, np.arange(len(off))), prefix_hash(hashes))


def anchor_runs(grain: Grain, s: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, first window, windows, text)`` of the runs of a slice; a
    window is named by its first symbol."""
    n, span = len(s.begin), grain.window - grain.gram + 1
    none = np.zeros(0, np.int64)
    if n < grain.window:
        return none.astype(np.uint64), none, none, none
    least, have = gram_hash(s.sums, grain.gram), 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
    end = np.repeat(s.text[1:], np.diff(s.text))[:len(least)]     # of a window's text
    inside = np.arange(grain.window, len(least) + grain.window) <= end
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (end[1:] != end[:-1])
    first = np.flatnonzero(new)
    border = np.flatnonzero(new | ~inside)
    stop = np.append(border, len(least))[np.searchsorted(border, first, "right")]
    pieces = -(-(stop - first) // PIECE)
    run = np.repeat(np.arange(len(first)), pieces)
    step = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first[run] + step * PIECE
    anchor = least[start] & np.uint64((1 << ANCHOR_BITS) - 1)
    return anchor, start, np.minimum(stop[run] - start, PIECE), np.searchsorted(s.text, start, "right") - 1


def row_key(docs: DataFrame) -> DataFrame:
    """``(_key, _doc, text)``: identity, place in the order of ids, text."""
    return docs.select(F.xxhash64("doc_id", "text").alias("_key"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LARGEST_ID)).alias("_doc"),
                       F.col("text").cast("string").alias("text"))


def _binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def pack_anchors(anchor: np.ndarray) -> bytes:
    return _binary(anchor.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BITS // 8])


def unpack_anchors(packed: list[bytes]) -> np.ndarray:
    short = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, ANCHOR_BITS // 8)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :ANCHOR_BITS // 8] = short
    return out.view("<u8").ravel().astype(np.uint64)


def distinct_bytes(anchor: np.ndarray, content: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of the distinct runs of each anchor, in order of anchors."""
    order = np.lexsort((content, anchor))
    anchor, content = anchor[order], content[order]
    other = np.append(True, anchor[1:] != anchor[:-1])
    new = other | np.append(True, content[1:] != content[:-1])
    return np.add.reduceat(np.where(new, size[order], 0), np.flatnonzero(other))


def pack_sizes(size: np.ndarray) -> bytes:
    at = np.flatnonzero(size > FEW_BYTES)
    return _binary(np.stack([at, np.minimum(size[at], (1 << 32) - 1)], axis=1).astype(np.uint32))


def unpack_sizes(packed: bytes, count: int) -> np.ndarray:
    out = np.full(count, FEW_BYTES, np.int64)
    at, size = np.frombuffer(packed, np.uint32).reshape(-1, 2).T
    out[at] = size
    return out


def by_bucket(owner: np.ndarray, anchor: np.ndarray, buckets: int):
    """Yield ``(bucket, keys, counts, anchors)``: documents' anchors, packed by
    a hash range of the documents."""
    bucket = owner % buckets
    order = np.lexsort((owner, bucket))
    owner, anchor, bucket = owner[order], anchor[order], bucket[order]
    for k, lo, hi in _groups(bucket):
        keys, count = np.unique(owner[lo:hi], return_counts=True)
        yield k, _binary(keys), _binary(count.astype(np.int32)), pack_anchors(anchor[lo:hi])


def anchor_rows(rows: DataFrame, grain: Grain, parts: int) -> DataFrame:
    """``(part, keys, counts, anchors, owners, sizes)``. ``part`` from 0: the
    anchors of a hash range, each with the place in ``keys``, from 1, of its only
    document, or 0; ``sizes`` are places of anchors and the bytes of their
    distinct runs, where these are more than ``FEW_BYTES``. Below 0: anchors that
    documents of a range share with others of their batch."""
    out = "part long, keys binary, counts binary, anchors binary, owners binary, sizes binary"

    def run(batches):
        held, anchors, texts = [], 0, 0
        for b in batches:
            keys = b.column(0).to_numpy()
            for i, j, data, off in text_slices(b.column(1)):
                s = symbols(grain, data, off)
                a, first, count, doc = anchor_runs(grain, s)
                last = first + count + grain.window - 1
                size = s.end[last - 1] - s.begin[first] if len(a) else first
                held.append((a, keys[i + doc], span_hash(s.sums, first, last), size))
                anchors, texts = anchors + len(a), texts + j - i
                if anchors > BATCH_ANCHORS or texts > BATCH_TEXTS:
                    yield from send(held)
                    held, anchors, texts = [], 0, 0
        yield from send(held)

    def send(held):
        anchor, owner, content, size = (np.concatenate([np.zeros(0, t), *(h[k] for h in held)])
                                        for k, t in enumerate((np.uint64, np.int64, np.uint64, np.int64)))
        if not len(anchor):
            return
        weight = distinct_bytes(anchor, content, size)
        keys, owner = np.unique(owner, return_inverse=True)
        order = np.lexsort((owner, anchor))
        anchor, owner = anchor[order], owner[order]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))
        anchor, owner = anchor[new], owner[new]
        head = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        several = np.diff(np.append(head, len(anchor))) > 1
        known = np.repeat(several, np.diff(np.append(head, len(anchor))))
        table = [(-1 - k, *rest, None, None) for k, *rest in by_bucket(keys[owner[known]], anchor[known], parts)]
        anchor, owner = anchor[head], np.where(several, -1, owner[head])
        part = (anchor % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((owner, part))     # documents together: their places compress well
        anchor, owner, part, weight = anchor[order], owner[order], part[order], weight[order]
        for p, lo, hi in _groups(part):
            own, place = np.unique(owner[lo:hi], return_inverse=True)
            place = place + (own[0] >= 0)     # 0 stands for several
            table.append((p, _binary(keys[own[own >= 0]]), None, pack_anchors(anchor[lo:hi]),
                          _binary(place.astype(np.uint16)), pack_sizes(weight[lo:hi])))
        kinds = (pa.int64(), *[pa.binary()] * 5)
        for at in range(0, len(table), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table[at:at + 4096]), kinds)],
                                             ["part", "keys", "counts", "anchors", "owners", "sizes"])

    return rows.select("_key", "text").mapInArrow(run, out)


def _groups(sorted_values: np.ndarray):
    """``(value, first, last + 1)`` of runs of equal values."""
    if not len(sorted_values):
        return
    head = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    for lo, hi in zip(head.tolist(), np.append(head[1:], len(sorted_values)).tolist()):
        yield int(sorted_values[lo]), lo, hi


def shared_anchors(found: DataFrame, parts: int) -> DataFrame:
    """``(_key, anchors, hot)``: for each document the anchors that others hold
    too; ``hot`` those of them whose runs have very many bytes."""
    layout = "bucket long, keys binary, counts binary, anchors binary"
    names = ["bucket", "keys", "counts", "anchors"]

    def reduce(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part < 0:      # what documents know already
            return table.select(["part", "keys", "counts", "anchors"]).rename_columns(names).set_column(
                0, "bucket", pa.array([-1 - part] * len(table), pa.int64()))
        anchor = unpack_anchors(table.column("anchors").to_pylist())
        owner = np.concatenate([
            np.append(0, np.frombuffer(keys, np.int64))[np.frombuffer(place, np.uint16)]
            for place, keys in zip(table.column("owners").to_pylist(), table.column("keys").to_pylist())])
        weight = np.concatenate([unpack_sizes(sizes, len(place) // 2) for place, sizes in zip(
            table.column("owners").to_pylist(), table.column("sizes").to_pylist())])
        order = np.argsort(anchor, kind="stable")
        anchor, owner, weight = anchor[order], owner[order], weight[order]
        head = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        size = np.diff(np.append(head, len(anchor)))
        told = np.repeat(size > 1, size) & (owner != 0)
        shared = (size > 1) | np.logical_or.reduceat(owner == 0, head)
        hot = shared & (np.add.reduceat(weight, head) > HOT)
        rows = [(None, b"", b"", pack_anchors(anchor[head[hot]])), *by_bucket(owner[told], anchor[told], parts)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))], names=names)

    def entries(table) -> tuple[np.ndarray, np.ndarray]:
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64)
        count = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32)
        return np.repeat(keys, count), unpack_anchors(table.column("anchors").to_pylist())

    def gather(table: pa.Table) -> pa.Table:
        owner, anchor = entries(table)
        order = np.argsort(owner, kind="stable")
        owner, anchor = owner[order], anchor[order]
        rows = [(k, pack_anchors(anchor[lo:hi])) for k, lo, hi in _groups(owner)]
        return pa.table({"_key": pa.array([k for k, _ in rows], pa.int64()),
                         "anchors": pa.array([a for _, a in rows], pa.binary())})

    def single_anchors(batches):
        for b in batches:
            owner, anchor = entries(b)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(anchor.astype(np.int64))], ["_key", "anchor"])

    def hot_anchors(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(unpack_anchors(b.column("anchors").to_pylist()).astype(np.int64))], ["anchor"])

    told = checkpointed(found.groupBy("part").applyInArrow(reduce, layout))
    mine = told.filter(F.col("bucket").isNotNull())
    lists = mine.groupBy("bucket").applyInArrow(gather, "_key long, anchors binary")
    hot = checkpointed(told.filter(F.col("bucket").isNull()).mapInArrow(hot_anchors, "anchor long"))
    if hot.isEmpty():
        return lists.withColumn("hot", F.array().cast("array<long>"))
    own = (mine.mapInArrow(single_anchors, "_key long, anchor long").join(maybe_broadcast(hot), "anchor")
           .groupBy("_key").agg(F.collect_set("anchor").alias("hot")))
    return lists.join(own, "_key", "left")


def run_rows(rows: DataFrame, told: DataFrame, grain: Grain, shards: int) -> DataFrame:
    """``(shard, docs, keys, starts, sizes, content, cover)``: packed runs for
    shards, or (``shard`` below 0) covered intervals of a range of documents."""
    out = "shard long, docs binary, keys binary, starts binary, sizes binary, content binary, cover binary"

    def run(batches):
        parts, size = [], 0
        for b in batches:
            for part in cut(b):
                parts.append(part)
                size += int((part[7] - part[6]).sum())
                if size > BATCH_BYTES:
                    yield from send(parts)
                    parts, size = [], 0
        yield from send(parts)

    def cut(b):
        keys, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
        lists, hots = b.column(3).to_pylist(), b.column(4).to_pylist()
        texts = pa.array([unpack_text(t) for t in b.column(2).to_pylist()], pa.binary())
        for i, j, data, off in text_slices(texts):
            s = symbols(grain, data, off)
            anchor, start, size, doc = anchor_runs(grain, s)
            chosen, single = np.zeros(len(anchor), bool), np.zeros(len(anchor), bool)
            for d, lo, hi in _groups(doc):
                chosen[lo:hi] = np.isin(anchor[lo:hi], unpack_anchors([lists[i + d]]))
                if hots[i + d]:
                    single[lo:hi] = np.isin(anchor[lo:hi], np.array(hots[i + d], np.int64).view(np.uint64))
            single &= chosen
            take = np.flatnonzero(chosen)
            times = np.where(single[take], size[take], 1)
            run_of = np.repeat(take, times)
            first = start[run_of] + np.arange(len(run_of)) - np.repeat(np.cumsum(times) - times, times)
            first = np.where(single[run_of], first, start[run_of])
            count = np.where(single[run_of], 1, size[run_of])
            last = first + count + grain.window - 1
            content = span_hash(s.sums, first, last)
            goes = np.where(single[run_of], content, mix(anchor[run_of]))
            yield (keys[i + doc[run_of]], ids[i + doc[run_of]], first - s.text[doc[run_of]], count,
                   content, goes, s.begin[first], s.end[last - 1], data)

    def send(parts):
        table = emit(parts)
        for at in range(0, len(table), 1024):
            yield pa.RecordBatch.from_pylist(table[at:at + 1024], schema=schema)

    schema = pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in (
        "docs", "keys", "starts", "sizes", "content", "cover"))])

    def emit(parts) -> list[dict]:
        if not sum(len(p[0]) for p in parts):
            return []
        key, doc, first, count, content, goes = (np.concatenate([p[k] for p in parts]) for k in range(6))
        base = np.cumsum([0] + [len(p[8]) for p in parts])
        lo = np.concatenate([p[6] + base[k] for k, p in enumerate(parts)])
        hi = np.concatenate([p[7] + base[k] for k, p in enumerate(parts)])
        data = np.concatenate([p[8] for p in parts])
        order = np.lexsort((doc, content, goes))
        head = np.append(True, (content[order][1:] != content[order][:-1]) | (goes[order][1:] != goes[order][:-1]))
        # equal hashes are no proof: a run counts as a repetition only if its bytes are those of the one before it
        raw, again = data.tobytes(), np.flatnonzero(~head)
        one, two = order[again - 1], order[again]
        head[again] = [raw[a:z] != raw[b:y] for a, z, b, y in zip(
            lo[one].tolist(), hi[one].tolist(), lo[two].tolist(), hi[two].tolist())]
        least = doc[order][np.flatnonzero(head)][np.cumsum(head) - 1]
        behind = order[doc[order] > least]     # equal to a run of a smaller document here
        spans = np.stack([key[behind], first[behind], first[behind] + count[behind] + grain.window - 1], axis=1)
        table = [{"shard": -1 - k, "cover": c} for k, c in spans_by_bucket(spans, shards)]
        ahead = order[doc[order] == least]
        shard = (goes[ahead] % np.uint64(shards)).astype(np.int64)
        ahead, shard = ahead[np.argsort(shard, kind="stable")], np.sort(shard)
        for p, a, z in _groups(shard):
            own = ahead[a:z]
            size = hi[own] - lo[own]
            at = np.repeat(lo[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            table.append({"shard": p, "docs": _binary(doc[own]), "keys": _binary(key[own]),
                          "starts": _binary(first[own]), "sizes": _binary(size.astype(np.int32)),
                          "content": pack(_binary(data[at]))})
        return table

    joined = with_packed_text(rows).join(told, "_key").select("_key", "_doc", "packed", "anchors", "hot")
    return joined.mapInArrow(run, out)


@dataclass
class Runs:
    """The distinct runs of a shard: content, smallest document; and for every
    row sent its run, document, key and first symbol."""

    content: list[bytes]
    least: np.ndarray
    run: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    start: np.ndarray


def unpack_runs(table: pa.Table) -> Runs:
    def array(name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    size = array("sizes", np.int32)
    data = b"".join(unpack_text(c) for c in table.column("content").to_pylist())
    end = np.cumsum(size.astype(np.int64))
    number: dict[bytes, int] = {}
    run = np.fromiter((number.setdefault(data[z - n:z], len(number)) for z, n in zip(end.tolist(), size.tolist())),
                      np.int64, len(size))
    doc = array("docs", np.int64)
    least = np.full(len(number), LARGEST_ID)
    np.minimum.at(least, run, doc)
    return Runs(list(number), least, run, doc, array("keys", np.int64), array("starts", np.int64))


def spans_by_bucket(spans: np.ndarray, buckets: int):
    """Yield ``(bucket, packed)``: rows ``(key, start, end)`` by a hash range of
    the keys, the intervals of a key merged."""
    bucket = spans[:, 0] % buckets
    order = np.lexsort((spans[:, 1], spans[:, 0], bucket))
    spans, bucket = spans[order], bucket[order]
    for k, lo, hi in _groups(bucket):
        yield k, pack(_binary(merge(spans[lo:hi])))


def covered_intervals(runs: DataFrame, grain: Grain, buckets: int, smallest_holder) -> DataFrame:
    """``(_key, cover)``: intervals of symbols covered by windows that a smaller
    document holds. ``smallest_holder(content, least)`` gives, by the operator's
    method, ``(run, window)`` of those windows of the runs which a document
    below the run's own holds."""
    def compare(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard < 0:
            return pa.table({"bucket": pa.array([-1 - shard] * len(table), pa.int64()), "cover": table.column("cover")})
        r = unpack_runs(table)
        run, window = smallest_holder(r.content, r.least)
        # rows behind the run's first document are covered whole, those of it
        # where a smaller document holds the window
        behind = np.flatnonzero(r.doc > r.least[r.run])
        length = np.array([len(c.split()) if grain.words else len(c) for c in r.content], np.int64)
        spans = [np.stack([r.key[behind], r.start[behind], r.start[behind] + length[r.run[behind]]], axis=1)]
        ahead = np.flatnonzero(r.doc == r.least[r.run])
        ahead = ahead[np.argsort(r.run[ahead], kind="stable")]
        lo, hi = (np.searchsorted(r.run[ahead], run, side) for side in ("left", "right"))
        times = hi - lo
        at = ahead[np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        start = r.start[at] + np.repeat(window, times)
        spans.append(np.stack([r.key[at], start, start + grain.window], axis=1))
        rows = list(spans_by_bucket(np.concatenate(spans), buckets))
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int64()),
                         "cover": pa.array([c for _, c in rows], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        spans = np.frombuffer(b"".join(map(unpack_text, table.column("cover").to_pylist())), np.int64).reshape(-1, 3)
        spans = merge(spans[np.lexsort((spans[:, 1], spans[:, 0]))])
        rows = [(k, _binary(spans[lo:hi, 1:])) for k, lo, hi in _groups(spans[:, 0])]
        return pa.table({"_key": pa.array([k for k, _ in rows], pa.int64()),
                         "cover": pa.array([c for _, c in rows], pa.binary())})

    covered = runs.groupBy("shard").applyInArrow(compare, "bucket long, cover binary")
    return covered.groupBy("bucket").applyInArrow(gather, "_key long, cover binary")


def merge(spans: np.ndarray) -> np.ndarray:
    """Union of the intervals of rows ``(key, start, end)`` in order of key and
    start; touching ones join."""
    if not len(spans):
        return spans
    number = np.cumsum(np.append(False, spans[1:, 0] != spans[:-1, 0]))
    far = np.int64(1) << 40       # longer than any text: keys do not reach into each other
    reach = np.maximum.accumulate(spans[:, 2] + number * far)
    head = np.flatnonzero(np.append(True, spans[1:, 1] + number[1:] * far > reach[:-1]))
    last = np.append(head[1:] - 1, len(spans) - 1)
    return np.stack([spans[head, 0], spans[head, 1], reach[last] - number[last] * far], axis=1)


def cover_of(packed: bytes | None) -> np.ndarray:
    """Merged intervals of a document."""
    return np.frombuffer(packed or b"", np.int64).reshape(-1, 2)


def find_cover(docs: DataFrame, grain: Grain, smallest_holder) -> DataFrame:
    """``(_key, cover)`` for the rows of ``docs`` that have something covered."""
    small_batches(docs.sparkSession)
    rows = row_key(docs)
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts, shards = max(8, -(-total // PART_BYTES)), max(8, -(-total // SHARD_BYTES))
    told = shared_anchors(anchor_rows(rows, grain, parts), parts)
    runs = run_rows(rows, told, grain, shards)
    return checkpointed(covered_intervals(runs, grain, shards, smallest_holder))


def join_cover(docs: DataFrame, cover: DataFrame, run, kept: list[str], schema: str) -> DataFrame:
    """Apply ``run`` to batches of ``kept`` columns, ``packed`` text and
    ``cover`` of every row of ``docs``."""
    rows = docs.select(*[F.col(c) for c in kept], F.xxhash64("doc_id", "text").alias("_key"),
                       F.col("text").cast("string").alias("text"))
    return (with_packed_text(rows).join(cover, "_key", "left").select(*kept, "packed", "cover")
            .mapInArrow(run, schema))
