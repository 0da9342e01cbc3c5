"""SimHash near-duplicates over an inverted index of fingerprint bytes.

A 64-bit fingerprint is eight bytes at fixed positions. Two fingerprints that
differ in at most ``max_bits`` (3) bits agree in at least five positions, the
guaranteed minimum. The postings of single bytes would hold 1/256 of the
corpus each, so the index is keyed by four positions and their bytes
together: the 14 position sets whose indices xor to zero, of which every five
positions contain one. Within a posting the shared positional bytes of each
pair are tallied, pairs that reach the minimum are kept and their bit distance
is verified.

Equal fingerprints are collapsed before anything is paired. A long posting
is cut into blocks whose pairs of blocks are separate pieces of work, and each
piece returns only a spanning forest of its links, so that a group of many
near copies costs no more rows than it has members. Components then follow by
star contraction.

Words are lower-cased (A-Z) runs of non-space bytes; texts of fewer than
three words have one shingle, the whole sequence; no word, empty or null text:
fingerprint zero, which links like any other. Null ``doc_id`` never names a
component unless all its members are null. Repeated rows get equal results.
An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import checkpointed, small_batches, text_slices
from tessera.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MIN_SHARED = 5             # byte positions that fingerprints within 3 bits share at least
BLOCK = 1024               # fingerprints of a posting in one block
POSITION_SETS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def fingerprints(texts: pa.Array, width: int = SHINGLE) -> np.ndarray:
    """SimHash of every text, as signed 64-bit integers."""
    out = np.zeros(len(texts), np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    for i, j, data, off in text_slices(texts):
        hashes, counts = [], np.zeros(j - i, np.int64)
        raw = data.tobytes().lower()
        for r in range(j - i):
            words = raw[off[r]:off[r + 1]].split()
            if not words:
                continue
            if len(words) <= width:
                shingles = [joined(words)]
            else:
                shingles = list(map(joined, zip(*(words[k:] for k in range(width)))))
            counts[r] = len(shingles)
            hashes.append(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles)))
        if not hashes:
            continue
        some = np.flatnonzero(counts)
        every = np.concatenate(hashes)
        starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        votes = np.zeros((len(some), 64), np.int64)
        at = 0
        while at < len(every):   # bits of at most 65,536 shingles at once
            upto = min(len(every), at + 65536)
            bits = np.unpackbits(every[at:upto].astype(">u8").view(np.uint8)).reshape(-1, 64)
            first = int(np.searchsorted(starts, at, "right")) - 1
            last = int(np.searchsorted(starts, upto, "left"))
            cut = np.maximum(starts[first:last], at) - at
            votes[first:last] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
            at = upto
        majority = votes * 2 > counts[some][:, None]
        out[i + some] = np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)
    return out.view(np.int64)


def add_fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``fingerprint`` (a signed integer) in place of ``text``."""
    small_batches(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        for b in batches:
            prints = pa.array(fingerprints(b.column("text")))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), prints],
                                             [*(f.name for f in kept), "fingerprint"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.withColumn("text", F.col("text").cast("string")).mapInArrow(run, f"{fields}, fingerprint long")


def postings(prints: DataFrame) -> DataFrame:
    """``(posting, fingerprint, piece)``: the index entries of postings with at
    least two fingerprints, long ones cut into pieces of pairs of blocks."""
    def key(n: int, positions) -> Column:
        out = F.lit(n).cast("long")
        for p in positions:
            out = F.shiftleft(out, 8).bitwiseOR(
                F.shiftrightunsigned("fingerprint", 8 * p).bitwiseAND(F.lit(255).cast("long")))
        return out

    entries = prints.select("fingerprint", F.explode(F.array(
        *[key(n, s) for n, s in enumerate(POSITION_SETS)])).alias("posting"))
    size = F.count(F.lit(1)).over(Window.partitionBy("posting"))
    entries = entries.withColumn("_n", size).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(BLOCK))
    own = F.pmod(F.xxhash64("fingerprint"), blocks)
    cells = F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1),
                    lambda other: F.least(own, other) * blocks + F.greatest(own, other)))
    return entries.select("posting", "fingerprint", F.explode(cells).alias("piece"))


def close_pairs(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter over shared positional bytes, then the bit distance."""
    other = (x ^ y).view(np.uint8).reshape(-1, 8)
    ok = (other == 0).sum(axis=1) >= MIN_SHARED
    ok[ok] = _POPCOUNT[other[ok]].sum(axis=1) <= max_bits
    return ok


def forest(groups: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(fingerprint, smaller fingerprint)`` that connect what is linked
    within each run of equal ``groups``, at most one per row."""
    n = len(prints)
    border = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    size = np.diff(np.concatenate([border, [n]]))
    end = np.repeat(border + size, size)
    left, right, rows, step = [], [], np.arange(n), 1
    while len(rows := rows[rows + step < end[rows]]):
        near = close_pairs(prints[rows], prints[rows + step], max_bits)
        left.append(rows[near])
        right.append(rows[near] + step)
        step += 1
    if not left:
        return prints[:0], prints[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return prints[moved], prints[label[moved]]


def link_forest(entries: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links between fingerprints, enough to connect all linked ones."""
    def run(batches):
        held = None
        for b in batches:
            now = np.stack([b.column(k).to_numpy() for k in range(3)])
            held = now if held is None else np.concatenate([held, now], axis=1)
            new = (held[0, 1:] != held[0, :-1]) | (held[1, 1:] != held[1, :-1])
            if not new.any():
                continue
            cut = int(np.flatnonzero(new)[-1]) + 1
            yield links(held[:, :cut])
            held = held[:, cut:]
        if held is not None and held.shape[1]:
            yield links(held)

    def links(part):
        group = np.cumsum(np.concatenate([[0], (part[0, 1:] != part[0, :-1]) | (part[1, 1:] != part[1, :-1])]))
        a, b = forest(group, np.ascontiguousarray(part[2]), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    ordered = (entries.select("posting", "piece", "fingerprint").repartition("posting", "piece")
               .sortWithinPartitions("posting", "piece", "fingerprint"))
    return ordered.mapInArrow(run, "a long, b long")


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fingerprint, component_id, _root)`` of every distinct fingerprint of
    ``(doc_id, fingerprint)`` rows."""
    distinct = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("_least")))
    roots = connected_components(link_forest(postings(distinct), max_bits))
    member = checkpointed(distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root")))
    least = member.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return checkpointed(member.join(least, "_root").select("fingerprint", "component_id", "_root"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``; the fingerprint in hex."""
    prints = checkpointed(add_fingerprints(docs.select("doc_id", "text")))
    members = fingerprint_components(prints, max_bits)
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return prints.join(members, "fingerprint").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates: that with the
    smallest ``doc_id`` (of several with it, one text by hash order)."""
    keys = [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("_k2")]
    prints = checkpointed(add_fingerprints(docs.select("doc_id", *keys, "text")))
    members = fingerprint_components(prints, max_bits)
    kept = (prints.join(members, "fingerprint").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("_root").agg(F.min(F.struct("_k1", "_k2")).alias("_k")).select("_k.*"))
    # the whole row as one column: no name of it can clash with those used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keys)
    return rows.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]).select("_row.*")
