"""Alignment of two tokenizers' tokens over the same bytes.

A text with a space before it is encoded by a byte-level BPE (A); the text
without it by a piece model with byte fallback (B), which adds the space. Byte
offsets where tokens of both end cut the tokens into groups, and every A token
of a group is linked to every B token of it.

*Identity map.* An array from A's ids to the B ids of the same bytes, made once
from the vocabularies, decides most groups: one A token and one B token that is
its image. Such groups are counted in a vector as long as A's vocabulary. Only
the pairs of other, irregular groups are shuffled, each batch of texts sending
every distinct pair once to the pair's hash range, with the number of its
documents, and getting the pair's corpus-wide count back.

*Pieces of text.* Neither tokenizer joins what stands before and behind a single
space between two letters, digits or symbols. A text is cut there, and since the
pieces repeat, each distinct piece of a batch is encoded and aligned once; a
document's results are sums over its pieces, its groups the groups of its pieces
in order. (B's vocabulary is checked for tokens that would reach over a space;
with such a vocabulary texts are not cut.)

1. :func:`encode_batches` reads the texts and writes, per batch, its documents
   and pieces, its irregular pairs, and per task the vector.
2. Vectors and pairs are added up. The highest count of each A id is a vector,
   too: these two, bounded by the vocabulary, go to every task.
3. Every batch meets the counts of its pairs and yields its documents' sums.

Texts that are null or empty, or whose joined A or B bytes differ from the text
(such as U+2581, which B reads as a space), have no tokens: zeros and an empty
digest. Special tokens' strings are plain text. Every row of the table counts
as a document, repeated rows and null ids included. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import importlib.util
import os
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, mix, pack, small_batches, text_buffers, unpack

BATCH_BYTES = 4 << 20       # of text whose pieces are encoded together
BATCH_ROWS = 1 << 16
SEGMENT_BYTES = 4096        # of pieces given to a tokenizer in one string
PART_BYTES = 256 << 20      # of text for each hash range of pairs
BLOCK = 1 << 20             # links, or pairs of documents, expanded at once


def tokenizer_path(name: str) -> str:
    """A file of the installed public vocabularies."""
    return os.path.join(os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), name)


@dataclass
class Vocabulary:
    """Bytes of every token of A and B, and A's image in B (-1: none)."""

    a: list[bytes]
    b: list[bytes]
    identity: np.ndarray
    cuttable: bool


class Tokenizers:
    """Both tokenizers, opened from their files; one of these lives in each
    Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.vocabulary = v = self._vocabulary()
        # an A id inside and at the end of a group's A tokens, a B id likewise
        self.written = pa.array([f"{i}{x}" for n, ends in ((len(v.a), ",|"), (len(v.b), ",;")) for x in ends for i in range(n)],
                                pa.large_string())

    def _vocabulary(self) -> Vocabulary:
        byte_of = {c: k for k, c in enumerate(byte_characters())}
        size = max(self.a.get_vocab(True).values()) + 1
        a = [b""] * size
        for token, i in self.a.get_vocab(True).items():
            known = all(c in byte_of for c in token)
            a[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                b.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                b.append(b"")
            else:
                b.append(piece.replace("▁", " ").encode())
        image: dict[bytes, int] = {}
        for i in sorted(range(len(b)), key=lambda i: (self.b.is_byte(i), i)):    # whole pieces before bytes
            if b[i]:
                image.setdefault(b[i], i)
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        identity = np.array([-1 if i in special else image.get(x, -1) for i, x in enumerate(a)], np.int64)
        return Vocabulary(a, b, identity, not any(" " in x.lstrip(b" ").decode(errors="replace") for x in b))

    def encode(self, segments: list[bytes]) -> list[tuple[list[int], list[int]]]:
        """``(A ids, B ids)`` of texts that begin with a space."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        ids = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        return list(zip(ids, self.b.encode([t[1:] for t in texts], num_threads=1)))


def byte_characters() -> str:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the others from U+0100 on, in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = (k for k in range(256) if k not in plain)
    place = {k: 256 + n for n, k in enumerate(other)}
    return "".join(chr(place.get(k, k)) for k in range(256))


def opened(paths: tuple[str, str]) -> Tokenizers:
    """The tokenizers of a Python worker, opened by its first task. This module
    travels with each task anew, so they are kept beside it."""
    kept = sys.__dict__.setdefault("_tessera_tokenizers", {})
    if paths not in kept:
        kept[paths] = Tokenizers(*paths)
    return kept[paths]


# ---------------------------------------------------------------- pieces

#: Bytes beside which a space may be cut: visible ASCII, and lead bytes of two-byte
#: characters from U+00C0 on but U+0300 to U+037F, none of which is a space.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xCC] = True
_LEAD[0xCE:0xE0] = True


def with_spaces(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of the texts, each with a space before it."""
    raw, off = raw[off[0]:off[-1]], off - off[0]
    wide = off + np.arange(len(off))
    out = np.full(int(wide[-1]), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[wide[:-1]] = False
    out[inside] = raw
    return out, wide


def safe_before(data: np.ndarray) -> np.ndarray:
    """Whether the character that ends with each byte may stand before a cut."""
    out = _VISIBLE[data].copy()
    out[1:] |= ((data[1:] & 0xC0) == 0x80) & _LEAD[data[:-1]]
    return out


def piece_borders(data: np.ndarray, off: np.ndarray, cuttable: bool) -> np.ndarray:
    """Where pieces begin: at each text's space and at every space to cut at."""
    begin = np.zeros(len(data), bool)
    begin[off[:-1][np.diff(off) > 0]] = True
    if cuttable and len(data) > 2:
        cut = (data[1:-1] == 0x20) & safe_before(data)[:-2] & (_VISIBLE | _LEAD)[data[2:]]
        begin[1:-1] |= cut
    return np.flatnonzero(begin)


@dataclass
class Pieces:
    """Distinct pieces, aligned. ``ok``: whether both token strings spell the
    piece. Pairs: of regular groups (A ids) and of irregular ones (place in
    ``keys``, ascending), each row with its piece and number of links."""

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    text: pa.Array              # the groups in writing, each with ";" behind it
    regular: np.ndarray         # rows (piece, A id, links)
    irregular: np.ndarray       # rows (piece, place in keys, links)
    keys: np.ndarray            # A id * B's size + B id


def spelled(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join([table[i] for i in ids])


def encode_pieces(tokenizers: Tokenizers, data: bytes, start: np.ndarray, stop: np.ndarray):
    """Tokens of the pieces ``data[start:stop]``, which lie behind each other:
    ``(ok, A ids, their ends, B ids, their ends)``. Pieces that may be joined are
    given to the tokenizers in segments; a segment that is not spelled by its
    tokens, or in which tokens reach over a piece's end, is done piece by piece."""
    v = tokenizers.vocabulary
    size_a, size_b = (np.array([len(x) for x in t], np.int64) for t in (v.a, v.b))
    raw = np.frombuffer(data, np.uint8)
    whole = safe_before(raw)[stop - 1] if len(raw) else np.zeros(0, bool)
    first = raw[np.minimum(start + 1, len(raw) - 1)] if len(raw) else raw
    whole = whole & (_VISIBLE | _LEAD)[first] & (stop - start > 1) & v.cuttable
    alone = ~whole
    group = np.cumsum(np.concatenate([[True], alone[1:] | alone[:-1] | (
        stop[1:] // SEGMENT_BYTES != stop[:-1] // SEGMENT_BYTES)])) - 1 if len(start) else start
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(start) else start
    todo = list(zip(head.tolist(), np.append(head[1:], len(start)).tolist()))
    ok = np.ones(len(start), bool)
    out = ([], [], [], [])
    while todo:
        again = []
        for (lo, hi), (a, b) in zip(todo, tokenizers.encode([data[start[lo]:stop[hi - 1]] for lo, hi in todo])):
            text = data[start[lo]:stop[hi - 1]]
            good = spelled(v.a, a) == text and spelled(v.b, b) == text
            if good:
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                end_a, end_b = start[lo] + np.cumsum(size_a[a]), start[lo] + np.cumsum(size_b[b])
                good = hi == lo + 1 or (np.isin(stop[lo:hi], end_a).all() and np.isin(stop[lo:hi], end_b).all())
            if good:
                for x, y in zip(out, (a, end_a, b, end_b)):
                    x.append((lo, y))
            elif hi == lo + 1:
                ok[lo] = False
            else:
                again += [(k, k + 1) for k in range(lo, hi)]
        todo = again
    parts = [np.concatenate([np.zeros(0, np.int64), *(y for _, y in sorted(x, key=lambda r: r[0]))]) for x in out]
    return ok, *parts


def align_pieces(tokenizers: Tokenizers, data: bytes, start: np.ndarray, stop: np.ndarray) -> Pieces:
    """Groups and links of pieces that lie behind each other in ``data``."""
    v = tokenizers.vocabulary
    n, width = len(start), len(v.b)
    ok, a, end_a, b, end_b = encode_pieces(tokenizers, data, start, stop)
    ends = np.intersect1d(end_a, end_b)       # a group ends where tokens of both do
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    p, q = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    of = np.searchsorted(stop, ends)          # the group's piece
    head_a, head_b = np.cumsum(p) - p, np.cumsum(q) - q
    one = (p == 1) & (q == 1)
    one[one] = v.identity[a[head_a[one]]] == b[head_b[one]]
    regular = unique_rows(of[one], a[head_a[one]], np.ones(int(one.sum()), np.int64), len(v.a))

    rest = np.flatnonzero(~one)
    found = [np.zeros((0, 3), np.int64)]
    links = p[rest] * q[rest]
    for lo, hi in blocks(links, BLOCK):
        g, many = rest[lo:hi], links[lo:hi]
        if hi == lo + 1 and many[0] > BLOCK:      # one very long group: by distinct tokens
            x, times_x = np.unique(a[head_a[g[0]]:head_a[g[0]] + p[g[0]]], return_counts=True)
            y, times_y = np.unique(b[head_b[g[0]]:head_b[g[0]] + q[g[0]]], return_counts=True)
            for k in range(0, len(x), max(1, BLOCK // len(y))):
                z = slice(k, k + max(1, BLOCK // len(y)))
                key = (x[z, None] * width + y[None, :]).ravel()
                found.append(np.stack([np.full(len(key), of[g[0]]), key, np.outer(times_x[z], times_y).ravel()], axis=1))
            continue
        group = np.repeat(g, many)
        step = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
        key = a[head_a[group] + step // q[group]] * width + b[head_b[group] + step % q[group]]
        found.append(unique_rows(of[group], key, np.ones(len(key), np.int64), len(v.a) * width))
    irregular = np.concatenate(found)
    irregular = unique_rows(irregular[:, 0], irregular[:, 1], irregular[:, 2], len(v.a) * width)
    keys, place = np.unique(irregular[:, 1], return_inverse=True)
    irregular[:, 1] = place

    def per_piece(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, of, values)
        return out

    return Pieces(ok, per_piece(p), per_piece(q), per_piece(np.ones(len(ends), np.int64)), per_piece(p * q),
                  written_groups(tokenizers, a, group_a, b, group_b, p, q, of, n), regular, irregular, keys)


def blocks(size: np.ndarray, limit: int):
    """``(first, last + 1)`` of runs of at most ``limit`` in all, or of one."""
    total, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + limit, "right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def unique_rows(x: np.ndarray, y: np.ndarray, times: np.ndarray, width: int) -> np.ndarray:
    """Rows ``(x, y, sum of times)`` in order of ``x`` and ``y < width``."""
    code = x * width + y
    if not len(code):
        return np.zeros((0, 3), np.int64)
    order = np.argsort(code, kind="stable")
    code = code[order]
    head = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return np.stack([code[head] // width, code[head] % width, np.add.reduceat(times[order], head)], axis=1)


def written_groups(tokenizers: Tokenizers, a, group_a, b, group_b, p, q, of, n: int) -> pa.Array:
    """Per piece ``a1,a2|b1;a3|b2,b3;``: the decimal ids of its groups."""
    v = tokenizers.vocabulary
    last_a, last_b = np.cumsum(p) - 1, np.cumsum(q) - 1
    code = np.empty(len(a) + len(b), np.int64)
    is_last = np.zeros(len(a), bool)
    is_last[last_a] = True
    before_b = np.cumsum(q) - q
    code[np.arange(len(a)) + before_b[group_a]] = a + np.where(is_last, len(v.a), 0)
    is_last = np.zeros(len(b), bool)
    is_last[last_b] = True
    after_a = np.cumsum(p)
    code[np.arange(len(b)) + after_a[group_b]] = 2 * len(v.a) + b + np.where(is_last, len(v.b), 0)
    text = tokenizers.written.take(pa.array(code))
    data, off = text_buffers(text)
    tokens = np.zeros(n, np.int64)
    np.add.at(tokens, of, p + q)
    stop = np.concatenate([[0], np.cumsum(tokens)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(off[stop]), pa.py_buffer(data)])


# ---------------------------------------------------------------- batches

@dataclass
class Batch:
    """What a batch of documents knows before counts come back."""

    documents: pa.RecordBatch           # results per document, without the counts
    used: np.ndarray                    # rows (document, piece, times)
    pieces: Pieces


def align_batch(tokenizers: Tokenizers, ids: pa.Array, texts: pa.Array) -> Batch:
    """Encode and align a batch's distinct pieces; sums of its documents."""
    raw, off = text_buffers(texts)
    data, off = with_spaces(raw, off)
    full = np.diff(off) > 1                     # neither null nor empty
    begin = piece_borders(data, off, tokenizers.vocabulary.cuttable)
    doc = np.searchsorted(off, begin, "right") - 1
    end = np.append(begin[1:], len(data))
    keep = full[doc]
    kind = pa.int32() if len(data) < 1 << 31 else pa.int64()
    make = pa.BinaryArray if kind == pa.int32() else pa.LargeBinaryArray
    border = pa.array(np.append(begin, len(data)), kind).buffers()[1]
    every = make.from_buffers(pa.binary() if kind == pa.int32() else pa.large_binary(), len(begin),
                              [None, border, pa.py_buffer(np.ascontiguousarray(data))])
    coded = every.filter(pa.array(keep)).dictionary_encode()
    doc, code = doc[keep], coded.indices.to_numpy().astype(np.int64)
    flat, at = text_buffers(coded.dictionary)
    flat = flat[at[0]:at[-1]].tobytes() if len(at) else b""
    at = at - at[0]
    pieces = align_pieces(tokenizers, flat, at[:-1], at[1:])
    n = len(full)
    good = full.copy()
    good[doc[~pieces.ok[code]]] = False
    doc, code = doc[good[doc]], code[good[doc]]
    sums = []
    for values in (pieces.n_a, pieces.n_b, pieces.n_groups, pieces.n_links):
        out = np.zeros(n, np.int64)
        np.add.at(out, doc, values[code])
        sums.append(pa.array(out))
    digests = np.full(n, "", object)
    length = np.diff(text_buffers(pieces.text)[1])
    for lo, hi in blocks(length[code], 4 * BLOCK):      # whole documents, or a part of a long one
        part, own = pieces.text.take(pa.array(code[lo:hi])), doc[lo:hi]
        text, stop = text_buffers(part)
        head = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for d, x, y in zip(own[head].tolist(), stop[head].tolist(), stop[np.append(head[1:], len(own))].tolist()):
            h = digests[d] or hashlib.sha256()
            if digests[d] != "":
                h.update(b";")
            h.update(text[x:y - 1].data)
            digests[d] = h
    digests = [h.hexdigest() if h != "" else "" for h in digests]
    documents = pa.RecordBatch.from_arrays(
        [ids, *sums, pa.array(digests, pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    used = unique_rows(doc, code, np.ones(len(doc), np.int64), max(len(pieces.ok), 1))
    return Batch(documents, used, pieces)


def csr(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each first value's rows begin."""
    return np.searchsorted(rows[:, 0], np.arange(n + 1))


def expand(used: np.ndarray, rows: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(document, second value)`` of the rows of every used piece."""
    lo, hi = begin[used[:, 1]], begin[used[:, 1] + 1]
    times = hi - lo
    at = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())
    return np.repeat(used[:, 0], times), rows[at, 1]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted without repeats (faster here than by hashing)."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def count_documents(batch: Batch, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """``(vector over A's ids, counts of the batch's keys)``: how many documents
    hold each identity pair in a regular group, and each irregular pair, identity
    pairs without the documents that the vector has counted."""
    p, width = batch.pieces, len(vocabulary.b)
    vector, counts = np.zeros(len(vocabulary.a), np.int64), np.zeros(len(p.keys), np.int64)
    regular, irregular = csr(p.regular, len(p.ok)), csr(p.irregular, len(p.ok))
    own = p.keys // width
    image = vocabulary.identity[own] == p.keys % width
    head = np.flatnonzero(np.append(True, batch.used[1:, 0] != batch.used[:-1, 0])) if len(batch.used) else []
    size = np.diff(np.append(head, len(batch.used))).astype(np.int64)
    for x, y in blocks(size, BLOCK // 4):        # whole documents
        used = batch.used[head[x]:head[y] if y < len(head) else len(batch.used)]
        doc, a = expand(used, p.regular, regular)
        held = distinct(doc * len(vector) + a)
        vector += np.bincount(held % len(vector), minlength=len(vector))
        doc, place = expand(used, p.irregular, irregular)
        pair = distinct(doc * max(len(counts), 1) + place)
        doc, place = pair // max(len(counts), 1), pair % max(len(counts), 1)
        twice = image[place]
        twice[twice] = np.isin(doc[twice] * len(vector) + own[place[twice]], held)
        counts += np.bincount(place[~twice], minlength=len(counts))
    return vector, counts


def to_bytes(*columns: np.ndarray) -> bytes:
    """Arrays of integers, packed together."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([(str(k), pa.from_numpy_dtype(c.dtype)) for k, c in enumerate(columns)])) as w:
        w.write_batch(pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                                 [str(k) for k in range(len(columns))]))
    return pack(sink.getvalue().to_pybytes())


def from_bytes(packed: bytes) -> list[np.ndarray]:
    table = pa.ipc.open_stream(unpack(packed)).read_all().combine_chunks()
    return [table.column(k).to_numpy() for k in range(table.num_columns)]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def row(kind: int, batch: int, **bodies: bytes) -> dict:
    return dict.fromkeys(("body", "pieces", "pairs", "used", "keys")) | {"kind": kind, "batch": batch} | bodies


#: Rows of :func:`encode_batches`. ``kind`` -1: a batch (documents, links of its
#: pieces, pieces of its documents, A ids of its pairs); -2: a task's vector; from 0
#: on: the batch's pairs of a hash range (``keys``) and their documents (``body``).
_LAYOUT = "kind long, batch long, body binary, pieces binary, pairs binary, used binary, keys binary"
_SCHEMA = pa.schema([("kind", pa.int64()), ("batch", pa.int64()),
                     *((c, pa.binary()) for c in ("body", "pieces", "pairs", "used", "keys"))])


def batch_rows(batch: Batch, number: int, vocabulary: Vocabulary, parts: int) -> tuple[np.ndarray, list[dict]]:
    """The task's vector for the batch, and the rows that the batch sends."""
    vector, counts = count_documents(batch, vocabulary)
    p = batch.pieces
    part = part_of(p.keys, parts)
    order = np.argsort(part, kind="stable")
    keys, counts, part = p.keys[order], counts[order], part[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))          # pairs in the order in which counts come back
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.documents.schema) as w:
        w.write_batch(batch.documents)
    of, pair, links = p.irregular.T
    rows = [row(-1, number, body=pack(sink.getvalue().to_pybytes()), pieces=to_bytes(*p.regular.T),
                pairs=to_bytes(of, place[pair], links), used=to_bytes(*batch.used.T), keys=to_bytes(keys // len(vocabulary.b)))]
    head = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
    for lo, hi in zip(head.tolist(), np.append(head[1:], len(part)).tolist()):
        rows.append(row(int(part[lo]), number, keys=to_bytes(keys[lo:hi]), body=to_bytes(counts[lo:hi])))
    return vector, rows


def encode_batches(docs: DataFrame, paths: tuple[str, str], parts: int) -> DataFrame:
    """Rows of ``_LAYOUT`` for every batch of texts."""
    def run(batches):
        tokenizers = opened(paths)
        number = TaskContext.get().partitionId() << 32
        total = np.zeros(len(tokenizers.vocabulary.a), np.int64)
        held, size, rows = [], 0, 0

        def close():
            nonlocal number
            table = pa.Table.from_batches(held).combine_chunks()
            vector, out = batch_rows(align_batch(tokenizers, table.column(0).combine_chunks(), table.column(1).combine_chunks()),
                                     number, tokenizers.vocabulary, parts)
            number += 1
            total[:] += vector
            return pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

        for b in batches:
            for piece in split(b):
                held.append(piece)
                size, rows = size + piece.column(1).nbytes, rows + len(piece)
                if size > BATCH_BYTES or rows > BATCH_ROWS:
                    yield close()
                    held, size, rows = [], 0, 0
        if held:
            yield close()
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_pylist([row(-2, number, body=to_bytes(at, total[at]))], schema=_SCHEMA)

    def split(b):
        """Parts of an Arrow batch of about a batch's bytes."""
        _, off = text_buffers(b.column(1))
        lo = 0
        while lo < len(b):
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BATCH_BYTES, "right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _LAYOUT)


def vector_sums(rows: DataFrame, size: int) -> np.ndarray:
    """Corpus-wide vector of the regular groups (as long as A's vocabulary)."""
    def run(batches):
        for b in batches:
            for body in b.column(0).to_pylist():
                at, n = from_bytes(body)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n)], ["a", "n"])

    out = np.zeros(size, np.int64)
    sums = rows.filter("kind = -2").select("body").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        out[r.a] = r.n
    return out


def pair_sums(rows: DataFrame, vector: np.ndarray, vocabulary_size: int, identity: np.ndarray) -> DataFrame:
    """``(batch, kind, body)``: the counts of the pairs that each batch has sent to
    a hash range, in its order; with null ``batch`` the range's highest count of
    each A id and the counts of its identity pairs."""
    shared = rows.sparkSession.sparkContext.broadcast((vector, identity))   # as long as A's vocabulary

    def add(table: pa.Table) -> pa.Table:
        vector, identity = shared.value
        sent = [from_bytes(x)[0] for x in table.column("keys").to_pylist()]
        keys, place = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([from_bytes(x)[0] for x in table.column("body").to_pylist()]),
                            minlength=len(keys)).astype(np.int64)      # exact below 2^53 documents
        a = keys // vocabulary_size
        image = identity[a] == keys % vocabulary_size
        total[image] += vector[a[image]]
        stop = np.cumsum([0, *map(len, sent)])
        replies = [to_bytes(total[place[x:y]]) for x, y in zip(stop[:-1], stop[1:])]
        head = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        best = to_bytes(a[head], np.maximum.reduceat(total, head), np.add.reduceat(np.where(image, total, 0), head))
        return pa.table({"batch": pa.array([*table.column("batch").to_pylist(), None], pa.int64()),
                         "kind": pa.array([*table.column("kind").to_pylist(), None], pa.int64()),
                         "body": pa.array([*replies, best], pa.binary())})

    pairs = rows.filter("kind >= 0").select("kind", "batch", "keys", "body")
    return checkpointed(pairs.groupBy("kind").applyInArrow(add, "batch long, kind long, body binary"))


def highest_counts(replies: DataFrame, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(highest count, identity pair's count)`` of every A id."""
    def run(batches):
        for b in batches:
            for body in b.column(0).to_pylist():
                a, most, same = from_bytes(body)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(most), pa.array(same)], ["a", "most", "same"])

    most, same = vector.copy(), vector.copy()
    rows = replies.filter(F.col("batch").isNull()).select("body").mapInArrow(run, "a long, most long, same long")
    for r in rows.groupBy("a").agg(F.max("most").alias("most"), F.max("same").alias("same")).collect():
        most[r.a], same[r.a] = max(most[r.a], r.most), max(same[r.a], r.same)
    return most, same


def document_sums(rows: DataFrame, replies: DataFrame, most: np.ndarray, same: np.ndarray, kind: str) -> DataFrame:
    """The result rows: every batch with the counts of its pairs."""
    shared = rows.sparkSession.sparkContext.broadcast((most, same))         # as long as A's vocabulary
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def finish(own: pa.Table, counts: pa.Table) -> pa.Table:
        most, same = shared.value
        body, pieces, pairs, used, keys = (own.column(c)[0].as_py() for c in ("body", "pieces", "pairs", "used", "keys"))
        documents = pa.ipc.open_stream(unpack(body)).read_all()
        counts = counts.sort_by("kind").column("body").to_pylist()
        count = np.concatenate([np.zeros(0, np.int64), *(from_bytes(x)[0] for x in counts)])
        key_a = from_bytes(keys)[0]
        piece, a, links = from_bytes(pieces)
        of, pair, many = from_bytes(pairs)
        doc, piece_used, times = from_bytes(used)
        n = 1 + max(int(x.max(initial=-1)) for x in (piece, of, piece_used))
        total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(total, piece, links * same[a])
        np.add.at(best, piece, np.where(same[a] == most[a], links, 0))
        np.add.at(total, of, many * count[pair])
        np.add.at(best, of, np.where(count[pair] == most[key_a[pair]], many, 0))
        out = np.zeros((2, documents.num_rows), np.int64)
        np.add.at(out[0], doc, times * best[piece_used])
        np.add.at(out[1], doc, times * total[piece_used])
        return documents.append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1])).select(names)

    own = rows.filter("kind = -1").select("batch", "body", "pieces", "pairs", "used", "keys")
    back = replies.filter(F.col("batch").isNotNull())
    return own.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string")


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``
    for every row. ``path_a``: a byte-level BPE of the tokenizers library,
    ``path_b``: a sentencepiece model that adds a space; the same on every machine."""
    paths = (path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model"))
    small_batches(docs.sparkSession)
    vocabulary = Tokenizers(*paths).vocabulary
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    rows = checkpointed(encode_batches(docs, paths, max(8, -(-total // PART_BYTES))))
    vector = vector_sums(rows, len(vocabulary.a))
    replies = pair_sums(rows, vector, len(vocabulary.b), vocabulary.identity)
    most, same = highest_counts(replies, vector)
    return document_sums(rows, replies, most, same, docs.schema["doc_id"].dataType.simpleString())
