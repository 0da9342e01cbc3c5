"""Spelling variants grouped under their frequent form, joined on q-chunks.

A word is a run of Latin letters, counted over all texts. Two words are near if
one inserted, deleted or replaced code point turns one into the other. The
join is asymmetric: the shorter word ``s`` of a pair (length L) is cut into two
disjoint chunks, one edit leaves one of them whole, and the longer word ``t``
(length L or L + 1) offers its positional grams at the places where that chunk
can stand: the place is shifted by 0 before the edit and by the difference of
lengths, 0 or 1, behind it. The chunk that holds the edit is cut in two once
more by the same argument. A key is thus ``s`` without one of four pieces, with
the lengths, and only words that agree on all else meet. Candidates are
verified by their edit distance. A key of very many words is dealt to a grid of
tasks (:mod:`tessera.operators.skew`), none is left out.

``word_counts`` counts per batch of texts in Python tasks and adds up in the
JVM; everything else is DataFrame code. The chain from a word to its last form
is followed by pointer doubling: a form has at least ``ratio`` times the
occurrences, so chains are short and have no cycle.

Null and empty texts have no word; a null ``doc_id`` is the empty text where
it takes part in the hash. Repeated rows count each time. Ties between forms go
to the smallest word in code-point order. An empty table gives an empty result.
Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, checkpointed, small_batches, text_slices
from tessera.operators.skew import PAIR_THRESHOLD, grid_join, hot_keys

MIN_LENGTH = 7        # code points of a word
MIN_COUNT = 2         # occurrences of a word
RATIO = 10            # a form's occurrences to the word's
DROP_EVERY = 31       # a run whose hash this divides loses a code point
BATCH_BYTES = 8 << 20     # of words counted in a task before they are sent

#: Letters in UTF-8: A-Z, a-z, and the two bytes of U+00C0 to U+00FF, of which
#: the first is 0xC3 and stands nowhere else in valid text but before U+00FF.
_ASCII = np.zeros(256, bool)
_ASCII[ord("a"):ord("z") + 1] = True


def letter_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text index)`` of the letter runs of lower-cased bytes of
    texts; no run crosses a text's border."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    lead = data == 0xC3
    solid = _ASCII[data] | lead
    solid[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = solid & np.append(True, ~solid[:-1] | edge[1:-1])
    last = solid & np.append(~solid[1:] | edge[1:-1], True)
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return before[ends] - before[starts]


def slice_words(data: np.ndarray, off: np.ndarray, prefixes: list[int], min_length: int) -> tuple[pa.Array, np.ndarray]:
    """``(words, occurrences)`` of the texts of a slice. ``prefixes``: crc32 of
    what stands before a run of each text in its hash."""
    data = LOWER[data]
    starts, ends, doc = letter_runs(data, off)
    keep = code_points(data, starts, ends) >= min_length      # a deletion only shortens
    starts, ends, doc = starts[keep], ends[keep], doc[keep]
    size = ends - starts
    stop = np.concatenate([[0], np.cumsum(size)])
    if stop[-1] >= 1 << 31:
        raise ValueError("a text of more than 2 GB")
    at = np.arange(stop[-1]) + np.repeat(starts - stop[:-1], size)
    runs = pa.StringArray.from_buffers(len(size), pa.py_buffer(stop.astype(np.int32)), pa.py_buffer(data[at]))
    coded = runs.dictionary_encode()
    words, number = coded.dictionary, max(len(coded.dictionary), 1)
    pair, times = np.unique(doc * number + coded.indices.to_numpy(), return_counts=True)
    plain = words.cast(pa.binary()).to_pylist()
    total = np.zeros(number, np.int64)
    np.add.at(total, pair % number, times)
    changed: dict[str, int] = {}
    for d, w, k in zip((pair // number).tolist(), (pair % number).tolist(), times.tolist()):
        h = zlib.crc32(plain[w], prefixes[d])
        if h % DROP_EVERY == 0:
            total[w] -= k
            word = plain[w].decode()
            place = h % len(word)
            if len(word) > min_length:
                word = word[:place] + word[place + 1:]
                changed[word] = changed.get(word, 0) + k
    left = np.flatnonzero(total[:len(words)])
    return (pa.concat_arrays([words.take(pa.array(left)), pa.array(list(changed), pa.string())]),
            np.concatenate([total[left], np.array(list(changed.values()), np.int64)]))


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n)`` of all words of at least ``min_length`` code points."""
    small_batches(docs.sparkSession)

    def run(batches):
        held, size = [], 0
        for b in batches:
            ids = [zlib.crc32(b":", zlib.crc32((i or "").encode())) for i in b.column(0).to_pylist()]
            for i, j, data, off in text_slices(b.column(1)):
                words, n = slice_words(data, off, ids[i:j], min_length)
                held.append(pa.table({"word": words, "n": n}))
                size += words.nbytes
                if size > BATCH_BYTES:
                    yield from added(held)
                    held, size = [], 0
        yield from added(held)

    def added(held):
        if held:
            both = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            both = both.select(["word", "n_sum"]).rename_columns(["word", "n"])
            yield from both.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(1 << 16)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _part(word: str, start: Column, stop: Column | None = None) -> Column:
    """Code points ``start`` (from 0) up to ``stop`` of a word."""
    size = (F.length(word) if stop is None else stop) - start
    return F.substring(word, start + 1, size)


def _keys(short: Column, shift: int) -> Column:
    """Keys of the column ``word``, one for each left-out piece, where the pair's
    shorter word has ``short`` code points and the longer ``shift`` more; this
    word is the one of ``short`` (``shift`` 0 in its own places) or the other."""
    q = F.floor(short / 2).cast("int")                        # the first chunk; the second is the rest
    p = F.floor(q / 2).cast("int")                            # either is cut in two
    r = (q + F.floor((short - q) / 2)).cast("int")
    longer = F.length("word") - short                         # this word's own shift behind the edit
    zero = F.lit(0)
    sides = [(_part("word", zero, r), F.lit("")),                                  # the edit lies behind r
             (_part("word", zero, q), _part("word", r + longer)),                  # between q and r
             (_part("word", zero, p), _part("word", q + longer)),                  # between p and q
             (F.lit(""), _part("word", p + longer))]                               # before p
    return F.array(*[F.xxhash64(short, F.lit(shift), F.lit(k), a, b) for k, (a, b) in enumerate(sides)])


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, threshold: int = PAIR_THRESHOLD) -> DataFrame:
    """``(s, s_n, t, t_n)``: every two words (``word``, ``n``; written before) that
    differ by one code point, once; ``s`` is the shorter, or the smaller of
    equally long ones."""
    length = F.length("word")
    same = F.transform(_keys(length, 0), lambda k: F.struct(F.lit(0).alias("shift"), k.alias("key")))
    longer = F.transform(_keys(length, 1), lambda k: F.struct(F.lit(1).alias("shift"), k.alias("key")))
    shorter = F.transform(_keys(length - 1, 1), lambda k: F.struct(F.lit(1).alias("shift"), k.alias("key")))
    chunks = words.select(F.col("word").alias("s"), F.col("n").alias("s_n"), F.explode(F.concat(same, longer)).alias("k"))
    grams = words.select(F.col("word").alias("t"), F.col("n").alias("t_n"), F.explode(
        F.when(length > min_length, F.concat(same, shorter)).otherwise(same)).alias("k"))
    chunks = chunks.select("s", "s_n", "k.shift", "k.key")
    grams = grams.select("t", "t_n", F.col("k.key").alias("key"))
    met = grid_join(chunks, grams, "key", hot_keys(chunks, "key", threshold))
    return (met.filter((F.col("shift") == 1) | (F.col("s") < F.col("t")))
            .filter(F.levenshtein("s", "t", 1) == 1)
            .select("s", "s_n", "t", "t_n").distinct())


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for rows ``(word, form)``: the end of the chain of forms."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = checkpointed(now.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        now = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return now


def group_variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words``
    (``word``, ``n``), all of at least ``min_length`` code points."""
    words = checkpointed(words.select("word", "n"))
    pairs = checkpointed(near_pairs(words, min_length))
    both = pairs.select(F.col("s").alias("word"), F.col("t").alias("near"), F.col("t_n").alias("near_n")).unionByName(
        pairs.select(F.col("t").alias("word"), F.col("s").alias("near"), F.col("s_n").alias("near_n")))
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("_best"))
    enough = -F.col("_best.less") >= F.col("n") * ratio
    found = checkpointed(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("_best.form")).alias("form"), F.when(enough, -F.col("_best.less")).alias("form_n")))
    roots = last_forms(found.filter(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """:func:`group_variants` over the words of ``docs`` that occur at least twice."""
    return group_variants(word_counts(docs).filter(F.col("n") >= MIN_COUNT))
