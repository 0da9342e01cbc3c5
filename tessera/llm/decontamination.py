"""Benchmark decontamination by SimHash over item-sized windows.

A document is contaminated by a benchmark item if one of its windows of as
many words as the item has is similar to it: SimHash fingerprints of the
five-word shingles within ``RADIUS`` bits, and then an exact weighted Jaccard
similarity of the shingles (weight: how often each occurs) of ``MIN_SIMILARITY``
or more. Windows may start at every word. To be as similar as that, a window
of w shingles must share ``MIN_SIMILARITY * (m + w) / (1 + MIN_SIMILARITY)`` with
an item of m, so windows are laid at all starts, and only those, where at least
so many of the window's shingles are the item's (runs of consecutive hits that
fit into a window give them); a document shorter than the item is one window.

Fingerprints are compared through a multi-index: eight blocks of eight bits,
of which any two fingerprints within 23 bits agree in one up to two bits. The
items' blocks are entered with all those variants, so an equality join on
(item size, block, value) finds every fingerprint within the radius. Equal
windows are collapsed before that, so a passage which many documents hold is
looked up once.

Words are lower-cased (A-Z) runs of non-space characters. An item of one to four
words has one shingle, the whole sequence; it is found where a window of as many
words equals it (similarity 1). Empty and null items match nothing, nor do such
documents. Null ``doc_id`` is kept as null. Repeated rows give one row per
``(doc_id, item_id)``, the best similarity and its first window. Empty
tables give an empty result. Only ``doc_id`` and ``text``, ``item_id`` and
``text`` are read. Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, maybe_broadcast

WORDS = 5
MIN_SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1      # 23 bits, all that the index guarantees

_SPACES = " \t\n\x0b\f\r"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: the optimizer would
    otherwise copy the expression into the lambdas that use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of lower-cased words; empty for a null text."""
    trimmed = F.btrim(F.translate(text.cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(_SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def shingles(text: Column) -> Column:
    """Hashes of all five-word shingles of a text, in order."""
    def of(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - F.lit(WORDS))
        return F.when(F.size(w) >= WORDS, F.transform(places, lambda i: F.xxhash64(
            *[F.get(w, i + F.lit(k)) for k in range(WORDS)]))).otherwise(F.array().cast("array<bigint>"))
    return let(words(text), of)


def simhash(grams: Column) -> Column:
    """SimHash of an array of hashes: a bit is 1 if set in over half of them.
    Each of 32 counters counts two bits in its halves."""
    zero, low = F.lit(0).cast("long"), F.lit((1 << 32) - 1).cast("long")

    def count(acc: Column, x: Column) -> Column:
        return F.transform(acc, lambda a, i: a + F.call_function("shiftright", x, i).bitwiseAND(
            F.lit((1 << 32) + 1).cast("long")))

    def bits(g: Column) -> Column:
        lanes = F.aggregate(g, F.array_repeat(zero, 32), count)
        half = F.size(g)
        one = F.lit(1).cast("long")
        set_bits = F.transform(lanes, lambda a, i: F.when(
            a.bitwiseAND(low) * 2 > half, F.call_function("shiftleft", one, i)).otherwise(zero).bitwiseOR(F.when(
                F.shiftrightunsigned(a, 32) * 2 > half, F.call_function("shiftleft", one, i + 32)).otherwise(zero)))
        return F.aggregate(set_bits, zero, lambda f, b: f.bitwiseOR(b))
    return let(grams, bits)


def weighted_jaccard(a: str, b: str) -> Column:
    """Sum of the smaller over sum of the larger counts of two arrays' values."""
    plain = f"size(array_distinct({a})) = size({a}) AND size(array_distinct({b})) = size({b})"
    slow = (f"aggregate(array_intersect({a}, {b}), 0, (s, g) -> s + least("
            f"size(filter({a}, x -> x = g)), size(filter({b}, x -> x = g))))")
    shared = f"if({plain}, size(array_intersect({a}, {b})), {slow})"
    return F.expr(f"transform(array({shared}), s -> s / cast(size({a}) + size({b}) - s as double))[0]")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(item_id, n, item_grams, item_print)`` of the items with a shingle."""
    items = checkpointed(benchmark.select("item_id", shingles(F.col("text")).alias("item_grams")))
    return checkpointed(items.filter(F.size("item_grams") > 0).select(
        "item_id", (F.size("item_grams") + WORDS - 1).alias("n"), "item_grams",
        simhash(F.col("item_grams")).alias("item_print")))


def window_starts(min_similarity: float) -> tuple[Column, Column]:
    """``(needed, starts)`` of a document of ``_size`` shingles and an item of ``_m``:
    how many shingles a window must share with it, and the starts of the windows
    that hold so many of the ascending places ``_hits``. Every ``needed``
    consecutive hits that fit into a window admit an interval of starts."""
    share = min_similarity / (1 + min_similarity)
    needed = f"greatest(1, cast(ceil({share!r}D * (_m + least(_size, _m)) - 1e-9D) as int))"
    starts = """array_distinct(flatten(transform(
        filter(transform(sequence(0, size(_hits) - _needed), j -> struct(
                   greatest(_hits[j + _needed - 1] - least(_size, _m) + 1, 0) as lo,
                   least(_hits[j], greatest(_size - _m, 0)) as hi)),
               x -> x.lo <= x.hi),
        x -> sequence(x.lo, x.hi))))"""
    return F.expr(needed), F.expr(starts)


def document_windows(docs: DataFrame, items: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``(doc_id, _hash, n, start, grams)``: the windows to be compared."""
    seeds = checkpointed(items.select(F.xxhash64("n", "item_grams").alias("_item"), F.size("item_grams").alias("_m"),
                                      F.explode("item_grams").alias("gram")).distinct())

    def grams(rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", F.xxhash64("text").alias("_hash"), shingles(F.col("text")).alias("grams"))

    needed, starts = window_starts(min_similarity)
    hits = (grams(docs).select("doc_id", "_hash", F.size("grams").alias("_size"), F.posexplode("grams").alias("_at", "gram"))
            .join(maybe_broadcast(seeds), "gram")
            .groupBy("doc_id", "_hash", "_size", "_item", "_m").agg(F.sort_array(F.collect_set("_at")).alias("_hits"))
            .withColumn("_needed", needed).filter(F.size("_hits") >= F.col("_needed")))
    found = checkpointed(hits.select("doc_id", "_hash", (F.col("_m") + WORDS - 1).alias("n"), F.explode(starts).alias("start"))
                         .distinct())
    # the texts with windows are cut up once more; no other text is sent
    per_doc = checkpointed(found.groupBy("doc_id", "_hash").agg(F.collect_set(F.struct("n", "start")).alias("_windows")))
    keys = maybe_broadcast(checkpointed(per_doc.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_own"))))
    held = docs.select("doc_id", "text").join(
        keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_own")), "left_semi")
    joined = grams(held).alias("g").join(per_doc.alias("d"), F.col("g.doc_id").eqNullSafe(F.col("d.doc_id"))
                                         & (F.col("g._hash") == F.col("d._hash")))
    cut = joined.select("g.doc_id", "g._hash", "g.grams", F.explode("d._windows").alias("w"))
    return cut.select("doc_id", "_hash", "w.n", "w.start",
                      F.expr(f"slice(grams, w.start + 1, w.n - {WORDS - 1})").alias("grams"))


def block_values(fingerprint: str) -> Column:
    """Array of ``block * 256 + value``."""
    return F.array(*[F.lit(k << BLOCK_BITS) + F.shiftrightunsigned(fingerprint, k * BLOCK_BITS).bitwiseAND(
        F.lit((1 << BLOCK_BITS) - 1).cast("long")) for k in range(BLOCKS)])


def similar_windows(distinct: DataFrame, items: DataFrame, radius: int, min_similarity: float) -> DataFrame:
    """``(n, grams, item_id, similarity, distance)`` of all similar pairs of
    windows ``(n, grams)`` and items of that size."""
    masks = F.expr(f"filter(sequence(0L, {(1 << BLOCK_BITS) - 1}L), x -> bit_count(x) <= {BLOCK_RADIUS})")
    index = (items.select("n", "item_id", "item_print", F.explode(block_values("item_print")).alias("_b"))
             .select("n", "item_id", "item_print", F.col("_b").alias("_b0"), F.explode(masks).alias("_mask"))
             .select("n", "item_id", "item_print", F.col("_b0").bitwiseXOR(F.col("_mask")).alias("_block")))
    prints = checkpointed(distinct.withColumn("_print", simhash(F.col("grams"))).withColumn("_key", F.xxhash64("n", "grams")))
    distance = F.bit_count(F.col("_print").bitwiseXOR(F.col("item_print")))
    near = (prints.select("n", "_key", "_print", F.explode(block_values("_print")).alias("_block"))
            .join(maybe_broadcast(checkpointed(index)), ["n", "_block"]).withColumn("distance", distance)
            .filter(F.col("distance") <= radius)
            .select("n", "_key", "_print", "item_id", "item_print", "distance").distinct())
    texts = items.select("n", "item_print", F.col("item_id").alias("_item"), "item_grams")
    pairs = near.join(prints, ["n", "_key", "_print"]).join(texts, ["n", "item_print"]).filter(
        F.col("item_id").eqNullSafe(F.col("_item")))
    return (pairs.withColumn("similarity", weighted_jaccard("grams", "item_grams"))
            .filter(F.col("similarity") >= min_similarity)
            .select("n", "grams", "item_id", "similarity", "distance"))


def short_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """``(doc_id, _hash, item_id, start, n, similarity, distance)`` of the items
    of fewer than ``WORDS`` words; None if there are none."""
    items = checkpointed(benchmark.select("item_id", words(F.col("text")).alias("_words")).filter(
        (F.size("_words") > 0) & (F.size("_words") < WORDS)).select(
        "item_id", F.size("_words").alias("n"), F.array_join("_words", " ").alias("_text")).distinct())
    sizes = [r.n for r in items.select("n").distinct().orderBy("n").collect()]    # WORDS - 1 at most
    if not sizes:
        return None

    def of(w: Column, n: int) -> Column:
        # a text of fewer than n words has no window of n
        places = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - F.lit(n))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(
            F.lit(n).alias("n"), i.alias("start"), F.array_join(F.slice(w, i + F.lit(1), F.lit(n)), " ").alias("_text")))

    def windows(w: Column) -> Column:
        return F.flatten(F.array(*[of(w, n) for n in sizes]))

    cut = docs.select("doc_id", F.xxhash64("text").alias("_hash"),
                      F.explode(let(words(F.col("text")), windows)).alias("_w")).select("doc_id", "_hash", "_w.*")
    return cut.join(maybe_broadcast(items), ["n", "_text"]).groupBy("doc_id", "_hash", "item_id", "n").agg(
        F.min("start").alias("start")).select("doc_id", "_hash", "item_id", "start", "n",
                                             F.lit(1.0).alias("similarity"), F.lit(0).alias("distance"))


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS,
                         min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``(doc_id, _hash, item_id, start, n, similarity, distance)``."""
    if radius >= BLOCKS * (BLOCK_RADIUS + 1):
        raise ValueError(f"the index guarantees a radius below {BLOCKS * (BLOCK_RADIUS + 1)}")
    items = benchmark_items(benchmark)
    windows = checkpointed(document_windows(docs, items, min_similarity))
    found = similar_windows(windows.select("n", "grams").distinct(), items, radius, min_similarity)
    found = windows.join(found, ["n", "grams"]).select(
        "doc_id", "_hash", "item_id", "start", "n", "similarity", "distance")
    short = short_windows(docs, benchmark)
    return found if short is None else found.unionByName(short)


def find_contamination(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS,
                       min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``(doc_id, item_id, similarity, start, n_words)``: each contaminated
    document with each item found in it, at its best (first) window."""
    found = contaminated_windows(docs, benchmark, radius, min_similarity)
    best = F.min(F.struct((-F.col("similarity")).alias("s"), F.col("start"), F.col("n"))).alias("_b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("_b.s")).alias("similarity"),
        F.col("_b.start").alias("start"), F.col("_b.n").alias("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS,
                      min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    found = contaminated_windows(docs, benchmark, radius, min_similarity)
    bad = found.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_bad")).distinct()
    # the whole row as one column: no name of it can clash with those used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_text"))
    return rows.join(bad, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_bad")),
                     "left_anti").select("_row.*")
