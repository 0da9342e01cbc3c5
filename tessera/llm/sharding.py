"""Contiguous sharding with the smallest possible largest shard.

Documents with equal texts form one atomic group. The groups are put in the
order of their text's SHA-256, and the smallest feasible shard capacity for a
contiguous partition is found by binary search, each capacity checked
greedily over the prefix sums of the group sizes. The cuts are then made at
that capacity, each as near to the mean of what is left as it allows.

Nothing is ordered or collected whole: the prefix sums are running sums
within chunks of the digest space plus chunk offsets. The search on the
driver sees only a bounded summary of them (the first and last sum in each of
``SUMMARY`` ranges) and asks for finer ranges just where its decisions depend
on hidden sums, until none does; so its result is exact. A document's shard
is a comparison of its digest with the cuts, without a join.

Law ``bytes``. A null text has size 1 and all null texts form one group
(apart from the group of empty texts); null ``doc_id`` is kept. Repeated
rows are separate members of one group. With fewer groups than shards some
shards stay empty. An empty table gives an empty result. Columns besides
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

SUMMARY = 1 << 15      # ranges of the first summary of the prefix sums
FINER = 64             # ranges of each further one
GROUPS_PER_CHUNK = 1 << 20
ROWS_PER_BLOCK = 50_000


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def digest(text: Column) -> Column:
    """SHA-256 in hex; the empty string for a null text."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def group_ends(slim: DataFrame, n_rows: int) -> DataFrame:
    """``(_digest, _weight, _end)``: each group's size and the sum of the sizes
    up to and with it, in digest order."""
    width = 3
    while n_rows / 16 ** width > GROUPS_PER_CHUNK:
        width += 1
    groups = (slim.groupBy("_digest").agg(F.sum("size").alias("_weight"))
              .withColumn("_chunk", F.substring("_digest", 1, width)))
    chunks = groups.groupBy("_chunk").agg(F.sum("_weight").alias("_sum"))
    # at most 16^width + 1 rows, about n_rows / GROUPS_PER_CHUNK, meet in this one window
    before = chunks.select(
        "_chunk", (F.sum("_sum").over(Window.orderBy("_chunk")) - F.col("_sum")).alias("_before"))
    running = F.sum("_weight").over(Window.partitionBy("_chunk").orderBy("_digest"))
    return (groups.withColumn("_run", running).join(before, "_chunk")
            .select("_digest", "_weight", (F.col("_before") + F.col("_run")).alias("_end")))


class PrefixSums:
    """Lookups in the sorted prefix sums from a bounded, refinable summary.

    ``at_most`` and ``at_least`` answer from the known sums and note every
    range with hidden sums that the answer depends on; :meth:`refine` reads
    those in finer ranges."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        self.width = -(-total // SUMMARY)
        self.known: list[int] = [0]
        self.hidden: set[int] = set()   # known sums with hidden ones before the next known
        self.asked: set[int] = set()
        bucket = F.floor(F.col("_end") / F.lit(self.width))
        self._take(ends.groupBy(bucket.alias("_b")).agg(
            F.min("_end").alias("lo"), F.max("_end").alias("hi"), F.count(F.lit(1)).alias("n")).collect())

    def _take(self, rows) -> None:
        for r in rows:
            self.known += {r.lo, r.hi}
            if r.n > 2:
                self.hidden.add(r.lo)
        self.known.sort()

    def _ask(self, x: int) -> int:
        """Index of the largest known sum up to ``x``."""
        i = bisect_right(self.known, x) - 1
        if self.known[i] < x and self.known[i] in self.hidden:
            self.asked.add(i)
        return i

    def at_most(self, x: int) -> int:
        return self.known[self._ask(x)]

    def at_least(self, x: int) -> int:
        if x >= self.total:
            return self.total
        self._ask(x)
        return self.known[bisect_left(self.known, x)]

    def refine(self) -> bool:
        """Read the ranges asked for; False if there were none."""
        if not self.asked:
            return False
        gaps = [(self.known[i], self.known[i + 1]) for i in self.asked]
        self.asked = set()
        spark = self.ends.sparkSession
        # a few lookups per capacity tried: bounded by the number of shards
        frame = spark.createDataFrame([(lo // self.width, lo, hi) for lo, hi in gaps],
                                      "_b long, _lo long, _hi long")
        inside = (self.ends.withColumn("_b", F.floor(F.col("_end") / F.lit(self.width)))
                  .join(F.broadcast(frame), "_b")
                  .filter((F.col("_end") > F.col("_lo")) & (F.col("_end") < F.col("_hi"))))
        step = F.greatest(F.lit(1), F.ceil((F.col("_hi") - F.col("_lo")) / F.lit(FINER)))
        part = F.floor((F.col("_end") - F.col("_lo")) / step)
        rows = inside.groupBy("_lo", part.alias("_p")).agg(
            F.min("_end").alias("lo"), F.max("_end").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
        self.hidden -= {lo for lo, _ in gaps}
        self._take(rows)
        return True


def smallest_capacity(sums: PrefixSums, n_shards: int, largest: int) -> int:
    """Binary search for the smallest capacity that the greedy check accepts."""
    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(n_shards):
            at = sums.at_most(at + capacity)
            if at >= sums.total:
                return True
        return False

    mean = -(-sums.total // n_shards)
    low, high = max(mean, largest), mean + largest
    while low < high:
        middle = (low + high) // 2
        if fits(middle):
            high = middle
        else:
            low = middle + 1
    return low


def cut_points(sums: PrefixSums, n_shards: int, capacity: int) -> list[int]:
    """``n_shards - 1`` prefix sums to cut after: no shard above the capacity,
    each cut as near to the mean of the rest as that allows."""
    earliest = [sums.total] * (n_shards + 1)
    for j in range(n_shards - 1, 0, -1):
        earliest[j] = sums.at_least(max(0, earliest[j + 1] - capacity))
    cuts, at = [], 0
    for j in range(1, n_shards):
        want = at + (sums.total - at) // (n_shards - j + 1)
        below, above = sums.at_most(want), sums.at_least(want)
        best = below if want - below <= above - want else above
        least = max(earliest[j], sums.at_least(min(sums.total, at + 1)))
        at = min(max(best, least), sums.at_most(at + capacity))
        cuts.append(at)
    return cuts


def plan_cuts(ends: DataFrame, n_shards: int) -> list[str]:
    """The last digest before each of the ``n_shards - 1`` cuts."""
    top = ends.agg(F.max("_end").alias("total"), F.max("_weight").alias("largest")).first()
    if not top.total:
        return []
    sums = PrefixSums(ends, top.total)
    while True:
        cuts = cut_points(sums, n_shards, smallest_capacity(sums, n_shards, top.largest))
        if not sums.refine():
            break
    at = {r["_end"]: r["_digest"] for r in
          ends.filter(F.col("_end").isin(sorted(set(cuts)))).select("_end", "_digest").collect()}
    return [at[c] for c in cuts]


def assign_shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row of ``docs``;
    ``slot`` numbers the rows of a shard from 0 without gaps."""
    slim = checkpointed(docs.select(
        "doc_id", text_size(F.col("text")).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), digest(F.col("text")).alias("_digest")))
    n_rows = slim.count()
    cuts = plan_cuts(checkpointed(group_ends(slim, n_rows)), n_shards)
    shard = F.lit(0)
    for last in cuts:
        shard = shard + (F.col("_digest") > F.lit(last)).cast("int")
    blocks = max(256, -(-n_rows // ROWS_PER_BLOCK))
    placed = slim.select("*", shard.cast("int").alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "_digest"), F.lit(blocks)).alias("_block"))
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("shard", "_block", (F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_block")) - F.col("_n")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("_digest", "doc_id"))
    return (placed.withColumn("_rank", rank).join(starts, ["shard", "_block"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("_start") + F.col("_rank") - 1).cast("long").alias("slot")))
