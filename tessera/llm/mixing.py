"""Mixing sources to target weights by capped water-filling.

Every source has a weight and at most ``max_epochs`` times its own size as a
target. Sources above that are clamped to it and the excess is shared again
among the rest by weight until none is above: with the sources in the order
of ``cap / weight`` the level at which this ends is the largest of
``(budget - caps before) / weights from here on``, so one pass over the
per-source table finds it.

A source's target is filled with whole repetitions of all its documents and
one fractional repetition: its documents in a seeded order up to the point
nearest the remainder. The order is that of ``md5(seed:doc_id)``; running
sums are taken within ranges of that hash and combined through range totals,
so a source that holds most of the rows is spread over many tasks.

Null text has size 0, null source is a source of its own and comes last.
Repeated rows are separate documents. Ties in the order go by ``doc_id`` and
size. Sources of size 0 get target 0. An empty table gives an empty result.
Columns other than ``doc_id``, ``text`` and ``source`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, checkpointed, maybe_broadcast

WEIGHTS = (3, 1, 2)
BUDGET = 1.5       # of all sizes
MAX_EPOCHS = 2
SEED = 17
RANGE_DIGITS = 3   # hex digits of the order that name a range: 4,096 a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts as the source by code point, null last; never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def water_fill(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(_src, source_size, target)`` from one row ``(_src, source_size)`` per
    source; the windows over all sources hold one row each."""
    index = F.pmod(F.row_number().over(Window.orderBy("_src")) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), index.cast("int") + 1)
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_src")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(budget)
             - (F.sum("_cap").over(upto) - F.col("_cap"))) / F.sum("_w").over(after)
    return (rows.withColumn("_level", level).withColumn("_level", F.max("_level").over(whole))
            .select("_src", "source_size", F.least("_cap", F.col("_level") * F.col("_w")).alias("target")))


def mix_documents(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
                  max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)``: how often, and
    with how many words, every document enters the mix."""
    return copies_of(checkpointed(mix_keys(docs, seed)), weights, budget, max_epochs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def order_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def mix_keys(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, _src, size, _key, _range)``: what the mix is planned from."""
    return docs.select(
        "doc_id", source_key(F.col("source")).alias("_src"), word_count(F.col("text")).alias("size"),
        order_key(F.col("doc_id"), seed).alias("_key")).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))


def copies_of(slim: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``source_size``, ``target``, ``_whole`` (repetitions of the whole
    source) and ``copies`` to the rows of :func:`mix_keys`."""
    sums = checkpointed(slim.groupBy("_src", "_range").agg(F.sum("size").alias("_sum")))
    targets = water_fill(sums.groupBy("_src").agg(F.sum("_sum").alias("source_size")), weights, budget, max_epochs)
    before = F.sum("_sum").over(Window.partitionBy("_src").orderBy("_range")) - F.col("_sum")
    starts = (sums.withColumn("_before", before).join(targets, "_src")
              .select("_src", "_range", "_before", "source_size", "target"))
    inner = Window.partitionBy("_src", "_range").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    at = 2 * (F.col("_before") + F.col("_run") - F.col("size")) + F.col("size")
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    return (slim.withColumn("_run", F.sum("size").over(inner)).join(starts, ["_src", "_range"])
            .withColumn("_whole", whole)
            .withColumn("copies", (F.col("_whole") + (at < 2 * rest).cast("int")).cast("int"))
            .drop("_run", "_before"))


def mix_rows(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET,
             max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it. The rows
    that get the fractional repetition are the first of their source, so the
    last key among them is all that has to be joined to the texts; rows with
    equal ``doc_id`` share a key and get it together."""
    slim = checkpointed(mix_keys(docs, seed))
    last = copies_of(slim, weights, budget, max_epochs).groupBy("_src").agg(
        F.max("_whole").alias("_whole"),
        F.max(F.when(F.col("copies") > F.col("_whole"), F.col("_key"))).alias("_last"))
    # the whole row as one column: no name of it can clash with those used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       source_key(F.col("source")).alias("_src"), order_key(F.col("doc_id"), seed).alias("_key"))
    times = F.col("_whole") + F.coalesce((F.col("_key") <= F.col("_last")).cast("int"), F.lit(0))
    return (rows.join(maybe_broadcast(checkpointed(last)), "_src")
            .select("_row", times.cast("int").alias("_times")).filter(F.col("_times") > 0)
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*"))
