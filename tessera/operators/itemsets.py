"""Frequent itemsets over baskets at an absolute support.

Baskets are kept in long form ``(basket_id, item)``. Supports are exact
counts over all baskets, so results do not depend on partitioning.

* :func:`level_wise_itemsets` - Apriori as DataFrame joins. Level k
  joins the frequent (k-1)-itemsets with each other to candidates, drops
  those with an infrequent subset, and counts the rest: the (k-1)-sets
  found in a basket are extended by a larger frequent item of the same
  basket (equi-join on ``basket_id``) where that gives a candidate.
* :func:`fpgrowth_itemsets` - ``pyspark.ml.fpm.FPGrowth`` on the same
  baskets (distributed FP-growth); must agree with the level-wise
  result.
* :func:`candidate_support` - exact support of a given candidate set
  (the second pass of SON), counted over a prefix tree: the candidates'
  items, rarest first, are the edges of a trie, and baskets walk down it one
  level at a time, so a basket that misses a prefix leaves early.

An itemset is an array of its items in ascending order; items may hold any
characters. Items are joined to text only in the report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import broadcast_if_small


def clean_basket_items(df: DataFrame) -> DataFrame:
    """Trim items, drop empty ones and duplicates within a basket."""
    return (
        df.select("basket_id", F.trim(F.col("item")).alias("item"))
        .filter(F.col("item") != "")
        .distinct()
    )


def basket_count(basket_items: DataFrame) -> int:
    """Number of baskets (one scalar to the driver)."""
    return basket_items.select(F.count_distinct("basket_id")).first()[0]


def default_support(n_baskets: int, percent: int = 11) -> int:
    """Absolute support ``n * percent div 100`` in integer arithmetic."""
    return n_baskets * percent // 100


def baskets(basket_items: DataFrame) -> DataFrame:
    """Distinct ``(basket_id, item)`` with each basket's size.

    The size table is the row count per basket, so very large baskets
    are known from it without another pass and their rows are spread
    over several tasks in the join back.
    """
    from tessera.operators.skew import hot_keys_from_counts, salted_join

    sizes = basket_items.groupBy("basket_id").agg(F.count(F.lit(1)).alias("basket_size")).checkpoint()
    hot = hot_keys_from_counts(sizes, "basket_id", "basket_size")
    return salted_join(sizes, basket_items, "basket_id", hot).select("basket_id", "item", "basket_size")


def frequent_singles(basket_items: DataFrame, support: int) -> DataFrame:
    return (
        basket_items.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
        .filter(F.col("support") >= support)
    )


def _as_itemsets(df: DataFrame, items_col: str = "items") -> DataFrame:
    return df.select(
        F.size(items_col).alias("size"),
        F.col(items_col).alias("items"),
        F.col("support").cast("bigint").alias("support"),
    )


def itemsets_as_text(df: DataFrame) -> DataFrame:
    """``df`` with ``items`` joined with ``,``."""
    return df.withColumn("items", F.array_join("items", ","))


def level_candidates(frequent: DataFrame, k: int) -> DataFrame:
    """``(items)``: k-sets whose (k-1)-subsets are all in ``frequent``
    (``items``: sorted arrays of k - 1)."""
    key = F.slice("items", 1, k - 2) if k > 2 else F.array().cast("array<string>")
    sides = frequent.select(key.alias("_head"), F.col("items")[k - 2].alias("_last"))
    joined = (
        sides.join(sides.withColumnRenamed("_last", "_next"), "_head").filter(F.col("_next") > F.col("_last"))
        .select(F.concat("_head", F.array("_last", "_next")).alias("items"))
    )
    if k < 3:
        return joined
    subsets = joined.select("items", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda i: F.concat(F.slice("items", F.lit(1), i - 1), F.slice("items", i + 1, F.lit(k) - i)))).alias("_sub"))
    return (subsets.join(frequent.select(F.col("items").alias("_sub")), "_sub", "left_semi")
            .groupBy("items").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == k).select("items"))


def level_wise_itemsets(basket_items: DataFrame, support: int, max_size: int | None = None) -> DataFrame:
    """All itemsets with support >= ``support``.

    Returns ``(size, items, support)``; ``items`` is a sorted array. Iterates until a level finds nothing (or ``max_size``):
    the driver loop runs once per itemset size. Each level's frequent sets
    are written to the checkpoint folder, its per-basket sets are kept until
    the next level has been counted.
    """
    f1 = frequent_singles(basket_items, support).checkpoint()
    # Frequent items of each basket, the only ones that can extend a set:
    # at most (rows / support) items are frequent, broadcast after a size
    # check; the rows are partitioned by basket once for the level joins.
    e1 = (
        basket_items.join(broadcast_if_small(f1.select("item")), "item", "left_semi")
        .repartition("basket_id")
        .persist()
    )
    levels = [f1.select(F.array("item").alias("items"), "support")]
    prev, held = e1.select("basket_id", F.array("item").alias("items"), F.col("item").alias("last")), e1
    k = 1
    while max_size is None or k < max_size:
        k += 1
        candidates = level_candidates(levels[-1], k).checkpoint()
        if candidates.isEmpty():
            break
        ext = (
            prev.join(e1.withColumnRenamed("item", "next"), "basket_id")
            .filter(F.col("next") > F.col("last"))
            .select("basket_id", F.concat("items", F.array("next")).alias("items"),
                    F.col("next").alias("last"))
            .join(broadcast_if_small(candidates), "items", "left_semi")
        ).persist()
        fk = (
            ext.groupBy("items").agg(F.count(F.lit(1)).alias("support"))
            .filter(F.col("support") >= support)
        ).checkpoint()
        if held is not e1:
            held.unpersist()
        held = ext
        if fk.isEmpty():
            break
        levels.append(fk)
        prev = ext.join(broadcast_if_small(fk.select("items")), "items", "left_semi")
    held.unpersist()
    e1.unpersist()
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return _as_itemsets(out)


def fpgrowth_itemsets(basket_items: DataFrame, support: int) -> DataFrame:
    """Frequent itemsets by ``FPGrowth``, same shape as the level-wise ones.

    FPGrowth's threshold is ``ceil(minSupport * n)``; ``(s - 0.5) / n``
    yields exactly ``s`` without float error. Items that cannot be
    frequent are removed before the per-basket sets are built, which
    bounds each transaction by the number of frequent items.
    """
    from pyspark.ml.fpm import FPGrowth

    f1 = frequent_singles(basket_items, support).select("item").checkpoint()
    tx = (
        basket_items.join(broadcast_if_small(f1), "item", "left_semi")
        .groupBy("basket_id").agg(F.collect_set("item").alias("items"))
    ).checkpoint()
    # the threshold is a share of the baskets that are left; every itemset present in the data has support >= 1, so a support
    # below 1 means the same as 1
    min_support = (max(support, 1) - 0.5) / max(tx.count(), 1)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(tx)
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"),
                                   F.col("freq").alias("support"))
    return _as_itemsets(fi)


def son_candidates(basket_items: DataFrame, frequent: DataFrame, singles: int) -> DataFrame:
    """``(items)``: candidates as SON's first pass hands them on, with real ones
    below the support: items of at least ``singles`` baskets, and every k-set
    whose (k-1)-subsets are all among ``frequent`` (``size``, ``items``)."""
    out = frequent_singles(basket_items, singles).select(F.array("item").alias("items"))
    sizes = [r["size"] for r in frequent.select("size").distinct().orderBy("size").collect()]
    for k in sizes:
        out = out.unionByName(level_candidates(frequent.filter(F.col("size") == k).select("items"), k + 1))
    return out


def candidate_trie(candidates: DataFrame, counts: DataFrame) -> list[DataFrame]:
    """The prefix tree of ``candidates`` (``items``: arrays), one written table of
    edges a level: ``(parent, item, node, items, size)``. The items of a candidate are taken
    rarest first (``counts``: ``item``, ``n``; ties by item), which keeps the
    baskets on a level few. ``items`` and ``size`` are set where a candidate ends."""
    listed = candidates.select(F.array_sort(F.array_distinct("items")).alias("items")).filter(
        F.size("items") > 0).distinct()
    placed = listed.select("items", F.explode("items").alias("item")).join(counts, "item", "left")
    paths = placed.groupBy("items").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "item"))),
                    lambda x: x["item"]).alias("_path")).checkpoint()
    depth = paths.agg(F.max(F.size("_path"))).first()[0] or 0
    levels, above = [], None
    for k in range(1, depth + 1):
        node = paths.filter(F.size("_path") >= k).groupBy(F.slice("_path", 1, k).alias("_prefix")).agg(
            F.max(F.when(F.size("_path") == k, F.struct("items"))).alias("_end"))
        node = node.withColumn("node", F.monotonically_increasing_id()).checkpoint()    # ids fixed by the written layout
        edge = node.select("_prefix", F.col("_prefix")[k - 1].alias("item"), "node", F.col("_end.items").alias("items"),
                           F.slice("_prefix", 1, k - 1).alias("_above"))
        if above is None:
            edge = edge.withColumn("parent", F.lit(0).cast("bigint"))
        else:
            edge = edge.join(above.select(F.col("_prefix").alias("_above"), F.col("node").alias("parent")), "_above")
        levels.append(edge.select("parent", "item", "node", "items").checkpoint())
        above = node
    return levels


def candidate_support(basket_items: DataFrame, candidates: DataFrame, trace: list | None = None) -> DataFrame:
    """``(size, items, support)``: exact support of every candidate itemset.

    ``candidates``: ``(items)``, arrays of any size (repetitions and order within
    one do not matter). Level by level the baskets that hold a prefix meet its
    edges (an equi-join on the node) and go on with the edges whose item they
    hold, too (an equi-join on basket and item). Candidates held by no basket
    get support 0; the empty set is none. Hot items and nodes are spread over
    tasks. ``trace``, when given, receives the (basket, prefix) rows of each level.
    """
    from tessera.operators.skew import hot_keys, hot_keys_from_counts, salted_join

    parts = candidates.select(F.explode("items").alias("item")).distinct().checkpoint()
    kept = basket_items.join(broadcast_if_small(parts), "item", "left_semi").select("basket_id", "item").persist()
    counts = kept.groupBy("item").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    levels = candidate_trie(candidates, counts)
    found, held = [], []
    for k, edges in enumerate(levels):
        if k == 0:
            front = salted_join(edges.select("item", "node"), kept, "item", hot_keys_from_counts(counts, "item", "n"))
        else:
            ahead = salted_join(edges.select(F.col("parent").alias("node"), "item", F.col("node").alias("_next")),
                                held[-1], "node", hot_keys(held[-1], "node"))
            front = ahead.join(kept, ["basket_id", "item"]).withColumnRenamed("_next", "_node").drop("node") \
                .withColumnRenamed("_node", "node")
        held.append(front.select("basket_id", "node").persist())
        sums = held[-1].groupBy("node").agg(F.count(F.lit(1)).alias("support"))
        level = edges.filter(F.col("items").isNotNull()).join(sums, "node", "left").select(
            "items", F.coalesce("support", F.lit(0)).alias("support")).checkpoint()
        found.append(level)
        if trace is not None:
            trace.append(held[-1].count())
        if k:
            held[-2].unpersist()
    for frame in (kept, *held[-1:]):
        frame.unpersist()
    if not found:
        return _as_itemsets(candidates.select("items", F.lit(0).alias("support")).limit(0))
    out = found[0]
    for level in found[1:]:
        out = out.unionByName(level)
    return _as_itemsets(out)


def itemset_report_lines(itemsets: DataFrame) -> DataFrame:
    """``(position, size, text)``: one row per itemset (``items``: arrays), ``text``
    its items as ``(a,b)``. Positions count from 0 in the order of the text report: by
    size, then by the items in lexicographic order. The rows are sorted by
    range, so no task holds a whole size."""
    from tessera.operators.dictionary import row_index

    ordered = itemsets.select("size", "items").repartitionByRange("size", "items") \
        .sortWithinPartitions("size", "items").checkpoint()
    return row_index(ordered, "position").select(
        "position", "size", F.concat(F.lit("("), F.array_join("items", ","), F.lit(")")).alias("text"))
