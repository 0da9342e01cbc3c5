"""Hot-key handling for equi-joins whose keys can be heavily skewed.

A key holding a large share of the rows would put all of its join
output on one task. :func:`hot_keys` finds such keys with one
pre-aggregated count (map-side combine, so the hot key itself is never
shuffled row by row): at most rows / threshold keys, a table that is
written to the checkpoint folder and joined as the planner sees fit; when no
key is hot the join stays a plain one. :func:`salted_join` then spreads each hot key over
``buckets`` tasks: the right side's rows of that key are dealt to
buckets by a deterministic hash of their columns, the left side's rows
are replicated to every bucket, so each (left, right) pair is produced
exactly once. Other keys join as usual (salt 0). Adaptive execution's
skew-join splitting remains on for anything not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

DEFAULT_THRESHOLD = 50_000   # rows per key a single task should take
PAIR_THRESHOLD = 4_000       # rows a side whose pairs a single task should take


def hot_keys_from_counts(counts: DataFrame, key: str, count_col: str,
                         threshold: int | None = None) -> DataFrame | None:
    """``(key, _buckets)`` for the keys whose count exceeds ``threshold``
    (``_buckets`` = ceil(count / threshold)), or ``None`` when no key is
    hot."""
    threshold = DEFAULT_THRESHOLD if threshold is None else threshold
    hot = counts.filter(F.col(count_col) > threshold).select(
        key, F.ceil(F.col(count_col) / threshold).cast("int").alias("_buckets")).checkpoint()
    return None if hot.isEmpty() else hot


def hot_keys(df: DataFrame, key: str, threshold: int | None = None) -> DataFrame | None:
    """Hot keys of ``df`` by row count (one pre-aggregated count)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_keys_from_counts(counts, key, "_rows", threshold)


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner equi-join on ``key`` with hot keys spread over buckets.

    ``hot`` comes from :func:`hot_keys`. Without hot keys this is a plain
    join, planned as the optimizer sees fit.
    """
    if hot is None:
        return left.join(right, key)
    h = hot
    r = (
        right.join(h, key, "left")
        .withColumn("_salt", F.when(
            F.col("_buckets").isNotNull(),
            F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.col("_buckets")))
            .otherwise(F.lit(0).cast("bigint")))
        .drop("_buckets")
    )
    l = (
        left.join(h, key, "left")
        .withColumn("_salt", F.explode(F.when(
            F.col("_buckets").isNotNull(),
            F.sequence(F.lit(0).cast("bigint"), (F.col("_buckets") - 1).cast("bigint")))
            .otherwise(F.array(F.lit(0).cast("bigint")))))
        .drop("_buckets")
    )
    return l.join(r, [key, "_salt"]).drop("_salt")


def grid_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner equi-join on ``key`` whose output per key is the product of both
    sides: a hot key's rows are dealt to B buckets on either side and every
    pair of buckets is a task's work of its own, so no task takes more than
    threshold x threshold pairs. Each pair is produced exactly once."""
    if hot is None:
        return left.join(right, key)
    b = F.coalesce("_buckets", F.lit(1)).cast("bigint")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        at = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), b)
        return (df.join(hot, key, "left").withColumn(own, at)
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), b - 1))).drop("_buckets"))

    return dealt(left, "_i", "_j").join(dealt(right, "_j", "_i"), [key, "_i", "_j"]).drop("_i", "_j")


BROADCAST_MAX_BYTES = 64 << 20


def _width(value, kind) -> F.Column:
    """Bytes of a value: those of its text or elements, 16 for anything of fixed size."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, ArrayType):
        each = F.aggregate(value, F.lit(0).cast("bigint"), lambda s, x: s + _width(x, kind.elementType))
        return F.coalesce(each, F.lit(0)) + 16
    if isinstance(kind, (MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)).cast("bigint") + 16
    return F.lit(16).cast("bigint")


def table_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df`` as measured: 32 a row and the width of every value."""
    row = F.lit(32).cast("bigint")
    for field in df.schema:
        row = row + _width(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.sum(row)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its measured bytes (:func:`table_bytes`) are at
    most ``max_bytes``; a larger table is left to a shuffle join. ``df`` should be
    persisted or checkpointed, as the measuring runs it once."""
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df
