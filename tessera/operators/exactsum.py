"""Sums and means of doubles that do not depend on partitioning or order.

A double is an integer times 2^-1074. Its magnitude is cut into digits of 32
bits on that fixed grid; the digits are summed as exact decimals per key and
place, in each task before the shuffle, and the places of a key (67 at most)
are put together as one integer and rounded once, to the nearest double (ties
to even). So the result is the correctly rounded sum, bit for bit the same
under any partitioning, and small values survive beside 1E78.

Nulls take no part. A key without values has null sum and mean and count 0. NaN,
or infinities of both signs, give NaN; else an infinity gives itself. A sum
beyond the doubles is infinite, its mean need not be. The sum -0.0 is 0.0. A hot
key sends at most 67 rows per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Exponent of the smallest double above 0, and bits of a digit.
LOWEST, BITS = 1074, 32

#: Places that stand for values without digits: NaN, the infinities, and the count.
NAN, PLUS, MINUS, COUNT = -1, -2, -3, -4


def _digits(x: F.Column) -> F.Column:
    """``[(place, digit)]`` of the double ``x``, and its 1 for the count."""
    size = F.abs(x)
    # the logarithm may be rounded to the next place: one more on either side; 53 bits meet three places
    top = F.floor((F.log2(size) + LOWEST) / BITS).cast("int")
    sign = F.when(x < 0, -1).otherwise(1)

    def digit(j):
        whole = (size / F.pow(F.lit(2.0), (j * BITS - LOWEST).cast("double"))) % float(1 << BITS)
        return F.struct(j.alias("place"), ((whole - whole % 1.0).cast("bigint") * sign).alias("digit"))

    def mark(place):
        return F.array(F.struct(F.lit(place).alias("place"), F.lit(1).cast("bigint").alias("digit")))

    places = F.sequence(F.greatest(top - 3, F.lit(0)), F.greatest(top + 1, F.lit(0)))
    value = (F.when(F.isnan(x), mark(NAN)).when(x == float("inf"), mark(PLUS)).when(x == float("-inf"), mark(MINUS))
             .when(size > 0, F.filter(F.transform(places, digit), lambda d: d["digit"] != 0)))
    return F.when(x.isNotNull(), F.concat(F.coalesce(value, F.array().cast("array<struct<place:int,digit:bigint>>")),
                                          mark(COUNT)))


def round_once(places: Iterable[tuple[int, int]]) -> tuple[int, float | None, float | None]:
    """``(n, sum, mean)`` from the summed digits of one key."""
    total = {p: int(d) for p, d in places}
    n = total.get(COUNT, 0)
    if not n:
        return 0, None, None
    if NAN in total or (PLUS in total and MINUS in total):
        return n, float("nan"), float("nan")
    if PLUS in total or MINUS in total:
        x = float("inf") if PLUS in total else float("-inf")
        return n, x, x
    units = sum(d << (BITS * p) for p, d in total.items() if p >= 0)
    return n, _nearest(Fraction(units, 1 << LOWEST)), _nearest(Fraction(units, n << LOWEST))


def _nearest(x: Fraction) -> float:
    try:
        return x.numerator / x.denominator
    except OverflowError:
        return float("inf") if x > 0 else float("-inf")


def exact_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(*keys, n, sum, mean)`` of the double column ``value``; null keys are a key."""
    keys = list(keys)
    taken = df.select(*keys, F.explode_outer(_digits(F.col(value).cast("double"))).alias("_d"))
    sums = taken.groupBy(*keys, F.col("_d.place").alias("_place")).agg(
        F.sum(F.col("_d.digit").cast("decimal(20,0)")).alias("_digit"))
    each = sums.groupBy(*keys).agg(F.collect_list(F.when(F.col("_place").isNotNull(), F.struct(
        "_place", F.col("_digit").cast("string").alias("_digit")))).alias("_all"))

    def batches(frames):
        import pandas as pd

        for frame in frames:
            found = [round_once((d["_place"], int(d["_digit"])) for d in places) for places in frame.pop("_all")]
            out = pd.DataFrame(index=frame.index)
            for name in keys:
                out[name] = frame[name]
            out["n"] = [f[0] for f in found]
            for at, name in ((1, "sum"), (2, "mean")):
                # pandas takes NaN for null; text keeps both
                out[name] = [None if f[at] is None else repr(f[at]) for f in found]
            yield out

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in each.schema if f.name in keys]
    return each.mapInPandas(batches, ", ".join(kinds + ["n long", "sum string", "mean string"])).select(
        *keys, "n", F.col("sum").cast("double").alias("sum"), F.col("mean").cast("double").alias("mean"))
