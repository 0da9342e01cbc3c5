"""Survey salary analytics: cleaning, annualisation and per-country
statistics.

The reference's observable behaviour (int32 wrap-around, overflowing
salaries vanishing from min/max but not from the average, unparseable
salaries averaged as 0.0) is available with ``compat=True``; the
default computes the intended statistics on 64-bit integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_up, to_double, to_int32, wrap_int32

# Salary-period multipliers to a yearly amount.
PERIOD_FACTOR = {"Monthly": 12, "Weekly": 52}
MISSING = "NA"
ZERO = "0"
YEARLY = "Yearly"


def strip_thousands(df: DataFrame, col: str = "Salary") -> DataFrame:
    """Remove every thousands separator from the salary text."""
    return df.withColumn(col, F.regexp_replace(col, ",", ""))


def clean_salary_rows(df: DataFrame) -> DataFrame:
    """Rows whose salary text is neither ``NA`` nor ``0``.

    The test is textual (``0.0`` passes) and null salaries drop out, as
    with SQL three-valued logic.
    """
    df = strip_thousands(df)
    return df.filter((F.col("Salary") != MISSING) & (F.col("Salary") != ZERO))


def normalise_salary_type(df: DataFrame, substring: bool = False) -> DataFrame:
    """Read a missing salary type as ``Yearly``.

    ``substring=True`` replaces ``NA`` anywhere in the text, like the
    reference's regular-expression replace.
    """
    if substring:
        expr = F.regexp_replace("SalaryType", MISSING, YEARLY)
    else:
        expr = F.when(F.col("SalaryType") == MISSING, F.lit(YEARLY)).otherwise(F.col("SalaryType"))
    return df.withColumn("SalaryType", expr)


def yearly_salary_rows(clean: DataFrame) -> DataFrame:
    return normalise_salary_type(clean).filter(F.col("SalaryType") == YEARLY)


def _annual(x, salary_type, as_double: bool):
    out = x
    for period, factor in PERIOD_FACTOR.items():
        k = F.lit(float(factor)) if as_double else F.lit(factor).cast("bigint")
        out = F.when(salary_type == period, x * k).otherwise(out)
    return out


def annualise(clean: DataFrame) -> DataFrame:
    """Add the integer and the double salary tracks, both per year.

    ``salary_int``: int32 parse (fraction truncated), zero and
    unparseable values null, annualised in 64 bits.
    ``salary_int32``: the same value wrapped to 32 bits as the
    reference's integer multiply does.
    ``salary_double``: double parse, annualised; null when unparseable.
    """
    st = F.col("SalaryType")
    i = to_int32("Salary")
    i = F.when(i != 0, i.cast("bigint"))
    annual_int = _annual(i, st, as_double=False)
    return clean.select(
        "resp_id", "Country", "SalaryType",
        annual_int.alias("salary_int"),
        wrap_int32(annual_int).alias("salary_int32"),
        _annual(to_double("Salary"), st, as_double=True).alias("salary_double"),
    )


def country_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("Country").agg(F.count(F.lit(1)).alias("n"))


def country_counts_with_total(clean: DataFrame, total_label: str = "Total") -> DataFrame:
    """Per-country counts plus a grand-total row, in one aggregation.

    ``rollup`` computes both levels from the same partial aggregates, so
    the input is scanned and shuffled once. The total row sorts first.
    """
    agg = clean.rollup("Country").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("Country").alias("is_total")
    )
    return (
        agg.select(
            F.when(F.col("is_total") == 1, F.lit(total_label)).otherwise(F.col("Country")).alias("Country"),
            "n",
            "is_total",
        )
        .orderBy(F.col("is_total").desc(), F.col("Country"))
        .drop("is_total")
    )


def country_salary_stats(clean: DataFrame, compat: bool = True) -> DataFrame:
    """``(Country, n, min_salary, max_salary, avg_salary)`` in one pass.

    compat: min/max on the wrapped int32 track; countries with no
    usable integer salary disappear (the reference's inner joins);
    average over the double track with unparseable salaries counted as
    0.0, rounded half-up to 2 decimals.
    default: min/max on 64-bit integers, unparseable salaries left out
    of the average, every country kept.
    """
    a = annualise(clean)
    if compat:
        track = F.col("salary_int32")
        avg_input = F.coalesce(F.col("salary_double"), F.lit(0.0))
    else:
        track = F.col("salary_int")
        avg_input = F.col("salary_double")
    out = a.groupBy("Country").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(track).alias("min_salary"),
        F.max(track).alias("max_salary"),
        round_half_up(F.avg(avg_input), 2).alias("avg_salary"),
        F.count(track).alias("_n_int"),
    )
    if compat:
        out = out.filter(F.col("_n_int") > 0)
    return out.drop("_n_int")


def country_salary_minmax(clean: DataFrame, compat: bool = True) -> DataFrame:
    return country_salary_stats(clean, compat).select("Country", "min_salary", "max_salary")


def country_salary_avg(clean: DataFrame, compat: bool = True) -> DataFrame:
    return country_salary_stats(clean, compat).select("Country", "avg_salary")


def country_salary_summary(clean: DataFrame, compat: bool = True) -> DataFrame:
    return country_salary_stats(clean, compat).orderBy("Country")
