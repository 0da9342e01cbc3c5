"""Input shapes of the four workloads, derived from the driver tables.

Each function returns the long-format DataFrame an operator consumes.
They are plain joins and projections, so they scale with the tables and
the oracle SQL (``tessera.plans.oracle``) can state the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


def salary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey responses ``(resp_id, Country, Salary, SalaryType)``.

    Salary is free text with thousands separators and the missing,
    zero, overflow, garbage, decimal and very large spellings of the survey
    data.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    salary = (
        F.when(k == 5, F.lit("1E78"))
        .when(k == 6, F.lit("1E39"))
        .when(k == 10, F.lit("NaN"))
        .when(k == 11, F.lit("Infinity"))
        .when(k % 23 == 0, F.lit("NA"))
        .when(k % 29 == 0, F.lit("0"))
        .when(k % 31 == 0, F.lit("0.0"))
        .when(k % 37 == 0, F.lit("240,000,000"))
        .when(k % 41 == 0, F.lit("99,999,999,999"))
        .when(k % 43 == 0, F.lit("abc"))
        .when(k % 47 == 0, F.lit("1000.50"))
        .otherwise(F.format_number(F.floor("o_totalprice").cast("bigint"), 0))
    )
    salary_type = (
        F.when(k % 4 == 0, F.lit("Yearly"))
        .when(k % 4 == 1, F.lit("Monthly"))
        .when(k % 4 == 2, F.lit("Weekly"))
        .otherwise(F.lit("NA"))
    )
    # nation has 25 rows whatever the scale: a fixed-size broadcast.
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("resp_id"),
            F.col("n_name").alias("Country"),
            salary.alias("Salary"),
            salary_type.alias("SalaryType"),
        )
    )


def basket_items(spark: SparkSession, sf_dir: str, item_col: str = "p_type") -> DataFrame:
    """``(basket_id, item)`` lines: an order is a basket of part types.

    Lines may repeat; :func:`tessera.operators.itemsets.clean_basket_items`
    trims and de-duplicates them."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(item_col).alias("item"))
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("basket_id"), "item")
    )


def document_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(basket_id, item)`` lines: a document is a basket of its words
    (single-space split, full stops and commas removed)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    word = F.explode(F.split("text", " "))
    return docs.select(F.col("doc_id").alias("basket_id"), word.alias("item")).select(
        "basket_id", F.regexp_replace("item", "[.,]", "").alias("item"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense points ``(id, v array<double>)`` from the embeddings table."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
    )


def is_test_rating(user: Column, item: Column) -> Column:
    """Deterministic one-in-five test split on the rating key."""
    return (user * 31 + item) % 5 == 0


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ratings ``(user, item, rating)`` in half stars 0.5..5.

    A customer's rating of a part is derived from the largest quantity
    they ordered of it.
    """
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stars = F.lit(0.5) + F.lit(0.5) * F.floor((F.col("l_quantity") - 1) / 5)
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.max(stars).alias("rating"))
    )


def ratings_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` partitions of :func:`ratings`."""
    r = ratings(spark, sf_dir)
    flag = is_test_rating(F.col("user"), F.col("item"))
    return r.filter(~flag), r.filter(flag)
