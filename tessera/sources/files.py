"""Readers for the reference's input files.

* survey CSV with a header row, every column read as text (S1/S2:
  types are never inferred; parsing is explicit, see
  :mod:`tessera.functions.numeric`);
* ``basket_id,item`` lines (S5), extra fields ignored;
* one document per text line (S3), ids in scan order (M10);
* ratings CSV with a header ``user_id,business_id,stars[,...]`` (S6).

``min_partitions`` (S4) spreads the rows round-robin; no result of this
library depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import to_double
from tessera.operators.dictionary import row_index


def _spread(df: DataFrame, min_partitions: int | None) -> DataFrame:
    return df.repartition(min_partitions) if min_partitions else df


def _counted(df: DataFrame, rejected, rejects: Observation | None) -> DataFrame:
    """``df`` with its rows (``lines``) and those that meet ``rejected`` counted in passing."""
    if rejects is None:
        return df
    return df.observe(rejects, F.count(F.lit(1)).alias("lines"), F.count_if(rejected).alias("rejected"))


def read_survey_csv(spark: SparkSession, path: str, columns=("Country", "Salary", "SalaryType"),
                    min_partitions: int | None = None) -> DataFrame:
    """Survey rows with a generated ``resp_id``; all fields are strings."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    df = df.select(*columns).withColumn("resp_id", F.monotonically_increasing_id())
    return _spread(df, min_partitions)


def read_basket_lines(spark: SparkSession, path: str, min_partitions: int | None = None,
                      rejects: Observation | None = None) -> DataFrame:
    """``(basket_id, item)`` from ``id,item`` lines, cut at each comma (quotes
    have no meaning). Lines without a comma are rejected. With ``rejects``, the first
    action on the frame that reads all of it also leaves ``lines`` and ``rejected``
    there (``rejects.get``), in the same scan; without an action there is
    :func:`count_rejected_baskets`."""
    lines = spark.read.text(path).select(F.split("value", ",").alias("p"))
    parts = _counted(lines, F.size("p") <= 1, rejects).filter(F.size("p") > 1)
    return _spread(parts.select(F.col("p")[0].alias("basket_id"), F.col("p")[1].alias("item")), min_partitions)


def count_rejected_baskets(spark: SparkSession, path: str) -> int:
    """Lines that :func:`read_basket_lines` leaves out."""
    return spark.read.text(path).filter(F.instr("value", ",") == 0).count()


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text)``: one document per line, ids 0..n-1 in scan
    order."""
    return row_index(spark.read.text(path), "doc_id").select("doc_id", F.col("value").alias("text"))


def _ratings(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).csv(path)
    u, i, r = df.columns[:3]
    return df.select(F.col(u).alias("user"), F.col(i).alias("item"), to_double(F.col(r)).alias("rating"))


def read_ratings_csv(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """``(user, item, rating)`` from a ratings CSV with a header; ids
    stay strings (encode them with :func:`tessera.operators.dictionary.dense_ids`).
    Rows without a number as rating are rejected; ``rejects`` counts them in passing
    as in :func:`read_basket_lines`, :func:`count_rejected_ratings` by a scan."""
    rows = _counted(_ratings(spark, path), F.col("rating").isNull(), rejects)
    return rows.filter(F.col("rating").isNotNull())


def count_rejected_ratings(spark: SparkSession, path: str) -> int:
    """Rows that :func:`read_ratings_csv` leaves out."""
    return _ratings(spark, path).filter(F.col("rating").isNull()).count()
