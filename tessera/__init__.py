"""tessera: DataFrame-first analytics on Spark.

Survey salary analytics, frequent itemsets, text clustering and
collaborative filtering, each written as DataFrame / ``pyspark.ml``
plans that Catalyst optimises and Spark distributes.
"""

from tessera.session import get_session

__all__ = ["get_session"]
