"""Session construction and cluster-safe defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. They are only applied when the
# session does not already carry a value, so a cluster's own
# configuration always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # let adaptive execution size the partitions of persisted plans too,
    # instead of keeping every cached table at the shuffle-partition count
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false")
    # remove checkpoint files once their DataFrame is garbage-collected
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = builder.getOrCreate()
    configure(spark)
    return spark


# On a cluster: start shuffles with many partitions and let adaptive
# execution coalesce them to ~128 MB by measured size, so large inputs
# never produce oversized partitions (applied only when unset).
_CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Fill in defaults that are unset; never overwrite cluster settings."""
    conf = spark.conf
    for key, value in _DEFAULTS.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        explicit = dict(sc.getConf().getAll())
        for key, value in _CLUSTER_DEFAULTS.items():
            if key not in explicit:
                conf.set(key, value)
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        if key not in explicit:
            conf.set(key, str(max(int(conf.get("spark.sql.shuffle.partitions")),
                                  4 * sc.defaultParallelism)))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names a shared file-system folder and is used
    as is. Only where it is unset and the session is local, as in tests, a
    folder below its warehouse takes its place; on a cluster an unset folder
    raises, as the warehouse may be a folder of one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def release_files(spark: SparkSession) -> None:
    """Have the driver's JVM look for plans that nothing refers to any more, upon which
    Spark removes their shuffle files. Otherwise the files of all steps of a loop stay until the
    driver's memory fills up, or for half an hour."""
    spark.sparkContext._jvm.System.gc()
