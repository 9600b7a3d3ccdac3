"""Session settings and input spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "tokenloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that has fewer partitions than the cluster has cores, ahead of work that is bound by computing.

    A table of many partitions, the normal case at scale, is left alone and costs no shuffle. ``df`` must be a plain
    scan: asking a plan with shuffles for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
