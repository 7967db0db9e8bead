"""Spreading small inputs over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many tasks as the cluster has cores, for Python work on few input splits.

    Input that already has that many splits is left alone, so that large tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
