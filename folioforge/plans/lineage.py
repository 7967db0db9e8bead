"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the reliable checkpoint folder and read from there.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset and the master is local
    (tests) a temporary folder is made.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="folioforge-")
        sc.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows: the check that stands before each broadcast."""
    return df.limit(rows + 1).count() <= rows
