"""Readers for the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the folder ``root`` (a file or a folder of files)."""
    return spark.read.parquet(f"{root}/{name}.parquet")
