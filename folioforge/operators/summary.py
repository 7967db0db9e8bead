"""Small summaries of record tables: evidence, list fields, closed sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_summary(df: DataFrame, group: str, evidence: Column, score: Column) -> DataFrame:
    """Of each group: records, those with evidence, and the mean score (six places; null where no record has one)."""
    return df.groupBy(group).agg(F.count("*").alias("records"), F.count(F.when(evidence, 1)).alias("with_evidence"), F.round(F.avg(score), 6).alias("mean_score"))


def field_counts(df: DataFrame, key: str, lists: list[str], fields: list[str]) -> DataFrame:
    """Of each record the sizes of its list fields (null counts as empty) and how many of ``fields`` are not blank."""
    sizes = [F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}") for c in lists]
    full = sum((F.when(F.trim(F.col(c).cast("string")) != "", 1).otherwise(0) for c in fields), F.lit(0))
    return df.select(key, *sizes, full.alias("filled"))


def closed_set(df: DataFrame, group: str, key: str, exactly: int, flag: Column) -> DataFrame:
    """Whether each group has exactly so many rows, all keys different, none flagged: group, rows, keys, flagged, ok."""
    g = df.groupBy(group).agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.count(F.when(flag, 1)).alias("flagged"))
    return g.withColumn("ok", (F.col("rows") == exactly) & (F.col("keys") == F.col("rows")) & (F.col("flagged") == 0))
