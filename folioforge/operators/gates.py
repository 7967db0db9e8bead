"""Constraint rules: each is a query that returns violating rows (gate, code, severity, subject, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rows(df: DataFrame, gate: str, code: str, subject: Column, detail: Column, severity: str) -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail"))


def required(df: DataFrame, gate: str, key: str, columns: list[str], severity: str = "error") -> DataFrame:
    """MISSING_FIELD: null or blank values, one row per field, in one pass."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in columns]))
    x = df.select(F.col(key).alias("k"), F.explode(missing).alias("f"))
    return _rows(x, gate, "MISSING_FIELD", F.col("k"), F.col("f"), severity)


def in_range(df: DataFrame, gate: str, key: str, column: str, low: float, high: float, severity: str = "error") -> DataFrame:
    return _rows(df.where((F.col(column) < low) | (F.col(column) > high)), gate, "INVALID_VALUE", F.col(key), F.lit(column), severity)


def one_of(df: DataFrame, gate: str, key: str, column: str, values: list[str], severity: str = "error") -> DataFrame:
    return _rows(df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)), gate, "UNKNOWN_VALUE", F.col(key), F.concat(F.lit(column + "="), F.col(column)), severity)


def unique(df: DataFrame, gate: str, column: str, severity: str = "error") -> DataFrame:
    n = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return _rows(n, gate, "DUPLICATE_ID", F.col(column), F.col("n"), severity)


def per_group(df: DataFrame, gate: str, group: str, least: int, most: int | None = None, severity: str = "error") -> DataFrame:
    n = df.groupBy(group).agg(F.count("*").alias("n"))
    few = _rows(n.where(F.col("n") < least), gate, "TOO_FEW", F.col(group), F.col("n"), severity)
    return few if most is None else few.unionByName(_rows(n.where(F.col("n") > most), gate, "TOO_MANY", F.col(group), F.col("n"), severity))


def orphan(df: DataFrame, gate: str, column: str, other: DataFrame, other_column: str, severity: str = "error") -> DataFrame:
    """DANGLING: values that the other table does not have, each once."""
    x = df.select(column).where(F.col(column).isNotNull()).distinct().join(other.select(F.col(other_column).alias(column)), column, "left_anti")
    return _rows(x, gate, "DANGLING", F.col(column), F.lit(column), severity)


def violates(df: DataFrame, gate: str, code: str, key: str, cond: Column, detail: Column, severity: str = "error") -> DataFrame:
    return _rows(df.where(cond), gate, code, F.col(key), detail, severity)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
