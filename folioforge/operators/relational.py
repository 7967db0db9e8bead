"""Relational shapes that many operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.plans.lineage import cut


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; ``order`` must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their rank. Spark prunes each partition to ``k`` rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Numbers all rows from 1 in ``order`` without putting them in one task.

    Rows are range-partitioned and sorted; only the partitions' sizes meet in one place.
    """
    # written once: a second evaluation might cut the ranges elsewhere
    sorted_ = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()))
    local = sorted_.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*order)))
    sizes = local.groupBy("__p").agg(F.max("__i").alias("__n"))
    starts = sizes.withColumn("__s", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(starts.select("__p", "__s")), "__p").withColumn(name, F.col("__s") + F.col("__i")).drop("__p", "__i", "__s")


def positional_zip(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str], how: str = "inner") -> DataFrame:
    """Row i of ``left`` beside row i of ``right``; ``inner`` ends with the shorter side, ``left`` keeps the left one."""
    return number_rows(left, left_order).join(number_rows(right, right_order), "row_no", how)


def outer_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of only one side: key, side."""
    a, b = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("in_left", F.lit(True)), right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.where("in_left is null or in_right is null").select(key, F.when(F.col("in_left"), "left_only").otherwise("right_only").alias("side"))


def first_match(df: DataFrame, value: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule (glob, label) that matches; globs know ``*`` and ``?``. The rules are a fixed list,
    so that the choice is one CASE expression and no join."""
    out: Column | None = None
    for glob, label in rules:
        rx = "^" + "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if c in ".+()[]{}^$|\\" else c for c in glob) + "$"
        cond = value.rlike("(?s)" + rx)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return (out.otherwise(F.lit(default)) if out is not None else F.lit(default)).cast("string")


def longest_match(path: Column, rules: list[tuple[str, bool]]) -> Column:
    """Whether the longest rule (prefix pattern with ``*`` and a closing ``$``, allow) that matches allows ``path``;
    of equally long ones the allowing one counts, and no match allows."""
    matched = []
    for pattern, allow in rules:
        body = pattern[:-1] if pattern.endswith("$") else pattern
        rx = "^" + "".join(".*" if c == "*" else "\\" + c if c in ".+?()[]{}^$|\\" else c for c in body) + ("$" if pattern.endswith("$") else "")
        matched.append(F.when(path.rlike("(?s)" + rx), F.struct(F.lit(len(pattern)).alias("n"), F.lit(allow).alias("allow"))))
    best = F.array_max(F.array_compact(F.array(*matched)))
    return F.coalesce(best["allow"], F.lit(True))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def upper_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, upper_median): the value at place ``n // 2 + 1`` of each group's values in order. Equal values are counted
    first, so that no group is collected; nulls do not count."""
    n = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    every = F.sum("__n").over(Window.partitionBy(group))
    at = n.select(group, value, upto.alias("__upto"), every.alias("__all")).where(F.col("__upto") > F.floor(F.col("__all") / 2))
    return at.groupBy(group).agg(F.min(value).alias("upper_median"))


def concentration(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct values, the most frequent one (of ties the least), its share, and the sum of squared shares.

    Nulls do not count; an empty input gives 0, null, 0, 0. Two levels of partial aggregation.
    """
    n = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    t = n.agg(F.count("*").alias("distinct_sources"), F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top_source"), F.max("n").alias("top"), F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    share = lambda a, b: F.coalesce(F.round(a.cast("double") / b, 9), F.lit(0.0))
    return t.select("distinct_sources", "top_source", share(F.col("top"), F.col("total")).alias("top_share"), share(F.col("squares"), F.col("total") * F.col("total")).alias("hhi"))


def ordered_hash(df: DataFrame, parts: list[Column], by: str | None = None) -> DataFrame:
    """Fingerprint of a set of rows: SHA-256 over the sorted hashes of the rows, in two levels, so that no task holds more
    than one of 4,096 buckets of hashes. ``by`` makes one fingerprint per value."""
    line = F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    keys = [by] if by else []
    h = df.select(*keys, F.sha2(line, 256).alias("h"))
    buckets = h.groupBy(*keys, F.substring("h", 1, 3).alias("b")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("h"), F.count("*").alias("n"))
    return buckets.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""), 256).alias("fingerprint"), F.sum("n").alias("files"))
