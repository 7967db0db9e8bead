"""Sample that follows target shares of categories (problem 6).

One pass keeps, per partition and category, a reservoir of the units with the lowest seeded hash and the counts of all
units. Reservoirs merge: a unit beyond a partition's quota is beyond the quota of the whole. The final counts tell which
categories are exhausted and what quotas are feasible: the quotas are trimmed to them, by one factor for all categories
where the shares are to be kept exactly, and the reservoirs with them. A histogram over the hash then finds the bucket in
which each quota ends; buckets below it are taken whole and only that bucket is sorted, so that no category, however
large, comes into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import estimate

#: Hex digits of the hash that number the buckets of the histogram.
BUCKET_DIGITS = 3
PASS_SCHEMA = "config_id bigint, stratum_key string, kind string, unit_id string, segment_id bigint, priority string, tokens bigint, units bigint"


def units_of(segments: DataFrame) -> DataFrame:
    """Each unit once: unit_id, lowest segment_id, first stratum_key that is not null or blank, estimate of its text.

    Rows without a unit_id are units of their own. Repeated rows of a unit meet in a partial aggregation.
    """
    unit = F.coalesce(F.col("unit_id"), F.concat(F.lit("#"), F.col("segment_id").cast("string")))
    rows = segments.select(unit.alias("unit_id"), "segment_id", F.when(F.trim("stratum_key") != "", F.col("stratum_key")).alias("stratum_key"), estimate(F.col("text")).alias("tokens"))
    return rows.groupBy("unit_id").agg(F.min("segment_id").alias("segment_id"), F.min_by("stratum_key", F.when(F.col("stratum_key").isNotNull(), F.col("segment_id"))).alias("stratum_key"), F.max("tokens").alias("tokens"))


def priority(seed: Column, unit: Column) -> Column:
    return F.substring(F.sha2(F.concat(seed.cast("string"), F.lit(":"), unit), 256), 1, 16)


def quotas(targets: DataFrame, configs: DataFrame) -> DataFrame:
    """config_id, stratum_key, quota in tokens, least number of units, seed. Null shares, budgets and minima count as 0."""
    c = configs.select("config_id", "seed", F.coalesce("representative_max_tokens", F.lit(0)).alias("budget"), F.coalesce("minimum_units_per_stratum", F.lit(0)).alias("least"))
    t = targets.where(F.col("stratum_key").isNotNull()).groupBy("config_id", "stratum_key").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"))
    return t.join(c, "config_id").select("config_id", "stratum_key", "seed", "target_share", (F.col("target_share") * F.col("budget")).alias("quota"), "least")


def one_pass(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of kind ``unit`` (the partitions' reservoirs) and ``total`` (the partitions' counts)."""
    ranked = units.where(F.col("stratum_key").isNotNull()).join(wanted, "stratum_key").select("config_id", "stratum_key", "quota", "least", "unit_id", "segment_id", priority(F.col("seed"), F.col("unit_id")).alias("priority"), "tokens")

    names = ["config_id", "stratum_key", "kind", "unit_id", "segment_id", "priority", "tokens", "units"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = trimmed = 0
        # of each category the greatest hash that its reservoir still holds, once it is full
        limit: dict[tuple[int, str], str] = {}
        counts: dict[tuple[int, str], list[int]] = {}
        for b in batches:
            if b.empty:
                continue
            key = list(zip(b["config_id"], b["stratum_key"]))
            for k, t in zip(key, b["tokens"]):
                x = counts.setdefault(k, [0, 0])
                x[0] += 1
                x[1] += t
            b = b[[p <= limit.get(k, "g") for k, p in zip(key, b["priority"])]]  # hashes are hex digits, all below g
            held.append(b)
            size += len(b)
            if size > 2 * trimmed + 5_000:  # sorted again only when it has doubled
                held = [trim(pd.concat(held, ignore_index=True), limit)]
                size = trimmed = len(held[0])
        if held:
            yield trim(pd.concat(held, ignore_index=True), limit).assign(kind="unit", units=1)[names]
            totals = [(k[0], k[1], "total", None, None, None, t, n) for k, (n, t) in counts.items()]
            yield pd.DataFrame(totals, columns=names).astype({"segment_id": "Int64"})

    def trim(rows: pd.DataFrame, limit: dict[tuple[int, str], str]) -> pd.DataFrame:
        rows = rows.sort_values(["config_id", "stratum_key", "priority", "unit_id"], kind="stable")
        g = rows.groupby(["config_id", "stratum_key"])
        before = g.tokens.cumsum() - rows.tokens
        fits = (before < rows.quota) | (g.cumcount() < rows.least)
        kept = rows[fits]
        full = rows[~fits][["config_id", "stratum_key"]].drop_duplicates()
        last = kept.groupby(["config_id", "stratum_key"]).priority.last()
        for k in zip(full["config_id"], full["stratum_key"]):
            limit[k] = last.get(k, "")
        return kept.reset_index(drop=True)

    return ranked.mapInPandas(run, PASS_SCHEMA)


def feasible(passed: DataFrame, wanted: DataFrame, keep_shares: bool = False) -> DataFrame:
    """``wanted`` with what there is (units, tokens) and the quota that can be met after the final counts.

    A category that has fewer tokens than its quota is exhausted: all of it is taken. The others keep their quotas, so that
    the budget is used as far as it goes; with ``keep_shares`` all quotas of a configuration are scaled by one factor, that
    of the scarcest category that has any units, so that the drawn shares are the target ones.
    """
    have = passed.where("kind = 'total'").groupBy("config_id", "stratum_key").agg(F.sum("units").alias("units"), F.sum("tokens").alias("tokens"))
    joined = wanted.join(have, ["config_id", "stratum_key"], "left").fillna(0, ["units", "tokens"])
    if keep_shares:
        scarce = joined.where("quota > 0 and tokens > 0").groupBy("config_id").agg(F.least(F.lit(1.0), F.min(F.col("tokens") / F.col("quota"))).alias("factor"))
        joined = joined.join(F.broadcast(scarce), "config_id", "left")  # one row a configuration
    else:
        joined = joined.withColumn("factor", F.lit(1.0))
    return joined.withColumn("feasible", F.least(F.col("quota") * F.coalesce("factor", F.lit(1.0)), F.col("tokens").cast("double"))).drop("factor")


def report(passed: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per target: what there is, what is wanted, and why it cannot be met (null where it can)."""
    few_tokens, few_units = F.col("tokens") < F.col("quota"), F.col("units") < F.col("least")
    reason = F.when(few_tokens & few_units, "too few tokens and units").when(few_tokens, "too few tokens").when(few_units, "too few units")
    f = feasible(passed, wanted)
    return f.select("config_id", "stratum_key", "target_share", "quota", F.col("least").alias("minimum_units"), "units", "tokens", reason.alias("reason"))


def draw(passed: DataFrame, wanted: DataFrame, keep_shares: bool = False) -> DataFrame:
    """The sample: config_id, stratum_key, unit_id, segment_id, tokens. Of each category the units with the lowest hash
    whose running total stays within the feasible quota, but at least the least number of units (all, where it has fewer)."""
    key = ["config_id", "stratum_key"]
    quota = feasible(passed, wanted, keep_shares).select(*key, F.col("feasible").alias("quota"), "least")
    rows = passed.where("kind = 'unit'").withColumn("bucket", F.substring("priority", 1, BUCKET_DIGITS))
    hist = rows.groupBy(*key, "bucket").agg(F.sum("tokens").alias("bt"), F.count("*").alias("bn"))
    w = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for c, n in (("bt", "t0"), ("bn", "n0"))]
    hist = hist.select(*key, "bucket", "bt", "bn", *before).join(quota, key)
    open_ = hist.where((F.col("t0") < F.col("quota")) | (F.col("n0") < F.col("least")))
    whole = (F.col("t0") + F.col("bt") <= F.col("quota")) | (F.col("n0") + F.col("bn") <= F.col("least"))
    got = rows.join(open_.withColumn("whole", whole), [*key, "bucket"])
    taken = got.where("whole").select(*key, "unit_id", "segment_id", "tokens")
    inner = Window.partitionBy(*key, "bucket").orderBy("priority", "unit_id")
    upto = F.col("t0") + F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    last = got.where("not whole").withColumn("upto", upto).withColumn("rank", F.col("n0") + F.row_number().over(inner))
    return taken.unionByName(last.where((F.col("upto") <= F.col("quota")) | (F.col("rank") <= F.col("least"))).select(*key, "unit_id", "segment_id", "tokens"))


def reached(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Of every row of :func:`report` what the sample has: drawn_units, drawn_tokens, and its share of the configuration's
    drawn tokens."""
    got = drawn.groupBy("config_id", "stratum_key").agg(F.count("*").alias("drawn_units"), F.sum("tokens").alias("drawn_tokens"))
    both = targets.join(got, ["config_id", "stratum_key"], "left").fillna(0, ["drawn_units", "drawn_tokens"])
    every = both.groupBy("config_id").agg(F.sum("drawn_tokens").alias("__all"))
    return both.join(F.broadcast(every), "config_id").withColumn("drawn_share", F.round(F.col("drawn_tokens") / F.greatest(F.lit(1), "__all"), 6)).drop("__all")


def invariants(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per configuration: categories, the exhausted ones, and the numbers of categories with too few units drawn,
    over their quota, exhausted but not taken whole, and of units drawn twice."""
    x = reached(drawn, targets)
    twice = drawn.groupBy("config_id", "stratum_key").agg((F.count("*") - F.countDistinct("unit_id")).alias("twice"))
    x = x.join(twice, ["config_id", "stratum_key"], "left").fillna(0, ["twice"])
    few = F.col("drawn_units") < F.least("minimum_units", "units")
    over = (F.col("drawn_tokens") > F.col("quota")) & (F.col("drawn_units") > F.col("minimum_units"))
    missed = (F.col("tokens") < F.col("quota")) & (F.col("drawn_units") < F.col("units"))
    return x.groupBy("config_id").agg(
        F.count("*").alias("categories"), F.count(F.when(F.col("tokens") < F.col("quota"), 1)).alias("exhausted"), F.count(F.when(few, 1)).alias("too_few"),
        F.count(F.when(over, 1)).alias("over_quota"), F.count(F.when(missed, 1)).alias("not_all_of_exhausted"), F.sum("twice").alias("twice"),
    )
