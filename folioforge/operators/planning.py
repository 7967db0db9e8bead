"""Chunks, shards, samples and dispatch order."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.rules import seeded_rank
from folioforge.functions.text import SPACE, estimate_py

#: Tokens at which a shard is closed, and that it never exceeds by taking another segment (fixed values).
TARGET, HARD = 30_000, 60_000


def pack_shards(df: DataFrame, group: str, order: list[str], tokens: str, target: int = TARGET, hard: int = HARD) -> DataFrame:
    """group, order columns, tokens, shard (from 1 in each group): segments in order; a shard is closed when it has
    ``target`` tokens or when the next segment would bring it over ``hard``.

    The rule looks back without bound, so that a group is folded in order. Groups are folded in parallel; each fold
    streams over its sorted rows with one number of state and reads no text.
    """
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__g"), *dict.fromkeys([group, *order, tokens]))
    names = list(dict.fromkeys([group, *order, tokens]))
    types = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group_now, shard, now = None, 0, 0
        for b in it:
            out = []
            for g, x in zip(b["__g"], b[tokens]):
                x = 0 if pd.isna(x) else int(x)
                if g != group_now:
                    group_now, shard, now = g, 1, 0
                elif now and (now >= target or now + x > hard):
                    shard, now = shard + 1, 0
                now += x
                out.append(shard)
            yield b[names].assign(shard=out)

    # one sorted stream per partition in place of one pandas frame per group: no group has to fit in memory
    parts = rows.repartition("__g").sortWithinPartitions("__g", *order)
    return parts.mapInPandas(run, f"{types}, shard int")


def stratified_sample(units: DataFrame, stratum: str, unit: str, seed: int, fraction: float, least: int = 1) -> DataFrame:
    """All columns with selected and inclusion_probability: of each stratum the ``max(least, ceil(n * fraction))`` units
    with the lowest seeded hash.

    The border is found in a histogram over the hash (4,096 buckets a stratum); only the bucket in which it lies is
    ranked, so that no stratum is sorted in one task.
    """
    x = units.withColumn("__h", seeded_rank(F.lit(seed), F.coalesce(F.col(unit).cast("string"), F.lit("")))).withColumn("__b", F.substring("__h", 1, 3))
    hist = x.groupBy(stratum, "__b").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(stratum)
    hist = hist.select(stratum, "__b", F.coalesce(F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(w).alias("__all"), "__n")
    take = F.least(F.col("__all"), F.greatest(F.lit(least), F.ceil(F.col("__all") * F.lit(fraction))))
    hist = hist.withColumn("__take", take)
    j = x.join(hist, x[stratum].eqNullSafe(hist[stratum]) & (x["__b"] == hist["__b"])).drop(hist[stratum]).drop(hist["__b"])
    rank = F.col("__before") + F.row_number().over(Window.partitionBy(stratum, "__b").orderBy("__h", unit))
    return j.withColumn("selected", rank <= F.col("__take")).withColumn("inclusion_probability", F.round(F.col("__take") / F.col("__all"), 6)).drop("__h", "__b", "__before", "__all", "__n", "__take")


def char_windows(df: DataFrame, key: str, text: str, window: int, overlap: int) -> DataFrame:
    """Overlapping windows of characters: key, window_no (from 0), start (from 0), piece. Blank pieces fall out."""
    n, step = F.length(text), window - overlap
    last = F.greatest(F.lit(0), F.ceil((n - window) / F.lit(step)).cast("int"))
    w = df.where(F.length(F.trim(text)) > 0).select(key, text, F.explode(F.sequence(F.lit(0), last)).alias("window_no"))
    return w.select(key, "window_no", (F.col("window_no") * step).alias("start"), F.regexp_replace(F.substring(F.col(text), F.col("window_no") * step + 1, F.lit(window)), f"^[{SPACE}]+|[{SPACE}]+$", "").alias("piece")).where("piece <> ''")


def split_paragraphs(text: str | None, limit: int) -> list[str]:
    """Chunks of whole paragraphs up to ``limit`` tokens; longer paragraphs are cut into overlapping windows whose width
    follows from the token estimate, so that no chunk exceeds the limit."""
    text = re.sub(r"\r\n?", "\n", text or "").strip()
    if not text or estimate_py(text) <= limit:
        return [text] if text else []
    out: list[str] = []
    now: list[str] = []
    size = 0
    for p in (x.strip() for x in re.split(r"\n\s*\n+", text)):
        if not p:
            continue
        n = estimate_py(p)
        if n > limit:
            if now:
                out.append("\n\n".join(now))
                now, size = [], 0
            out.extend(_windows(p, limit))
        elif now and size + n > limit:
            out.append("\n\n".join(now))
            now, size = [p], n
        else:
            now.append(p)
            size += n
    return out + (["\n\n".join(now)] if now else [])


def _windows(p: str, limit: int) -> list[str]:
    width = max(1, int(len(p) * limit / estimate_py(p) * 0.9))
    overlap = min(width // 3, min(1200, max(200, width // 20)))
    out, a = [], 0
    while a < len(p):
        b = min(len(p), a + width)
        while b > a + 1 and estimate_py(p[a:b]) > limit:
            b -= max(1, (b - a) // 20)
        if piece := p[a:b].strip():
            out.append(piece)
        if b >= len(p):
            break
        a = max(a + 1, b - overlap)
    return out


def split_text(df: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """key, chunk_no (from 1), chunk, tokens."""
    kind = df.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            rows = [(k, i + 1, c, estimate_py(c)) for k, t in zip(b[key], b["__t"]) for i, c in enumerate(split_paragraphs(t, limit))]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "chunk", "tokens"])

    return df.select(key, F.col(text).alias("__t")).mapInPandas(run, f"`{key}` {kind}, chunk_no int, chunk string, tokens bigint")


def even_sample(df: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """Of each group the rows at ``k`` evenly spaced places of its order (all rows where it has at most k)."""
    w = Window.partitionBy(group)
    x = df.withColumn("i", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count("*").over(w))
    hit = F.floor((F.col("i") + 1) * k / F.col("n")) > F.floor(F.col("i") * k / F.col("n"))
    return x.where((F.col("n") <= k) | hit).drop("i", "n")


def recommended_workers(tokens: Column) -> Column:
    return F.when(tokens < 40_000, "1").when(tokens < 150_000, "2-4").when(tokens < 500_000, "4-8").otherwise("index-and-sample-first")
