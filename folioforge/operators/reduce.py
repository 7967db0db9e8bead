"""Merging candidates: fuzzy first-come deduplication in a fixed order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of the beginning that make two texts one, of the part that is compared, and the ratio (fixed values).
HEAD, PART, RATIO, LEAST = 120, 1200, 0.92, 80


def plain(text: str | None) -> str:
    return re.sub(r"[^\w]", "", (text or "").lower())


def repeats(text: str, accepted: list[str]) -> bool:
    """Whether a plain text is empty, begins as an accepted one does, or is nearly the same in its first part."""
    if not text:
        return True
    for other in accepted:
        if text[:HEAD] == other[:HEAD]:
            return True
        if min(len(text), len(other)) > LEAST:
            m = SequenceMatcher(None, text[:PART], other[:PART])
            if m.real_quick_ratio() >= RATIO and m.quick_ratio() >= RATIO and m.ratio() >= RATIO:
                return True
    return False


def reduce_fuzzy(df: DataFrame, group: str, key: str, text: str, order: list[str], most: int = 60) -> DataFrame:
    """(group, key, place): of each group, in order, the texts that repeat none accepted before, up to ``most``.

    Each partition streams over its groups in order and holds the accepted texts of one group only, at most ``most``.
    Null groups are one group; null and wordless texts are left out.
    """
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__g"), group, key, F.col(text).alias("__t"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)])
    kinds = [df.schema[c].dataType.simpleString() for c in (group, key)]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, accepted = None, []
        for b in it:
            out = []
            for g, own, k, t in zip(b["__g"], b[group], b[key], b["__t"]):
                if g != now:
                    now, accepted = g, []
                p = plain(t)
                if len(accepted) < most and not repeats(p, accepted):
                    accepted.append(p)
                    out.append((own, k, len(accepted)))
            yield pd.DataFrame(out, columns=[group, key, "place"])

    parts = rows.repartition("__g").sortWithinPartitions("__g", *[f"__o{i}" for i in range(len(order))])
    return parts.mapInPandas(run, f"`{group}` {kinds[0]}, `{key}` {kinds[1]}, place int")
