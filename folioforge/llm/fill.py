"""Filling containers of fixed capacity (problem 8).

Oversized items are cut into pieces at natural boundaries first. Items and pieces are dealt by hash to blocks; each block
is packed by itself, so that the work grows with the number of items and only one container per block and level of
fullness stays partly empty. Within a block vector best-fit: each open container has a residual of tokens, of documents
and of attention cost (the sum of squared sizes); an item goes to the container with the smallest weighted norm of what
it leaves, among all open ones that hold it under every constraint.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import estimate, estimate_py
from folioforge.llm.common import spread
from folioforge.llm.split import split_text
from folioforge.llm.tokens import VOCABULARY, worker_counter

#: Items that one block holds at about; a block is packed in one task, whatever the table's size.
BLOCK = 20_000
#: Weights of the residual norm: tokens, documents, attention cost.
WEIGHTS = (1.0, 0.05, 0.05)


@dataclass(frozen=True)
class Capacity:
    """What one container holds at most. ``documents`` and ``attention`` (sum of squared sizes) bind where they are given;
    an item that is over the attention capacity by itself gets a container of its own."""

    tokens: int
    documents: int | None = None
    attention: float | None = None

    def __post_init__(self) -> None:
        if self.tokens < 1 or (self.documents is not None and self.documents < 1) or (self.attention is not None and self.attention <= 0):
            raise ValueError("capacities must be positive")


def pack(sizes: list[int], capacity: Capacity) -> list[int]:
    """Container number of each size (all between 0 and ``capacity.tokens``), largest first, by vector best-fit over all
    containers that are still open. A container is closed when not even the smallest item left fits it."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    most = capacity.documents if capacity.documents is not None else max(1, len(sizes))
    bound = float(capacity.attention) if capacity.attention is not None else np.inf
    scale = bound if np.isfinite(bound) else 1.0
    out = [0] * len(sizes)
    least = sizes[order[-1]] if order else 0
    size = 1024
    room, docs, cost, number = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
    n = made = 0  # open containers, containers at all
    for i in order:
        s = float(sizes[i])
        r = room[:n] - s
        ok = r >= 0
        if np.isfinite(bound):
            ok &= cost[:n] >= s * s
        best = -1
        at = np.flatnonzero(ok)
        if len(at):
            norm = WEIGHTS[0] * (r[at] / capacity.tokens) ** 2 + WEIGHTS[1] * ((docs[at] - 1) / most) ** 2 * (r[at] / capacity.tokens)
            if np.isfinite(bound):
                norm += WEIGHTS[2] * ((cost[at] - s * s) / scale) ** 2 * (r[at] / capacity.tokens)
            best = int(at[norm.argmin()])
        if best < 0:
            if n == size:
                size *= 2
                room, docs, cost, number = (np.resize(x, size) for x in (room, docs, cost, number))
            best, n = n, n + 1
            room[best], docs[best], cost[best], number[best] = capacity.tokens, most, bound, made
            made += 1
        room[best] -= s
        docs[best] -= 1
        cost[best] -= s * s
        out[i] = int(number[best])
        if docs[best] <= 0 or room[best] < least or cost[best] < least * least:  # closed: the last open one takes its place
            n -= 1
            for x in (room, docs, cost, number):
                x[best] = x[n]
    return out


OUT_SCHEMA = "container string, piece_no int, n_pieces int, start_pos int, end_pos int, tokens bigint, oversized boolean"


def cut(text: str, capacity: int, count: Callable[[str], int]) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of pieces of a text, each of at most ``capacity`` tokens by ``count``, without overlap and at
    natural boundaries where there are any."""
    if count is estimate_py:
        return [(a, b, estimate_py(text[a:b])) for a, b, _ in split_text(text, capacity, 0)]
    limit = max(1, int(capacity * estimate_py(text) / max(1, count(text))))
    out: list[tuple[int, int, int]] = []
    todo = [(a, b, limit) for a, b, _ in split_text(text, min(limit, capacity * 4), 0)][::-1]
    while todo:
        a, b, most = todo.pop()
        n = count(text[a:b])
        if n <= capacity or b - a == 1:
            out.append((a, b, n))
        else:  # richer in tokens than the text on the whole
            most = max(1, most // 2) if most > 1 else 0
            parts = split_text(text[a:b], most, 0) if most else [(i, i + 1, "") for i in range(b - a)]
            todo += [(a + x, a + y, most) for x, y, _ in parts][::-1]
    return out


def sized(items: DataFrame, capacity: int, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """key, piece_no, n_pieces, start_pos, end_pos, tokens of every item, or of the pieces of those larger than ``capacity``.

    Tokens are the project's estimate, or exact longest-match counts over ``vocabulary`` where one is given. Null and empty
    texts have 0 tokens and are one piece. With the estimate only oversized texts leave the JVM.
    """
    rows = items.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))

    @F.pandas_udf("array<struct<start_pos:int,end_pos:int,tokens:bigint>>")
    def cut_up(texts: pd.Series) -> pd.Series:
        count = worker_counter(vocabulary).text if vocabulary else estimate_py

        def one(t: str | None) -> list[dict] | None:
            if t is None:
                return None
            n = count(t)
            return [{"start_pos": a, "end_pos": b, "tokens": m} for a, b, m in (cut(t, capacity, count) if n > capacity else [(0, len(t), n)])]

        return texts.map(one, na_action=None)

    body = F.col("__text")
    if vocabulary:
        cuts = spread(rows).select(key, cut_up(body).alias("__cuts"))
    else:  # one scan: the texts that fit are sized in the JVM, the others alone are handed over
        rows = rows.withColumn("__size", estimate(body))
        whole = F.array(F.struct(F.lit(0).alias("start_pos"), F.length(body).alias("end_pos"), F.col("__size").alias("tokens")))
        cuts = rows.select(key, F.coalesce(cut_up(F.when(F.col("__size") > capacity, body)), whole).alias("__cuts"))
    out = cuts.select(key, F.size("__cuts").alias("n_pieces"), F.posexplode("__cuts").alias("__i", "__c"))
    return out.select(key, (F.col("__i") + 1).alias("piece_no"), "n_pieces", "__c.start_pos", "__c.end_pos", "__c.tokens")


def fill(pieces: DataFrame, capacity: Capacity, key: str, tokens: str = "tokens", items: int | None = None) -> DataFrame:
    """The rows of :func:`sized` (or any with a key and a size column of at most the capacity) with their container:
    key, container, piece_no, n_pieces, start_pos, end_pos, tokens, oversized.

    ``items``: how many there are at about, where that is known cheaper than by counting. Null sizes count as 0, sizes over the capacity raise an error. Repeated keys are packed each for itself; an empty table
    gives no rows.
    """
    kind = pieces.schema[key].dataType.simpleString()
    have = set(pieces.columns)
    one, zero = F.lit(1).cast("int"), F.lit(0).cast("int")
    rows = pieces.select(
        F.col(key), *[(F.col(c).cast("int") if c in have else d).alias(c) for c, d in (("piece_no", one), ("n_pieces", one), ("start_pos", zero), ("end_pos", zero))],
        F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)).alias("tokens"),
    )
    blocks = max(1, -(-(rows.count() if items is None else items) // BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(key, "piece_no"), F.lit(blocks)).cast("int"))
    names = [key, "container", "piece_no", "n_pieces", "start_pos", "end_pos", "tokens", "oversized"]

    def run(b: pd.DataFrame) -> pd.DataFrame:
        if b.empty:
            return pd.DataFrame({c: [] for c in names})
        b = b.sort_values([key, "piece_no", "tokens"]).reset_index(drop=True)
        if int(b["tokens"].max()) > capacity.tokens or int(b["tokens"].min()) < 0:
            raise ValueError("a size lies outside the capacity; cut the item first")
        where = pack(b["tokens"].astype(int).tolist(), capacity)
        return b.assign(container=[f"{k}-{w}" for k, w in zip(b["block"], where)], oversized=b["n_pieces"] > 1)[names]

    return rows.groupBy("block").applyInPandas(run, f"`{key}` {kind}, {OUT_SCHEMA}")


def filled(items: DataFrame, capacity: Capacity, key: str, text: str, vocabulary: str = "") -> DataFrame:
    """Every item or piece of one in its container; with a ``vocabulary`` sizes are exact token counts."""
    return fill(sized(items, capacity.tokens, key, text, vocabulary or None), capacity, key, items=items.count())


def containers(rows: DataFrame, capacity: Capacity) -> DataFrame:
    """One row per container: items, tokens, attention, unused tokens."""
    n = F.col("tokens")
    g = rows.groupBy("container").agg(F.count("*").alias("items"), F.sum(n).alias("tokens"), F.sum(n * n).alias("attention"))
    return g.withColumn("unused", capacity.tokens - F.col("tokens"))


def invariants(items: DataFrame, rows: DataFrame, capacity: Capacity, key: str, text: str, least_filled: float) -> DataFrame:
    """One row: documents, whole ones and cut ones, and what must not be: containers over a capacity, documents that are
    not covered exactly once from their first to their last character, and whether the containers are filled."""
    of = rows.groupBy(key).agg(F.count("*").alias("n"), F.max("n_pieces").alias("pieces"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("covered"), F.max("end_pos").alias("last"), F.min("start_pos").alias("first"))
    whole = items.groupBy(key).agg(F.count("*").alias("times"), F.max(F.length(F.coalesce(F.col(text), F.lit("")))).alias("chars"))
    both = whole.join(of, key, "left")
    wrong = F.col("n").isNull() | (F.col("n") != F.col("times") * F.col("pieces")) | (F.col("covered") != F.col("chars") * F.col("times")) | (F.col("last") != F.col("chars")) | (F.col("first") != 0)
    d = both.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("documents"), F.count(F.when(F.col("pieces") == 1, 1)).alias("whole"), F.count(F.when(F.col("pieces") > 1, 1)).alias("cut"), F.count(F.when(wrong, 1)).alias("miscovered"))
    over = (F.col("tokens") > capacity.tokens) | (F.col("items") > F.lit(capacity.documents or 1 << 60)) | ((F.col("items") > 1) & (F.col("attention") > F.lit(capacity.attention or 1e300)))
    c = containers(rows, capacity).agg(F.count(F.when(over, 1)).alias("over_capacity"), (F.sum("tokens") >= least_filled * F.count("*") * capacity.tokens).alias("filled"))
    return d.join(F.broadcast(c))  # one row each
