"""Splitting oversized items at natural boundaries (problem 1).

Recursive separator hierarchy: section, paragraph, line, sentence, word, character. What is over the limit is split at the
separators of the highest level, each part that is still over it at those of the next, and so on. The parts are then
packed greedily: a piece takes parts while it stays under the limit, and the next piece begins with the last words of
the one before, as many as the overlap asks for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import blanks, estimate

#: Boundaries, highest level first: each pattern's match ends where the next piece may start.
LEVELS = (
    ("section", re.compile(r"\n(?=[ \t]*(?:#{1,6} |--- Page \d+|\[\d+(?:\.\d+)*\]|[=*_-]{3,}[ \t]*\n))|\n[ \t]*\n[ \t]*\n\s*")),
    ("paragraph", re.compile(r"\r?\n(?:[ \t]*\r?\n)+")),
    ("line", re.compile(r"\r?\n[ \t]*")),
    ("sentence", re.compile(r"[.!?…。！？।؟][\"'”’»」』）)\]]*\s+|[。！？।؟][”’」』）»]*")),
    ("word", re.compile(r"\s+|(?<=[，、；：])")),
)
#: A sign that belongs to the character before it; no piece starts with one.
ATTACHED = re.compile("[\u0300-\u036f\u0591-\u05bd\u064b-\u0655\u0900-\u0903\u093a-\u093c\u093e-\u094f\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u200b-\u200d\u3099-\u309a\ufe00-\ufe0f]")
PIECE_SCHEMA = "piece_no int, n_pieces int, start_pos int, end_pos int, cut_level string, text string, token_estimate bigint, source_detail string"


class _Sizes:
    """Estimates of all stretches of a text by running counts."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        cjk = (codes >= 0x4E00) & (codes <= 0x9FFF)
        space = blanks(codes)
        self.text, self.n = text, len(codes)
        ideographs, others = np.append(0, np.cumsum(cjk)), np.append(0, np.cumsum(~cjk & ~space))
        self.cost = ideographs * 1.05 + others / 3.8
        self.ideographs, self.others = ideographs.tolist(), others.tolist()  # single places are read far faster from lists

    def size(self, a: int, b: int) -> int:
        return int((self.ideographs[b] - self.ideographs[a]) * 1.05 + (self.others[b] - self.others[a]) / 3.8)

    def reach(self, a: int, most: int) -> int:
        """The furthest end of a stretch from ``a`` on of at most ``most`` tokens, but of at least one character."""
        b = min(max(int(np.searchsorted(self.cost, self.cost[a] + most + 1, side="left")) - 1, a + 1), self.n)
        while b > a + 1 and self.size(a, b) > most:
            b -= 1
        end = b
        while a + 1 < end < self.n and ATTACHED.match(self.text[end]):
            end -= 1
        return end if end > a + 1 else b

    def back(self, a: int, end: int, least: int) -> int:
        """The latest start after ``a`` from which on there are ``least`` tokens up to ``end``."""
        at = int(np.searchsorted(self.cost, self.cost[end] - least, side="right")) - 1 if least else end
        at = max(at, a + 1)
        while at > a + 1 and self.size(at, end) < least:
            at -= 1
        return at


def _parts(sizes: _Sizes, cuts: list[np.ndarray], a: int, b: int, level: int, most: int, out: list[tuple[int, str]]) -> None:
    """Appends (end, name of the level that ends it) of the parts of a stretch, each of at most ``most`` tokens."""
    while level < len(LEVELS):
        at = cuts[level]
        inner = at[np.searchsorted(at, a, side="right") : np.searchsorted(at, b, side="left")].tolist()
        if inner:
            start = a
            for end in [*inner, b]:
                if sizes.size(start, end) > most:
                    _parts(sizes, cuts, start, end, level + 1, most, out)
                    if end < b:
                        out[-1] = (end, LEVELS[level][0])
                else:
                    out.append((end, LEVELS[level][0]))
                start = end
            return
        level += 1
    while sizes.size(a, b) > most:
        a = sizes.reach(a, most)
        out.append((a, "character"))
        if a >= b:
            return
    out.append((b, "character"))


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """Pieces (start, end, level of the cut at the end) of ``text``, each with an estimate of at most ``limit``."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("limit must be positive and overlap less than it")
    sizes = _Sizes(text)
    if sizes.size(0, sizes.n) <= limit:
        return [(0, sizes.n, "end")]
    cuts = [np.array([m.end() for m in rx.finditer(text)], np.int64) for _, rx in LEVELS]
    parts: list[tuple[int, str]] = []
    # a part fits beside the overlap of the piece before it, whose first word may come whole
    _parts(sizes, cuts, 0, sizes.n, 0, max(1, limit - overlap - 1), parts)
    words = cuts[-1]
    out: list[tuple[int, int, str]] = []
    a = end = 0
    level = "end"
    for stop, name in parts:
        if end > a and sizes.size(a, stop) > limit:
            out.append((a, end, level))
            back = sizes.back(a, end, overlap)
            i = int(np.searchsorted(words, back, side="right")) - 1
            if overlap and i >= 0 and a < words[i] and back - words[i] <= 40 and sizes.size(int(words[i]), stop) <= limit:
                back = int(words[i])
            while back > a + 1 and back < sizes.n and ATTACHED.match(text[back]) and sizes.size(back - 1, stop) <= limit:
                back -= 1
            while back < end and sizes.size(back, stop) > limit:
                back += 1
            a = back
        end, level = stop, name
    return [*out, (a, sizes.n, "end")]


def split_oversized(df: DataFrame, limit: int, overlap: int, key: str = "segment_id", text: str = "text", detail: str = "source_detail") -> DataFrame:
    """Pieces of every row whose text has an estimate above ``limit``; rows up to the limit, nulls and empty texts give
    none. Repeated rows are split each with its own key. Every piece but the last overlaps the next by at least
    ``overlap``; its source_detail is the row's (null counts as empty) followed by ``, part i of n``. Only the columns
    named are read, so that other columns cannot clash."""
    large = df.select(F.col(key), F.col(text).alias("text"), F.col(detail).cast("string").alias("detail")).where(estimate(F.col("text")) > limit)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from folioforge.functions.text import estimate_py

        for b in batches:
            rows = []
            for k, t, d in zip(b[key], b["text"], b["detail"]):
                pieces = split_text(t, limit, overlap)
                for i, (s, e, level) in enumerate(pieces):
                    place = f"{d}, " if isinstance(d, str) and d else ""
                    rows.append((k, i + 1, len(pieces), s, e, level, t[s:e], estimate_py(t[s:e]), f"{place}part {i + 1} of {len(pieces)}"))
            yield pd.DataFrame(rows, columns=[key, "piece_no", "n_pieces", "start_pos", "end_pos", "cut_level", "text", "token_estimate", "source_detail"])

    return large.mapInPandas(run, f"`{key}` {kind}, {PIECE_SCHEMA}")


def invariants(df: DataFrame, cut: DataFrame, limit: int, overlap: int, key: str = "segment_id", text: str = "text") -> DataFrame:
    """One row over the pieces ``cut`` of ``df``: rows that were split, and the numbers of pieces over the limit, of gaps and
    missing ends, of overlaps that are too short, of pieces that are not the text at their place, and of unnamed places."""
    w = Window.partitionBy(key).orderBy("piece_no")
    p = cut.withColumns({"prev_end": F.lag("end_pos").over(w), "prev_size": F.lag("token_estimate").over(w)})
    chars = df.select(F.col(key), F.length(text).alias("__chars"), F.col(text).alias("__whole"))
    p = p.join(chars, key)
    shared = estimate(F.substring(F.col("text"), F.lit(1), F.col("prev_end") - F.col("start_pos")))
    gap = ((F.col("piece_no") == 1) & (F.col("start_pos") != 0)) | (F.col("start_pos") > F.col("prev_end")) | ((F.col("piece_no") == F.col("n_pieces")) & (F.col("end_pos") != F.col("__chars")))
    other = F.substring(F.col("__whole"), F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos")) != F.col("text")
    bad = {
        "over_limit": estimate(F.col("text")) > limit, "gaps": gap, "short_overlaps": (F.col("piece_no") > 1) & (shared < F.least(F.lit(overlap), F.col("prev_size") - 1)),
        "misplaced": other, "unnamed": ~F.col("source_detail").endswith(F.concat(F.lit("part "), F.col("piece_no"), F.lit(" of "), F.col("n_pieces"))),
    }
    return p.agg(F.countDistinct(key).alias("split"), *[F.count(F.when(c, 1)).alias(k) for k, c in bad.items()])
