"""Verbatim checks of quotations against a corpus, and the ledger from claims to sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.dedup import prints, short_grams
from folioforge.plans.lineage import small_enough

#: Punctuation that comparisons leave out, as a class body (fixed values).
PUNCTUATION = r"!-/:-@\[-`{-~\x{A1}-\x{BF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{3001}-\x{3003}\x{3008}-\x{3011}\x{3014}-\x{301F}\x{3030}\x{FE10}-\x{FE19}\x{FE30}-\x{FE4F}\x{FE50}-\x{FE6B}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}"
WIDE = "".join(chr(c) for c in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)))
NARROW = "".join(chr(ord(c) - 0xFEE0) for c in WIDE)
#: Grams up to this number are sent to every task; beyond it both sides are shuffled.
FEW = 20_000


def normalized(text: Column) -> Column:
    """Without white space and punctuation, full-width letters and digits in normal width."""
    return F.translate(F.regexp_replace(text, rf"[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}{PUNCTUATION}]+", ""), WIDE, NARROW)


def located(needles: DataFrame, corpus: DataFrame, needle_key: str, needle: str, key: str, text: str) -> DataFrame:
    """(needle_key, key): every text of the corpus that holds the needle verbatim, both normalized. Empty needles are
    nowhere.

    A part of a text has the text's content-defined grams: a needle is looked up by the least of its own and then
    compared. Needles too short to have one are looked up by their first three signs.
    """
    n = needles.select(needle_key, normalized(F.col(needle)).alias("needle")).where("length(needle) > 0")
    c = corpus.select(F.col(key), normalized(F.col(text)).alias("hay"))
    np_ = prints(n, needle_key, "needle", ("needle",))
    cp = prints(c, key, "hay", ("hay",))
    anchored = np_.where(F.size("prints") > 0).select(needle_key, "needle", F.array_min("prints").alias("g"))
    wanted = anchored.select("g").distinct()
    seen = cp.select(key, "hay", F.explode("prints").alias("g")).join(F.broadcast(wanted) if small_enough(wanted, FEW) else wanted, "g", "left_semi")
    hits = seen.join(anchored, "g").where(F.expr("contains(hay, needle)")).select(needle_key, key)
    short = np_.where(F.size("prints") == 0).select(needle_key, "needle", F.substring("needle", 1, 3).alias("s"))
    if short.isEmpty():
        return hits.distinct()
    starts = short.select("s").distinct()
    grams = c.select(key, "hay", F.explode(short_grams(F.col("hay"))).alias("s"))
    near = grams.join(F.broadcast(starts) if small_enough(starts, FEW) else starts, "s", "left_semi")
    return hits.unionByName(near.join(short, "s").where(F.expr("contains(hay, needle)")).select(needle_key, key)).distinct()


def first_located(needles: DataFrame, corpus: DataFrame, needle_key: str, needle: str, key: str, text: str) -> DataFrame:
    """Every needle with the least key of the corpus that holds it, null where none does, and its normalized length."""
    at = located(needles, corpus, needle_key, needle, key, text).groupBy(needle_key).agg(F.min(key).alias("found_in"), F.count("*").alias("holders"))
    base = needles.select(needle_key, F.length(normalized(F.col(needle))).alias("chars"))
    return base.join(at, needle_key, "left").select(needle_key, "chars", "found_in", F.coalesce("holders", F.lit(0)).alias("holders"))


def coverage(checked: DataFrame, group: str) -> DataFrame:
    """Of each group its claims, those found in the corpus, and the share."""
    return checked.groupBy(group).agg(F.count("*").alias("claims"), F.count("found_in").alias("verified"), F.round(F.count("found_in") / F.count("*"), 6).alias("share"))


def longest_prefix(needle: Column, hay: Column) -> Column:
    """Length of the longest beginning of ``needle`` that ``hay`` holds anywhere. Holding is monotone in the length, so
    it is found by halving."""
    n = F.length(needle)
    steps = F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.log2(n + 1)).cast("int")))
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"] + 1) / 2).cast("int")
        ok = F.contains(hay, F.substring(needle, F.lit(1), mid))
        done = s["lo"] >= s["hi"]
        return F.struct(F.when(done | ~ok, s["lo"]).otherwise(mid).alias("lo"), F.when(done | ok, s["hi"]).otherwise(mid - 1).alias("hi"))

    return F.aggregate(steps, start, step, lambda s: s["lo"])
