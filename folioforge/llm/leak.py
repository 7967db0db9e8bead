"""Evaluation texts in training text (problem 9).

A distributed positional inverted index. Both sides are cut into terms without case, punctuation, spacing, markup and
look-alike characters: words, and single characters of scripts without spaces. The index holds the postings (term,
document, position) of the runs of N terms of the training texts that may be runs of an item, by a Bloom filter of
bounded size. Of an item's runs the lists are taken rarest first: a document that has too few of them cannot hold the
passage and is left out before any longer list is opened. The lists of the documents left are intersected after shifting
each posting by the run's place in the item, so that a copied passage shows as many postings on one diagonal. Candidates
are then checked term by term for the longest passage with few alterations.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.lookalike import canonical
from folioforge.plans.lineage import cut, small_enough

#: Terms of one run: words, and characters of scripts without spaces.
RUN_WORDS, RUN_SIGNS = 3, 4
#: Share of an item that a passage must hold, and of its terms that may be altered.
SHARE, ALTERED = 0.5, 0.11
#: How far insertions and deletions may shift a diagonal, and how much of the share runs must cover for a candidate.
DRIFT, COVER = 12, 0.5
#: Bits of the Bloom filter for each run of an item, the most it has in all (32 MB), and its hash functions.
BLOOM_BITS, BLOOM_MOST, BLOOM_HASHES = 24, 1 << 28, 3
#: Item runs and candidate documents up to so many rows are broadcast; beyond it both sides are shuffled, hot runs salted.
BROADCAST_ROWS, SALT = 2_000_000, 16

_MARKUP = re.compile(r"<[^<>\n]{1,200}>|&[a-z]{2,8};|\]\([^()\s]*\)")
_TERM = re.compile(r"[぀-ヿ㐀-鿿\U00020000-\U0002ffff]|(?:(?![぀-ヿ㐀-鿿])[^\W_])+")
_RUN, _SIGNS, _OTHER = re.compile(r"[^\W_]+"), re.compile(r"[぀-ヿ㐀-鿿\U00020000-\U0002ffff]"), re.compile(r"[^぀-ヿ㐀-鿿\U00020000-\U0002ffff]")
#: Signs that mark words up or stand within them; without them the words are the same.
DROPPED = "*_~`'\u2019\u2018\u02bc\u00ad\u200b\u200c\u200d\u2060\ufeff"
_WRAPPED = re.compile(r"[-‐¬]\r?\n")
_WRAP = re.compile(r"(?<=[^\W\d_])[-‐¬]\r?\n(?=[^\W\d_])")


#: What makes a text other than its canonical form, apart from punctuation, and signs that mark words up.
_SPECIAL = re.compile("[\u00a0\u00ad\u0300-\u036f\u0370-\u052f\u1680\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2e80-\u2fd5\u3000\u3099\u309a\uf900-\ufaff\ufb00-\ufdff\ufe00-\ufe0f\ufe70-\ufeff\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff61-\uffdc\u2160-\u217f]")


def terms(text: str | None) -> list[str]:
    """The terms of a text in order."""
    if not text:
        return []
    t = text
    if not t.isascii() and _SPECIAL.search(t):
        t = canonical(t)
    if "<" in t or "&" in t or "](" in t:
        t = _MARKUP.sub(" ", t)
    if "\n" in t and _WRAPPED.search(t):
        t = _WRAP.sub("", t)
    for c in DROPPED:
        if c in t:
            t = t.replace(c, "")
    words = _RUN.findall(t.lower())
    if t.isascii():
        return words
    out: list[str] = []
    for w in words:
        if w < "\u3040" or w.isascii():  # begins below the scripts without spaces
            out.extend(_TERM.findall(w) if _SIGNS.search(w) else (w,))
        elif _OTHER.search(w):
            out.extend(_TERM.findall(w))
        else:
            out.extend(w)
    return out


def _fold(terms_: list[str]) -> np.ndarray:
    """64-bit hash of each term; accents do not count."""
    return np.fromiter((_hash(t) for t in terms_), np.uint64, len(terms_))


_KNOWN: dict[str, int] = {}


def _hash(t: str) -> int:
    h = _KNOWN.get(t)
    if h is None:
        import xxhash

        if len(_KNOWN) > 500_000:
            _KNOWN.clear()
        s = t if t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
        h = _KNOWN[t] = xxhash.xxh64_intdigest(s)
    return h


def runs(h: np.ndarray, signs: np.ndarray, words: tuple[int, ...] = (RUN_WORDS,), chars: tuple[int, ...] = (RUN_SIGNS,)) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every run of terms: of ``chars`` terms where it begins with a sign, of ``words`` elsewhere."""
    out_h, out_p = [], []
    mul = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for n, wanted in [(n, ~signs) for n in words] + [(n, signs) for n in chars]:
            if len(h) < n:
                continue
            m = len(h) - n + 1
            r = np.full(m, n if n not in (RUN_WORDS, RUN_SIGNS) else 0, np.uint64)
            for i in range(n):
                r = (r ^ h[i : i + m]) * mul
                r ^= r >> np.uint64(31)
            at = np.flatnonzero(wanted[:m])
            out_h.append(r[at])
            out_p.append(at)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_p)


def own_runs(h: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Runs of an item as of a text, and 0; of an item too short to have any its terms as a whole, and their number."""
    r, at = runs(h, signs)
    if len(r) or not len(h):
        return r, at, 0
    n = len(h)
    r, at = runs(h, signs, (n,), (n,))
    return r[at == 0], at[at == 0], n


def _signs(ts: list[str]) -> np.ndarray:
    return np.fromiter(("\u3040" <= t[0] <= "\u9fff" or t[0] >= "\U00020000" for t in ts), bool, len(ts))


def needed(n: int) -> int:
    """How many of an item's ``n`` runs a candidate must have on neighbouring diagonals. Half an item with every ninth
    word altered keeps six of nine runs of that half (of nine signs, five), but for those at its ends."""
    return max(1, math.floor(n * SHARE * COVER) - 2)


def item_postings(items: DataFrame, key: str, text: str) -> DataFrame:
    """(key, run, at, whole) of every run of every item; ``whole`` is the number of terms of an item that has no other run."""
    kind = items.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, rh, rp, rw = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ts = terms(t)
                h, p, n = own_runs(_fold(ts), _signs(ts)) if ts else ((), (), 0)
                row += [i] * len(h)
                rh += [int(x) for x in np.asarray(h, np.uint64).view(np.int64)]
                rp += [int(x) for x in p]
                rw += [n] * len(h)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(rh, pa.int64()), pa.array(rp, pa.int32()), pa.array(rw, pa.int32())], names=[key, "run", "at", "whole"])

    return items.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, run bigint, at int, whole int")


class Bloom:
    """A Bloom filter over 64-bit hashes; its size follows from the number of hashes up to a bound."""

    def __init__(self, bits: int, field: np.ndarray | None = None):
        self.bits = bits
        self.field = np.zeros(bits // 8, np.uint8) if field is None else field

    @staticmethod
    def size(n: int) -> int:
        return min(BLOOM_MOST, 1 << max(10, (n * BLOOM_BITS - 1).bit_length()))

    def places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(33)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(BLOOM_HASHES):
                yield (h + np.uint64(i) * step) & np.uint64(self.bits - 1)

    def add(self, h: np.ndarray) -> None:
        for p in self.places(h):
            np.bitwise_or.at(self.field, p >> np.uint64(3), (np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)))

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h):
            out &= (self.field[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
        return out


def bloom_of(item_runs: DataFrame) -> Bloom:
    """Filter of all runs of ``item_runs``, each task's part being put together before it comes here (at most 32 MB each)."""
    bits = Bloom.size(max(1, item_runs.count()))
    parts = max(1, min(item_runs.rdd.getNumPartitions(), (1 << 29) // bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bloom(bits)
        for b in batches:
            own.add(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([own.field.tobytes()], pa.binary())], names=["field"])

    out = Bloom(bits)
    for r in item_runs.select("run").distinct().coalesce(parts).mapInArrow(run, "field binary").toLocalIterator():
        out.field |= np.frombuffer(r["field"], np.uint8)
    return out


def postings(df: DataFrame, key: str, text: str, bloom: Bloom, least: int, words: tuple[int, ...], chars: tuple[int, ...]) -> DataFrame:
    """(key, run, position, first) of the runs of every text that the filter lets through, of texts with at least ``least``
    different ones; ``first`` where the run stands there for the first time. Null and empty texts have none."""
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom_ = held.value
        for b in batches:
            row, rh, rp, rf = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ts = terms(t)
                if not ts:
                    continue
                h, p = runs(_fold(ts), _signs(ts), words, chars)
                keep = bloom_.has(h)
                h, p = h[keep], p[keep]
                if len(h) >= least:
                    _, at = np.unique(h, return_index=True)
                    if len(at) >= least:
                        row.append(np.full(len(h), i))
                        rh.append(h)
                        rp.append(p)
                        rf.append(np.isin(np.arange(len(h)), at))
            if row:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(row))), pa.array(np.concatenate(rh).view(np.int64)), pa.array(np.concatenate(rp).astype(np.int32)), pa.array(np.concatenate(rf))], names=[key, "run", "position", "first"])

    return df.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, run bigint, position int, first boolean")


def _distance(x: list[int], y: list[int]) -> int:
    """Terms altered, lost or put in between two stretches."""
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            last, row[j] = row[j], last if c == d else 1 + min(last, row[j], row[j - 1])
    return row[-1]


def _further(x: list[int], y: list[int], most: int) -> tuple[int, int]:
    """(terms, altered) by which an equal stretch goes on into ``x`` and ``y`` beyond an altered term, with at most ``most``
    altered: up to the last equal term where the equal ones outnumber the altered ones by most, or are as many."""
    best, more = (0, 0), 0
    row = list(range(min(len(y), most) + 1))
    for i, c in enumerate(x, 1):
        # columns beyond ``most`` off the diagonal cannot be reached
        new, end = [i], most + 1
        for j in range(1, min(len(y), i + most) + 1):
            step = row[j - 1]
            if c == y[j - 1]:
                end = min(end, step)
            else:
                step = 1 + min(step, new[-1], row[j] if j < len(row) else most + 1)
            new.append(step)
        row = new
        if end <= most and i - 2 * end >= more:
            best, more = (i, end), i - 2 * end
        if min(row) > most:
            break
    return best


def longest_passage(item: np.ndarray, doc: np.ndarray, pairs: list[tuple[int, int]]) -> tuple[int, int, int, int]:
    """The longest stretch of ``item`` that ``doc`` holds with at most the allowed share altered: (first term, terms,
    altered, position in doc). ``pairs``: places (item, doc) of shared runs.

    Equal stretches around the shared runs are chained by their places; what lies between two of them is compared term by
    term, so that equal terms there do not count as altered, and so are both ends.
    """
    xs, ys = item.tolist(), doc.tolist()
    most = int(ALTERED * len(item))
    wide = RUN_SIGNS * (most + 1)  # a longer stretch holds a run or is altered too much
    apart: dict[tuple[int, int, int, int], int] = {}
    ahead: dict[tuple[int, int], tuple[int, int]] = {}
    blocks: list[tuple[int, int, int]] = []
    done: set[tuple[int, int]] = set()
    for i, d in sorted(set(pairs), key=lambda x: (x[1] - x[0], x[0])):
        if blocks and (i - d) == (blocks[-1][0] - blocks[-1][1]) and i < blocks[-1][0] + blocks[-1][2]:
            continue
        a, b = i, d
        while a > 0 and b > 0 and item[a - 1] == doc[b - 1]:
            a, b = a - 1, b - 1
        n = i - a
        while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]:
            n += 1
        if n and (a, b) not in done:
            done.add((a, b))
            blocks.append((a, b, n))
    blocks.sort()
    best = (0, 0, 0, 0)
    # from each block on, the chain that goes on with the nearest block; its prefixes are the passages
    for s in range(len(blocks)):
        a0, b0, n0 = blocks[s]
        ia, ib, altered = a0 + n0, b0 + n0, 0
        head = _further(xs[max(0, a0 - wide) : a0][::-1], ys[max(0, b0 - wide - most) : b0][::-1], most) if a0 and b0 else (0, 0)
        if len(item) - a0 + head[0] <= best[1]:
            continue
        k = s
        while True:
            tail = ahead.get((ia, ib))
            if tail is None:
                tail = ahead[ia, ib] = _further(xs[ia : ia + wide], ys[ib : ib + wide + most], most)
            for before, after in ((head, tail), (head, (0, 0)), ((0, 0), tail), ((0, 0), (0, 0))):
                size, x = before[0] + ia - a0 + after[0], before[1] + altered + after[1]
                if x <= ALTERED * size and size > best[1]:
                    best = (a0 - before[0], size, x, max(0, b0 - before[0]))
            nxt = None
            for j in range(k + 1, len(blocks)):
                a, b, n = blocks[j]
                if a - ia > 8 + DRIFT:
                    break
                if a + n <= ia or b + n <= ib or b - ib > 8 + DRIFT:
                    continue
                over = max(0, ia - a, ib - b)
                if n <= over:
                    continue
                gap = max(a + over - ia, b + over - ib)
                if nxt is None or gap < nxt[0]:
                    nxt = (gap, j, a + over, b + over, n - over)
            if nxt is None:
                break
            _, k, a, b, n = nxt
            gap = apart.get((ia, ib, a, b))
            if gap is None:
                gap = apart[ia, ib, a, b] = _distance(xs[ia:a], ys[ib:b])
            altered += gap
            ia, ib = a + n, b + n
            if altered > ALTERED * len(item) + 3:
                break
    return best


def _meet(index: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """``index`` joined with the few rows of items on ``run``: broadcast where they are few enough, else both shuffled, with
    the run's postings over SALT tasks, as one run may stand in a third of all documents."""
    if small_enough(side, BROADCAST_ROWS):
        return index.join(F.broadcast(side), "run")
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return index.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALT)).cast("int")).join(salted, ["run", "salt"]).drop("salt")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """One row per document and item that leaked into it: key, item_id, share (of the item's terms in the longest
    passage), altered, position (of the passage in the document's terms).

    Null and empty texts hold nothing; an item of fewer terms than a run is met where a document has all its terms in a
    row. Repeated documents count each with its own key. The plan is the same for any number of items; the jobs up to the
    candidates run while it is built.
    """
    item_runs = cut(item_postings(items.where(F.col(item_text).isNotNull()), item_key, item_text))
    want = F.greatest(F.lit(1), F.floor(F.col("runs") * SHARE * COVER) - 2).cast("int")
    size = cut(item_runs.groupBy(item_key).agg((F.max("at") + 1).alias("runs"), F.max("whole").alias("whole")).withColumn("need", want))
    known = size.agg(F.min("need"), F.collect_set(F.when(F.col("whole") > 0, F.col("whole")))).first()  # lengths below a run: 1 to 3
    short = tuple(sorted(known[1] or ()))
    words, chars = (RUN_WORDS, *[n for n in short if n < RUN_WORDS]), (RUN_SIGNS, *[n for n in short if n < RUN_SIGNS])
    index = cut(postings(docs, key, text, bloom_of(item_runs), int(known[0] or 1), words, chars))
    # rarest first: of the item's runs the most frequent ones, half of what a candidate must have, are left unopened
    frequency = index.where("first").groupBy("run").agg(F.count("*").alias("df"))
    order = Window.partitionBy(item_key).orderBy(F.desc(F.coalesce("df", F.lit(0))), "run", "at")
    ranked = item_runs.join(frequency, "run", "left").join(size, item_key).withColumn("place", F.row_number().over(order))
    seeds = cut(ranked.where(F.col("place") > F.floor(F.col("need") / 2)).select(item_key, "run", F.ceil(F.col("need") / 2).alias("least")).distinct())
    seen = _meet(index.where("first").select(key, "run"), seeds, key).groupBy(key, item_key).agg(F.count("*").alias("n"), F.max("least").alias("least"))
    met = cut(seen.where("n >= least").select(key, item_key))
    few = small_enough(met, BROADCAST_ROWS)
    some = F.broadcast(met.select(key).distinct()) if few else met.select(key).distinct()
    near = _meet(index.join(some, key, "left_semi").select(key, "run", "position"), item_runs.select(item_key, "run", "at"), key)
    hits = near.join(F.broadcast(met) if few else met, [key, item_key], "left_semi")
    # intersection of the offset-adjusted lists: postings of one passage lie on one diagonal
    hits = cut(hits.select(key, item_key, F.col("position"), "at", F.floor((F.col("position") - F.col("at")) / (2 * DRIFT)).alias("band")))
    both = hits.select(key, item_key, F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    bands = both.groupBy(key, item_key, "band").agg(F.count("*").alias("n"))
    found = bands.join(size, item_key).where("n >= need").select(key, item_key).distinct()
    places = cut(hits.join(found, [key, item_key], "left_semi").groupBy(key, item_key).agg(F.collect_list(F.struct("at", "position")).alias("places")))
    # only the texts of documents with candidates move, each once for all its items
    bodies = items.select(F.col(item_key), F.col(item_text).alias("item_body"))
    of = places.join(bodies, item_key).groupBy(key).agg(F.collect_list(F.struct(item_key, "places", "item_body")).alias("items"))
    keys = places.select(key).distinct()
    texts = docs.select(F.col(key), F.col(text).alias("doc_text")).join(F.broadcast(keys) if small_enough(keys, BROADCAST_ROWS) else keys, key, "left_semi")
    return _check(texts.join(of, key).select(key, "doc_text", "items"), key, item_key, items.schema[item_key].dataType.simpleString())


def _check(candidates: DataFrame, key: str, item_key: str, item_kind: str) -> DataFrame:
    kind = candidates.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached: dict[str, np.ndarray] = {}
        for b in batches:
            row, ids, share, altered, where = [], [], [], [], []
            for i, (d, xs) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                dt = _fold(terms(d))
                for x in xs:
                    it = cached.get(x["item_body"])
                    if it is None:
                        it = cached[x["item_body"]] = _fold(terms(x["item_body"]))
                    _, n, k, at = longest_passage(it, dt, [(p["at"], p["position"]) for p in x["places"]])
                    least = len(it) if len(it) < RUN_WORDS else SHARE * len(it)
                    if len(it) and n >= least:
                        row.append(i)
                        ids.append(x[item_key])
                        share.append(n / len(it))
                        altered.append(k)
                        where.append(at)
            kinds = b.schema.field(2).type.value_type.field(item_key).type
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(ids, kinds), pa.array(share, pa.float64()), pa.array(altered, pa.int32()), pa.array(where, pa.int32())], names=[key, item_key, "share", "altered", "position"])

    return candidates.mapInArrow(run, f"`{key}` {kind}, `{item_key}` {item_kind}, share double, altered int, position int")
