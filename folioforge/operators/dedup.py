"""Exact, near and contained duplicates.

Texts are compared by content-defined samples of their 8-character grams. Copies with the same set of grams are one
class with one representative. Between representatives only the rarest grams of a set are looked up (a set that is to
share a given part of its grams must share one of them), and bitmaps part most of what meets before sets are compared.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.plans.lineage import cut, small_enough

GRAM, KEEP_MOD = 8, 8
JACCARD, CONTAINED = 0.85, 0.9
#: First signs of short fragments that are sent to every task; beyond it both sides are shuffled.
FEW = 20_000
#: Grams of the sets of a block, and pairs and grams that are compared at once.
BLOCK, CHUNK = 6_000_000, 250_000
#: Keys of copies, and links of a forest, up to which one process holds them.
COPIES, LINKS = 500_000, 2_000_000

_RAW = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _RAW[_i] = _c


_NOT_SOLID = re.compile(r"[\W_]+")  # all but str.isalnum


def solid_text(text: str) -> str:
    """Letters and digits only."""
    return _NOT_SOLID.sub("", text)


def prints_of(text: str | None, n: int = GRAM, keep_mod: int = KEEP_MOD) -> np.ndarray:
    """Sorted distinct CRC-32 values, divisible by ``keep_mod``, of the n-grams of a text's letters and digits.

    Vectorised over all grams at once, byte by byte. Texts shorter than n have none.
    """
    s = solid_text(text or "")
    if len(s) < n:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(s.encode("utf-8", "replace"), np.uint8)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.append(lead, len(data))
    begin, end = lead[: len(lead) - n + 1], ends[n:]
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    width = end - begin
    least = int(width.min())
    for k in range(least):
        crc = (crc >> 8) ^ _RAW.take((crc ^ data[begin + k]) & 0xFF)
    for k in range(least, int(width.max())):
        at = begin + k
        on = at < end
        c = crc[on]
        crc[on] = (c >> 8) ^ _RAW[(c ^ data[at[on]]) & 0xFF]
    crc ^= 0xFFFFFFFF
    return np.unique(crc[crc % keep_mod == 0])


def whole_of(text: str | None) -> str | None:
    """Digest of the letters and digits of a text, of its other signs where it has none; null for null."""
    if text is None:
        return None
    return hashlib.sha256((solid_text(text) or "".join(text.split())).encode("utf-8", "replace")).hexdigest()


def prints(df: DataFrame, key: str, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, kept columns, prints array<bigint>, whole. Null and short texts have an empty array; whole is the digest of a
    text of which no gram was sampled, null for null and all others."""
    source = df.select(key, *keep, F.col(text).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    n = 1 + len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(n).to_pylist()
            sets = [prints_of(t) for t in texts]
            flat = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            whole = pa.array([None if len(s) else whole_of(t) for s, t in zip(sets, texts)], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), whole], names=[key, *keep, "prints", "whole"])

    return source.mapInArrow(run, f"{types}, prints array<bigint>, whole string")


def classes(printed: DataFrame, key: str) -> DataFrame:
    """(key, class_id) of every row: class_id is the least key of the texts with the same set of prints, where that is
    empty of those with the same letters and digits. Null texts are each a class of their own."""
    by_set = F.concat_ws("-", F.xxhash64("prints"), F.crc32(F.concat_ws(",", F.col("prints").cast("array<string>")).cast("binary")))
    h = printed.select(key, F.when(F.size("prints") > 0, by_set).otherwise(F.col("whole")).alias("same"))
    least = h.where("same is not null").groupBy("same").agg(F.min(key).alias("class_id"))
    return h.join(least, "same", "left").select(key, F.coalesce("class_id", key).alias("class_id"))


def edges(printed: DataFrame, key: str, jaccard: float = JACCARD, contained: float = CONTAINED) -> DataFrame:
    """(small, big, inter, n_small, n_big, relation) between representatives: near_duplicate from ``jaccard`` on, else
    contained where ``contained`` of the smaller set lies in the larger. Of equally large sets the lesser key is small.

    The sets are dealt to blocks, and each pair of blocks is compared by one task, so that a pair of sets is met in one
    task only and no candidates are stored: what is shuffled is every set once for each block.
    """
    kind = printed.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [_packed(np.asarray(x, np.uint32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=[key, "packed"])

    packed = cut(printed.where(F.size("prints") > 0).select(key, "prints").mapInArrow(pack, f"`{key}` {kind}, packed binary"))  # read three times below
    same = packed.select(key, F.xxhash64("packed").alias("h"), F.crc32("packed").alias("c"))
    copies = same.join(same.groupBy("h", "c").agg(F.min(key).alias("least")), ["h", "c"]).where(F.col(key) != F.col("least")).select(key)
    reps = packed.join(F.broadcast(copies) if small_enough(copies, COPIES) else copies.hint("merge"), key, "left_anti")
    blocks = max(1, -(-(packed.agg(F.sum(F.length("packed"))).first()[0] or 0) // (4 * BLOCK)))
    mine = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    # the task of blocks i <= j has the number j (j + 1) / 2 + i
    tasks = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: (F.greatest(k, "__b") * (F.greatest(k, "__b") + 1) / 2 + F.least(k, "__b")).cast("int"))
    dealt = reps.withColumn("__b", mine).select(F.explode(tasks).alias("task"), "__b", F.col(key).alias("id"), "packed")
    dealt = dealt.repartitionById(blocks * (blocks + 1) // 2, F.col("task")).sortWithinPartitions("task")
    names = ["small", "big", "inter", "n_small", "n_big", "relation"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_task(batches):
            for ids, a, b, n, inter in _met(rows, jaccard, contained):
                near = inter >= jaccard * (n[a] + n[b] - inter) - 1e-9
                on = near | (inter >= contained * n[a] - 1e-9)
                a, b, inter, near = a[on], b[on], inter[on], near[on]
                ints = [pa.array(x, pa.int32()) for x in (inter, n[a], n[b])]
                relation = pa.array(np.where(near, "near_duplicate", "contained"), pa.string())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b)), *ints, relation], names=names)

    return dealt.mapInArrow(run, f"small {kind}, big {kind}, inter int, n_small int, n_big int, relation string")


def _packed(x: np.ndarray) -> bytes:
    """A set of prints as gaps, the high bytes of all apart, as those are mostly zero. Prints are divisible by 8: turned by
    three bits the gaps are small."""
    x = np.sort((x >> 3) | (x << 29))
    return np.diff(x, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32)


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each task (first column), which come one after another."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        t = b.column(0).to_numpy()
        at = [0, *(np.flatnonzero(t[1:] != t[:-1]) + 1), len(t)]
        for i, j in zip(at, at[1:]):
            if j > i and held and held[0].column(0)[0].as_py() != t[i]:
                yield pa.Table.from_batches(held)
                held = []
            if j > i:
                held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1 ... (count[0] numbers), then those of the next."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def _bitmaps(doc: np.ndarray, gram: np.ndarray, off: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of each set: a bit that one set has and another has not stands for at least one gram of that kind."""
    out = np.zeros((len(off) - 1, bits // 64), np.uint64)
    for i in range(0, len(out), 8192):
        j = min(len(out), i + 8192)
        on = np.zeros((j - i, bits), bool)
        at = (gram[off[i] : off[j]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        on[doc[off[i] : off[j]] - i, at.astype(np.int64) & (bits - 1)] = True
        out[i:j] = np.packbits(on, axis=1).view(np.uint64)
    return out


def _met(rows: pa.Table, jaccard: float, contained: float) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, a, b, n, inter) of the pairs of one task that may be linked: a is the smaller set of ids and b the larger, n
    are the sizes of all. In a task of two blocks only pairs across them are met."""
    ids, side = rows.column("id").combine_chunks(), rows.column("__b").to_numpy()
    sets = [_unpacked(x.as_py()) for x in rows.column("packed")]
    del rows
    n = np.array([len(x) for x in sets], np.int64)
    # by size, then key: of two sets the first is the smaller one
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(n))
    order = np.lexsort((rank, n))
    ids, side, n = ids.take(pa.array(order)), side[order], n[order]
    flat = np.concatenate([sets[i] for i in order])
    del sets
    off = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
    maps = [_bitmaps(doc, flat, off, bits) for bits in (256, 1024)]
    known = np.unique(flat)
    gram = np.searchsorted(known, flat).astype(np.int32)
    del flat, known
    df = np.bincount(gram)
    gram_bits, doc_bits = len(df).bit_length(), len(n).bit_length()
    most = (1 << (62 - gram_bits - doc_bits)) - 1
    # a set that shares the part c of its grams with B shares one of any |A| - ceil(c|A|) + 1 of them: take the rarest
    part = min(contained, 2 * jaccard / (1 + jaccard) if jaccard < 1 else 1.0)
    spare = n - np.ceil(part * n - 1e-9).astype(np.int64)
    by = doc.astype(np.int64)
    by <<= 62 - doc_bits
    by |= ((np.minimum(df, most) << gram_bits) | np.arange(len(df)))[gram]
    by.sort()
    by = by[_ragged(off[:-1], np.minimum(spare + 1, n))]
    p_doc, p_gram = by >> (62 - doc_bits), by & ((1 << gram_bits) - 1)
    on = df[p_gram] > 1
    p_doc, p_gram = p_doc[on], p_gram[on]
    sought = np.zeros(len(df), bool)
    sought[p_gram] = True
    every = doc.astype(np.int64)  # ascending, as are the grams of a set
    every <<= gram_bits
    every |= gram
    own = np.unique(side)
    for x, y in [(own[0], own[0])] if len(own) == 1 else [(own[0], own[1]), (own[1], own[0])]:
        on = sought[gram] & (side[doc] == y)
        posted = np.sort((gram[on].astype(np.int64) << doc_bits) | doc[on])
        on = side[p_doc] == x
        a_, g_ = p_doc[on], p_gram[on]
        lo, hi = np.searchsorted(posted, (g_ << doc_bits) | a_, "right"), np.searchsorted(posted, (g_ + 1) << doc_bits)
        total = np.cumsum(hi - lo)
        rest, i = np.zeros(0, np.int64), 0
        while i < len(a_):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + CHUNK, "right")))
            a, b = np.repeat(a_[i:j], hi[i:j] - lo[i:j]), posted[_ragged(lo[i:j], hi[i:j] - lo[i:j])] & ((1 << doc_bits) - 1)
            on = np.bitwise_count(maps[0][a] & ~maps[0][b]).sum(1) <= spare[a]
            rest = np.unique(np.concatenate([rest, (a[on] << doc_bits) | b[on]]))
            # the pairs of the last set may be met again over its next gram
            upto = len(rest) if j == len(a_) else int(np.searchsorted(rest, a_[j] << doc_bits))
            now, rest, i = rest[:upto], rest[upto:], j
            for k in range(0, len(now), CHUNK):
                a, b = now[k : k + CHUNK] >> doc_bits, now[k : k + CHUNK] & ((1 << doc_bits) - 1)
                on = np.bitwise_count(maps[1][a] & ~maps[1][b]).sum(1) <= spare[a]
                a, b = a[on], b[on]
                a, b = a[o := np.argsort(b, kind="stable")], b[o]
                ends = np.cumsum(n[a])
                s = 0
                while s < len(a):
                    e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + CHUNK, "right")))
                    u, v = a[s:e], b[s:e]
                    q = (np.repeat(v, n[u]) << gram_bits) | gram[_ragged(off[u], n[u])]
                    hit = every[np.minimum(np.searchsorted(every, q), len(every) - 1)] == q
                    yield ids, u, v, n, np.add.reduceat(hit, np.cumsum(n[u]) - n[u], dtype=np.int64)
                    s = e


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in ``links`` (u, v): component is the least id that can be reached. Large and small stars
    in turn until a round changes nothing; the rounds grow with the logarithm of the longest path. Before that each task
    keeps only links that connect, and where few are left one task ends the work."""
    kind = links.schema["u"].dataType.simpleString()
    forest = cut(links.select("u", "v").mapInArrow(_forest, f"u {kind}, v {kind}"))
    if small_enough(forest, LINKS):
        every = forest.coalesce(1).mapInArrow(_forest, f"u {kind}, v {kind}")
        return every.select(F.col("u").alias("id"), F.col("v").alias("component"))
    links = forest
    star = cut(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(lower.select("u", F.col("m").alias("v")))
        new = cut(small.distinct())
        if new.join(star, ["u", "v"], "left_anti").isEmpty() and star.join(new, ["u", "v"], "left_anti").isEmpty():
            break
        star = new
    return star.select(F.col("u").alias("id"), F.col("v").alias("component")).union(star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of each id in the links: v is the least id that it is connected with by them."""
    up: dict = {}
    ids = None

    def top(x):
        while (p := up[x]) != x:
            up[x] = x = up[p]
        return x

    for b in batches:
        ids = b.column(0).type
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            up.setdefault(u, u), up.setdefault(v, v)
            u, v = top(u), top(v)
            if u != v:
                up[max(u, v)] = min(u, v)
    keys = list(up)
    for i in range(0, len(keys), 100_000):
        some = keys[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, ids), pa.array([top(x) for x in some], ids)], names=["u", "v"])


def resolved(links: DataFrame) -> DataFrame:
    """(dropped, kept, relation): first come, first kept, over the links of :func:`edges`.

    A near duplicate gives way to the lesser id, a contained text to its container. As in the reference the links are met in
    the order of their lesser, then their greater id, and one counts only while neither text is dropped; so each linked
    group is read once in that order, holding the ids it drops, and nothing stays undecided. Where the text that another
    gave way to is dropped later, kept is the one that stands at the end; relation is that of the deciding link.
    """
    # what gives way: 0 v, a near duplicate; 1 u, 2 v, contained
    way = F.when(F.col("relation") == "near_duplicate", 0).when(F.col("small") < F.col("big"), 1).otherwise(2).cast("tinyint")
    rule = cut(links.select(F.least("small", "big").alias("u"), F.greatest("small", "big").alias("v"), way.alias("way")))
    of = components(rule.select("u", "v"))
    ordered = rule.join(of.withColumnRenamed("id", "u"), "u").repartition("component").sortWithinPartitions("component", "u", "v").select("component", "u", "v", "way")
    kind = links.schema["small"].dataType.simpleString()
    names = ["dropped", "kept", "relation"]

    def settled(gone: dict, ids: pa.DataType) -> pa.RecordBatch:
        last: dict = {}  # the one that stands at the end, by dropped id
        for k in reversed(gone):  # a text that gave way is met no more, so its better one was dropped later
            last[k] = last.get(gone[k][0], gone[k][0])
        return pa.RecordBatch.from_arrays([pa.array(list(gone), ids), pa.array([last[k] for k in gone], ids), pa.array([r for _, r in gone.values()], pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone, ids = None, {}, None
        for b in batches:
            ids = b.column(1).type
            for c, u, v, way in zip(*(b.column(i).to_pylist() for i in range(4))):
                if c != now:
                    if gone:
                        yield settled(gone, ids)
                    now, gone = c, {}
                if u not in gone and v not in gone:
                    worse, better = (u, v) if way == 1 else (v, u)
                    gone[worse] = (better, "contained" if way else "near_duplicate")
        if gone:
            yield settled(gone, ids)

    return ordered.mapInArrow(run, f"dropped {kind}, kept {kind}, relation string")


def exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, digest, duplicate_of): the least key of all rows with the same text; null for that row itself and for null
    texts. The least key comes from a partial aggregation, not from a window over all copies."""
    h = df.select(key, F.sha2(text, 256).alias("digest"))
    first = h.where("digest is not null").groupBy("digest").agg(F.min(key).alias("first"))
    return h.join(first, "digest", "left").select(key, "digest", F.when(F.col("first") != F.col(key), F.col("first")).alias("duplicate_of"))


def short_grams(text: Column, most: int = 3) -> Column:
    """The different stretches of one to ``most`` characters of a text."""
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text)))
    every = F.flatten(F.transform(at, lambda i: F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.substring(text, i, k))))
    return F.array_distinct(every)


def surviving(df: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """Fragments that no longer fragment of their group contains, each distinct one once: group, key (the least), text.

    A fragment within a longer one has all of that one's sampled grams that lie within it: it meets the texts of its group
    over the least of its own. Fragments too short to have any meet the longer texts over their first signs. Only numbers
    are exploded and joined; texts come to the pairs that are left. These joins are never broadcasts: the plan's estimates
    do not see how much an explosion adds.
    """
    once = df.where(F.length(text) > 0).groupBy(group, F.col(text).alias("t")).agg(F.min(key).alias(key)).withColumn("n", F.length("t"))
    once = cut(prints(once, key, "t", (group, "t", "n")).drop("whole").withColumn("__no", F.monotonically_increasing_id()))
    bits = F.aggregate("prints", F.lit(0).cast("bigint"), lambda m, p: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(p, 3).bitwiseAND(63).cast("int"))))
    light = once.select(F.col(group).alias("g"), "__no", "n", "prints", bits.alias("bits"))
    needle = light.where(F.size("prints") > 0).select("g", F.col("__no").alias("a"), "n", "bits", F.array_min("prints").alias("p"))
    hay = light.select("g", F.col("__no").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"), F.explode("prints").alias("p"))
    pairs = needle.join(hay.hint("merge"), ["g", "p"]).where((F.col("n2") > F.col("n")) & (F.col("bits").bitwiseAND(F.col("bits2")) == F.col("bits"))).select("a", "b")
    short = once.where(F.size("prints") == 0).select(F.col(group).alias("g"), F.col("__no").alias("a"), "n", F.substring("t", 1, 3).alias("s"))
    if not short.isEmpty():
        starts = short.groupBy("g", "s").agg(F.min("n").alias("least"))
        grams = once.select(F.col(group).alias("g"), F.col("__no").alias("b"), F.col("n").alias("n2"), F.explode(short_grams(F.col("t"))).alias("s"))
        sought = grams.join(F.broadcast(starts) if small_enough(starts, FEW) else starts.hint("merge"), ["g", "s"]).where("n2 > least")
        pairs = pairs.unionByName(sought.join(short.hint("merge"), ["g", "s"]).where("n2 > n").select("a", "b"))
    needles, longer = once.select(F.col("__no").alias("a"), F.col("t").alias("t1")), once.select(F.col("__no").alias("b"), F.col("t").alias("t2"))
    gone = pairs.join(needles.hint("merge"), "a").join(longer.hint("merge"), "b").where(F.col("t2").contains(F.col("t1"))).select(F.col("a").alias("__no")).distinct()
    return once.join(gone.hint("merge"), "__no", "left_anti").select(group, key, F.col("t").alias("text"))
