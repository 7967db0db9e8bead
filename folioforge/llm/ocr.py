"""Noise in text from scanned pages (problem 4).

Two passes over the texts. The first counts word forms (and, in scripts without spaces, the neighbours of confusable
signs) and gathers the lines that may be running heads, with their digits masked. Forms are grouped by their
confusable-glyph skeleton; a form that clean text does not know gives way to a frequent form of its group, and where there
are several to the one that the rest of its text supports. A masked line that stands on several different pages of a
source, or is its title, is a running head. The second pass marks and repairs every line; paragraphs are then put together
with SQL windows.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.tokens import file_name
from folioforge.plans.lineage import cut, small_enough

#: Glyphs that scanners confuse (fixed values): several letters read as one, and classes of single ones.
SEVERAL = (("rn", "m"), ("cl", "d"), ("vv", "w"))
CLASSES = ("oO0оО", "sS5", "B8", "lI1ijJ|", "ceе", "nu", "bh", "ft", "gq9", "zZ2", "ний", "вь", "зэЭЗ3", "бb6", "ъы", "的旳", "日曰目", "问向", "問", "人入", "于干千", "几儿", "没汶", "天夭", "时吋", "大犬太", "自白", "己已巳", "未末", "土士", "りリ", "一ー", "トト卜", "口ロ", "力カ", "ニ二", "だた")
_REP = {ord(c): k[0] for k in CLASSES for c in k}
_REP.pop(ord("b"), None)
_REP[ord("b")] = "b"
_REP[ord("h")] = "b"
#: A frequent form replaces another one when it is at least so often in clean text, and so many times as often.
LEAST, TIMES = 3, 5
#: Where clean text does not have the frequent form either (a corpus of scans alone), by how much more of both.
SCANNED = 4
#: Different pages of a source on which a masked line stands to be a head: beside a page number, and by itself; and the
#: share of the source's pages for the latter, as headings of chapters are repeated too, but not on page after page.
HEAD_PAGES, BARE_PAGES, BARE_SHARE = 2, 4, 0.3
#: Characters that a head has at most: by definition it is a short line, not a line of running text.
HEAD_CHARS = 90
#: Corrections and heads up to so many rows are broadcast; beyond it they are joined to the texts that need them.
BROADCAST_ROWS = 400_000

_WORD = re.compile(r"[A-Za-zÀ-ɏͰ-ӿ0-9�]{2,}")
_LETTER = re.compile(r"[A-Za-zÀ-ɏͰ-ӿ]")
_CJK_SIGNS = "".join(c for k in CLASSES for c in k if ord(c) > 0x2E80)
_SIGN = re.compile(f"[{_CJK_SIGNS}]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
HYPHENS = "-¬‐­"
#: A word cut at a line's end. A hyphen after a number or before a capital, and dashes of speech, are none.
HYPHENATED = re.compile(rf"(?<=[^\W\d_�])[{HYPHENS}][ \t]*\r?\n(?:[ \t]*\r?\n)*(?=[^\W\d_A-ZÀ-ÖØ-ÞА-ЯЁ�]|�)")
_DASH = r"[-–—一・·•|.\[\]()~=_ \t]"
PAGE_WORDS = r"(?:p|pp|pg|page|seite|s|pag|pág|página|pagina|стр|с|ص|पृ|หน้า)"
#: A line with only a page number, its digits perhaps misread.
PAGE_NUMBER = re.compile(rf"^{_DASH}*(?:{PAGE_WORDS}\.?\s*)?(?:第\s*)?(?=[\dlIOo]*\d)[\dlIOo]{{1,4}}\s*(?:[页頁])?{_DASH}*$", re.I)
#: Markers of pages that stay.
MARKER = re.compile(r"^\s*[-=*]{2,}\s*(?:Page|p\.)\s*\d+.*[-=*]{2,}\s*$", re.I)
NUMBERED = re.compile(r"^\s*(?:\d{1,4}\s{2,}(\S.+?)|(\S.+?)\s{2,}\d{1,4})\s*$")
_END = re.compile(r"[.!?。！？।؟…:：;；][\"”’»」』）)\]“]*\s*$|[”»」』\"]\s*$")
_LIST = re.compile(r"^\s*(?:[-*•]\s|\d{1,3}[.)]\s|#{1,6}\s|\*\*|[QAＱＡ][:：]|>)")


def skeleton(word: str) -> str:
    for a, b in SEVERAL:
        word = word.replace(a, b)
    return word.translate(_REP)


def head_key(line: str) -> str:
    """A line with its digits masked away, in one case, as skeleton letters."""
    s = re.sub(r"^\s*\d+\s|\s\d+\s*$|[,，]?\s*\d+\s*$", " ", line)
    s = re.sub(r"(?<=\D)\d+\s*$", "", s) if not _LETTER.search(s) else s
    return re.sub(r"[\W_]+", "", s.translate(_UP).lower().translate(_REP))


_UP = {ord("0"): "o", ord("8"): "b", ord("5"): "s", ord("1"): "l", ord("9"): "g"}


#: Invisible characters; a soft hyphen at a line's end is a sign of a cut word and stays.
_INVISIBLE = re.compile("[\u200b-\u200f\u2060-\u2064\ufeff]|\u00ad(?!\\s*\n)")


_COMBINING = re.compile("[\u0300-\u036f\u3099\u309a]")


def visible(text: str) -> str:
    """The text with composed accents and without invisible characters."""
    text = _INVISIBLE.sub("", text)
    return unicodedata.normalize("NFC", text) if _COMBINING.search(text) else text


def joined(text: str) -> str:
    return HYPHENATED.sub("", visible(text))


def forms(text: str) -> list[str]:
    """The forms that a text counts for: words, and neighbours of confusable signs."""
    flat = joined(text)
    out = [w for w in _WORD.findall(flat) if _LETTER.search(w)]
    if _SIGN.search(flat):
        flat = flat.replace("\n", "").replace("\r", "")
        for m in _SIGN.finditer(flat):
            i = m.start()
            if i and _CJK.match(flat[i - 1]):
                out.append("<" + flat[i - 1 : i + 1])
            if i + 1 < len(flat) and _CJK.match(flat[i + 1]):
                out.append(">" + flat[i : i + 2])
    return out


def paged(file: Column, detail: Column) -> Column:
    """Whether a segment comes from pages: a PDF, or a place named by pages, or nothing known."""
    return F.coalesce(F.lower(file).rlike(r"\.pdf\s*$") | F.lower(detail).rlike(r"\.pdf|pages? \d"), F.lit(True))


def source_key(df: DataFrame) -> Column:
    return F.coalesce(file_name(F.col("source_file")), F.col("source_id").cast("string"))


def head_lines(text: str) -> list[tuple[str, bool]]:
    """(key, numbered) of the lines that may be running heads: short lines beside a page number, and short lines that stand
    by themselves, between blank lines or at the text's edge, and are neither sentences nor lists."""
    out = []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        s = line.strip()
        if not s or len(s) >= HEAD_CHARS or MARKER.match(s):
            continue
        numbered = (s[0].isdigit() or s[-1].isdigit()) and NUMBERED.match(line)
        if numbered:
            k = head_key(numbered.group(1) or numbered.group(2))
        elif (i == 0 or not lines[i - 1].strip()) and (i + 1 == len(lines) or not lines[i + 1].strip()) and not _END.search(s) and not _LIST.match(s):
            k = head_key(s)
        else:
            continue
        if len(k) >= 2:
            out.append((k, bool(numbered)))
    return out


def _text_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) >> 1


def first_pass(segments: DataFrame) -> DataFrame:
    """Rows (kind, a, b, clean, total, pages): word forms with their numbers; and of each source the keys of lines that may be
    heads, each with the least hashes of different texts that have it (copies of a page count once), and of its titles."""
    rows = segments.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), paged(F.col("source_file"), F.col("source_detail")).alias("paged"), source_key(segments).alias("source"), F.col("source_title").alias("title"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean: Counter = Counter()
        scanned: Counter = Counter()
        heads: dict[tuple[str, str, str], set[int]] = {}
        times: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            keys = sorted(clean.keys() | scanned.keys())
            h = sorted(heads)
            kind = pa.array(["form"] * len(keys) + [x[0] for x in h], pa.string())
            a = pa.array(keys + [x[1] for x in h], pa.string())
            b = pa.array([None] * len(keys) + [x[2] for x in h], pa.string())
            n = pa.array([clean[k] for k in keys] + [0] * len(h), pa.int64())
            m = pa.array([clean[k] + scanned[k] for k in keys] + [times[x] for x in h], pa.int64())
            pages = pa.array([None] * len(keys) + [sorted(heads[x]) for x in h], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([kind, a, b, n, m, pages], names=["kind", "a", "b", "clean", "total", "pages"])
            clean.clear(), scanned.clear(), heads.clear(), times.clear()

        for batch in batches:
            for text, is_paged, source, title in zip(*(batch.column(i).to_pylist() for i in range(4))):
                (scanned if is_paged else clean).update(forms(text))
                if is_paged and source is not None:
                    heads.setdefault(("source", source, ""), set())
                    times["source", source, ""] += 1
                    if title and len(k := head_key(title)) >= 2:
                        heads.setdefault(("title", source, k), set())
                    found = set(head_lines(text))
                    at = _text_hash(text) if found else 0
                    for k, numbered in found:
                        x = ("numbered" if numbered else "bare", source, k)
                        some = heads.setdefault(x, set())
                        some.add(at)
                        times[x] += 1
                        if len(some) > BARE_PAGES:  # the least hashes tell whether there are so many
                            some.remove(max(some))
            if len(clean) + len(scanned) + len(heads) > 500_000:
                yield from out()
        yield from out()

    return rows.mapInArrow(run, "kind string, a string, b string, clean bigint, total bigint, pages array<bigint>")


def running_heads(passed: DataFrame) -> DataFrame:
    """(source, head): titles, and keys of lines on enough different pages of the source."""
    found = passed.where("kind in ('title', 'numbered', 'bare')").select(F.col("a").alias("source"), F.col("b").alias("head"), "kind", F.explode_outer("pages").alias("page"))
    pages = lambda *kinds: F.count_distinct(F.when(F.col("kind").isin(*kinds), F.col("page")))
    n = found.groupBy("source", "head").agg(F.max(F.col("kind") == "title").alias("title"), pages("numbered").alias("numbered"), pages("numbered", "bare").alias("bare"))
    n = n.where(F.col("title") | (F.col("numbered") >= HEAD_PAGES) | (F.col("bare") >= BARE_PAGES))
    times = passed.where("kind in ('numbered', 'bare')").groupBy(F.col("a").alias("source"), F.col("b").alias("head")).agg(F.sum("total").alias("times"))
    every = passed.where("kind = 'source'").groupBy(F.col("a").alias("source")).agg(F.sum("total").alias("all"))
    n = n.join(times, ["source", "head"], "left").join(every, "source")
    on_most = (F.col("bare") >= BARE_PAGES) & (F.col("times") >= BARE_SHARE * F.col("all"))
    return n.where(F.col("title") | (F.col("numbered") >= HEAD_PAGES) | on_most).select("source", "head")


def corrections(passed: DataFrame) -> DataFrame:
    """(bad, good[]) forms. Within a skeleton group a form that clean text does not have gives way to the nearest forms that
    are frequent there, or in scans alone still more frequent. A word with a sign of a lost character stands for the
    frequent words that fit it. The most frequent form comes first."""
    counts = passed.where("kind = 'form'").groupBy(F.col("a").alias("form")).agg(F.sum("clean").alias("clean"), F.sum("total").alias("total"))
    skel = F.col("form")
    for a, b in SEVERAL:
        skel = F.replace(skel, F.lit(a), F.lit(b))
    skel = F.translate(skel, "".join(map(chr, _REP)), "".join(_REP.values()))
    whole = counts.where(~F.col("form").contains("�")).withColumn("skeleton", skel)
    mixed = F.col("bad").rlike("[A-Za-zÀ-ɏ]") & F.col("bad").rlike("[Ͱ-ӿ]")  # look-alikes of another alphabet are no misreading
    rare = whole.where("clean = 0").select(F.col("form").alias("bad"), "total", "skeleton").where(~mixed)
    best, enough = F.greatest("clean", F.floor(F.col("total") / SCANNED)), F.lit(LEAST)
    known = whole.select(F.col("form").alias("good"), best.alias("best"), "skeleton").where(F.col("best") >= enough)
    near = rare.join(known, "skeleton").where((F.col("best") >= TIMES * F.col("total")) & (F.col("bad") != F.col("good")))
    near = near.select("bad", "good", F.levenshtein("bad", "good").alias("d"), "best")
    # all of the nearest forms, the most frequent first: the text decides between them
    ranked = near.groupBy("bad").agg(F.array_sort(F.collect_list(F.struct("d", (-F.col("best")).alias("o"), "good"))).alias("xs"))
    nearest = F.filter("xs", lambda x: x["d"] == F.col("xs")[0]["d"])
    bad = ranked.select("bad", F.transform(nearest, lambda x: x["good"]).alias("good"))
    lost = counts.where(F.col("form").contains("�") & (F.length(F.regexp_replace("form", "[^�]", "")) == 1) & (F.length("form") > 3)).select("form")
    counts = counts.withColumn("clean", F.greatest("clean", F.floor(F.col("total") / SCANNED)))
    frequent = counts.where((F.col("clean") >= LEAST) & ~F.col("form").contains("�") & ~F.col("form").rlike("^[<>]") & (F.length("form") > 3))
    holes = frequent.select("form", "clean", F.explode(F.sequence(F.lit(1), F.length("form"))).alias("i")).select(F.concat(F.expr("substring(form, 1, i - 1)"), F.lit("�"), F.expr("substring(form, i + 1)")).alias("hole"), "form", "clean")
    fits = lost.withColumnRenamed("form", "bad").join(holes, F.col("bad") == F.col("hole")).groupBy("bad").agg(F.array_sort(F.collect_list(F.struct((-F.col("clean")).alias("o"), "form"))).alias("xs"))
    return bad.unionByName(fits.select("bad", F.transform("xs", lambda x: x["form"]).alias("good")))


_UNIT = re.compile(r"[A-Za-zÀ-ɏͰ-ӿ0-9�]{2,}|" + f"[{_CJK_SIGNS}]")


def repair_line(line: str, fixes: dict[str, list[str]], before: str = "", after: str = "", said: frozenset[str] | set[str] = frozenset()) -> tuple[str, int]:
    """The line with its misread forms put right and their number. ``before`` and ``after`` are the neighbouring signs
    of the lines around it, for signs at its ends; ``said`` are the words of the text, which choose between several forms."""
    n = 0

    def put(m: re.Match) -> str:
        nonlocal n
        w = m.group()
        if len(w) > 1:
            goods = fixes.get(w)
            if goods is None or not _LETTER.search(w):
                return w
            n += "�" not in w
            return next((g for g in goods if g in said), goods[0])
        i = m.start()
        p = line[i - 1] if i else before
        q = line[i + 1] if i + 1 < len(line) else after
        told = []
        if p and _CJK.match(p):
            told.append(fixes.get("<" + p + w, ("<" + p + w,))[0][-1])
        if q and _CJK.match(q):
            told.append(fixes.get(">" + w + q, (">" + w + q,))[0][1])
        if told and len(set(told)) == 1 and told[0] != w:
            n += 1
            return told[0]
        return w

    return _UNIT.sub(put, line), n


def mark(text: str, fixes: dict[str, list[str]], is_head, lines_too: bool = True) -> tuple[list[tuple[str, str]], int, int, int, int]:
    """Lines of a text with what they are, and the numbers of words cut, heads, page numbers and misread signs.

    ``is_head``: says of a key whether it is a head of the text's source. Kinds: text, blank, head, number, marker. A head
    is no head where it opens the text without a page number by it.
    """
    text = visible(text)
    cutwords = len(HYPHENATED.findall(text))
    lines = text.split("\n")
    kinds: list[str] = []
    first = -1
    for i, x in enumerate(lines):
        s = x.strip()
        if not s:
            kinds.append("blank")
            continue
        if first < 0:
            first = i
        kind = "text"
        if len(s) < HEAD_CHARS:
            if MARKER.match(s):
                kind = "marker"
            elif PAGE_NUMBER.match(s):
                kind = "number"
            else:
                numbered = NUMBERED.match(x)
                if (numbered or i != first) and is_head(head_key((numbered.group(1) or numbered.group(2)) if numbered else s)):
                    kind = "head"
        kinds.append(kind)
    misread = text.count("�")
    said = set(_WORD.findall(text))
    out = []
    for i, x in enumerate(lines):
        if kinds[i] == "text":
            x, k = repair_line(x, fixes, lines[i - 1][-1:] if i and kinds[i - 1] == "text" else "", lines[i + 1][:1] if i + 1 < len(lines) and kinds[i + 1] == "text" else "", said)
            misread += k
        if lines_too:
            out.append((x, kinds[i]))
    return out, cutwords, kinds.count("head"), kinds.count("number"), misread


MARK_SCHEMA = "lines array<struct<line:string,kind:string>>, cut_words int, heads int, page_numbers int, misread int, noisy boolean"


def marked(segments: DataFrame, key: str = "segment_id", lines: bool = True) -> DataFrame:
    """Of every segment its lines with what they are, and the numbers of its noise: key, lines, cut_words, heads,
    page_numbers, misread, noisy. Null and empty texts are not noisy and have no lines; repeated rows stay.

    ocr_required and page_quality are not read. Corrections and heads are broadcast where they are few enough and
    otherwise joined to the forms and lines that the texts have. The first pass runs while the plan is built.
    """
    passed = cut(first_pass(segments))
    fixes, heads = cut(corrections(passed)), cut(running_heads(passed))
    base = segments.select(F.col(key), F.coalesce(F.col("text"), F.lit("")).alias("text"), source_key(segments).alias("source"))
    kind = segments.schema[key].dataType.simpleString()
    rows, common, known = base, None, None
    if small_enough(fixes.select(F.explode("good")), BROADCAST_ROWS):
        common = {r["bad"]: list(r["good"]) for r in fixes.collect()}
        rows = rows.withColumn("own", F.lit(None).cast("map<string,array<string>>"))
    else:
        need = base.select(F.col(key), "text").mapInArrow(_form_rows(key), f"`{key}` {kind}, bad string")
        own = need.join(fixes, "bad").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bad", "good"))).alias("own"))
        rows = rows.join(own, key, "left")
    if small_enough(heads, BROADCAST_ROWS):
        known = {(r["source"], r["head"]) for r in heads.collect()}
        rows = rows.withColumn("heads", F.lit(None).cast("array<string>"))
    else:
        need = base.select(F.col(key), "source", "text").mapInArrow(_key_rows(key), f"`{key}` {kind}, source string, head string")
        rows = rows.join(need.join(heads, ["source", "head"]).groupBy(key).agg(F.collect_set("head").alias("heads")), key, "left")
    blob = segments.sparkSession.sparkContext.broadcast(pickle.dumps((common, known)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, known = _unpickled(blob.value)
        for b in batches:
            texts, sources, own, mine = (b.column(i).to_pylist() for i in range(1, 5))
            got = []
            for t, s, o, h in zip(texts, sources, own, mine):
                is_head = (lambda k, s=s: (s, k) in known) if known is not None else (lambda k, h=frozenset(h or ()): k in h)
                got.append(mark(t, common if common is not None else dict(o or ()), is_head, lines))
            ints = [pa.array([g[i] for g in got], pa.int32()) for i in range(1, 5)]
            body = _line_lists([g[0] if t else [] for g, t in zip(got, texts)])
            yield pa.RecordBatch.from_arrays([b.column(0), body, *ints, pa.array([sum(g[1:]) > 0 for g in got], pa.bool_())], names=[key, "lines", "cut_words", "heads", "page_numbers", "misread", "noisy"])

    return rows.select(key, "text", "source", "own", "heads").mapInArrow(run, f"`{key}` {kind}, {MARK_SCHEMA}")


def _line_lists(rows: list[list[tuple[str, str]]]) -> pa.Array:
    """Lists of (line, kind), made of flat arrays."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = [x for r in rows for x in r]
    fields = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.string())], names=["line", "kind"])
    return pa.ListArray.from_arrays(pa.array(offsets), fields)


_HELD: dict = {}


def _unpickled(blob: bytes) -> tuple:
    if blob not in _HELD:
        _HELD.clear()
        _HELD[blob] = pickle.loads(blob)
    return _HELD[blob]


def _form_rows(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, f) for i, t in enumerate(b.column(1).to_pylist()) for f in set(forms(t))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in found], pa.int64())), pa.array([f for _, f in found], pa.string())], names=[key, "bad"])

    return run


def _key_rows(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, (s, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                if s is not None:
                    keys = set()
                    for x in visible(t).split("\n"):
                        if x.strip() and len(x.strip()) < HEAD_CHARS:
                            m = NUMBERED.match(x)
                            keys.add(head_key((m.group(1) or m.group(2)) if m else x.strip()))
                    found += [(i, s, k) for k in keys]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _, _ in found], pa.int64())), pa.array([s for _, s, _ in found], pa.string()), pa.array([k for _, _, k in found], pa.string())], names=[key, "source", "head"])

    return run


def reflowed(marks: DataFrame, key: str = "segment_id") -> DataFrame:
    """Continuous paragraphs: key, text. Heads and page numbers go, cut words are joined, wrapped lines are put together.

    A line opens a paragraph where a blank line, marker, heading or list mark parts it from the one before; blanks around
    a removed head or number part only where the sentence before is complete.
    """
    # texts whose lines are paragraphs already need no windows: all of them text, with blank lines between
    kinds = F.concat_ws("", F.transform("lines", lambda x: F.substring(x["kind"], 1, 1)))
    marks = marks.withColumn("__plain", ~kinds.rlike("[^tb]|tt"))
    solid_lines = F.filter("lines", lambda x: x["kind"] == "text")
    plain = marks.where("__plain").select(key, F.array_join(F.transform(solid_lines, lambda x: F.trim(x["line"])), "\n\n").alias("text")).where("text <> ''")
    lines = marks.where("not __plain").select(key, F.posexplode("lines").alias("no", "x")).select(key, "no", F.col("x.line").alias("line"), F.col("x.kind").alias("kind"))
    w = Window.partitionBy(key).orderBy("no")
    solid = F.col("kind").isin("text", "marker")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.select(
        key, "no", "kind", F.trim("line").alias("line"),
        F.last(F.when(solid, F.rtrim("line")), True).over(before).alias("prev"), F.last(F.when(solid, F.col("kind")), True).over(before).alias("prev_kind"), F.last(F.when(solid, F.col("no")), True).over(before).alias("prev_no"),
        F.sum(F.when(F.col("kind").isin("head", "number"), 1).otherwise(0)).over(before).alias("removed"), F.sum(F.when(F.col("kind") == "blank", 1).otherwise(0)).over(before).alias("blanks"),
    ).where(solid)
    w2 = Window.partitionBy(key).orderBy("no")
    gap_removed = F.coalesce(F.col("removed") - F.lag("removed").over(w2), F.lit(0)) > 0
    gap_blank = F.coalesce(F.col("blanks") - F.lag("blanks").over(w2), F.lit(0)) > 0
    complete = F.col("prev").rlike(_END.pattern)
    short = F.length("prev") < 30
    opens = (
        F.col("prev").isNull() | (F.col("kind") == "marker") | (F.col("prev_kind") == "marker") | F.col("line").rlike(_LIST.pattern)
        | (gap_blank & ~gap_removed) | (gap_removed & complete) | (short & ~complete & ~gap_removed & F.col("line").rlike(r"^\p{Lu}"))
    )
    numbered = lines.select(key, "no", "line", F.sum(F.when(opens, 1).otherwise(0)).over(w2).alias("paragraph"), "prev")
    # what joins a line to the one before: nothing after a cut word or between ideographs, else a blank
    p, n = F.col("prev"), F.col("line")
    hyphen = p.rlike(rf"\p{{L}}[{HYPHENS}]$") & n.rlike(r"^\p{Ll}")
    ideograph = p.rlike(r"[\x{3000}-\x{30FF}\x{3400}-\x{9FFF}\x{FF00}-\x{FFEF}]$") | n.rlike(r"^[\x{3000}-\x{30FF}\x{3400}-\x{9FFF}\x{FF00}-\x{FFEF}]")
    cutted = F.when(F.lead("paragraph").over(w2) == F.col("paragraph"), F.when(n.rlike(rf"\p{{L}}[{HYPHENS}]$") & F.lead("line").over(w2).rlike(r"^\p{Ll}"), F.regexp_replace(n, rf"[{HYPHENS}]$", "")).otherwise(n)).otherwise(n)
    glue = F.when(hyphen | ideograph, F.lit("")).otherwise(F.lit(" "))
    parts = numbered.select(key, "paragraph", "no", F.concat(glue, cutted).alias("part"))
    paras = parts.groupBy(key, "paragraph").agg(F.array_sort(F.collect_list(F.struct("no", "part"))).alias("xs")).select(key, "paragraph", F.trim(F.array_join(F.transform("xs", lambda x: x["part"]), "")).alias("body"))
    return plain.unionByName(paras.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "body"))), lambda x: x["body"]), "\n\n").alias("text")))
