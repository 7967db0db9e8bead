"""Sentence boundaries across languages and scripts (problem 5).

Segmentation rules in cascading tables: each rule is a pair of regular expressions, for what stands before and after a
position, and says break or no break. The rules of a text's language come first, then those of its script, then the
common ones; at each candidate position the first rule that matches decides. Candidates are the ends of stops with
their closing quotes, and white space in Thai. Quotations and brackets are matched per line beforehand: a stop inside
them is no candidate, and the rules see whether a closed quotation opened its sentence.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import lid

#: Abbreviations that take what follows with them (fixed values); those of _OPEN end a sentence before a capital.
ABBREVIATIONS = {
    "en": "Mr Mrs Ms Dr Prof St Rev Gen Col Capt Lt Sgt Sen Rep Hon Jr Sr vol vols no nos p pp fig figs ed eds cf ca approx i.e e.g viz vs ch sec art op cit al Messrs",
    "fr": "M MM Mme Mlle Dr Pr St Ste t p pp n no vol fig éd cf c.-à-d p.ex env chap art av apr",
    "de": "Hr Fr Dr Prof St Bd Bde S Nr Abb Hg Hrsg vgl ca d.h z.B u.a bzw Kap Art Abs geb gest Jh v n d z u",
    "es": "Sr Sra Srta Dr Dra D Dña Prof St Sto Sta vol vols núm n pág págs p pp fig ed eds cf aprox p.ej ej cap art EE UU",
    "pt": "Sr Sra Srta Dr Dra D Prof S Sto Sta vol vols n núm pág págs p pp fig ed eds cf aprox p.ex ex cap art séc",
    "it": "sig sigg sig.ra dott dott.ssa prof S vol voll n num pag pagg p pp fig ed cfr ca art cap sec p.es es",
    "ru": "г гг т тт с стр п пп рис см ср им ред изд д-р проф св гл ст т.е т.к напр ок руб коп н",
    "hi": "डॉ पृ श्री श्रीमती सं प्रो खं क्र रु",
    "ar": "د ص ج م أ ه هـ ق ط",
    "th": "ดร นพ พญ ผศ รศ ศ พ.ศ ค.ศ น จ อ ต ถ",
}
#: Abbreviations only before a number; elsewhere they are words.
_NUMBERED = {"en": "no nos art sec op ch ed fig", "it": "sec num", "es": "art", "pt": "art ex", "fr": "art no env", "de": "Art Fr d u v n z"}
_OPEN = {"en": "etc a.m p.m Inc Ltd Co Bros B.C A.D", "fr": "etc", "de": "usw etc", "es": "etc a.m p.m Ud Uds", "pt": "etc a.m p.m", "it": "ecc etc", "ru": "т.д т.п др пр"}
OPENERS, CLOSERS = "“«„「『《〈(（[【‹‚", "”»」』》〉)）]】›"
PAIRS = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "《": "》", "〈": "〉", "(": ")", "（": "）", "[": "]", "【": "】", "‹": "›", "‚": "‘’"}
BRACKETS = "(（[【《〈"
STOPS = ".!?…。！？｡．।॥؟۔‼⁇⁈⁉"
_STOP = re.compile(rf"[{re.escape(STOPS)}]+")
_MARK = re.compile(r"\s*(?:[-*•–—·]\s+|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)]\s+|[①-⑳]\s*)")
_GLUE = r"(?<![^\W\d_])"


def _words(text: str) -> str:
    return "|".join(re.escape(w) for w in sorted(text.split(), key=len, reverse=True))


Rule = tuple[bool, re.Pattern, re.Pattern]
_ANY = re.compile("")


def _rules() -> dict[str, list[Rule]]:
    upper, lower = r"\s+[\"“«„‘'(\[¿¡]*(?=[^\W\d_])(?-i:[A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞĪŁŃŇŌŐŘŚŞŠŤŪŮŰŹŻŽА-ЯЁ])", r"\s*[\"“«„‘'(\[]*[a-zß-öø-ÿа-яё]"
    rules: dict[str, list[Rule]] = {}
    for lang, words in ABBREVIATIONS.items():
        own: list[Rule] = []
        # letters with stops between them may stand apart: "d. h.", "т. е.", "p. ej."
        if lang in _OPEN:
            opened = "|".join(re.escape(w).replace(r"\.", r"\.\s?" if w.islower() else r"\.") for w in sorted(_OPEN[lang].split(), key=len, reverse=True))
            own.append((True, re.compile(rf"{_GLUE}(?:{opened})\.$"), re.compile(rf"{upper}|\s*$")))
            own.append((False, re.compile(rf"{_GLUE}(?:{opened})\.$"), _ANY))
        if lang in _NUMBERED:
            own.append((True, re.compile(rf"(?<![^\W_])(?:{_words(_NUMBERED[lang])})\.$"), re.compile(r"\s+[\"“«„¿¡]*[A-ZÀ-Þ][a-zß-ÿ]+\s+[a-zß-ÿ]")))
        spaced = "|".join(re.escape(w).replace(r"\.", r"\.\s?") for w in sorted(words.split(), key=len, reverse=True))
        before = r"(?<![^\W_])" if lang not in ("hi", "th") else r"(?:(?<=^)|(?<=\s)|(?<=[\"“«(]))" if lang == "hi" else ""
        own.append((False, re.compile(rf"{before}(?:{spaced})\.$"), re.compile(r"\s*\S")))
        rules[lang] = own
    months = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahrhundert|Jh|Kapitel|Auflage|Teil"
    rules["de"] += [(False, re.compile(r"\b\d{1,3}\.$"), re.compile(rf"\s+(?:{months})\b|\s+[a-zäöüß]"))]
    rules["ja"] = [(False, re.compile(r"[」』）)]$"), re.compile(r"[ぁ-ん、，,・]"))]
    rules["zh"] = [(False, re.compile(r"[”』」）)]$"), re.compile(r"[，、；：,]"))]
    rules["cjk"] = [
        (False, re.compile(r"(?:……|…|\.\.\.|‥‥)[”」』]?$"), re.compile(r"[^\s“「『]")),
        (True, re.compile(r"[。！？｡．!?][”」』）)’\"]*$"), _ANY),
        (False, re.compile(r"\.$"), re.compile(r"\S")),
    ]
    rules["thai"] = [
        (False, re.compile(r"\d\.$"), re.compile(r"\d")),
        (False, re.compile(r"[^!?]$"), re.compile(r"\S")),
    ]
    rules["common"] = [
        (True, _ANY, re.compile(r"\s*$")),
        (False, re.compile(r"\d\.$"), re.compile(r"\d")),  # decimals, versions
        (False, re.compile(r"[.…]$"), re.compile(r"[^\s\"”’)\]»]")),  # no white space: names of files, sites
        (False, re.compile(r"(?<![^\W_])[^\W\d_]\.$"), re.compile(r"\s*(?:[^\W\d_]\.|[A-ZÀ-ÞА-ЯЁ][^\W\d_]+|[-–])")),  # initials
        (False, re.compile(r"(?:\.{2,}|…)[”\"»’)\]]*$"), re.compile(lower)),
        (False, re.compile(r"(?:\.{2,}|…)$"), re.compile(r"\s+[^\sA-ZÀ-ÞА-ЯЁ\"“«¿¡]")),
        (False, _ANY, re.compile(r"\s*[,;:،؛]|\s+[–—]\s+[^\W\d_A-ZÀ-ÞА-ЯЁ]|\s*[–—]\s+[a-zа-яё]")),
        (False, re.compile(r"[.!?…][”\"»’)\]“]*$"), re.compile(r"\s*[a-zß-öø-ÿа-яё]")),
        (True, re.compile(r"[।॥؟۔.!?…‼⁇⁈⁉][”\"»’)\]“]*\s?[”\"»]?$"), re.compile(r"\s+|[A-ZÀ-ÞА-ЯЁ؀-ۿऀ-ॿ“«\"]")),
        (True, re.compile(r"[।॥؟]$"), _ANY),
    ]
    return rules


RULES = _rules()
_SCRIPT = {"zh": "cjk", "ja": "cjk", "th": "thai"}


def cascade(lang: str | None) -> list[Rule]:
    """The rules for a language: its own, its script's, the common ones. Unknown languages get English's."""
    own = RULES.get(lang or "en", [])
    return [*own, *(RULES[_SCRIPT[lang]] if lang in _SCRIPT else []), *RULES["common"]]


_CASCADE = {x: cascade(x) for x in (None, *lid.LANGUAGES)}


def _spans(line: str) -> list[tuple[int, int, bool]]:
    """Matched quotations and brackets of a line, outermost only: (start, end, whether a bracket)."""
    out: list[tuple[int, int, bool]] = []
    stack: list[tuple[str, int]] = []
    found: list[tuple[int, int, bool]] = []
    for i, c in enumerate(line):
        if c == '"':
            k = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == '"'), None)
            if k is None:
                stack.append((c, i))
            else:
                found.append((stack[k][1], i + 1, False))
                del stack[k:]
        elif c in PAIRS and not (c == "“" and any(s[0] == "„" for s in stack)):
            stack.append((c, i))
        elif c in CLOSERS or c in "“’‘":
            k = next((j for j in range(len(stack) - 1, -1, -1) if c in PAIRS.get(stack[j][0], "")), None)
            if k is not None:
                found.append((stack[k][1], i + 1, stack[k][0] in BRACKETS))
                del stack[k:]
    for s in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


_PLAIN = re.compile(r"[\"“”«»„「」『』《》〈〉(（)）\[\]【】‹›‚]")


def line_ends(line: str, lang: str | None) -> list[int]:
    """Ends of the sentences of one line (white space after them left out), the last being the line's end."""
    stop = len(line.rstrip())
    first = len(line) - len(line.lstrip())
    if stop <= first:
        return []
    m = _MARK.match(line)
    begin = m.end() if m and m.end() < stop else first
    spans = _spans(line) if _PLAIN.search(line) else []
    rules = _CASCADE.get(lang, _CASCADE[None])
    thai = lang == "th"
    candidates: list[tuple[int, bool]] = []  # position, whether a closed quotation stands there
    k = 0
    for m in (_TH if thai else _STOP).finditer(line, begin):
        at = m.start()
        while k < len(spans) and spans[k][1] <= at:
            k += 1
        if k < len(spans) and spans[k][0] <= at < spans[k][1]:
            continue
        candidates.append((at if thai and line[at].isspace() else m.end(), False))
    for s, e, bracket in spans:
        inner = line[s + 1 : e - 1].rstrip()
        if s >= begin and inner and (inner[-1] in STOPS or inner[-1:] in "”»’」』\"" and inner[-2:-1] in STOPS):
            candidates.append((e, True))
    candidates.sort()
    opened = {e: (s, b) for s, e, b in spans}
    out: list[int] = []
    start = begin
    for at, closed in candidates:
        if at <= start or at >= stop:
            continue
        if closed:
            s, bracket = opened[at]
            own = not line[start:s].strip()
            if bracket != own:  # a remark within a sentence, or a quotation that its speaker follows
                continue
        if thai and line[at : at + 1].isspace():
            if spans and any(e == at and not line[start:s].strip() and not b for s, e, b in spans):
                continue
            if not RULES["th"][0][1].search(line, start, at) and not line[start:at].isspace():
                out.append(at)
                start = at + len(line[at:]) - len(line[at:].lstrip())
            continue
        for is_break, before, after in rules:
            if before.search(line, start, at) and after.match(line, at):
                if is_break:
                    out.append(at)
                    start = at + len(line[at:]) - len(line[at:].lstrip())
                break
    if not out or out[-1] < stop:
        out.append(stop)
    return out


_TH = re.compile(r"\s+|[!?]+")
_ENDED = re.compile(r"[.!?…。！？।؟۔:：;；][”\"»’」』）)\]“›*_]*\s*$|[”»」』]\s*$")
_LINE = re.compile(r"[^\r\n  \x0b\x0c\x85]+")


def wrapped(line: str, following: str, lang: str | None) -> bool:
    """Whether ``following`` goes on with the sentence of ``line``: a full-width line without a stop at its end."""
    wide = 16 if lang in ("zh", "ja") else 35
    s = line.strip()
    return lang != "th" and len(s) >= wide and not _ENDED.search(s) and not _MARK.match(following) and not following.lstrip().startswith(("#", "---", ">"))


def sentence_ends(text: str | None, lang: str | None) -> list[tuple[int, int]]:
    """(start, end) of every sentence in code points. Null and blank texts have none."""
    out: list[tuple[int, int]] = []
    lines = [(m.start(), m.group()) for m in _LINE.finditer(text or "")]
    i = 0
    while i < len(lines):
        base, body = lines[i]
        j = i
        while j + 1 < len(lines) and body.strip() and lines[j + 1][1].strip() and text[lines[j][0] + len(lines[j][1]) : lines[j + 1][0]] in ("\n", "\r\n", "\r") and wrapped(lines[j][1], lines[j + 1][1], lang):
            j += 1
            body = text[base : lines[j][0] + len(lines[j][1])]
        last = 0
        for e in line_ends(body.replace("\r", " ").replace("\n", " "), lang):
            s = last + len(body[last:e]) - len(body[last:e].lstrip())
            out.append((base + s, base + e))
            last = e
        i = j + 1
    return out


def _script_language(line: str, lang: str | None) -> str | None:
    """``lang``, unless the line is in the script of another language."""
    n = len(line)
    if lid.KANA.search(line) and len(lid.KANA.findall(line)) * 8 > n:
        return "ja"
    if lang != "ja" and len(lid.HAN.findall(line)) * 3 > n:
        return "zh"
    return lang


SCHEMA = "sentence_no int, start_pos int, end_pos int, language string, sentence string"


def sentences(df: DataFrame, model: lid.Model, key: str = "segment_id", text: str = "text") -> DataFrame:
    """One row per sentence: key, sentence_no, start_pos and end_pos (code points), language, sentence.

    The language is the text's own by ``model``, whatever its label says. Null, empty and blank texts give no row;
    repeated rows are cut each with its own key; columns but key and text are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    blob = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = lid.worker_model(blob.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            s, chars = m.score_lines([t or "" for t in texts])
            s = m.restrain([t or "" for t in texts], s)
            langs = [m.languages[k] if n else None for k, n in zip(s.argmax(1), chars)]
            row, no, start, end, lang, body = [], [], [], [], [], []
            for i, (t, x) in enumerate(zip(texts, langs)):
                for k, (a, e) in enumerate(sentence_ends(t, _script_language(t or "", x))):
                    row.append(i)
                    no.append(k + 1)
                    start.append(a)
                    end.append(e)
                    lang.append(x)
                    body.append(t[a:e])
            ints = lambda x: pa.array(np.array(x, np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), ints(no), ints(start), ints(end), pa.array(lang, pa.string()), pa.array(body, pa.string())], names=[key, "sentence_no", "start_pos", "end_pos", "language", "sentence"])

    return df.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")
