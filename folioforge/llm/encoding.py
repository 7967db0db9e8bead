"""Text that was read in another encoding than it was written in (problem 3).

The characters of a text are mapped back to the bytes of a legacy encoding. An automaton over the byte structure of a
multibyte encoding (UTF-8, GB18030, Big5, Shift-JIS, EUC) finds the maximal well-formed multibyte spans, and only those
are decoded. For single-byte alphabets, where every byte is well formed, the span is the suspect stretch itself. A
stretch is put right only where the new reading breaks far fewer rules of written text than the old one.

The rules are those of Unicode's character classes, not of a list of languages: no controls, private or unassigned
characters, no symbols or drawing signs inside words, no capitals after small letters, no two scripts in one word, the
letters of a line within one alphabet, ideographs within the first level of a national standard. They are counted in
numpy tables over code points, so that a reading costs a few array operations and not a loop over its characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings that garbled text was read in, and those it may have been written in.
READ_IN = ("cp1252", "latin-1", "mac-roman", "cp437", "cp1250", "cp1251", "koi8-r", "cp866", "cp850", "cp1254", "mac_cyrillic", "iso8859_5", "cp874", "cp1256")
#: Double-byte readings, by the codec that has exactly their double bytes.
READ_IN_WIDE = {"gb18030": "gbk", "big5": "cp950", "shift_jis": "cp932", "euc_jp": "euc_jp", "euc_kr": "cp949"}
WRITTEN_WIDE = ("gb18030", "euc_jp", "shift_jis", "big5")
WRITTEN_NARROW = ("cp1252", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859_5", "cp1256", "cp874", "mac-roman", "cp1250", "cp850", "cp437")
#: What it costs to have been written in encodings in which chance bytes look like words: from double bytes, else.
DOUBT = {
    "cp874": (0.3, 0.3), "cp1256": (0.3, 0.3), "koi8-r": (0.3, 0.03), "cp866": (0.3, 0.03), "mac-roman": (0.3, 0.05), "cp850": (0.3, 0.05),
    "cp437": (0.3, 0.06), "mac_cyrillic": (0.3, 0.05), "iso8859_5": (0.3, 0.05), "cp1250": (0.3, 0.1), "cp1251": (0.06, 0.0),
}
ROUNDS = 3
#: Signs of lost characters from which on a text is garbled though nothing of it can be read otherwise.
LOST = 3
#: Broken rules per character from which on a stretch is suspect, and how much of it one stretch must add up to.
SUSPECT, LEAST = 0.2, 4.0
#: What a reading costs at most that needs no comparison with those in further encodings.
CERTAIN = 0.03
LOSS = 0xFFFD

#: The byte structure of the multibyte encodings (fixed values).
UTF8 = rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3})"
#: Automata of the multibyte encodings: each finds the maximal well-formed spans.
SPANS = {
    "utf-8": re.compile(rb"(?:" + UTF8 + rb")+"),
    "gb18030": re.compile(rb"(?:[\x81-\xfe][\x40-\x7e\x80-\xfe]|[\x81-\xfe][\x30-\x39][\x81-\xfe][\x30-\x39])+"),
    "big5": re.compile(rb"(?:[\x81-\xfe][\x40-\x7e\xa1-\xfe])+"),
    "shift_jis": re.compile(rb"(?:[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]|[\xa1-\xdf])+"),
    "euc_jp": re.compile(rb"(?:[\xa1-\xfe][\xa1-\xfe]|\x8e[\xa1-\xdf]|\x8f[\xa1-\xfe][\xa1-\xfe])+"),
}
HIGH = re.compile(rb"[\x80-\xff]+")

#: Letters above ASCII of alphabets, small ones (fixed values): the letters of a line are to lie within one of them.
ALPHABETS = {
    "fr": "àâæçèéêëîïôœùûüÿ", "de": "äöüß", "es": "áéíñóúü", "pt": "àáâãçéêíóôõú", "it": "àèéìíîòóùú", "ca": "àçèéíïòóúü", "nl": "áäéëíïóöúü",
    "is": "áæðéíóöúýþ", "da": "åæøé", "sv": "åäöé", "cs": "áčďéěíňóřšťúůýž", "sk": "áäčďéíĺľňóôŕšťúýž", "pl": "ąćęłńóśźż", "hu": "áéíóöőúüű",
    "ro": "ăâîșțşţ", "hr": "čćđšž", "tr": "âçğıîöşûü", "lv": "āčēģīķļņšūž", "lt": "ąčęėįšųūž", "et": "äõöüšž", "eo": "ĉĝĥĵŝŭ", "mt": "ċġħżàèìòù",
    "cy": "âêîôûŵŷáéäëïö", "ga": "áéíóú", "sq": "çë", "yo": "àáèéẹìíòóọṣùú", "az": "çəğıöşü",
    "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "uk": "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя", "be": "абвгдеёжзійклмнопрстуўфхцчшыьэюя",
    "bg": "абвгдежзийклмнопрстуфхцчшщъьюя", "sr": "абвгдђежзијклљмнњопрстћуфхцчџш", "mk": "абвгдѓежзѕијклљмнњопрстќуфхцчџш",
    "kk": "аәбвгғдеёжзийкқлмнңоөпрстуұүфхһцчшщъыіьэюя",
}
#: Bits of information in a Russian letter, by how common it is (fixed values): for readings that only permute letters.
RUSSIAN = {"оеаи": 3.7, "нтср": 4.1, "влкмд": 4.8, "пуяыьг": 5.7, "збчйх": 6.2, "жшюцщэфъё": 8.0}
#: Frequent ideographs and kana of running text (fixed values).
FREQUENT = (
    "的一是在不了有和人这中大为上个国我以要他时来用们生到作地于出就分对成会可主发年动同工也能下过子说产种面而方后多定行学法所民得经十三之进着等部度家里如水高自二理起小现实加都两体当使点从业本去把性好应开它合还因由其些然前外天那"
    "這為個國時來們說過後經對會發動還沒樣與關長問題學書話從點實請讓"
)

(
    LOW, UP, DIGIT, SPACE, POINT, LAT_LOW, LAT_UP, VIET, CYR_LOW, CYR_UP, GREEK, ARAB, THAI, DEVA, OTHER, HANGUL, KANA, HALF, HAN_TOP, HAN_1, HAN_2,
    HAN_X, BOPO, TYPO, MARK, BOX, BAD, GONE, WIDE, JOIN, ACCENT, QUOTE,
) = range(32)
KINDS = 32
WORD, SIGN, RUN = 1, 2, 4
_QUOTE = set("«»„“”‚‹›")  # quotation marks that stand between two letters of no word
_TYPO = set("‘’–—…·•′″ ­  　")
_WORDS = (LOW, UP, LAT_LOW, LAT_UP, VIET, CYR_LOW, CYR_UP, GREEK)
_HAN = (HAN_TOP, HAN_1, HAN_2, HAN_X)


def _first_level() -> tuple[set[str], set[str]]:
    """Ideographs of the first levels of the Chinese, Japanese and Taiwanese standards, and all that these standards have."""
    first: set[str] = set()
    every: set[str] = set()
    rows = (("gb2312", range(0xB0, 0xF8), range(0xA1, 0xFF), 0xD8), ("euc_jp", range(0xB0, 0xF5), range(0xA1, 0xFF), 0xD0), ("big5", range(0xA4, 0xFA), (*range(0x40, 0x7F), *range(0xA1, 0xFF)), 0xC7))
    for codec, leads, trails, second in rows:
        for lead in leads:
            got = {c for t in trails if len(c := bytes((lead, t)).decode(codec, "ignore")) == 1}
            every |= got
            if lead < second:
                first |= got
    return first, every


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind of every code point, and which ones Japanese encodings lack."""
    kind = np.full(0x110000, MARK, np.uint8)
    foreign = np.zeros(0x110000, bool)
    first, every = _first_level()
    kind[0x10000:0x1D000], kind[0x1E000:0x1F000] = OTHER, OTHER
    kind[0x20000:0xE0000], kind[0xE0000:0xF0000], kind[0xF0000:] = HAN_X, JOIN, BAD
    for o in range(0x10000):
        c = chr(o)
        cat = unicodedata.category(c)
        k = MARK
        if o < 0x80:
            k = DIGIT if cat == "Nd" else LOW if cat == "Ll" else UP if cat == "Lu" else SPACE if o in (9, 10, 13, 32) else POINT if o > 32 and o < 127 else BAD
        elif o == LOSS:
            k = GONE
        elif c in _QUOTE:
            k = QUOTE
        elif c in _TYPO:
            k = TYPO
        elif cat in ("Cc", "Co", "Cn", "Cs"):
            k = BAD
        elif cat == "Cf":
            k = JOIN
        elif cat == "Sk":
            k = ACCENT
        elif 0x4E00 <= o <= 0x9FFF:
            k = HAN_TOP if c in FREQUENT else HAN_1 if c in first else HAN_2 if c in every else HAN_X
        elif 0x3400 <= o <= 0x4DBF:
            k = HAN_X
        elif 0x3041 <= o <= 0x30FF:
            k = KANA
        elif 0xFF66 <= o <= 0xFF9F:
            k = HALF
        elif 0x3105 <= o <= 0x312F:
            k = BOPO
        elif 0xAC00 <= o <= 0xD7A3 or 0x1100 <= o <= 0x11FF:
            k = HANGUL
        elif 0x2500 <= o <= 0x259F:
            k = BOX
        elif cat[0] == "L":
            if 0x1EA0 <= o <= 0x1EF9 or c in "ơưƠƯ":
                k = VIET
            elif o < 0x250 or 0x1E00 <= o <= 0x1EFF:
                k = LAT_UP if cat == "Lu" else LAT_LOW if c not in "ªº" else MARK
            elif 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
                k = GREEK
            elif 0x400 <= o <= 0x52F:
                k = CYR_UP if cat == "Lu" else CYR_LOW
            elif 0x600 <= o <= 0x77F or 0xFB50 <= o <= 0xFEFC:
                k = ARAB
            else:
                k = THAI if 0xE00 <= o <= 0xE7F else DEVA if 0x900 <= o <= 0x97F else OTHER
        elif cat[0] == "M":
            k = THAI if 0xE00 <= o <= 0xE7F else DEVA if 0x900 <= o <= 0x97F else ARAB if 0x600 <= o <= 0x6FF else JOIN
        elif 0x3001 <= o <= 0x303F or 0xFF01 <= o <= 0xFF60 or 0xFFE0 <= o <= 0xFFEF or 0xFE10 <= o <= 0xFE6F:
            k = WIDE
        elif cat[0] in "PZ" and o >= 0x2000 or cat == "Nd" or 0x60C <= o <= 0x61F or o in (0x964, 0x965, 0xE3F, 0xE46, 0x387, 0x37E):
            k = TYPO
        kind[o] = k
        if 0x4E00 <= o <= 0x9FFF:
            foreign[o] = not _has(c, "cp932")
    return kind, foreign


def _has(c: str, codec: str) -> bool:
    try:
        c.encode(codec)
        return True
    except UnicodeEncodeError:
        return False


def _costs() -> tuple[np.ndarray, np.ndarray]:
    """What a character costs by its kind, and a pair of neighbours by both."""
    base = np.zeros(KINDS, np.float32)
    base[BAD], base[HAN_2], base[HAN_X], base[BOX], base[HALF] = 3.0, 0.35, 1.1, 0.1, 0.15
    pair = np.zeros((KINDS, KINDS), np.float32)

    def both(xs, ys, cost: float) -> None:
        for x in xs:
            for y in ys:
                pair[x, y] = pair[y, x] = cost

    latin, cyrillic = (LOW, UP, LAT_LOW, LAT_UP, VIET), (CYR_LOW, CYR_UP)
    scripts = (latin, cyrillic, (GREEK,), (ARAB,), (THAI,), (DEVA,), (OTHER,), (HANGUL,))
    for i, a in enumerate(scripts):
        for b in scripts[i + 1 :]:
            both(a, b, 0.9)
        both((*_HAN, KANA), a if a is not latin else (LAT_LOW, LAT_UP), 0.9)
        both(a, (BOX,), 1.5)
        both(a, (HALF,), 0.8)
    both((*_HAN, KANA), (BOX,), 1.0)
    both((OTHER,), (OTHER,), 0.0)
    both((*_HAN, KANA), (HALF,), 1.3)
    both(_HAN, (BOPO,), 0.8)
    both((*_HAN, KANA), (OTHER,), 0.5)
    both((BOPO,), (BOPO,), 0.0)
    for a in _WORDS:
        pair[a, ACCENT], pair[ACCENT, a] = 0.9, 0.5
    for a, b in ((LOW, LAT_UP), (LAT_LOW, UP), (LAT_LOW, LAT_UP), (CYR_LOW, CYR_UP)):
        pair[a, b] = 1.2
    return base, pair


_KIND, _FOREIGN = _tables()
_BASE, _PAIR = _costs()
_PAIR = _PAIR.ravel()
_FLAGS = np.zeros(KINDS, np.uint8)
_FLAGS[list(_WORDS)] |= WORD
_FLAGS[[MARK, BOX, HALF, ACCENT, QUOTE]] |= SIGN
_FLAGS[[LAT_LOW, LAT_UP, MARK]] |= RUN
_IS_LETTER = np.isin(np.arange(KINDS), (LAT_LOW, LAT_UP, VIET, CYR_LOW, CYR_UP, GREEK, ARAB, THAI, DEVA, OTHER, HANGUL))
_IS_HAN = np.isin(np.arange(KINDS), _HAN)
_NAMES = list(ALPHABETS)
_ALPHABET = np.zeros((len(_NAMES), 0x530), np.float32)
_BITS = np.zeros(0x530, np.float32)
_SPECIAL = np.zeros(0x530, bool)  # letters that an alphabet must have: Latin ones above ASCII, and Cyrillic ones
for _i, _name in enumerate(_NAMES):
    for _c in ALPHABETS[_name] + ALPHABETS[_name].upper():
        if len(_c) == 1 and ord(_c) < 0x530:
            _ALPHABET[_i, ord(_c)] = 1
for _o in range(0x80, 0x530):
    _SPECIAL[_o] = _KIND[_o] in (LAT_LOW, LAT_UP, CYR_LOW, CYR_UP)
_BITS[0x400:0x530] = 8.0
for _cs, _b in {**RUSSIAN, "іїјўєґ": 5.0}.items():
    for _c in _cs + _cs.upper():
        _BITS[ord(_c)] = _b


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)


def broken(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each character breaks of the rules by itself and with its neighbours, and the characters' kinds."""
    k = _KIND[codes]
    v = _BASE[k]
    n = len(k)
    if n < 2:
        return v, k
    v[1:] += _PAIR[k[:-1].astype(np.int16) * KINDS + k[1:]]
    flags = _FLAGS[k]
    sign = (flags & SIGN) > 0
    if n > 2 and sign.any():
        w = (flags & WORD) > 0
        solid = sign & (k != QUOTE)
        v[1:-1] += 1.3 * (w[:-2] & sign[1:-1] & w[2:])
        two = sign[:-1] & sign[1:]
        if two.any():  # two signs before a letter, after one, or between two
            v[1:-1] += 0.6 * (two[:-1] & w[2:] & solid[1:-1])
            v[2:] += 0.9 * (w[:-2] & two[1:] & solid[2:])
            if n > 3:
                v[2:-1] += 1.3 * (w[:-3] & two[1:-1] & w[3:])
    run = (flags & RUN) > 0
    if n > 3 and run.any():
        four = run[3:] & run[2:-1] & run[1:-2] & run[:-3]
        if four.any():
            in_run = np.zeros(n, bool)
            for i in range(4):
                in_run[i : n - 3 + i] |= four
            v += 0.6 * (in_run & (k != MARK))
    if n > 2 and v.any():
        same = codes[1:] == codes[:-1]
        v[1:-1][same[:-1] & same[1:]] = 0  # drawn lines and the like
    return v, k


def _of_line(codes: np.ndarray, k: np.ndarray) -> float:
    """What a line breaks as a whole: letters of no one alphabet, seldom letters, seldom ideographs."""
    total = 0.0
    low = codes[codes < 0x530]
    low = low[_SPECIAL[low]]
    if len(low):
        n = np.bincount(low)
        has = np.flatnonzero(n)
        total += 0.6 * (len(low) - float((_ALPHABET[:, has] * n[has]).sum(1).max()))
        cyr = low[low >= 0x400]
        if len(cyr) >= 8:
            total += len(cyr) * 0.9 * max(0.0, float(_BITS[cyr].mean()) - 5.0)
    is_han = _IS_HAN[k]
    han = int(is_han.sum())
    if han:
        kana = int((k == KANA).sum())
        top = int((k == HAN_TOP).sum())
        if kana >= 0.15 * han:
            total += 3.0 * int(_FOREIGN[codes].sum()) + han * max(0.0, 0.05 - top / han)
        else:
            total += han * max(0.0, 0.24 - top / han) * (3.0 if han >= 6 else 1.0)
        ascii_by = int((is_han[1:] & (k[:-1] <= UP)).sum() + (is_han[:-1] & (k[1:] <= UP)).sum())
        if ascii_by > 0.3 * han:
            total += 0.8 * ascii_by
    return total


def badness(text: str) -> float:
    """How unlike written text the characters above ASCII are, per character: about 0 for sound text, above 1 for garbled."""
    codes = _codes(text)
    v, k = broken(codes)
    return _mean(codes, v, k)


def _mean(codes: np.ndarray, v: np.ndarray, k: np.ndarray) -> float:
    n = int(((codes >= 0x80) & (k != GONE)).sum())
    return (float(v.sum()) + _of_line(codes, k)) / n if n else 0.0


@lru_cache(maxsize=64)
def _byte_of(codec: str) -> np.ndarray:
    """Byte of a single-byte codec by code point, -1 where it has none; undefined bytes stand for the control of their number."""
    out = np.full(0x10000, -1, np.int16)
    out[:0x80] = np.arange(0x80)
    out[0x80:0xA0] = np.arange(0x80, 0xA0)
    for b in range(0x80, 0x100):
        c = bytes([b]).decode(codec, "ignore")
        if c:
            out[ord(c)] = b
    return out


@lru_cache(maxsize=64)
def _char_of(codec: str) -> np.ndarray:
    """Code point by byte of a single-byte codec."""
    return np.array([ord(bytes([b]).decode(codec, "ignore") or "�") for b in range(256)], np.int32)


def _bytes(codes: np.ndarray, codec: str) -> np.ndarray:
    return np.where(codes < 0x10000, _byte_of(codec)[np.minimum(codes, 0xFFFF)], -1)


def utf8_spans(text: str, codec: str, codes: np.ndarray | None = None) -> str | None:
    """``text`` with every maximal well-formed UTF-8 span of its bytes under a single-byte ``codec`` decoded; None where
    there is no span."""
    b = _bytes(_codes(text) if codes is None else codes, codec)
    lead = (b[:-1] >= 0xC2) & (b[:-1] < 0xF5)
    if not (lead & (((b[1:] >= 0x80) & (b[1:] < 0xC0)) | (b[1:] == 0x20))).any():
        return None
    data = np.where(b >= 0, b, 0x3F).astype(np.uint8)
    data[(b == 0x20) & np.append(False, (b >= 0xC2)[:-1] & (b < 0xF5)[:-1])] = 0xA0  # a no-break space that became a blank
    out, last = [], 0
    for m in SPANS["utf-8"].finditer(data.tobytes()):
        out.append(text[last : m.start()])
        out.append(m.group().decode("utf-8"))
        last = m.end()
    return "".join(out) + text[last:] if out else None


def _decode(data: bytes, written: str, keep: str | None) -> str:
    """``data`` read in ``written``. Of a multibyte encoding only the maximal spans with its byte structure are decoded;
    other high bytes stay as the characters of ``keep`` (an encoding) or become one sign of loss a stretch."""
    spans = SPANS.get(written)
    if spans is None:
        return data.decode(written, "replace")
    out, last = [], 0
    for m in spans.finditer(data):
        out.append(_outside(data[last : m.start()], keep))
        out.append(m.group().decode(written, "replace"))
        last = m.end()
    out.append(_outside(data[last:], keep))
    return "".join(out)


def _outside(data: bytes, keep: str | None) -> str:
    if keep:
        return data.decode(keep, "replace")
    return "�".join(x.decode("ascii") for x in HIGH.split(data)) if HIGH.search(data) else data.decode("ascii")


_ASCII_RUN = re.compile(r"[\x00-\x7f]+|[^\x00-\x7f]")


@lru_cache(maxsize=200_000)
def _double(c: str, codec: str) -> bytes | None:
    try:
        return c.encode(codec)
    except UnicodeEncodeError:
        two = c.encode("gb18030") if codec == "gbk" and c != "�" else b""
        return two if len(two) == 2 else None  # places of the double-byte plane that stand for private characters


def wide_stretches(line: str, codec: str, k: np.ndarray) -> list[str | bytes] | None:
    """``line`` as the maximal stretches that map back to double bytes of ``codec`` (bytes) and what lies between (str).
    None where nothing maps, or where the line is not mostly of signs that such codecs are for."""
    high = (k > POINT) & (k != TYPO) & (k != QUOTE) & (k != GONE)
    asian = _IS_HAN[k] | np.isin(k, (KANA, HALF, BOPO, WIDE, HANGUL)) | (k == BAD)
    if 2 * int((asian & high).sum()) < int(high.sum()):
        return None  # the double bytes of other alphabets say nothing
    parts = _stretches(line, lambda c: _double(c, codec))
    # a stretch read in another encoding maps here and there at most
    return parts if parts and 2 * sum(x != "�" for x in parts if isinstance(x, str)) < int((high & asian).sum()) else None


def narrow_stretches(line: str, codec: str) -> list[str | bytes] | None:
    """The same for a single-byte ``codec``."""
    table = _byte_of(codec)

    def one(c: str) -> bytes | None:
        b = int(table[ord(c)]) if ord(c) < 0x10000 else -1
        return None if b < 0 else bytes((b,))

    return _stretches(line, one)


def _stretches(line: str, to_bytes) -> list[str | bytes] | None:
    out: list[str | bytes] = []
    buf = bytearray()
    mapped = False
    for piece in _ASCII_RUN.findall(line):
        if piece < "\x80":
            buf += piece.encode("ascii")
            continue
        b = to_bytes(piece)
        if b is None:
            if buf:
                out.append(bytes(buf))
                buf.clear()
            out.append(piece)
        else:
            buf += b
            mapped = True
    if buf:
        out.append(bytes(buf))
    return out if mapped else None


def reading(stretches: list[str | bytes], written: str, keep: str | None = None) -> str:
    """The stretches of bytes read in ``written``, the rest as it is."""
    return "".join(x if isinstance(x, str) else _decode(x, written, keep) for x in stretches)


def _structured(parts: list[str | bytes], written: str) -> bool:
    """Whether nearly all high bytes lie in well-formed spans of a multibyte encoding."""
    high = inside = 0
    for x in parts:
        if isinstance(x, bytes):
            high += sum(map(len, HIGH.findall(x)))
            inside += sum(sum(map(len, HIGH.findall(m.group()))) for m in SPANS[written].finditer(x))
    return high > 0 and inside >= 0.85 * high


def _cost(codes: np.ndarray, order: int, written: str = "", wide: bool = False, most: float = 9e9) -> float:
    """What a reading costs, or a number over ``most`` where it costs more than that."""
    v, k = broken(codes)
    high = max(1, int((codes >= 0x80).sum()))
    lost = int((k == GONE).sum())
    fixed = 0.002 * order + DOUBT.get(written, (0.0, 0.0))[0 if wide else 1] + 0.5 * lost / high
    if float(v.sum()) / max(1, high - lost) + fixed > most:
        return 9e9
    cyr = codes[(k == CYR_LOW) | (k == CYR_UP)]
    fine = 0.2 * len(cyr) / high * max(0.0, float(_BITS[cyr].mean()) - 4.4) if len(cyr) else 0.0  # between two alphabets' readings
    return _mean(codes, v, k) + fine + fixed


def _put_right(line: str, first: tuple[str, str] | None = None, least: float = SUSPECT) -> tuple[str, str, str] | None:
    """The best other reading of a suspect stretch: (text, read in, written in), or None where none is much better.

    ``first``: the pair of encodings that put another line of the text right; where it does well here no other is tried.
    """
    codes = _codes(line)
    v, k = broken(codes)
    now = _mean(codes, v, k)
    if now < least or now * int(((codes >= 0x80) & (k != GONE)).sum()) < 0.9:
        return None  # not even one rule broken
    letters = int(_IS_LETTER[k].sum())
    mostly_letters = 10 * letters > 3 * int((k != SPACE).sum())
    may_lose = bool(((k == GONE) | (k == BAD)).any())
    best: tuple[float, str, str, str] | None = None
    for i, read in enumerate(READ_IN):
        new = line
        for _ in range(ROUNDS):  # text may have been garbled more than once
            got = utf8_spans(new, read, codes if new is line else None)
            if not got or got == new:
                break
            new = got
            b = _cost(_codes(new), i)
            if best is None or b < best[0]:
                best = (b, new, read, "utf-8")
        if best is not None and best[0] < 0.02:
            break
    if best is not None and best[0] < min(0.2, now / 2):
        return best[1:]
    seen: set[bytes] = {codes.tobytes()}

    def offer(new: np.ndarray, text, order: int, read: str, written: str, wide: bool) -> None:
        nonlocal best
        if not may_lose and (new == LOSS).any():
            return  # a right reading of a whole text loses nothing
        at = new.tobytes()
        if at in seen:
            return
        seen.add(at)
        b = _cost(new, order, written, wide, best[0] if best is not None else 9e9)
        if best is None or b < best[0]:
            best = (b, text if isinstance(text, str) else text(), read, written)

    def try_wide(j: int, read: str, only: str | None = None) -> None:
        parts = wide_stretches(line, READ_IN_WIDE[read], k)
        if parts is None:
            return
        for i, written in enumerate(("utf-8", *WRITTEN_WIDE, *WRITTEN_NARROW)):
            if written != read and only in (None, written) and (written not in SPANS or _structured(parts, written)):
                new = reading(parts, written)
                offer(_codes(new), new, i + j, read, written, True)

    def try_narrow(j: int, read: str, only: str | None = None) -> None:
        b = _bytes(codes, read)
        on = (b >= 0x80) & (codes >= 0x80)
        high = (codes >= 0x80) & (k != GONE) & (k != TYPO) & (k != QUOTE)
        at = b.tobytes()
        if at in seen:
            return
        seen.add(at)
        if not on.any() or 10 * int((on & high).sum()) < 9 * int(high.sum()):
            return  # the stretch was not read in this encoding
        for i, written in enumerate(WRITTEN_NARROW):
            if written != read and only in (None, written):
                new = np.where(on, _char_of(written)[np.maximum(b, 0)], codes)
                if mostly_letters and 10 * int(_IS_LETTER[_KIND[new]].sum()) < 7 * letters:
                    continue  # words that become signs
                offer(new, lambda new=new: "".join(map(chr, new.tolist())), i + j + 4, read, written, False)
        parts = None
        for i, written in enumerate(WRITTEN_WIDE):
            if only in (None, written):
                parts = parts or narrow_stretches(line, read)
                if parts and _structured(parts, written):
                    new = reading(parts, written, read)
                    offer(_codes(new), new, i + j, read, written, False)

    order = [*READ_IN_WIDE, *READ_IN]
    if first is not None:
        (try_wide if first[0] in READ_IN_WIDE else try_narrow)(0, first[0], first[1])
        if best is not None and best[0] < min(0.12, now / 3):
            return best[1:]
    for read in order:
        if best is not None and best[0] < CERTAIN:
            break
        (try_wide if read in READ_IN_WIDE else try_narrow)((list(READ_IN_WIDE) if read in READ_IN_WIDE else list(READ_IN)).index(read), read)
    if best is not None and (best[0] < min(0.25, now / 2) or best[0] < now - 0.6):
        return best[1:]
    return None


#: Two characters that well-formed UTF-8 leaves when read byte by byte, in any of the encodings.
_UTF8_TRACE = re.compile("|".join(("[ÂÃâåæçèéäãÐÑà][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]", "[√¬‚¿][\u00a0-ÿıŒœŸƒˆ-˝πΩ–-›€™⁄∂∆∏∑√∞∫≈≠≤≥◊ﬁﬂ\uf8ff]", "[├Γπσ╨╤][\u0080-ÿ─-▟ªº¿⌐¬½¼¡«»αßΓπΣσµτΦΘΩδ∞φε∩≡±≥≤⌠⌡÷≈°∙·√ⁿ²■]", "[ĂĹĂâĐŃ][\u0080-¿€-™ˇ˘Ł¤Ą¦§¨©ŞŤŹŻ°±˛ł´µ¶·¸ąşĽ˝ľżŚťźžśšŤť]", "[РСвГЂ][\u0080-¿Ђ-Џђ-џ€-™Ґґ°±Іі¶·№є»ј]")))


def _weight(text: str) -> float:
    """All that a text breaks of the rules."""
    codes = _codes(text)
    v, k = broken(codes)
    return float(v.sum()) + _of_line(codes, k)


def _passages(line: str) -> tuple[str, str, str] | None:
    """Reading of a line of which only a part is garbled: well-formed UTF-8 spans are decoded where each of them gains."""
    best = None
    now = _weight(line)
    codes = _codes(line)
    for read in READ_IN:
        got = utf8_spans(line, read, codes)
        if got and got != line:
            gain = now - _weight(got)
            if gain > 0.8 and badness(got) < 0.35 and (best is None or gain > best[0]):
                best = (gain, got, read)
    return None if best is None else (best[1], best[2], "utf-8")


def _densest(line: str) -> tuple[int, int] | None:
    """The stretch of a line in which broken rules stand densest, at word ends: (start, end); None where none is suspect."""
    codes = _codes(line)
    v, k = broken(codes)
    cyrillic = (k == CYR_LOW) | (k == CYR_UP)
    if v.sum() < LEAST and not cyrillic.any():
        return None
    x = v - np.where(codes < 0x80, 0.03, np.where((k == GONE) | cyrillic, 0.0, 0.3))
    x[cyrillic] += 0.35 * (_BITS[codes[cyrillic]] - 5.0)
    c = np.cumsum(x)
    low = np.minimum.accumulate(np.append(0.0, c[:-1]))
    end = int((c - low).argmax())
    if c[end] - low[end] < LEAST:
        return None
    start = int(np.append(0.0, c)[: end + 1].argmin())
    apart = (k == SPACE) | (k == WIDE)
    left, right = np.flatnonzero(apart[:start]), np.flatnonzero(apart[end + 1 :])
    start = int(left[-1]) + 1 if len(left) else 0
    end = end + 1 + int(right[0]) if len(right) else len(line)
    return None if start == 0 and end == len(line) else (start, end)


def _line_repair(line: str, first: tuple[str, str] | None) -> tuple[str, str, str] | None:
    """A line put right as a whole, or else its densest suspect stretch by itself."""
    new = _put_right(line, first)
    if new is not None:
        return new
    if _UTF8_TRACE.search(line):
        new = _passages(line)
    if span := _densest(line):
        for a, b in _trimmed(line, *span):
            part = _put_right(line[a:b], first, SUSPECT / 2)
            if part is not None:
                other = (line[:a] + part[0] + line[b:], *part[1:])
                if new is None or _weight(other[0]) < _weight(new[0]):
                    new = other
                break
    return new


def _trimmed(line: str, a: int, b: int) -> list[tuple[int, int]]:
    """A stretch, and the same without its last or its first word, which may be sound."""
    last, first = line.rfind(" ", a, b), line.find(" ", a, b)
    return [(a, b)] + ([(a, last), (first + 1, b)] if a < first < b else [])


def repair(text: str | None) -> tuple[str | None, str | None, str | None, bool]:
    """(text put right, read in, written in, lost): lost where the signs of lost bytes stand in place of most letters.

    Null and empty texts and sound texts come back as they are, with nulls.
    """
    if not text or text.isascii():
        return text, None, None, False
    codes = _codes(text)
    v, k = broken(codes)
    if v.sum() < 1.0 and (k == GONE).sum() < LOST and _mean(codes, v, k) < SUSPECT / 10 and not _UTF8_TRACE.search(text):
        return text, None, None, False  # not even one capital within a word
    first: tuple[str, str] | None = None
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if line.isascii():
            continue
        for _ in range(ROUNDS):
            new = _line_repair(line, first)
            if new is None or new[0] == line:
                break
            line, first = new[0], new[1:]
        lines[i] = line
    out = "\n".join(lines)
    read, written = first or (None, None)
    return out, read, written, out.count("�") >= LOST


OUT_SCHEMA = "garbled boolean, repaired string, read_in string, written_in string, lost boolean"


def repaired(df: DataFrame, key: str = "decoded_id", text: str = "text") -> DataFrame:
    """Every row with its text put right: key, garbled, repaired, read_in, written_in, lost.

    Nulls and empty texts are not garbled. Stored encoding and replacements are not read. Repeated rows stay.
    """
    kind = df.schema[key].dataType.simpleString()
    names = [key, "garbled", "repaired", "read_in", "written_in", "lost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [repair(t) for t in b.column(1).to_pylist()]
            garbled = pa.array([r[1] is not None or r[3] for r in rows], pa.bool_())
            strings = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), garbled, *strings, pa.array([r[3] for r in rows], pa.bool_())], names=names)

    return df.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, {OUT_SCHEMA}")
