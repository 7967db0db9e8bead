"""Visually identical text with different characters (problem 7).

Compatibility normalization of widths, ligatures and look-alike ideographs; deletion of ignorable characters; one kind
of space. Then each word with letters that look alike in several alphabets is a lattice: at each letter stand all
letters of its look-alike class, and Viterbi finds the reading with the best character n-gram score that stays in one
script where it can. The lattice depends on the looks alone, so texts that look the same come out the same.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioforge.llm.lid import SEED
from folioforge.plans.lineage import cut

#: Letters of the same shape in Latin, Cyrillic and Greek (fixed values); a point stands where a script has none.
SHAPES = (
    "aа.", "cсϲ", "eе.", "iіι", "jјϳ", "oоο", "pрρ", "sѕ.", "xх.", "yу.", "hһ.", "dԁ.", "qԛ.", "wԝ.", "lӏ.", "v.ν", "u.υ",
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "HНΗ", "IІΙ", "JЈ.", "KКΚ", "MМΜ", "N.Ν", "OОΟ", "PРΡ", "SЅ.", "TТΤ", "XХΧ", "YҮΥ", "Z.Ζ", "WԜ.", "QԚ.", ".ГΓ", ".ПΠ", ".ФΦ", ".кκ",
)
SCRIPTS = ("latin", "cyrillic", "greek")
#: Other letters that look as those of the classes (fixed values).
ALIASES = {"ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "Ӏ": "I", "ｏ": "o", "ʜ": "н", "Υ": "Y", "Ү": "Y"}
IGNORABLE = "\u00ad\u034f\u061c\u115f-\u1160\u17b4-\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U000e0000-\U000e0fff"
SPACES = "\t\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
_IGNORABLE, _SPACE, _BREAK = re.compile(f"[{IGNORABLE}]"), re.compile(f"[{SPACES}]"), re.compile("\r\n|[\r\x0b\x0c\x85  ]")
_COMPAT = re.compile("[\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\ufb00-\ufb06\ufb13-\ufb17\ufb50-\ufdff\ufe70-\ufefc\u2e9f\u2ef3\u2f00-\u2fd5\u2160-\u217f\u0132-\u0133\u01c7-\u01cc\u01f1-\u01f3\uffa1-\uffdc]+")
_KANA_NARROW = re.compile("[\uff61-\uff9f]+")
_LETTERS = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
_LATIN, _CYRILLIC, _GREEK = r"A-Za-zÀ-ɏḀ-ỿ", r"Ѐ-ԯ", r"Ͱ-Ͽἀ-῿"
_FOREIGN = re.compile(f"[{_CYRILLIC}{_GREEK}]")
_GREEK_SEED = "Ο άνθρωπος που ήταν εκεί είπε ότι δεν είναι ακόμη γνωστό αν πήγαν στο σπίτι. Γιατί δεν απάντησε σε αυτή την ερώτηση; Οι άλλοι δεν πρέπει να είναι μαζί μας στην πόλη."

_CLASS: dict[str, tuple[str, ...]] = {}
for _shape in SHAPES:
    for _c in _shape:
        if _c != ".":
            _CLASS[_c] = tuple(_shape)
for _c, _d in ALIASES.items():
    if _d in _CLASS:
        _CLASS[_c] = _CLASS[_d]


@lru_cache(maxsize=None)
def _script(c: str) -> str | None:
    o = ord(c)
    if 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
        return "greek"
    if 0x400 <= o <= 0x52F:
        return "cyrillic"
    if c.isalpha() and (o < 0x250 or 0x1E00 <= o <= 0x1EFF):
        return "latin"
    return None


@lru_cache(maxsize=None)
def _scores() -> dict[str, dict[str, float]]:
    """Logarithms of smoothed character bigrams of each script, of the seed sentences."""
    texts = {"latin": " ".join(v for k, v in SEED.items() if k in ("en", "fr", "de", "es", "pt", "it")), "cyrillic": SEED["ru"], "greek": _GREEK_SEED}
    out = {}
    for script, text in texts.items():
        words = ["^" + unicodedata.normalize("NFD", w.lower()) + "$" for w in re.findall(r"[^\W\d_]+", text)]
        pairs, ones = Counter(), Counter()
        for w in words:
            w = "".join(c for c in w if not unicodedata.combining(c))
            pairs.update(w[i : i + 2] for i in range(len(w) - 1))
            ones.update(w[:-1])
        out[script] = {p: math.log((n + 0.1) / (ones[p[0]] + 4)) for p, n in pairs.items()} | {"": math.log(0.1 / 40)}
    return out


SWITCH = -9.0


def _read(word: str, prior: dict[str, float]) -> str:
    """The most likely reading of a decomposed word; ``prior``: logarithm of each script's weight in the text."""
    scores = _scores()
    base = [c for c in word if not unicodedata.combining(c)]
    # best score of a reading up to here by the script of the last letter, and that reading
    states: dict[str, tuple[float, str, str]] = {s: (prior.get(s, -20.0), "^", "") for s in SCRIPTS}
    for c in base:
        alts = _CLASS.get(c)
        new: dict[str, tuple[float, str, str]] = {}
        options = [(s, a) for s, a in zip(SCRIPTS, alts) if a != "."] if alts else [(_script(c), c)]
        for s, a in options:
            if s is None:
                new = {k: (v[0], "^", v[2] + c) for k, v in states.items()}
                break
            table = scores[s]
            best = max(((v[0] + (0.0 if k == s else SWITCH) + table.get((v[1] if k == s else "^") + a.lower(), table[""]), k) for k, v in states.items()), key=lambda x: (x[0], x[1] == "latin"))
            new[s] = (best[0], a.lower(), states[best[1]][2] + a)
        states = new
    reading = max(states.items(), key=lambda x: (x[1][0], x[0] == "latin"))[1][2]
    out, i = [], 0
    for c in word:
        if unicodedata.combining(c):
            out.append(c)
        else:
            out.append(reading[i])
            i += 1
    return "".join(out)


def canonical(text: str | None) -> str | None:
    """The one form of all texts that look like ``text``. Null stays null, an empty text empty.

    Widths, kinds of space, invisible characters, ligatures, accents composed or not, and the alphabet of letters of
    the same shape do not count. Raised digits, accents, case, punctuation and numbers do.
    """
    if not text:
        return text
    t = _BREAK.sub("\n", text)
    t = _SPACE.sub(" ", _IGNORABLE.sub("", t))
    if _KANA_NARROW.search(t):
        t = _KANA_NARROW.sub(lambda m: unicodedata.normalize("NFKC", m.group()), t)
    if _COMPAT.search(t):
        t = _COMPAT.sub(lambda m: unicodedata.normalize("NFKC", m.group()), t)
    t = unicodedata.normalize("NFC", t.replace("ํา", "ำ"))
    if not _FOREIGN.search(t) and not any(c in t for c in ALIASES):
        return t
    return unicodedata.normalize("NFC", _one_alphabet(unicodedata.normalize("NFD", t)))


def _one_alphabet(t: str) -> str:
    known = Counter(s for c, n in Counter(t).items() if c not in _CLASS and (s := _script(c)) for _ in range(min(n, 10_000)))
    total = sum(known.values())
    # scripts that show themselves in the text by letters of their own; Latin where there are none
    prior = {s: math.log(n / total) for s, n in known.items()} if total else {"latin": 0.0}
    only = next(iter(prior)) if len(prior) == 1 else None
    seen: dict[str, str] = {}

    def put(m: re.Match) -> str:
        w = m.group()
        r = seen.get(w)
        if r is None:
            if not any(c in _CLASS for c in w):
                r = w
            elif only is not None and all(c not in _CLASS or _CLASS[c][SCRIPTS.index(only)] != "." for c in w):
                k = SCRIPTS.index(only)
                r = "".join(_CLASS[c][k] if c in _CLASS else c for c in w)
            else:
                own = {s for c in w if c not in _CLASS and not unicodedata.combining(c) and (s := _script(c))}
                k = SCRIPTS.index(next(iter(own))) if len(own) == 1 else -1
                if k >= 0 and all(c not in _CLASS or _CLASS[c][k] != "." for c in w):
                    r = "".join(_CLASS[c][k] if c in _CLASS else c for c in w)
                else:
                    r = _read(w, prior)
            seen[w] = r
        return r

    return _LETTERS.sub(put, t)


#: What may make a text differ from its canonical form, for the JVM: anything named above, or two alphabets in one text.
_JAVA_SPECIAL = (
    r"[\t\r\x0B\x0C\x{85}\x{A0}\x{AD}\x{131}\x{132}\x{133}\x{1C7}-\x{1CC}\x{1F1}-\x{1F3}\x{251}\x{261}\x{29C}\x{300}-\x{36F}\x{340}\x{341}\x{374}\x{37E}\x{387}\x{61C}\x{653}-\x{655}"
    r"\x{958}-\x{95F}\x{9DC}-\x{9DF}\x{E4D}\x{1100}-\x{11FF}\x{1680}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{1F00}-\x{1FFF}\x{2000}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{206F}\x{2126}\x{212A}\x{212B}\x{2160}-\x{217F}"
    r"\x{2E9F}\x{2EF3}\x{2F00}-\x{2FD5}\x{3000}\x{3099}\x{309A}\x{F900}-\x{FAFF}\x{FB00}-\x{FDFF}\x{FE00}-\x{FE0F}\x{FE20}-\x{FE2F}\x{FE70}-\x{FEFF}\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{FF61}-\x{FFDC}\x{FFF0}-\x{FFF8}\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1F}\x{E0000}-\x{E0FFF}"
    # what else NFC may compose or take apart
    r"\x{93C}\x{9BE}\x{9D7}\x{A33}\x{A36}\x{A59}-\x{A5B}\x{A5E}\x{B3E}\x{B56}-\x{B57}\x{B5C}-\x{B5D}\x{BBE}\x{BD7}\x{C56}\x{CC2}\x{CD5}-\x{CD6}\x{D3E}"
    r"\x{D57}\x{DCA}\x{DCF}\x{DDF}\x{F43}\x{F4D}\x{F52}\x{F57}\x{F5C}\x{F69}\x{F73}\x{F75}-\x{F76}\x{F78}\x{F81}\x{F93}\x{F9D}"
    r"\x{FA2}\x{FA7}\x{FAC}\x{FB9}\x{102E}\x{1B35}\x{2329}-\x{232A}\x{2ADC}\x{110BA}\x{11127}\x{1133E}\x{11357}\x{114B0}\x{114BA}\x{114BD}\x{115AF}"
    r"\x{11930}]"
    # marks (also those newer than the JVM) that follow each other may change places; the vowel signs of Devanagari and Thai named here never do
    r"|[\p{M}\p{Cn}&&[^\x{900}-\x{903}\x{93A}\x{93B}\x{93E}-\x{94C}\x{94E}\x{94F}\x{E31}\x{E34}-\x{E37}\x{E47}\x{E4C}-\x{E4E}]]{2}"
)
#: The usual characters without any of these, for a first look that is much cheaper; none is a mark or unassigned.
_JAVA_PLAIN = r"[ -~\n\x{4E00}-\x{9FEF}\x{410}-\x{44F}\x{C0}-\x{FF}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{3001}\x{3002}\x{FF0C}\x{621}-\x{64A}\x{E01}-\x{E30}\x{E40}-\x{E46}\x{904}-\x{939}]"
_JAVA_ALPHABETS = r"[\x{370}-\x{3FF}\x{400}-\x{52F}\x{1F00}-\x{1FFF}]"
#: Cyrillic and Greek letters that have a shape of another alphabet: a text of them alone is read by its other letters.
_JAVA_LATIN = r"[A-Za-z\x{C0}-\x{24F}\x{1E00}-\x{1EFF}]"
_JAVA_OWN_CYRILLIC = r"[бвгдёжзийклмнптфцчшщъыьэюяБГДЁЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]"
_JAVA_GREEK = r"[\x{370}-\x{3FF}\x{1F00}-\x{1FFF}]"
_JAVA_RARE_CYRILLIC = r"[\x{400}\x{402}-\x{40F}\x{450}\x{452}-\x{52F}]"


def needs_work(text: Column) -> Column:
    """Whether ``text`` may differ from its canonical form. Texts of Latin letters alone, and of Russian ones alone with
    at least one letter of no other alphabet, are canonical as they are."""
    foreign = text.rlike(_JAVA_ALPHABETS)
    plain_russian = text.rlike(_JAVA_OWN_CYRILLIC) & ~text.rlike(_JAVA_LATIN) & ~text.rlike(_JAVA_GREEK) & ~text.rlike(_JAVA_RARE_CYRILLIC)
    rest = F.regexp_replace(text, f"{_JAVA_PLAIN}+", " ")  # what stands side by side still does
    return rest.rlike(_JAVA_SPECIAL) | (foreign & ~plain_russian)


@F.pandas_udf(StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore")


def canonical_column(text: Column) -> Column:
    """Canonical form; only texts that may differ from it go through Python."""
    return F.coalesce(_canonical_udf(F.when(needs_work(text), text)), text)


def with_canonical(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, text, canonical of every row; nulls stay null, repeated rows stay, other columns are dropped."""
    return df.select(F.col(key), F.col(text).alias("text")).withColumn("canonical", canonical_column(F.col("text")))


def _looks(tables: dict[str, tuple[DataFrame, str]], text: str) -> DataFrame:
    """tbl, id, two hashes of the canonical form and two of the text, of every row with a text, written once."""
    parts = []
    for name, (df, key) in tables.items():
        rows = with_canonical(df, key, text).where(F.col("text").isNotNull())
        hashes = [F.xxhash64("canonical").alias("c1"), F.xxhash64(F.lit("c"), "canonical").alias("c2"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("t"), "text").alias("t2")]
        parts.append(rows.select(F.lit(name).alias("tbl"), F.col(key).cast("bigint").alias("id"), *hashes))
    return cut(reduce(DataFrame.unionByName, parts))


def lookalike_classes(tables: dict[str, tuple[DataFrame, str]], text: str = "text") -> DataFrame:
    """(tbl, id, class_id, variants, members) of every row whose text has the form of a different string: class_id is the
    least id of the rows of that form, variants the number of different strings among its members.

    The form of use at scale: one row a member, however many pairs they make. Null texts are in no class.
    """
    rows = _looks(tables, text)
    look = ["tbl", "c1", "c2"]
    variants = rows.groupBy(*look, "t1", "t2").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    several = variants.groupBy(*look).agg(F.min("least").alias("class_id"), F.count("*").alias("variants"), F.sum("n").alias("members")).where("variants > 1")
    return rows.join(several, look).select("tbl", "id", "class_id", "variants", "members")


def lookalike_pairs(tables: dict[str, tuple[DataFrame, str]], text: str = "text") -> DataFrame:
    """(tbl, id_a, id_b): rows of one table whose texts have the same canonical form but are not the same string.

    ``tables``: of each name the DataFrame and its key. Equal strings are met once, as one variant: variants are paired
    before they are spread over their rows, so that a text repeated a million times makes no pairs of its own. Null
    texts are in no pair.
    """
    rows = _looks(tables, text)
    look = ["tbl", "c1", "c2"]
    variants = rows.select(*look, "t1", "t2").distinct()
    several = variants.groupBy(*look).count().where("count > 1").select(*look)
    variants = variants.join(several, look)
    members = rows.join(several, look, "left_semi")
    a = variants.select(*look, F.col("t1").alias("a1"), F.col("t2").alias("a2"))
    b = variants.select(*look, F.col("t1").alias("b1"), F.col("t2").alias("b2"))
    couples = a.join(b, look).where((F.col("a1") < F.col("b1")) | ((F.col("a1") == F.col("b1")) & (F.col("a2") < F.col("b2"))))
    left = members.select("tbl", F.col("t1").alias("a1"), F.col("t2").alias("a2"), F.col("id").alias("ia"))
    right = members.select("tbl", F.col("t1").alias("b1"), F.col("t2").alias("b2"), F.col("id").alias("ib"))
    pairs = couples.join(left, ["tbl", "a1", "a2"]).join(right, ["tbl", "b1", "b2"])
    return pairs.select("tbl", F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()
