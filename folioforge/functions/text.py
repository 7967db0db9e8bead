"""Scalar text expressions that stay inside the JVM.

Every function takes and returns a Column; null in gives null out unless said otherwise.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.isspace`` has it, as a class body that Java regex and RE2 both accept (fixed values).
SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The ideographs that the token estimate weighs (fixed values).
IDEOGRAPH = r"\x{4E00}-\x{9FFF}"


def count_chars(text: Column, cls: str) -> Column:
    """Number of characters of the class body ``cls``."""
    return F.length(F.regexp_replace(text, f"[^{cls}]+", ""))


def ideographs(text: Column) -> Column:
    return count_chars(text, IDEOGRAPH)


def non_space(text: Column) -> Column:
    """Number of characters that are not white space."""
    return F.length(F.regexp_replace(text, f"[{SPACE}]+", ""))


def estimate(text: Column) -> Column:
    """Token estimate (bigint): 0 for empty text, else at least 1 and trunc(1.05 ideographs + 0.263 others).

    Null text counts as empty.
    """
    t = F.coalesce(text, F.lit(""))
    cjk = ideographs(t)
    raw = cjk * F.lit(1.05) + (non_space(t) - cjk) / F.lit(3.8)
    return F.when(F.length(t) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), raw.cast("bigint"))).cast("bigint")


#: Which code points are white space, up to the last one that is.
BLANK = np.fromiter((chr(o).isspace() for o in range(0x3001)), bool, 0x3001)


def blanks(codes: np.ndarray) -> np.ndarray:
    """Which of an array of code points are white space."""
    return BLANK[np.minimum(codes, 0x2FFF)] | (codes == 0x3000)


def estimate_py(text: str | None) -> int:
    """The same estimate for one Python string (used inside Arrow functions)."""
    if not text:
        return 0
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cjk = int(((codes >= 0x4E00) & (codes <= 0x9FFF)).sum())
    return max(1, int(cjk * 1.05 + (len(codes) - int(blanks(codes).sum()) - cjk) / 3.8))


def blank_to_null(c: Column) -> Column:
    """Null for strings that are empty or all white space."""
    return F.when(F.length(F.trim(c)) > 0, c)


def letters_only(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")
