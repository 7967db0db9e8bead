"""Comparing names and titles in several spellings."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

CJK = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


def folded(text: str | None) -> str:
    """Compatibility form in lower case, letters and digits only; empty for null."""
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", text or "").lower())


def words(text: str | None) -> set[str]:
    """Words of letters of the compatibility form in lower case."""
    return set(re.findall(r"[^\W\d_]+", unicodedata.normalize("NFKC", text or "").lower()))


def names_match(name: str | None, field: str | None) -> bool:
    """Whether a field names a person: a name with ideographs or kana as a part of the field, any other with all its words."""
    if not name or not field:
        return False
    if CJK.search(name):
        part = folded(name)
        return bool(part) and part in folded(field)
    own = words(name)
    return bool(own) and own <= words(field)


@F.pandas_udf(StringType())
def folded_column(texts: pd.Series) -> pd.Series:
    return texts.map(folded, na_action="ignore")


@F.pandas_udf(BooleanType())
def _match(names: pd.Series, fields: pd.Series) -> pd.Series:
    return pd.Series([names_match(a, b) for a, b in zip(names, fields)])


def match_column(name: Column, field: Column) -> Column:
    """:func:`names_match` of two columns; null matches nothing."""
    return _match(name, field)


def same_titles(a: DataFrame, b: DataFrame, title_a: str, title_b: str) -> DataFrame:
    """(title_a, title_b): different spellings of titles of both sides that are the same when folded. Each spelling is folded
    once; null and wordless titles match none."""
    left = a.select(title_a).distinct().withColumn("__f", folded_column(F.col(title_a))).where("__f <> ''")
    right = b.select(title_b).distinct().withColumn("__f", folded_column(F.col(title_b))).where("__f <> ''")
    return left.join(right, "__f").select(title_a, title_b)
