"""What the modules of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from folioforge.plans.parallel import spread  # noqa: F401
from folioforge.sources.tables import table


def setting(spark: SparkSession, root: str, name: str) -> int:
    """One amount of the fixed table run_settings (three rows)."""
    row = table(spark, root, "run_settings").where(F.col("setting") == name).select("amount").first()
    if row is None:
        raise ValueError(f"run_settings has no {name}")
    return int(row[0])


#: Names and codes of the twelve languages (fixed values).
LANGUAGE_CODES = {
    "en": ("en", "eng", "english"), "zh": ("zh", "zho", "chi", "cmn", "chinese"), "fr": ("fr", "fra", "fre", "french"),
    "de": ("de", "deu", "ger", "german"), "es": ("es", "spa", "spanish"), "pt": ("pt", "por", "portuguese"),
    "it": ("it", "ita", "italian"), "ru": ("ru", "rus", "russian"), "ja": ("ja", "jpn", "jp", "japanese"),
    "hi": ("hi", "hin", "hindi"), "th": ("th", "tha", "thai"), "ar": ("ar", "ara", "arabic"),
}
LANGUAGES = tuple(LANGUAGE_CODES)


def label_language(label: Column) -> Column:
    """The language that a label names in any code or spelling (``en``, ``ENG``, ``en-US``), else null."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]+)(?:[-_ ].*)?$", 1))
    pairs = [x for lang, codes in LANGUAGE_CODES.items() for c in codes for x in (F.lit(c), F.lit(lang))]
    return F.try_element_at(F.create_map(*pairs), head)
