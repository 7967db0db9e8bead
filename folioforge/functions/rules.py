"""Scalar rules of the corpus model: names, places, scores. Columns in, columns out; nulls give null unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import SPACE, count_chars, ideographs, non_space

#: Suffixes and their media types (fixed values).
MEDIA_TYPES = {".txt": "text/plain", ".md": "text/markdown", ".markdown": "text/markdown", ".pdf": "application/pdf", ".epub": "application/epub+zip"}
#: Slugs that name nothing (fixed values).
RESERVED = ("con", "prn", "aux", "nul")


def ladder(*steps: tuple[Column, object], default: object = None) -> Column:
    """CASE WHEN: the value of the first condition that holds."""
    out = None
    for cond, value in steps:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def listed(*steps: tuple[Column, str]) -> Column:
    """Sorted distinct labels of all conditions that hold, joined by ``|``."""
    labels = F.array(*[F.when(c, F.lit(name)) for c, name in steps])
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), "|")


def source_priority(name: Column) -> Column:
    """1 to 8 by prefix and words of a file name, the first rule that holds; 5 where none does."""
    n = F.lower(name)
    return ladder(
        (n.startswith("p1_"), 1), (n.startswith("p2_"), 2), (n.startswith("p3_"), 3), (n.contains("primary") | n.contains("first"), 2),
        (n.contains("secondary") | n.contains("biography"), 4), (n.contains("duplicate"), 8), default=5,
    )


def canonical_url(url: Column) -> Column:
    """Trimmed, https in place of http, without slashes at the end; the query stays."""
    return F.regexp_replace(F.regexp_replace(F.trim(url), "(?i)^http://", "https://"), "/+$", "")


def media_type(extension: Column) -> Column:
    e = F.lower(extension)
    return ladder(*[(e == k, v) for k, v in MEDIA_TYPES.items()], default="application/octet-stream")


def host_of(url: Column) -> Column:
    """Host of a URL, lower case, without port and closing point."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), r"\.$", "")


def host_allowed(host: Column, patterns: list[str]) -> Column:
    """Whether a host equals a pattern or, for ``*.x``, lies under x."""
    exact, under = [p for p in patterns if not p.startswith("*.")], [p[1:] for p in patterns if p.startswith("*.")]
    ok = host.isin(*exact) if exact else F.lit(False)
    for u in under:
        ok = ok | host.endswith(u)
    return ok


def slug_valid(slug: Column) -> Column:
    """Lower-case words joined by single hyphens, at most 64 characters, no reserved name."""
    return slug.rlike(r"\A[a-z0-9]+(-[a-z0-9]+)*\z") & (F.length(slug) <= 64) & ~slug.isin(*RESERVED)


def safe_path(path: Column) -> Column:
    """Whether a path is relative, without drive, backslash, empty, ``.`` or ``..`` parts."""
    return (F.length(path) > 0) & ~path.rlike(r"\\|^/|^[A-Za-z]:|//|/$") & ~path.rlike(r"(^|/)\.{1,2}(/|$)")


def detect_language(text: Column) -> Column:
    """zh, en or other by the first 4,000 characters: more ideographs than letters a to z, any letter, none."""
    s = F.substring(text, 1, 4000)
    cjk, letters = ideographs(s), count_chars(F.lower(s), "a-z")
    return ladder((cjk > letters, "zh"), (letters > 0, "en"), default="other")


def quality_score(text: Column) -> Column:
    """0 to 1 by fixed weights: 0.65, more for 80 solid characters, less for under 20, for lost and for control characters."""
    n = non_space(text).cast("double")
    lost, control = count_chars(text, r"\x{FFFD}"), count_chars(text, r"\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}")
    raw = F.lit(0.65) + ladder((n >= 80, 0.2), (n < 20, -0.25), default=0.0) - F.least(F.lit(0.25), lost / n * 2) - F.least(F.lit(0.15), control / n * 2)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def quality_band(score: Column) -> Column:
    return ladder((score >= 0.75, "good"), (score >= 0.45, "review"), (score > 0, "poor"), default="unreadable")


def difficulty(tokens: Column, ocr: Column, band: Column, language: Column, images: Column) -> Column:
    """low, medium or high by fixed points for size, scanned or poor text, other languages and images."""
    points = (
        ladder((tokens >= 45_000, 3), (tokens >= 30_000, 2), (tokens >= 20_000, 1), default=0)
        + F.when(F.coalesce(ocr, F.lit(False)) | F.coalesce(band.isin("poor", "unreadable"), F.lit(False)), 2).otherwise(0)
        + F.when(F.coalesce(language, F.lit("other")).isin("en", "zh"), 0).otherwise(1)
        + F.when(F.coalesce(images, F.lit(0)) > 0, 1).otherwise(0)
    )
    return ladder((points >= 5, "high"), (points >= 3, "medium"), default="low")


def confidence_rank(c: Column) -> Column:
    return ladder((c == "high", 0), (c == "medium", 1), (c == "low", 2), default=3)


def content_rank(c: Column) -> Column:
    return ladder((c == "principle", 0), (c == "quote", 1), (c == "behavior_record", 2), (c == "expression_sample", 3), (c == "analysis", 4), default=5)


def norm_line(line: Column) -> Column:
    """A trimmed line with each number masked by ``#``."""
    return F.regexp_replace(F.regexp_replace(line, f"^[{SPACE}]+|[{SPACE}]+$", ""), "[0-9]+", "#")


def seeded_rank(seed: Column, key: Column) -> Column:
    """First 16 hex digits of the SHA-256 of ``seed:key``: an order that is the same in every run."""
    return F.substring(F.sha2(F.concat(seed.cast("string"), F.lit(":"), key), 256), 1, 16)
