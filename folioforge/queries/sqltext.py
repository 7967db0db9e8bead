"""Pieces of SQL that several queries share."""

SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def count_chars(text: str, cls: str) -> str:
    return rf"length(regexp_replace({text}, '[^{cls}]+', '', 'g'))"


def solid(text: str) -> str:
    return rf"length(regexp_replace({text}, '[{SPACE}]+', '', 'g'))"


def estimate(text: str) -> str:
    cjk = count_chars(f"coalesce({text}, '')", r"\x{4E00}-\x{9FFF}")
    return f"(CASE WHEN coalesce({text}, '') = '' THEN 0 ELSE greatest(1, trunc({cjk} * 1.05::DOUBLE + ({solid(f'coalesce({text}, {chr(39) * 2})')} - {cjk}) / 3.8::DOUBLE)::BIGINT) END)"


def lines(table: str, key: str, keep: str = "") -> str:
    """key, kept columns, line_no, line of a table's texts."""
    return rf"(SELECT {key}{keep}, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT {key}{keep}, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM {table} WHERE text IS NOT NULL))"
