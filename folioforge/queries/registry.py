"""All queries of the core, by name."""

from folioforge.queries import corpus, pages, records, tables, text

PARTS = (text, tables, corpus, pages, records)
QUERIES: dict = {name: q for part in PARTS for name, q in part.QUERIES.items()}
SQL: dict[str, str] = {name: s for part in PARTS for name, s in part.SQL.items()}
