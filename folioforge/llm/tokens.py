"""Token counts by source and language (problem 2).

A longest-match subword counter: a trie over the vocabulary with failure links. Each node holds how many tokens are
certain once the match fails there, so that a text is counted in one pass over its characters, without trying any
character twice. Words are remembered per Python worker. Characters outside the vocabulary count as their UTF-8 bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import estimate
from folioforge.llm import lid
from folioforge.llm.common import spread

#: Where the vocabulary lies; a parameter of every function that needs it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
REMEMBER = 400_000


class Counter:
    """Counts the tokens of greedy longest match; linear in the text."""

    def __init__(self, pieces: list[str]):
        self.child: list[dict[str, int]] = [{}]
        whole = [False]
        for p in pieces:
            at = 0
            for c in p:
                nxt = self.child[at].get(c)
                if nxt is None:
                    nxt = self.child[at][c] = len(self.child)
                    self.child.append({})
                    whole.append(False)
                at = nxt
            whole[at] = True
        n = len(self.child)
        self.fail, self.emit, self.rest = [0] * n, [0] * n, [0] * n
        queue = [(0, v, c) for c, v in self.child[0].items()]
        for u, v, c in queue:  # grows while it is read: breadth first
            if whole[v]:
                self.fail[v], self.emit[v] = 0, 1
            elif u == 0:
                self.fail[v], self.emit[v] = 0, len(c.encode())
            else:
                z, n_out = self.fail[u], self.emit[u]
                while True:
                    nxt = self.child[z].get(c)
                    if nxt is not None:
                        self.fail[v], self.emit[v] = nxt, n_out
                        break
                    if z == 0:
                        self.fail[v], self.emit[v] = 0, n_out + len(c.encode())
                        break
                    n_out += self.emit[z]
                    z = self.fail[z]
            queue.extend((v, w, d) for d, w in self.child[v].items())
        for _, v, _ in queue:
            self.rest[v] = self.emit[v] + self.rest[self.fail[v]]
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        child, fail, emit = self.child, self.fail, self.emit
        at = total = 0
        for c in word:
            while True:
                nxt = child[at].get(c)
                if nxt is not None:
                    at = nxt
                    break
                if at == 0:
                    total += len(c.encode("utf-8", "replace"))
                    break
                total += emit[at]
                at = fail[at]
        return total + self.rest[at]

    def text(self, text: str) -> int:
        """Tokens of a text; each word begins with the sign of a word's start, white space itself counts nothing."""
        known, total = self.known, 0
        for w in text.split():
            n = known.get(w)
            if n is None:
                n = self.word(START + w)
                if len(w) <= 40:
                    if len(known) > REMEMBER:
                        known.clear()
                    known[w] = n
            total += n
        return total


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The pieces of a SentencePiece model, without control and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=os.path.realpath(path))
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]


_COUNTER: dict[str, Counter] = {}


def worker_counter(path: str) -> Counter:
    if path not in _COUNTER:
        _COUNTER[path] = Counter(vocabulary(path))
    return _COUNTER[path]


def counted(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The kept columns of every row with ``text_estimate`` and the exact number ``tokens``.

    Null and empty texts have 0 of both. Repeated rows stay. Columns that are not kept are dropped.
    """
    source = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    source = source.withColumn("__estimate", estimate(F.col("__text")))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = worker_counter(path)
        for b in batches:
            n = pa.array([c.text(t) for t in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), b.column(len(keep) + 1), n], names=[*keep, "text_estimate", "tokens"])

    return source.mapInArrow(run, f"{types}, text_estimate bigint, tokens bigint")


def mistaken(stored: Column, true: Column) -> Column:
    """Whether a stored estimate is null or off by more than a quarter of the estimate of the text."""
    return stored.isNull() | (F.abs(stored - true) * 4 > true)


def file_name(c: Column) -> Column:
    """One spelling of a file name: last part of the path, lower case, runs of blanks, _ and - before letters as they are.

    Null, blank and wordless names become null.
    """
    base = F.regexp_replace(F.lower(F.trim(c)), r"^.*[/\\]", "")
    base = F.regexp_replace(F.regexp_replace(base, r"%20|\s+", "_"), r"_+", "_")
    return F.when(F.length(base) > 0, base)


def audit(segments: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Of each row of ``segments``: the stored estimate, the text's estimate, its exact tokens, and whether the stored
    one is mistaken."""
    rows = counted(spread(segments.select("segment_id", "token_estimate", "text")), ["segment_id", "token_estimate"], path=path)
    return rows.withColumn("mistaken", mistaken(F.col("token_estimate"), F.col("text_estimate")))


def host(url: Column) -> Column:
    """The domain of a URL in lower case without ``www.`` and port; null where there is none."""
    found = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:www\.)?([^/:?#]+)", 1)
    return F.when(found != "", found)


def named_sources(registry: DataFrame) -> DataFrame:
    """source_id, file and domain of every source: of repeated ones the latest version (of ties the greatest registry_id).

    Rows without a source_id name none. Repeated rows meet in a partial aggregation."""
    order = F.struct(F.coalesce(F.col("version"), F.lit(0)), F.col("registry_id"))
    last = registry.where(F.col("source_id").isNotNull()).groupBy("source_id").agg(F.max_by(F.struct("filename", "canonical_url"), order).alias("r"))
    return last.select("source_id", file_name(F.col("r.filename")).alias("registered_file"), host(F.col("r.canonical_url")).alias("domain"))


def totals(segments: DataFrame, registry: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Tokens by source file, domain and language, each unit once.

    A unit is a unit_id (rows without one count each for itself); of rows of one unit the lowest segment_id is taken.
    The language is the text's own, found by the models of :mod:`folioforge.llm.lid`; file names are brought to one
    spelling, and a missing one is the registered file of the source. The registry meets the totals by source, not the
    segments. The first aggregation is by unit, the second partial before its shuffle, so that a large source is no hot
    group. Unknown files, domains and languages are null.
    """
    model = lid.fit(segments, "text", "language", "segment_id")
    keep = ["segment_id", "unit_id", "source_file", "source_id"]
    n = counted(spread(segments.select(*keep, "text")), [*keep, "text"], path=path).withColumnRenamed("text", "body")
    found = lid.languages_of(n, model, "segment_id", "body", ["unit_id", "source_file", "source_id", "text_estimate", "tokens"]).where("passage_rank = 1")
    unit = F.coalesce(F.col("unit_id"), F.concat(F.lit("#"), F.col("segment_id").cast("string")))
    once = found.groupBy(unit.alias("unit")).agg(F.min_by(F.struct("source_file", "source_id", "lang", "text_estimate", "tokens"), "segment_id").alias("u"))
    sums = [F.sum("units").alias("units"), F.sum("token_estimate").alias("token_estimate"), F.sum("tokens").alias("tokens")]
    by_source = (
        once.groupBy(file_name(F.col("u.source_file")).alias("own_file"), F.col("u.source_id").alias("source_id"), F.col("u.lang").alias("language"))
        .agg(F.count("*").alias("units"), F.sum("u.text_estimate").alias("token_estimate"), F.sum("u.tokens").alias("tokens"))
    )
    named = by_source.join(named_sources(registry), "source_id", "left")
    return named.groupBy(F.coalesce("own_file", "registered_file").alias("source_file"), "domain", "language").agg(*sums)
