"""Raw files: scan, decode, register; JSON, JSON lines and CSV; staged and upserting sinks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.rules import media_type
from folioforge.operators.relational import first_per_key

#: Suffixes of files that are read (fixed values).
SUFFIXES = (".txt", ".md", ".markdown", ".pdf", ".epub")
FALLBACK = ("gb18030", "big5")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``root`` with a known suffix: relative_path, extension, media_type, bytes, sha256, content."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = F.regexp_replace(F.lit(root.rstrip("/")), "^file:(//)?", "")
    path = F.regexp_replace("path", "^file:(//)?", "")
    rel = F.substring(path, F.length(base) + 2, F.lit(100_000))
    ext = F.lower(F.regexp_extract(rel, r"(\.[^./]+)$", 1))
    files = raw.select(rel.alias("relative_path"), ext.alias("extension"), F.col("length").alias("bytes"), "content")
    return files.where(F.col("extension").isin(*SUFFIXES)).withColumn("media_type", media_type(F.col("extension"))).withColumn("sha256", F.sha2("content", 256))


def register(files: DataFrame) -> DataFrame:
    """Registry rows: source_id, path, name, hash, duplicate_of (the first source, by lower-case path, with the same bytes)."""
    x = files.withColumn("source_id", F.concat(F.lit("src_"), F.substring(F.sha2(F.concat(F.lower("relative_path"), F.lit("\n"), "sha256"), 256), 1, 20)))
    first = x.groupBy("sha256").agg(F.min_by("source_id", F.struct(F.lower("relative_path"), "relative_path")).alias("first"))
    named = x.join(first, "sha256").withColumn("filename", F.regexp_extract("relative_path", r"([^/]+)$", 1))
    return named.select("source_id", "relative_path", "filename", "media_type", "extension", "bytes", "sha256", F.when(F.col("first") != F.col("source_id"), F.col("first")).alias("duplicate_of"))


def decode(data: bytes | None, declared: str | None = None) -> tuple[str | None, str | None, int]:
    """(text, encoding, lost characters): a UTF-16 mark, UTF-8, the declared encoding, GB18030, Big5, UTF-8 with losses."""
    if data is None:
        return None, None, 0
    tries = [("utf-16", "utf-16")] if data[:2] in (b"\xff\xfe", b"\xfe\xff") else []
    tries += [("utf-8", "utf-8-sig" if declared is not None else "utf-8")]
    tries += [(declared, declared)] if declared else []
    for name, codec in [*tries, *((c, c) for c in FALLBACK)]:
        try:
            return data.decode(codec), name, 0
        except (UnicodeDecodeError, LookupError):
            continue
    text = data.decode("utf-8", "replace")
    return text, "utf-8-replace", text.count("�")


def decoded(df: DataFrame, keep: list[str], content: str = "content", charset: str | None = None) -> DataFrame:
    """Kept columns with text, encoding and replacements of the bytes in ``content``. Null content gives nulls and 0."""
    source = df.select(*keep, F.col(content).alias("__data"), (F.col(charset) if charset else F.lit(None)).cast("string").alias("__charset"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [decode(d, c) for d, c in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int64())], names=[*keep, "text", "encoding", "replacements"])

    return source.mapInArrow(run, f"{types}, text string, encoding string, replacements bigint")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole JSON documents, with or without a byte order mark; a document that is none gives a row in _corrupt_record."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One record a line; lines that are no JSON are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Appends one JSON object a line, its fields in the order of their names."""
    df.select(*sorted(df.columns)).write.mode("append").json(path)


def publish(df: DataFrame, path: str, checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None, keep_backup: bool = False) -> list[str]:
    """Writes to a staging folder beside ``path``, runs the checks on what was written (each returns violating rows) and
    swaps it in only if none has any. Returns the names of failed checks; then ``path`` is as it was.

    The swap renames the old folder away and the new one in; if the second rename fails the first is undone.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = f"{time.time_ns()}"
    staging, backup = f"{path}.staging-{mark}", f"{path}.backup-{mark}"
    hp = jvm.org.apache.hadoop.fs.Path
    df.write.mode("overwrite").parquet(staging)
    written = spark.read.parquet(staging)
    failed = [name for name, check in (checks or {}).items() if not check(written).isEmpty()]
    if failed:
        fs.delete(hp(staging), True)
        return failed
    had = fs.exists(p)
    if had and not fs.rename(p, hp(backup)):
        raise RuntimeError(f"{path} cannot be moved away")
    if not fs.rename(hp(staging), p):
        if had:
            fs.rename(hp(backup), p)
        raise RuntimeError(f"{path} cannot be put in place")
    if had and not keep_backup:
        fs.delete(hp(backup), True)
    return []


def upsert(base: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``base`` with the last change (by ``order``) of each key in place of its row, new keys appended. Columns that are
    null in a change keep the base's value."""
    last = first_per_key(changes, [key], [F.desc(c) for c in order])
    other = [c for c in base.columns if c != key]
    new = last.select(key, *[F.col(c).alias(f"__{c}") if c in last.columns else F.lit(None).alias(f"__{c}") for c in other])
    return base.join(new, key, "full_outer").select(key, *[F.coalesce(f"__{c}", c).alias(c) for c in other])
