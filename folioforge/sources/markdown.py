"""Structure of Markdown: sections, cards, quotations, front matter, dialogue. All on exploded lines in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators.cleaning import lines_of


def headed_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines with the heading they stand under: key, line_no, line, section (0 before the first), level, title."""
    w = Window.partitionBy(key).orderBy("line_no")
    x = lines_of(df, key, text)
    x = x.withColumn("h", F.regexp_extract("line", r"^(#{1,6})\s+\S", 1))
    head = F.col("h") != ""
    x = x.withColumns({"section": F.sum(F.when(head, 1).otherwise(0)).over(w), "level": F.last(F.when(head, F.length("h")), True).over(w), "title": F.last(F.when(head, F.trim(F.regexp_replace("line", r"^#+\s+", ""))), True).over(w), "is_head": head})
    return x.drop("h")


def sections(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, section, level, title, lines, chars of every section that has a heading."""
    return headed_lines(df, key, text).where("section > 0").groupBy(key, "section").agg(F.first("level").alias("level"), F.first("title").alias("title"), F.sum(F.when(F.col("is_head"), 0).otherwise(1)).alias("lines"), F.sum(F.when(F.col("is_head"), 0).otherwise(F.length("line"))).alias("chars"))


def cards(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Cards under ``###`` headings: key, card_no, title, verbatim (its ``>`` lines), fields (``- name: value``)."""
    x = headed_lines(df, key, text).where("level = 3 and not is_head")
    quote = F.when(F.col("line").rlike(r"^>\s?\S"), F.trim(F.regexp_replace("line", r"^>\s?", "")))
    rx = r"^-\s*([A-Za-z_]+|出处|语料位置|现代转译)\s*[：:]\s*(\S.*?)\s*$"
    field = F.when(F.col("line").rlike(rx), F.struct(F.regexp_extract("line", rx, 1).alias("k"), F.regexp_extract("line", rx, 2).alias("v"), F.col("line_no").alias("n")))
    g = x.groupBy(key, "section", "title").agg(F.sort_array(F.collect_list(F.when(quote.isNotNull(), F.struct("line_no", quote.alias("q"))))).alias("qs"), F.collect_list(field).alias("fs"))
    # the last value of a field counts
    latest = F.array_sort("fs", lambda a, b: a["n"] - b["n"])
    return g.select(key, F.col("section").alias("card_no"), "title", F.array_join(F.transform("qs", lambda s: s["q"]), "\n").alias("verbatim"), F.aggregate(latest, F.expr("cast(map() as map<string,string>)"), lambda m, f: F.map_concat(F.map_filter(m, lambda k, _: k != f["k"]), F.create_map(f["k"], f["v"]))).alias("fields"))


def quotations(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Bracketed quotations by their place: key, place (epigraph, source or list), quote. An epigraph is a ``>`` line
    before the first ``##``; list quotes stand in list or table lines under one."""
    x = headed_lines(df, key, text).withColumn("quote", F.regexp_extract("line", "「([^」]+)」", 1)).where("quote <> ''")
    place = (
        F.when(F.col("line").rlike(r"^\s*>") & (F.coalesce("level", F.lit(1)) < 2), "epigraph").when(F.col("line").rlike(r"^\*\*[^*]+[：:]\*\*"), "source")
        .when(F.col("line").rlike(r"^\s*[-*|]") & (F.col("level") >= 2), "list")
    )
    return x.select(key, "line_no", place.alias("place"), "quote").where("place is not null")


def front_matter(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, name, value) of the ``name: value`` lines between two ``---`` lines at the start; indented lines go on with
    the value before."""
    block = F.regexp_extract(F.col(text), r"(?s)\A---\r?\n(.*?)\r?\n---(?:\r?\n|\z)", 1)
    x = lines_of(df.select(key, block.alias("block")).where("block <> ''"), key, "block")
    w = Window.partitionBy(key).orderBy("line_no")
    x = x.withColumn("name", F.when(F.col("line").rlike(r"^[A-Za-z_][\w-]*:"), F.regexp_extract("line", r"^([A-Za-z_][\w-]*):", 1)))
    x = x.withColumn("no", F.count("name").over(w)).withColumn("value", F.trim(F.regexp_replace(F.regexp_replace("line", r"^[A-Za-z_][\w-]*:", ""), r"^\s*[>|]-?\s*$", "")))
    g = x.where("no > 0").groupBy(key, "no").agg(F.max("name").alias("name"), F.sort_array(F.collect_list(F.struct("line_no", "value"))).alias("vs"))
    return g.select(key, "name", F.trim(F.array_join(F.transform("vs", lambda v: v["value"]), " ")).alias("value"))


def dialogue_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Turns of a dialogue written with ``Q:`` and ``A:`` (also bold): key, line_no, role, content (to the next turn)."""
    rx = r"^\s*(?:\*\*)?([QA])[:：](?:\*\*)?\s*"
    x = lines_of(df, key, text).withColumn("mark", F.regexp_extract("line", rx, 1))
    w = Window.partitionBy(key).orderBy("line_no")
    x = x.withColumn("turn", F.sum(F.when(F.col("mark") != "", 1).otherwise(0)).over(w)).where("turn > 0")
    g = x.groupBy(key, "turn").agg(F.max("mark").alias("mark"), F.sort_array(F.collect_list(F.struct("line_no", F.regexp_replace("line", rx, "").alias("body")))).alias("ls"))
    return g.select(key, "turn", F.when(F.col("mark") == "Q", "user").otherwise("assistant").alias("role"), F.trim(F.array_join(F.transform("ls", lambda v: v["body"]), "\n")).alias("content"))


def pairs(turns: DataFrame, key: str) -> DataFrame:
    """One row per answer: key, turn, prompt (the last question since the answer before, else empty), response."""
    w = Window.partitionBy(key).orderBy("turn")
    x = turns.withColumn("g", F.coalesce(F.sum(F.when(F.col("role") == "assistant", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    asked = F.last(F.when(F.col("role") == "user", F.col("content")), True).over(Window.partitionBy(key, "g").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    return x.withColumn("prompt", F.coalesce(asked, F.lit(""))).where("role = 'assistant'").select(key, "turn", "prompt", F.col("content").alias("response"))


def template_residue(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no, placeholder) of every ``{…}`` left in a line."""
    x = lines_of(df, key, text).where(F.col("line").contains("{"))
    return x.select(key, "line_no", F.explode(F.expr(r"regexp_extract_all(line, '(\\{[^{}\\n]+\\})', 1)")).alias("placeholder"))


def page_ranges(c: Column) -> Column:
    """Page numbers of ``1-3,10``: sorted, distinct; null for anything else."""
    ok = c.rlike(r"^\s*\d+(\s*-\s*\d+)?(\s*,\s*\d+(\s*-\s*\d+)?)*\s*$")
    parts = F.split(F.regexp_replace(c, r"\s", ""), ",")
    ranges = F.transform(parts, lambda p: F.sequence(F.split(p, "-")[0].cast("int"), F.element_at(F.split(p, "-"), -1).cast("int")))
    return F.when(ok, F.array_sort(F.array_distinct(F.flatten(ranges))))
