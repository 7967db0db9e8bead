"""Queries on names, record summaries, page titles and surviving sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import names, style, summary
from folioforge.sources import html
from folioforge.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


@query("""SELECT content_type, count(*) AS records, count(*) FILTER (len(topic_tags) > 0) AS with_evidence, round(avg(len(topic_tags)), 6) AS mean_score
FROM extracts GROUP BY 1""")
def principle_summary(spark: SparkSession, root: str) -> DataFrame:
    """Records of each kind, those with evidence, and their mean score (the number of topic tags)."""
    n = F.when(F.col("topic_tags").isNotNull(), F.size("topic_tags"))
    return summary.record_summary(table(spark, root, "extracts"), "content_type", n > 0, n)


@query("""SELECT extract_id, coalesce(len(topic_tags), 0) AS n_topic_tags,
(CASE WHEN trim(text) <> '' THEN 1 ELSE 0 END) + (CASE WHEN trim(source_detail) <> '' THEN 1 ELSE 0 END) + (CASE WHEN trim(source_url) <> '' THEN 1 ELSE 0 END)
+ (CASE WHEN trim(confidence) <> '' THEN 1 ELSE 0 END) AS filled FROM extracts""")
def framework_counts(spark: SparkSession, root: str) -> DataFrame:
    """Of each record the sizes of its lists and its fields that are not blank."""
    return summary.field_counts(table(spark, root, "extracts"), "extract_id", ["topic_tags"], ["text", "source_detail", "source_url", "confidence"])


@query("""SELECT shard_id, count(*) AS rows, count(DISTINCT extract_id) AS keys, count(*) FILTER (confidence = 'low') AS flagged,
count(*) = 10 AND count(DISTINCT extract_id) = count(*) AND count(*) FILTER (confidence = 'low') = 0 AS ok FROM extracts GROUP BY 1""")
def closed_set_check(spark: SparkSession, root: str) -> DataFrame:
    """Whether each shard has exactly ten extracts, all different, none of low confidence."""
    return summary.closed_set(table(spark, root, "extracts"), "shard_id", "extract_id", 10, F.col("confidence") == "low")


@query()
def same_titles(spark: SparkSession, root: str) -> DataFrame:
    """Titles of documents and of extracts that are the same in compatibility form (no SQL: DuckDB has no NFKC)."""
    return names.same_titles(table(spark, root, "documents"), table(spark, root, "extracts"), "title", "source_title")


@query(r"""SELECT doc_id, nullif(trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')), '') AS page_title, '/next|/p?id=' || doc_id::VARCHAR AS links, false AS hidden_shown
FROM documents WHERE text IS NOT NULL""")
def page_links(spark: SparkSession, root: str) -> DataFrame:
    """Titles and links of documents put into pages with nested navigation, hidden parts and dropped classes and ids."""
    e = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(
        F.lit("<html><head><title>\n "), e("title"), F.lit("</title></head><body><nav><div><a href='/menu'>QQZ</a></div></nav><div id='headerContainer'>QQZ</div>"),
        F.lit("<div style='color:red; display : none'><p>QQZ <a href='/no'>x</a></p></div><div class='a main b'><p>"), e("text"),
        F.lit("</p><a href='/next'>n</a><span class='noprint'><b>QQZ</b></span><ul><li><a href='/p?id="), F.col("doc_id").cast("string"),
        F.lit("'>p</a><li><a href='/next'>again</a></ul></div><a href='/outside'>QQZ</a></body></html>"),
    )
    d = table(spark, root, "documents").where("text is not null").select("doc_id", page.alias("html"))
    titled = d.select("doc_id", html.page_title(F.col("html")).alias("page_title"))
    got = html.page_texts(d, "doc_id", "html", "main").select("doc_id", F.array_join("links", "|").alias("links"), F.contains("text", F.lit("QQZ")).alias("hidden_shown"))
    return titled.join(got, "doc_id")


@query(r"""WITH s AS (SELECT doc_id, text, list_filter(list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '([。！？!?；;])', '\1' || chr(10), 'g'), '\n+'), lambda x: trim(x)), lambda x: length(x) >= 6) AS ss FROM documents)
SELECT doc_id, len(ss) AS sentences, len(list_filter(ss, lambda x: contains(regexp_replace(coalesce(text, ''), '[0-9]', '?', 'g'), x))) AS verbatim FROM s""")
def sentence_survival(spark: SparkSession, root: str) -> DataFrame:
    """Sentences of each document, and those that are left verbatim in a reading that lost all digits."""
    n, kept = style.surviving_sentences(F.col("text"), F.regexp_replace("text", "[0-9]", "?"))
    return table(spark, root, "documents").select("doc_id", n.alias("sentences"), kept.alias("verbatim"))
