"""Queries on page layout, merging, matching of names, and further joins and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import rules
from folioforge.operators import cleaning, layout, reduce, relational
from folioforge.queries.sqltext import lines as sql_lines
from folioforge.queries.tables import _sane
from folioforge.sources import markdown
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


def _boxes(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the decoded texts as recognised lines: texts with ideographs in columns, others in rows."""
    x = cleaning.lines_of(table(spark, root, "decoded"), "decoded_id").where(F.trim("line") != "")
    tall = F.col("line").rlike(r"[\x{4E00}-\x{9FFF}]")
    n, no = F.length("line").cast("double"), F.col("line_no").cast("double")
    return x.select(
        "decoded_id", "line_no", F.when(tall, 1000 - 30 * no).otherwise(F.lit(0.0)).alias("x0"), F.when(tall, F.lit(100.0)).otherwise(30 * no).alias("y0"),
        F.when(tall, 1020 - 30 * no).otherwise(20 * n).alias("x1"), F.when(tall, 100 + 20 * n).otherwise(30 * no + 20).alias("y1"), F.col("line").alias("text"), (F.lit(0.55) + F.pmod("line_no", F.lit(5)) / 10).alias("score"),
    )


@query()
def page_layout(spark: SparkSession, root: str) -> DataFrame:
    """Reading order and doubtful lines of pages (fixtures and brute force in the tests stand for SQL)."""
    return layout.page_texts(_boxes(spark, root), "decoded_id").select("decoded_id", "layout", "lines", F.round("mean_score", 6).alias("mean_score"), "dropped", "short", "doubtful", "missed")


@query()
def recognition_gate(spark: SparkSession, root: str) -> DataFrame:
    p = layout.page_texts(_boxes(spark, root), "decoded_id").join(table(spark, root, "decoded").select("decoded_id", "source_id"), "decoded_id")
    return layout.recognition_gate(p, "source_id")


@query()
def reduce_extracts(spark: SparkSession, root: str) -> DataFrame:
    """Up to sixty extracts of each title, best first, that repeat none before (difflib ratios: no SQL)."""
    x = _sane(spark, root).withColumns({"c": rules.confidence_rank(F.col("confidence")), "k": rules.content_rank(F.col("content_type")), "n": -F.length("text")})
    return reduce.reduce_fuzzy(x, "source_title", "extract_id", "text", ["c", "k", "n", "extract_id"])


_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))"


@query(f"""WITH a AS (SELECT DISTINCT title, {_WORDS.format('title')} AS ws FROM documents WHERE title IS NOT NULL), b AS (SELECT DISTINCT source_title, {_WORDS.format('source_title')} AS ws FROM extracts WHERE source_title IS NOT NULL)
SELECT a.title, count(b.source_title) AS matches, min(b.source_title) AS first_match FROM a LEFT JOIN b ON len(a.ws) > 0 AND len(list_intersect(a.ws, b.ws)) = len(a.ws) GROUP BY 1""")
def name_match(spark: SparkSession, root: str) -> DataFrame:
    """Titles of extracts that hold all words of a document's title. Titles meet over the longest word, not all pairs."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    a = table(spark, root, "documents").where("title is not null").select("title").distinct().withColumn("ws", words(F.col("title")))
    b = table(spark, root, "extracts").where("source_title is not null").select("source_title").distinct().withColumn("bs", words(F.col("source_title")))
    anchor = F.array_max(F.transform("ws", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    probe = a.withColumn("w", anchor).where("w is not null")
    hits = probe.join(b.withColumn("w", F.explode("bs")), "w").where(F.size(F.array_except("ws", "bs")) == 0).groupBy("title").agg(F.count("*").alias("matches"), F.min("source_title").alias("first_match"))
    return a.select("title").join(hits, "title", "left").select("title", F.coalesce("matches", F.lit(0)).alias("matches"), "first_match")


@query("SELECT DISTINCT tag FROM (SELECT lower(trim(unnest(topic_tags))) AS tag FROM extracts WHERE content_type = 'principle') WHERE tag <> '' AND tag NOT IN (SELECT lower(trim(t)) FROM (SELECT unnest(topic_tags) AS t FROM extracts WHERE content_type = 'quote' AND confidence = 'certain' AND language = 'en') WHERE t IS NOT NULL)")
def uncovered_anti(spark: SparkSession, root: str) -> DataFrame:
    """Topics of principles that no English quotation called certain has."""
    e = table(spark, root, "extracts")
    tags = lambda d: d.select(F.explode("topic_tags").alias("t")).select(F.lower(F.trim("t")).alias("tag")).where("tag <> ''")
    return tags(e.where("content_type = 'principle'")).distinct().join(tags(e.where("content_type = 'quote' and confidence = 'certain' and language = 'en'")), "tag", "left_anti")


@query("SELECT source_title, round(count(*) FILTER (confidence = 'high')::DOUBLE / greatest(1, count(*)), 3) AS high_ratio, round(count(*) FILTER (text IS NOT NULL)::DOUBLE / greatest(1, count(*)), 3) AS text_ratio, round(count(DISTINCT content_type)::DOUBLE / 5, 3) AS kind_ratio FROM extracts GROUP BY 1")
def confidence_ratios(spark: SparkSession, root: str) -> DataFrame:
    n = F.greatest(F.lit(1), F.count("*"))
    return table(spark, root, "extracts").groupBy("source_title").agg(F.round(relational.count_where(F.col("confidence") == "high") / n, 3).alias("high_ratio"), F.round(F.count("text") / n, 3).alias("text_ratio"), F.round(F.countDistinct("content_type") / 5, 3).alias("kind_ratio"))


@query("""WITH u AS (SELECT user_id, list_distinct(list(event_type)) AS done FROM events GROUP BY 1)
SELECT user_id, array_to_string(list_sort(list_filter(['signup', 'view', 'click', 'purchase', 'refund'], lambda x: NOT list_contains(done, x))), '|') AS open FROM u WHERE len(list_filter(['view', 'click'], lambda x: NOT list_contains(done, x))) = 0""")
def runnable_units(spark: SparkSession, root: str) -> DataFrame:
    """Units whose prerequisites are all among what is done, with what is still open."""
    u = table(spark, root, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("done"))
    arr = lambda *xs: F.array(*map(F.lit, xs))
    return u.where(F.size(F.array_except(arr("view", "click"), F.col("done"))) == 0).select("user_id", F.array_join(F.array_sort(F.array_except(arr("signup", "view", "click", "purchase", "refund"), F.col("done"))), "|").alias("open"))


@query("SELECT source_id, text_key, min(origin) AS origin FROM (SELECT source_id, md5(text) AS text_key, 'decoded' AS origin FROM decoded UNION ALL SELECT source AS source_id, md5(text) AS text_key, 'documents' AS origin FROM documents) WHERE source_id IS NOT NULL AND text_key IS NOT NULL GROUP BY 1, 2")
def explode_union(spark: SparkSession, root: str) -> DataFrame:
    """Texts of two tables by source, each once, with the table it is first in by name."""
    a = table(spark, root, "decoded").select("source_id", F.md5("text").alias("text_key"), F.lit("decoded").alias("origin"))
    b = table(spark, root, "documents").select(F.col("source").alias("source_id"), F.md5("text").alias("text_key"), F.lit("documents").alias("origin"))
    return a.unionByName(b).where("source_id is not null and text_key is not null").groupBy("source_id", "text_key").agg(F.min("origin").alias("origin"))


@query("""SELECT p.page_id, r.registry_id FROM page_quality p JOIN (SELECT source_id, filename, min(registry_id) AS registry_id FROM source_registry WHERE source_id IS NOT NULL GROUP BY 1, 2) r ON p.source_id = r.source_id AND p.source_file = r.filename""")
def bound_sidecar_join(spark: SparkSession, root: str) -> DataFrame:
    """Pages bound to the registration of the same source and file; others are left out."""
    r = table(spark, root, "source_registry").where("source_id is not null").groupBy("source_id", F.col("filename").alias("source_file")).agg(F.min("registry_id").alias("registry_id"))
    return table(spark, root, "page_quality").select("page_id", "source_id", "source_file").join(r, ["source_id", "source_file"]).select("page_id", "registry_id")


@query("""SELECT registry_id, CASE WHEN media_type = 'application/pdf' THEN 'verbatim' WHEN media_type LIKE 'text/html%' THEN 'html_to_text' WHEN media_type LIKE 'text/%' THEN 'text' WHEN media_type IS NULL THEN 'unknown' ELSE 'unsupported' END AS action, coalesce(bytes, 0) > 500000 AS large FROM source_registry""")
def materialize_dispatch(spark: SparkSession, root: str) -> DataFrame:
    """How each source is made into text, by its media type."""
    m = F.col("media_type")
    action = rules.ladder((m == "application/pdf", "verbatim"), (m.startswith("text/html"), "html_to_text"), (m.startswith("text/"), "text"), (m.isNull(), "unknown"), default="unsupported")
    return table(spark, root, "source_registry").select("registry_id", action.alias("action"), (F.coalesce("bytes", F.lit(0)) > 500000).alias("large"))


_JSON = r"(?s)^\s*(?:```(?:json)?\s*)?(\{.*\})\s*(?:```)?\s*$"


@query(f"SELECT event_id, json_valid(j) AS valid, CASE WHEN json_valid(j) THEN (j->>'k')::BIGINT END AS k FROM (SELECT event_id, regexp_extract(CASE WHEN event_id % 2 = 0 THEN '```json' || chr(10) || props || chr(10) || '```' WHEN event_id % 3 = 0 THEN 'so: ' || props ELSE props END, '{_JSON}', 1) AS j FROM events)")
def strict_json(spark: SparkSession, root: str) -> DataFrame:
    """JSON objects that stand alone or in one fence; anything beside them makes the answer invalid."""
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(F.col("event_id") % 3 == 0, F.concat(F.lit("so: "), F.col("props"))).otherwise(F.col("props"))
    e = table(spark, root, "events").select("event_id", F.regexp_extract(raw, _JSON, 1).alias("j"))
    k = F.from_json("j", "k bigint")["k"]
    return e.select("event_id", F.coalesce((F.col("j") != "") & F.from_json("j", "map<string,string>").isNotNull(), F.lit(False)).alias("valid"), k.alias("k"))


@query(f"""SELECT doc_id, count(*) AS lines, count(*) FILTER (regexp_matches(line, '(?i)\\b(?:todo|tbd|fixme|unresolved)\\b|待查|待补|存疑')) AS notes FROM {sql_lines('documents', 'doc_id')} GROUP BY 1""")
def textual_note(spark: SparkSession, root: str) -> DataFrame:
    """Lines of each document, and those that say that something is still open."""
    x = cleaning.lines_of(table(spark, root, "documents"), "doc_id")
    return x.groupBy("doc_id").agg(F.count("*").alias("lines"), relational.count_where(F.col("line").rlike(r"(?i)\b(?:todo|tbd|fixme|unresolved)\b|待查|待补|存疑")).alias("notes"))


@query("""WITH t AS (SELECT source_file, count(*) AS pages, count(*) FILTER (quality_score IS NULL) AS unread, avg(CASE WHEN ocr_required THEN 1.0 ELSE 0.0 END) AS share FROM page_quality WHERE page_number <= 5 GROUP BY 1), a AS (SELECT source_file, count(*) AS n FROM page_quality GROUP BY 1)
SELECT source_file, pages, unread, round(share, 6) AS share, round(share * n * 1.1 / 60, 6) AS minutes FROM t JOIN a USING (source_file)""")
def survey_eta(spark: SparkSession, root: str) -> DataFrame:
    """Of each file its first five pages as a sample: unread ones, the share that needs recognition, and the minutes that
    all its pages then take."""
    p = table(spark, root, "page_quality").where("source_file is not null")
    g = p.groupBy("source_file").agg(F.count("*").alias("n"), F.sum(F.when(F.col("page_number") <= 5, 1).otherwise(0)).alias("pages"), F.sum(F.when((F.col("page_number") <= 5) & F.col("quality_score").isNull(), 1).otherwise(0)).alias("unread"), F.avg(F.when(F.col("page_number") <= 5, F.when(F.col("ocr_required"), 1.0).otherwise(0.0))).alias("share"))
    return g.where("pages > 0").select("source_file", "pages", "unread", F.round("share", 6).alias("share"), F.round(F.col("share") * F.col("n") * 1.1 / 60, 6).alias("minutes"))


@query()
def md_quotes(spark: SparkSession, root: str) -> DataFrame:
    """Bracketed quotations of the documents by their place."""
    return markdown.quotations(table(spark, root, "documents"), "doc_id").select("doc_id", "line_no", "place", F.length("quote").alias("chars"))


@query(rf"""SELECT doc_id, line_no::INTEGER AS line_no, ref FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '\[(\d+\.\d+)\]', 1)) AS ref FROM {sql_lines('documents', 'doc_id')} WHERE contains(line, '['))""")
def reference_marks(spark: SparkSession, root: str) -> DataFrame:
    """Reference numbers in brackets by document and line."""
    x = cleaning.lines_of(table(spark, root, "documents"), "doc_id").where(F.col("line").contains("["))
    return x.select("doc_id", "line_no", F.explode(F.expr(r"regexp_extract_all(line, '\\[(\\d+\\.\\d+)\\]', 1)")).alias("ref"))
