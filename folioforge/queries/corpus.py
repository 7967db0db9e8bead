"""Queries on duplicates, shards, samples, verbatim checks, pages and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import rules
from folioforge.functions.text import estimate
from folioforge.operators import dedup, planning, provenance, relational
from folioforge.queries.sqltext import SPACE
from folioforge.queries.sqltext import estimate as sql_estimate
from folioforge.plans.parallel import spread
from folioforge.sources import files, html, markdown
from folioforge.sources.tables import table
from folioforge.streaming import events as streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def _prints(spark: SparkSession, root: str) -> DataFrame:
    return dedup.prints(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id")


@query()
def near_dup_classes(spark: SparkSession, root: str) -> DataFrame:
    """Class of each document by its set of sampled 8-grams (no SQL: CRC-32 over every gram is too slow there)."""
    return dedup.classes(_prints(spark, root), "doc_id")


@query()
def near_dup_edges(spark: SparkSession, root: str) -> DataFrame:
    """Near duplicate and contained pairs of class representatives (membership is near_dup_classes)."""
    return dedup.edges(_prints(spark, root), "doc_id")


@query()
def near_dup_resolved(spark: SparkSession, root: str) -> DataFrame:
    """Representatives that give way, and to which one."""
    return dedup.resolved(near_dup_edges(spark, root))


_PACK = """WITH RECURSIVE o AS (SELECT source_id, segment_id, coalesce(token_estimate, 0) AS tok, row_number() OVER (PARTITION BY source_id ORDER BY segment_id) AS i FROM segments),
p AS (SELECT source_id, segment_id, tok, i, 1 AS shard, tok AS cur FROM o WHERE i = 1
 UNION ALL SELECT o.source_id, o.segment_id, o.tok, o.i, CASE WHEN p.cur > 0 AND (p.cur >= 3000 OR p.cur + o.tok > 6000) THEN p.shard + 1 ELSE p.shard END, CASE WHEN p.cur > 0 AND (p.cur >= 3000 OR p.cur + o.tok > 6000) THEN o.tok ELSE p.cur + o.tok END
 FROM p JOIN o ON o.source_id IS NOT DISTINCT FROM p.source_id AND o.i = p.i + 1)"""


@query(f"{_PACK} SELECT source_id, segment_id, shard::INTEGER AS shard FROM p")
def pack_shards(spark: SparkSession, root: str) -> DataFrame:
    """Shard of every segment in its source (3,000 tokens, never over 6,000 by taking another one)."""
    s = table(spark, root, "segments").select("source_id", "segment_id", "token_estimate")
    return planning.pack_shards(s, "source_id", ["segment_id"], "token_estimate", 3000, 6000).select("source_id", "segment_id", "shard")


@query(f"""{_PACK}, t AS (SELECT source_id, shard, count(*) AS segments, sum(tok)::BIGINT AS tokens FROM p GROUP BY 1, 2)
SELECT source_id, count(*) AS shards, sum(segments)::BIGINT AS segments, sum(tokens)::BIGINT AS tokens, count(*) FILTER (tokens > 6000) AS over_limit, CASE WHEN sum(tokens) < 40000 THEN '1' WHEN sum(tokens) < 150000 THEN '2-4' WHEN sum(tokens) < 500000 THEN '4-8' ELSE 'index-and-sample-first' END AS workers FROM t GROUP BY 1""")
def shard_manifest(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "segments").select("source_id", "segment_id", "token_estimate")
    t = planning.pack_shards(s, "source_id", ["segment_id"], "token_estimate", 3000, 6000).groupBy("source_id", "shard").agg(F.count("*").alias("segments"), F.sum(F.coalesce("token_estimate", F.lit(0))).alias("tokens"))
    return t.groupBy("source_id").agg(F.count("*").alias("shards"), F.sum("segments").alias("segments"), F.sum("tokens").alias("tokens"), F.count(F.when(F.col("tokens") > 6000, 1)).alias("over_limit"), planning.recommended_workers(F.sum("tokens")).alias("workers"))


_STRATUM = "concat_ws('|', coalesce(lang, 'other'), coalesce(genre, 'none'))"


@query(f"""SELECT doc_id, rk <= take AS selected, round(take::DOUBLE / n, 6) AS inclusion_probability FROM (SELECT *, least(n, greatest(1, ceil(n * 0.45::DOUBLE))) AS take FROM (SELECT doc_id, count(*) OVER (PARTITION BY stratum) AS n, row_number() OVER (PARTITION BY stratum ORDER BY sha256('20261014:' || doc_id::VARCHAR)[1:16], doc_id) AS rk FROM (SELECT doc_id, {_STRATUM} AS stratum FROM documents)))""")
def stratified_sample(spark: SparkSession, root: str) -> DataFrame:
    """Reproducible sample of 45 % of each stratum of language and genre, at least one."""
    d = table(spark, root, "documents").select("doc_id", F.concat_ws("|", F.coalesce("lang", F.lit("other")), F.coalesce("genre", F.lit("none"))).alias("stratum"))
    return planning.stratified_sample(d, "stratum", "doc_id", 20261014, 0.45).select("doc_id", "selected", "inclusion_probability")


@query(f"""SELECT * FROM (SELECT doc_id, window_no::INTEGER AS window_no, (window_no * 1800)::INTEGER AS start, regexp_replace(substr(text, window_no * 1800 + 1, 2000), '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS piece FROM (SELECT doc_id, text, unnest(range(greatest(0, ceil((length(text) - 2000) / 1800.0))::BIGINT + 1)) AS window_no FROM documents WHERE length(trim(text)) > 0) ) WHERE piece <> ''""")
def char_windows(spark: SparkSession, root: str) -> DataFrame:
    """Windows of 2,000 characters with an overlap of 200."""
    return planning.char_windows(table(spark, root, "documents"), "doc_id", "text", 2000, 200)


@query()
def split_text(spark: SparkSession, root: str) -> DataFrame:
    """Chunks of whole paragraphs up to 1,000 tokens."""
    return planning.split_text(table(spark, root, "documents"), "doc_id", "text", 1000)


@query("SELECT source_id, segment_id FROM (SELECT source_id, segment_id, row_number() OVER (PARTITION BY source_id ORDER BY segment_id) - 1 AS i, count(*) OVER (PARTITION BY source_id) AS n FROM segments WHERE source_id IS NOT NULL) WHERE n <= 3 OR floor((i + 1) * 3 / n) > floor(i * 3 / n)")
def even_sample(spark: SparkSession, root: str) -> DataFrame:
    """Three evenly spaced segments of each source."""
    return planning.even_sample(table(spark, root, "segments").where("source_id is not null").select("source_id", "segment_id"), "source_id", "segment_id", 3)


_NORM = rf"translate(regexp_replace({{0}}, '[\s\x{{{{85}}}}\x{{{{A0}}}}\x{{{{1680}}}}\x{{{{2000}}}}-\x{{{{200A}}}}\x{{{{2028}}}}\x{{{{2029}}}}\x{{{{202F}}}}\x{{{{205F}}}}\x{{{{3000}}}}{provenance.PUNCTUATION.replace('{', '{{').replace('}', '}}')}]+', '', 'g'), '{provenance.WIDE}', '{provenance.NARROW}')"


def _checked(spark: SparkSession, root: str) -> DataFrame:
    d = spread(table(spark, root, "documents").select("doc_id", "text"))
    return provenance.first_located(table(spark, root, "eval_items"), d, "item_id", "text", "doc_id", "text")


_LOCATED = f"""n AS (SELECT item_id, suite, {_NORM.format('text')} AS needle FROM eval_items), c AS (SELECT doc_id, {_NORM.format('text')} AS hay FROM documents),
v AS (SELECT n.item_id, any_value(n.suite) AS suite, any_value(length(needle))::INTEGER AS chars, min(c.doc_id) AS found_in, count(c.doc_id) AS holders FROM n LEFT JOIN c ON contains(c.hay, n.needle) GROUP BY 1)"""


@query(f"WITH {_LOCATED} SELECT item_id, chars, found_in, holders FROM v")
def verbatim_locate(spark: SparkSession, root: str) -> DataFrame:
    """The first document that holds each evaluation item verbatim, and how many do."""
    return _checked(spark, root).select("item_id", "chars", "found_in", "holders")


@query(f"WITH {_LOCATED} SELECT item_id FROM v WHERE found_in IS NULL")
def quote_closure_anti(spark: SparkSession, root: str) -> DataFrame:
    """Items that no document holds verbatim."""
    return _checked(spark, root).where("found_in is null").select("item_id")


@query(f"WITH {_LOCATED} SELECT suite, count(*) AS claims, count(found_in) AS verified, round(count(found_in)::DOUBLE / count(*), 6) AS share FROM v GROUP BY 1")
def evidence_coverage(spark: SparkSession, root: str) -> DataFrame:
    j = _checked(spark, root).join(table(spark, root, "eval_items").select("item_id", "suite"), "item_id")
    return provenance.coverage(j, "suite")


@query("""WITH p AS (SELECT d.doc_id, d.title, d.text FROM documents d WHERE d.title IS NOT NULL AND d.text IS NOT NULL)
SELECT doc_id, coalesce((SELECT max(n) FROM range(1, length(title) + 1) r(n) WHERE contains(text, substr(title, 1, n::INTEGER))), 0)::INTEGER AS chars FROM p""")
def longest_prefix(spark: SparkSession, root: str) -> DataFrame:
    """How much of its title, from the beginning, each document holds."""
    d = table(spark, root, "documents").where("title is not null and text is not null")
    return d.select("doc_id", provenance.longest_prefix(F.col("title"), F.col("text")).alias("chars"))


@query()
def cer(spark: SparkSession, root: str) -> DataFrame:
    """Character error rate between the first and the last text of each source (no SQL: there the distance counts bytes)."""
    s = table(spark, root, "decoded").where("source_id is not null and text is not null")
    g = s.groupBy("source_id").agg(F.min_by("text", "decoded_id").alias("a"), F.max_by("text", "decoded_id").alias("b"), F.count("*").alias("n")).where("n > 1")
    d = F.when(F.col("a") == F.col("b"), 0).otherwise(F.levenshtein("a", "b"))
    return g.select("source_id", d.alias("distance"), F.round(d / F.greatest(F.lit(1), F.length("a")), 6).alias("cer"))


@query("SELECT source_id, array_to_string(list_sort(list_distinct(flatten(list_transform(list(pages), lambda p: range(split_part(p, '-', 1)::INTEGER, split_part(p, '-', 2)::INTEGER + 1))))), ',') AS pages FROM (SELECT source_id, regexp_extract(source_detail, 'pages (\\d+-\\d+)', 1) AS pages FROM segments WHERE source_id IS NOT NULL AND regexp_matches(source_detail, 'pages \\d+-\\d+')) GROUP BY 1")
def page_ranges(spark: SparkSession, root: str) -> DataFrame:
    """The pages that the segments of each source come from."""
    s = table(spark, root, "segments").where("source_id is not null").where(F.col("source_detail").rlike(r"pages \d+-\d+")).select("source_id", F.regexp_extract("source_detail", r"pages (\d+-\d+)", 1).alias("p")).distinct()
    x = s.select("source_id", F.explode(markdown.page_ranges(F.col("p"))).alias("page")).distinct().groupBy("source_id").agg(F.sort_array(F.collect_list("page")).alias("pages"))
    return x.select("source_id", F.array_join(F.transform("pages", lambda v: v.cast("string")), ",").alias("pages"))


@query()
def decode_bytes(spark: SparkSession, root: str) -> DataFrame:
    """Texts written as UTF-8 and UTF-16 bytes and read again by the cascade."""
    d = table(spark, root, "documents").where("text is not null")
    data = F.when(F.pmod("doc_id", F.lit(3)) == 1, F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    return files.decoded(d.select("doc_id", data.alias("content")), ["doc_id"]).select("doc_id", "encoding", "replacements", F.md5("text").alias("digest"))


@query()
def html_to_text(spark: SparkSession, root: str) -> DataFrame:
    """Documents wrapped in pages with navigation and scripts, and read back."""
    esc = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>t</title><script>x()</script></head><body><nav>menu</nav><div class='main'><p>"), F.regexp_replace(esc, "\n+", "</p><p>"), F.lit("</p><a href='/next'>next</a></div></body></html>"))
    d = table(spark, root, "documents").where("text is not null").select("doc_id", page.alias("html"))
    return html.page_texts(d, "doc_id", "html", "main").select("doc_id", F.length("text").alias("chars"), F.size("links").alias("links"))


@query()
def stream_tumbling(spark: SparkSession, root: str) -> DataFrame:
    """The hourly counts by Structured Streaming, read to the end into a table in memory."""

    name = "stream_tumbling_out"
    schema = table(spark, root, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(root)
    q = streams.tumbling(streams.timed(e)).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@query(f"SELECT source_id, round(sum(t)::DOUBLE, 6) AS tokens, round(avg(s), 6) AS mean_score FROM (SELECT source_id, {sql_estimate('text')} AS t, CASE WHEN quality_flags IS NULL THEN 0 ELSE len(quality_flags) END AS s FROM segments) GROUP BY 1")
def source_tokens(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "segments").select("source_id", estimate(F.col("text")).alias("t"), F.coalesce(F.size("quality_flags"), F.lit(0)).alias("s"))
    return s.groupBy("source_id").agg(F.round(F.sum("t").cast("double"), 6).alias("tokens"), F.round(F.avg(F.greatest("s", F.lit(0))), 6).alias("mean_score"))


@query("SELECT registry_id, source_id, 'src_' || sha256(lower(relative_path) || chr(10) || coalesce(sha256, ''))[1:20] AS computed, first_value(registry_id) OVER (PARTITION BY sha256 ORDER BY lower(relative_path), registry_id) AS first_same FROM source_registry WHERE sha256 IS NOT NULL")
def source_identity(spark: SparkSession, root: str) -> DataFrame:
    """The id that follows from each source's path and bytes, and the first registration with the same bytes."""
    r = table(spark, root, "source_registry").where("sha256 is not null")
    first = r.groupBy("sha256").agg(F.min_by("registry_id", F.struct(F.lower("relative_path"), "registry_id")).alias("first_same"))
    made = F.concat(F.lit("src_"), F.substring(F.sha2(F.concat(F.lower("relative_path"), F.lit("\n"), "sha256"), 256), 1, 20))
    return r.join(first, "sha256").select("registry_id", "source_id", made.alias("computed"), "first_same")


@query("""WITH o AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, event_id AS view_id FROM events WHERE event_type = 'view')
SELECT o.event_id, v.view_id FROM o ASOF LEFT JOIN v ON o.user_id = v.user_id AND o.ts >= v.ts""")
def asof_view(spark: SparkSession, root: str) -> DataFrame:
    """The last view before each purchase, by one window over both."""
    from pyspark.sql import Window

    e = table(spark, root, "events").where(F.col("event_type").isin("view", "purchase"))
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == "view", 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), True).over(w)
    return e.select("event_id", "event_type", last.alias("view_id")).where("event_type = 'purchase'").select("event_id", "view_id")




@query("""SELECT source_file, count(*) AS pages, sum(CASE WHEN replacement_chars > 2 THEN 1 ELSE 0 END)::BIGINT AS doubtful, sum(CASE WHEN non_ws_chars < 20 THEN 1 ELSE 0 END)::BIGINT AS short, list_sort(list(text_chars))[len(list(text_chars)) // 2 + 1]::BIGINT AS upper_median FROM page_quality WHERE source_file IS NOT NULL AND text_chars IS NOT NULL GROUP BY 1""")
def page_line_summary(spark: SparkSession, root: str) -> DataFrame:
    """Of each file its pages with losses or little text, and the upper median of their lengths."""
    p = table(spark, root, "page_quality").where("source_file is not null and text_chars is not null")
    g = p.groupBy("source_file").agg(F.count("*").alias("pages"), F.sum(F.when(F.col("replacement_chars") > 2, 1).otherwise(0)).alias("doubtful"), F.sum(F.when(F.col("non_ws_chars") < 20, 1).otherwise(0)).alias("short"))
    return g.join(relational.upper_median(p, "source_file", "text_chars"), "source_file")


@query("SELECT segment_id, CASE WHEN regexp_matches(source_file, '[/\\\\]') THEN 'path' WHEN lower(source_file) <> source_file THEN 'case' ELSE 'plain' END AS spelling, lower(regexp_replace(source_file, '^.*[/\\\\]', '')) AS name FROM segments WHERE source_file IS NOT NULL")
def raw_location(spark: SparkSession, root: str) -> DataFrame:
    """How each segment spells its file, and the file's plain name."""
    f = F.col("source_file")
    s = table(spark, root, "segments").where("source_file is not null")
    return s.select("segment_id", rules.ladder((f.rlike(r"[/\\]"), "path"), (F.lower(f) != f, "case"), default="plain").alias("spelling"), F.lower(F.regexp_replace(f, r"^.*[/\\]", "")).alias("name"))


@query("SELECT config_id, mode, CASE WHEN mode IN ('exhaustive', 'stratified') THEN mode WHEN total <= pilot_max_tokens THEN 'exhaustive' ELSE 'stratified' END AS chosen, total <= representative_max_tokens AS whole FROM sampling_config, (SELECT sum(coalesce(token_estimate, 0))::BIGINT AS total FROM segments)")
def choose_mode(spark: SparkSession, root: str) -> DataFrame:
    """How each configuration samples the segments."""
    total = table(spark, root, "segments").agg(F.sum(F.coalesce("token_estimate", F.lit(0))).alias("total"))
    c = table(spark, root, "sampling_config").join(F.broadcast(total))  # one row
    chosen = rules.ladder((F.col("mode").isin("exhaustive", "stratified"), F.col("mode")), (F.col("total") <= F.col("pilot_max_tokens"), "exhaustive"), default="stratified")
    return c.select("config_id", "mode", chosen.alias("chosen"), (F.col("total") <= F.col("representative_max_tokens")).alias("whole"))


@query()
def md_cards(spark: SparkSession, root: str) -> DataFrame:
    """Cards that the documents hold under third-level headings."""
    return markdown.cards(table(spark, root, "documents"), "doc_id").select("doc_id", "card_no", "title", F.length("verbatim").alias("chars"), F.size("fields").alias("fields"))
