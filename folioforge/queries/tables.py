"""Queries on the registry, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import rules
from folioforge.operators import gates, relational
from folioforge.operators.dedup import exact_duplicates, surviving
from folioforge.sources.files import upsert
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


@query("""WITH u AS (SELECT source AS v, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)
SELECT count(*) AS distinct_sources, arg_min(v, (-n, v)) AS top_source, coalesce(round(max(n)::DOUBLE / sum(n), 9), 0) AS top_share, coalesce(round(sum(n * n)::DOUBLE / (sum(n) * sum(n)), 9), 0) AS hhi FROM u""")
def source_concentration(spark: SparkSession, root: str) -> DataFrame:
    """How far the documents come from one source."""
    return relational.concentration(table(spark, root, "documents"), "source")


@query("""WITH u AS (SELECT l_suppkey AS v, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) AS distinct_sources, arg_min(v, (-n, v)) AS top_source, round(max(n)::DOUBLE / sum(n), 9) AS top_share, round(sum(n * n)::DOUBLE / (sum(n) * sum(n)), 9) AS hhi FROM u""")
def supplier_concentration(spark: SparkSession, root: str) -> DataFrame:
    return relational.concentration(table(spark, root, "lineitem"), "l_suppkey")


@query("SELECT doc_id, sha256(text) AS digest, CASE WHEN first <> doc_id THEN first END AS duplicate_of FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)")
def exact_dup_registry(spark: SparkSession, root: str) -> DataFrame:
    """Every document with its hash and the first document with the same text."""
    return exact_duplicates(table(spark, root, "documents"), "doc_id", "text")


_PRIORITY = "CASE WHEN n LIKE 'p1\\_%' ESCAPE '\\' THEN 1 WHEN n LIKE 'p2\\_%' ESCAPE '\\' THEN 2 WHEN n LIKE 'p3\\_%' ESCAPE '\\' THEN 3 WHEN contains(n, 'primary') OR contains(n, 'first') THEN 2 WHEN contains(n, 'secondary') OR contains(n, 'biography') THEN 4 WHEN contains(n, 'duplicate') THEN 8 ELSE 5 END"


@query(f"SELECT registry_id, ({_PRIORITY})::INTEGER AS priority FROM (SELECT registry_id, lower(filename) AS n FROM source_registry)")
def source_priority(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "source_registry").select("registry_id", rules.source_priority(F.col("filename")).alias("priority"))


@query("SELECT registry_id, regexp_replace(regexp_replace(trim(canonical_url), '(?i)^http://', 'https://'), '/+$', '') AS url FROM source_registry")
def canonical_url(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "source_registry").select("registry_id", rules.canonical_url(F.col("canonical_url")).alias("url"))


@query("SELECT registry_id, CASE lower(extension) WHEN '.txt' THEN 'text/plain' WHEN '.md' THEN 'text/markdown' WHEN '.markdown' THEN 'text/markdown' WHEN '.pdf' THEN 'application/pdf' WHEN '.epub' THEN 'application/epub+zip' ELSE 'application/octet-stream' END AS media_type FROM source_registry")
def media_type(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "source_registry").select("registry_id", rules.media_type(F.col("extension")).alias("media_type"))


@query("SELECT registry_id, host, host = 'archive.dry-canal.example' OR host LIKE '%.north-archive.example' AS allowed FROM (SELECT registry_id, regexp_replace(lower(regexp_extract(trim(canonical_url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '\\.$', '') AS host FROM source_registry WHERE canonical_url IS NOT NULL)")
def host_allowed(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "source_registry").where("canonical_url is not null").select("registry_id", rules.host_of(F.col("canonical_url")).alias("host"))
    return r.withColumn("allowed", rules.host_allowed(F.col("host"), ["archive.dry-canal.example", "*.north-archive.example"]))


_ROBOTS = [("/", True), ("/1", False), ("/12", True), ("/*5", False), ("/3*/", False), ("/2$", False)]


@query("""SELECT registry_id, path, coalesce((SELECT allow FROM (VALUES (1, true, '^/'), (2, false, '^/1'), (3, true, '^/12'), (3, false, '^/.*5'), (4, false, '^/3.*/'), (3, false, '^/2$')) r(n, allow, rx) WHERE regexp_matches(path, rx) ORDER BY n DESC, allow DESC LIMIT 1), true) AS allowed
FROM (SELECT registry_id, regexp_extract(trim(canonical_url), '^[A-Za-z]+://[^/]+(/.*)$', 1) AS path FROM source_registry WHERE canonical_url IS NOT NULL)""")
def robots_longest_match(spark: SparkSession, root: str) -> DataFrame:
    """Whether crawl rules allow the path of each source: the longest rule decides."""
    r = table(spark, root, "source_registry").where("canonical_url is not null").select("registry_id", F.regexp_extract(F.trim("canonical_url"), r"^[A-Za-z]+://[^/]+(/.*)$", 1).alias("path"))
    return r.withColumn("allowed", relational.longest_match(F.col("path"), _ROBOTS))


@query("SELECT registry_id, CASE WHEN regexp_matches(relative_path, '(?s)^p1_.*\\.pdf$') THEN 'primary-scan' WHEN regexp_matches(relative_path, '(?s)^p1_') THEN 'primary' WHEN regexp_matches(relative_path, '(?s)^secondary_.*_0000.3\\.') THEN 'third' WHEN regexp_matches(relative_path, '(?s)^secondary_') THEN 'secondary' ELSE 'other' END AS declared FROM source_registry")
def first_match_glob(spark: SparkSession, root: str) -> DataFrame:
    """The first of an ordered list of path patterns that each source meets."""
    globs = [("p1_*.pdf", "primary-scan"), ("p1_*", "primary"), ("secondary_*_0000?3.*", "third"), ("secondary_*", "secondary")]
    r = table(spark, root, "source_registry")
    return r.select("registry_id", relational.first_match(r, F.col("relative_path"), globs, "other").alias("declared"))


@query("SELECT registry_id, regexp_full_match(slug, '[a-z0-9]+(-[a-z0-9]+)*') AND length(slug) <= 64 AND slug NOT IN ('con', 'prn', 'aux', 'nul') AS valid_slug, length(relative_path) > 0 AND NOT regexp_matches(relative_path, '\\\\|^/|^[A-Za-z]:|//|/$') AND NOT regexp_matches(relative_path, '(^|/)\\.{1,2}(/|$)') AS safe FROM (SELECT registry_id, relative_path, regexp_replace(filename, '\\..*$', '') AS slug FROM source_registry)")
def slug_and_path(spark: SparkSession, root: str) -> DataFrame:
    """Whether each source's name makes a slug, and its path is safe."""
    r = table(spark, root, "source_registry").withColumn("slug", F.regexp_replace("filename", r"\..*$", ""))
    return r.select("registry_id", rules.slug_valid(F.col("slug")).alias("valid_slug"), rules.safe_path(F.col("relative_path")).alias("safe"))


@query("""WITH r AS (SELECT source_id, arg_max(rights_status, registry_id) AS rights, arg_max(role, registry_id) AS role FROM source_registry WHERE source_id IS NOT NULL GROUP BY 1)
SELECT s.source_id, any_value(r.role) AS role, count(*) AS segments, count(r.source_id) AS registered FROM segments s LEFT JOIN r USING (source_id) GROUP BY s.source_id""")
def registry_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Segments per source with the role of the source's last registration. Counted before the join, which then is as
    small as the number of sources."""
    r = table(spark, root, "source_registry").where("source_id is not null").groupBy("source_id").agg(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("registry_id"))).alias("role"))
    n = table(spark, root, "segments").groupBy("source_id").agg(F.count("*").alias("segments"))
    j = n.join(r.withColumn("hit", F.lit(True)), "source_id", "left")
    return j.select("source_id", "role", "segments", F.when(F.col("hit"), F.col("segments")).otherwise(0).cast("bigint").alias("registered"))


@query("""WITH v2 AS (SELECT filename, sha256, max(origin) AS origin, max(canonical_url) AS url FROM source_registry WHERE version = 2 GROUP BY 1, 2)
SELECT r.registry_id, coalesce(v2.origin, r.origin) AS origin, coalesce(v2.url, r.canonical_url) AS url, v2.filename IS NOT NULL AS overlaid FROM source_registry r LEFT JOIN v2 ON r.filename = v2.filename AND r.sha256 = v2.sha256 WHERE r.version = 1""")
def provenance_overlay(spark: SparkSession, root: str) -> DataFrame:
    """First registrations with what a later one of the same file and bytes says about their origin."""
    r = table(spark, root, "source_registry")
    late = r.where("version = 2").groupBy("filename", "sha256").agg(F.max("origin").alias("o2"), F.max("canonical_url").alias("u2")).withColumn("hit", F.lit(True))
    j = r.where("version = 1").join(late, ["filename", "sha256"], "left")
    return j.select("registry_id", F.coalesce("o2", "origin").alias("origin"), F.coalesce("u2", "canonical_url").alias("url"), F.col("hit").isNotNull().alias("overlaid"))


@query("SELECT coalesce(a.source_id, b.source_id) AS source_id, CASE WHEN b.source_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side FROM (SELECT DISTINCT source_id FROM segments WHERE source_id IS NOT NULL) a FULL OUTER JOIN (SELECT DISTINCT source AS source_id FROM documents WHERE source IS NOT NULL) b ON a.source_id = b.source_id WHERE a.source_id IS NULL OR b.source_id IS NULL")
def full_outer_diff(spark: SparkSession, root: str) -> DataFrame:
    """Sources that only segments or only documents have."""
    return relational.outer_diff(table(spark, root, "segments"), table(spark, root, "documents").withColumnRenamed("source", "source_id"), "source_id")


@query("SELECT DISTINCT s.source_file FROM segments s WHERE s.source_file IS NOT NULL AND NOT EXISTS (SELECT 1 FROM source_registry r WHERE r.filename = s.source_file)")
def dangling_ref_anti(spark: SparkSession, root: str) -> DataFrame:
    """File names of segments, as spelled there, that the registry does not have."""
    return table(spark, root, "segments").select("source_file").where("source_file is not null").distinct().join(table(spark, root, "source_registry").select(F.col("filename").alias("source_file")), "source_file", "left_anti")


@query("""WITH a AS (SELECT filename, max(sha256) AS sha FROM source_registry WHERE version = 1 GROUP BY 1), b AS (SELECT filename, max(sha256) AS sha FROM source_registry WHERE version = 2 GROUP BY 1)
SELECT coalesce(a.filename, b.filename) AS filename, CASE WHEN b.filename IS NULL THEN 'missing' WHEN a.filename IS NULL THEN 'unlisted' WHEN a.sha = b.sha THEN 'same' ELSE 'mismatch' END AS state FROM a FULL OUTER JOIN b ON a.filename = b.filename""")
def manifest_verify(spark: SparkSession, root: str) -> DataFrame:
    """First registrations as a manifest against the later ones: missing, unlisted, same or other bytes."""
    r = table(spark, root, "source_registry").where("filename is not null")
    a = r.where("version = 1").groupBy("filename").agg(F.max("sha256").alias("a"), F.lit(True).alias("ha"))
    b = r.where("version = 2").groupBy("filename").agg(F.max("sha256").alias("b"), F.lit(True).alias("hb"))
    state = rules.ladder((F.col("hb").isNull(), "missing"), (F.col("ha").isNull(), "unlisted"), (F.col("a") == F.col("b"), "same"), default="mismatch")
    return a.join(b, "filename", "full_outer").select("filename", state.alias("state"))


@query("""WITH f AS (SELECT shard_id, arg_max(input_fingerprint, (extracted_at, extract_id)) AS input_fingerprint FROM extracts WHERE shard_id IS NOT NULL AND input_fingerprint IS NOT NULL AND extracted_at IS NOT NULL GROUP BY 1)
SELECT extract_id, shard_id FROM extracts SEMI JOIN f USING (shard_id, input_fingerprint)""")
def fresh_output_semi(spark: SparkSession, root: str) -> DataFrame:
    """Extracts made from their shard's latest input."""
    e = table(spark, root, "extracts")
    f = e.where("shard_id is not null and input_fingerprint is not null and extracted_at is not null").groupBy("shard_id").agg(F.max_by("input_fingerprint", F.struct("extracted_at", "extract_id")).alias("input_fingerprint"))
    return e.join(f, ["shard_id", "input_fingerprint"], "left_semi").select("extract_id", "shard_id")


@query("SELECT row_no, s_suppkey, p_partkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS row_no FROM supplier) JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS row_no FROM part) USING (row_no)")
def positional_zip(spark: SparkSession, root: str) -> DataFrame:
    """Row i of one table beside row i of another, as far as the shorter one goes."""
    return relational.positional_zip(table(spark, root, "supplier").select("s_suppkey"), table(spark, root, "part").select("p_partkey"), ["s_suppkey"], ["p_partkey"])


@query("SELECT row_no, p_partkey, coalesce(s_name, 'none') AS s_name FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS row_no FROM part) LEFT JOIN (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS row_no FROM supplier) USING (row_no)")
def positional_left(spark: SparkSession, root: str) -> DataFrame:
    z = relational.positional_zip(table(spark, root, "part").select("p_partkey"), table(spark, root, "supplier").select("s_suppkey", "s_name"), ["p_partkey"], ["s_suppkey"], "left")
    return z.select("row_no", "p_partkey", F.coalesce("s_name", F.lit("none")).alias("s_name"))


_FOLD = "regexp_replace(regexp_replace(lower({0}), '[0-9]+$', ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


@query(f"""WITH c AS (SELECT source_title, count(*) AS segments, {_FOLD.format('source_title')} AS k FROM segments WHERE source_title IS NOT NULL GROUP BY 1), d AS (SELECT title, count(*) AS docs, {_FOLD.format('title')} AS k FROM documents WHERE title IS NOT NULL GROUP BY 1),
h AS (SELECT c.source_title, sum(d.docs) AS docs, bool_or(c.source_title = d.title) AS exact FROM c JOIN d USING (k) GROUP BY 1)
SELECT c.source_title, CASE WHEN h.exact THEN 'resolved' WHEN h.source_title IS NOT NULL THEN 'ambiguous' ELSE 'unresolved' END AS state, coalesce(h.docs, 0)::BIGINT AS docs FROM c LEFT JOIN h USING (source_title)""")
def catalog_resolve(spark: SparkSession, root: str) -> DataFrame:
    """Titles of segments looked up among titles of documents: the same title, one alike but for numbers, or none."""
    fold = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]+$", ""), r"[^\p{L}\p{N}]+", "")
    c = table(spark, root, "segments").where("source_title is not null").select("source_title").distinct().withColumn("k", fold(F.col("source_title")))
    d = table(spark, root, "documents").where("title is not null").groupBy("title").agg(F.count("*").alias("docs")).withColumn("k", fold(F.col("title")))
    h = c.join(d, "k").groupBy("source_title").agg(F.sum("docs").alias("docs"), F.bool_or(F.col("source_title") == F.col("title")).alias("exact"))
    j = c.join(h, "source_title", "left")
    return j.select("source_title", rules.ladder((F.col("exact"), "resolved"), (F.col("docs").isNotNull(), "ambiguous"), default="unresolved").alias("state"), F.coalesce("docs", F.lit(0)).alias("docs"))


@query("""SELECT key, 'old' AS origin FROM (SELECT DISTINCT sha256[1:12] AS key FROM source_registry WHERE version = 1 AND sha256 IS NOT NULL) UNION ALL
SELECT key, 'new' AS origin FROM (SELECT DISTINCT sha256[1:12] AS key FROM source_registry WHERE version = 2 AND sha256 IS NOT NULL) WHERE key NOT IN (SELECT DISTINCT sha256[1:12] FROM source_registry WHERE version = 1 AND sha256 IS NOT NULL)""")
def plan_append_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Known keys with those of the later batch that are not yet among them."""
    r = table(spark, root, "source_registry").where("sha256 is not null").withColumn("key", F.substring("sha256", 1, 12))
    old = r.where("version = 1").select("key").distinct()
    new = r.where("version = 2").select("key").distinct().join(old, "key", "left_anti")
    return old.withColumn("origin", F.lit("old")).unionByName(new.withColumn("origin", F.lit("new")))


@query("SELECT r_name, mode, level FROM region, (VALUES ('stratified'), ('exhaustive')) m(mode), (VALUES (0), (1), (2)) l(level)")
def grid_cross(spark: SparkSession, root: str) -> DataFrame:
    """A grid of settings: each region (five rows, fixed) with each mode and level, unfolded from arrays."""
    r = table(spark, root, "region").select("r_name", F.explode(F.array(F.lit("stratified"), F.lit("exhaustive"))).alias("mode"))
    return r.select("r_name", "mode", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("level"))


@query("""WITH x AS (SELECT source_title, list_distinct(flatten(list(topic_tags))) AS tags FROM extracts WHERE source_title IS NOT NULL AND topic_tags IS NOT NULL GROUP BY 1)
SELECT source_title, len(tags)::INTEGER AS n, round(len(list_intersect(tags, ['patience', 'trust', 'error', 'risk', 'habit']))::DOUBLE / greatest(len(tags), 5), 6) AS overlap FROM x""")
def set_overlap(spark: SparkSession, root: str) -> DataFrame:
    """Overlap of each title's topics with a given set: the common part over the larger set."""
    wanted = ["patience", "trust", "error", "risk", "habit"]
    x = table(spark, root, "extracts").where("source_title is not null and topic_tags is not null").groupBy("source_title").agg(F.array_compact(F.array_distinct(F.flatten(F.collect_list("topic_tags")))).alias("tags"))
    both = F.size(F.array_intersect("tags", F.array(*map(F.lit, wanted))))
    return x.select("source_title", F.size("tags").alias("n"), F.round(both / F.greatest(F.size("tags"), F.lit(len(wanted))), 6).alias("overlap"))


_TAGS = "(SELECT extract_id, source_title, confidence, content_type, lower(trim(unnest(topic_tags))) AS tag FROM extracts WHERE topic_tags IS NOT NULL)"


def _tags(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "extracts").where("topic_tags is not null")
    return e.select("extract_id", "source_title", "confidence", "content_type", F.explode("topic_tags").alias("tag")).withColumn("tag", F.lower(F.trim("tag")))


@query(f"SELECT tag, count(*) AS n FROM {_TAGS} WHERE tag <> '' GROUP BY tag ORDER BY n DESC, min(extract_id), tag LIMIT 12")
def tag_topk(spark: SparkSession, root: str) -> DataFrame:
    """The twelve most frequent topics; of equally frequent ones the first seen."""
    return _tags(spark, root).where("tag <> ''").groupBy("tag").agg(F.count("*").alias("n"), F.min("extract_id").alias("first")).orderBy(F.desc("n"), "first", "tag").limit(12).select("tag", "n")


@query(f"""SELECT tag, count(*) AS extracts, count(DISTINCT source_title) AS sources, count(*) FILTER (lower(confidence) = 'high') AS high, round(count(*) FILTER (lower(confidence) = 'high')::DOUBLE / count(*), 6) AS high_share,
 min(CASE lower(confidence) WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END)::INTEGER AS best FROM {_TAGS} WHERE tag <> '' GROUP BY tag""")
def coverage_matrix(spark: SparkSession, root: str) -> DataFrame:
    """Of each topic its extracts, sources, and confidence."""
    high = F.lower("confidence") == "high"
    return _tags(spark, root).where("tag <> ''").groupBy("tag").agg(F.count("*").alias("extracts"), F.countDistinct("source_title").alias("sources"), relational.count_where(high).alias("high"), F.round(relational.count_where(high) / F.count("*"), 6).alias("high_share"), F.min(rules.confidence_rank(F.lower(F.col("confidence")))).alias("best"))


@query("""SELECT coalesce(content_type, 'none') AS content_type, count(*) AS extracts, count(DISTINCT source_title) AS sources, count(*) FILTER (confidence = 'high') AS high, round(count(*) FILTER (confidence = 'high')::DOUBLE / greatest(count(*), 1), 6) AS high_ratio,
 count(*) FILTER (text IS NULL OR trim(text) = '') AS empty FROM extracts GROUP BY 1""")
def extract_stats(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "extracts")
    high = relational.count_where(F.col("confidence") == "high")
    return e.groupBy(F.coalesce("content_type", F.lit("none")).alias("content_type")).agg(F.count("*").alias("extracts"), F.countDistinct("source_title").alias("sources"), high.alias("high"), F.round(high / F.greatest(F.count("*"), F.lit(1)), 6).alias("high_ratio"), relational.count_where(F.col("text").isNull() | (F.trim("text") == "")).alias("empty"))


_SANE = """(SELECT extract_id, trim(text) AS text, coalesce(nullif(source_title, ''), 'Local source') AS source_title, coalesce(nullif(source_detail, ''), '') AS source_detail,
 CASE WHEN coalesce(nullif(content_type, ''), 'analysis') = 'passage' THEN 'analysis' ELSE coalesce(nullif(content_type, ''), 'analysis') END AS content_type, coalesce(nullif(confidence, ''), 'high') AS confidence FROM extracts WHERE trim(coalesce(text, '')) <> '')"""


def _sane(spark: SparkSession, root: str) -> DataFrame:
    """Extracts with defaults for what is missing; those without text are left out."""
    e = table(spark, root, "extracts").where(F.trim(F.coalesce("text", F.lit(""))) != "")
    or_ = lambda c, d: F.coalesce(F.nullif(c, F.lit("")), F.lit(d))
    kind = or_("content_type", "analysis")
    return e.select("extract_id", F.trim("text").alias("text"), or_("source_title", "Local source").alias("source_title"), or_("source_detail", "").alias("source_detail"), F.when(kind == "passage", "analysis").otherwise(kind).alias("content_type"), or_("confidence", "high").alias("confidence"))


@query(f"SELECT extract_id, source_title, source_detail, content_type, confidence, length(text) AS chars FROM {_SANE}")
def sanitize_extracts(spark: SparkSession, root: str) -> DataFrame:
    return _sane(spark, root).select("extract_id", "source_title", "source_detail", "content_type", "confidence", F.length("text").cast("bigint").alias("chars"))


_CONF = "CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 ELSE 3 END"
_CONT = "CASE content_type WHEN 'principle' THEN 0 WHEN 'quote' THEN 1 WHEN 'behavior_record' THEN 2 WHEN 'expression_sample' THEN 3 WHEN 'analysis' THEN 4 ELSE 5 END"


@query(f"SELECT source_title, extract_id, rank::INTEGER AS rank FROM (SELECT source_title, extract_id, row_number() OVER (PARTITION BY source_title ORDER BY {_CONF}, {_CONT}, -length(text), extract_id) AS rank FROM {_SANE}) WHERE rank <= 5")
def extract_rank(spark: SparkSession, root: str) -> DataFrame:
    """The five best extracts of each title by confidence, kind and length."""
    order = [rules.confidence_rank(F.col("confidence")), rules.content_rank(F.col("content_type")), -F.length("text"), F.col("extract_id")]
    return relational.top_per_group(_sane(spark, root), ["source_title"], order, 5).select("source_title", "extract_id", "rank")


_KEY = "substr(regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '', 'g'), 1, 120)"


@query(f"SELECT extract_id, k FROM (SELECT extract_id, {_KEY} AS k, row_number() OVER (PARTITION BY {_KEY} ORDER BY {_CONF}, {_CONT}, -length(text), extract_id) AS rn FROM {_SANE}) WHERE rn = 1 AND k <> ''")
def reduce_exact(spark: SparkSession, root: str) -> DataFrame:
    """The best extract of those that begin with the same 120 letters and digits. One partial aggregation, no sort."""
    k = F.substring(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_]+", ""), 1, 120)
    order = F.struct(rules.confidence_rank(F.col("confidence")), rules.content_rank(F.col("content_type")), -F.length("text"), F.col("extract_id"))
    return _sane(spark, root).withColumn("k", k).where("k <> ''").groupBy("k").agg(F.min_by("extract_id", order).alias("extract_id"))


@query(f"SELECT source_title, content_type, arg_min(extract_id, ({_CONF}, extract_id)) AS extract_id FROM {_SANE} GROUP BY 1, 2")
def best_per_key(spark: SparkSession, root: str) -> DataFrame:
    return _sane(spark, root).groupBy("source_title", "content_type").agg(F.min_by("extract_id", F.struct(rules.confidence_rank(F.col("confidence")), "extract_id")).alias("extract_id"))


@query(f"SELECT source_title, string_agg(tag, '|' ORDER BY first, tag) AS tags FROM (SELECT source_title, tag, min(extract_id) AS first FROM {_TAGS} WHERE tag <> '' AND source_title IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def ordered_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Distinct topics of each title in the order of their first use."""
    x = _tags(spark, root).where("tag <> '' and source_title is not null").groupBy("source_title", "tag").agg(F.min("extract_id").alias("first"))
    g = x.groupBy("source_title").agg(F.sort_array(F.collect_list(F.struct("first", "tag"))).alias("xs"))
    return g.select("source_title", F.array_join(F.transform("xs", lambda s: s["tag"]), "|").alias("tags"))


@query(f"""WITH x AS (SELECT {_KEY.replace('120', '40')} AS cluster_id, * FROM {_SANE} WHERE content_type IN ('principle', 'quote')), g AS (SELECT cluster_id, count(*) AS evidence, count(*) FILTER (confidence = 'high') AS high, count(DISTINCT source_title) AS sources, arg_min(source_title, ({_CONF}, extract_id)) AS lead, min(extract_id) AS first FROM x WHERE cluster_id <> '' GROUP BY 1)
SELECT cluster_id, evidence, high, sources, lead, row_number() OVER (ORDER BY high DESC, evidence DESC, sources DESC, first) AS rank FROM g ORDER BY rank LIMIT 50""")
def principle_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Groups of principles and quotations with the same beginning: evidence, sources, lead; the fifty first in rank."""
    k = F.substring(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_]+", ""), 1, 40)
    x = _sane(spark, root).where(F.col("content_type").isin("principle", "quote")).withColumn("cluster_id", k).where("cluster_id <> ''")
    g = x.groupBy("cluster_id").agg(F.count("*").alias("evidence"), relational.count_where(F.col("confidence") == "high").alias("high"), F.countDistinct("source_title").alias("sources"), F.min_by("source_title", F.struct(rules.confidence_rank(F.col("confidence")), "extract_id")).alias("lead"), F.min("extract_id").alias("first"))
    order = [F.desc("high"), F.desc("evidence"), F.desc("sources"), F.col("first")]
    top = g.orderBy(*order).limit(50)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")).drop("first")


@query(f"""WITH t AS (SELECT DISTINCT source_title, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_]+', '', 'g') AS f FROM {_SANE}), x AS (SELECT * FROM t WHERE f <> '')
SELECT source_title, count(*) AS fragments, sum(length(f))::BIGINT AS chars FROM x a WHERE NOT EXISTS (SELECT 1 FROM x b WHERE b.source_title = a.source_title AND length(b.f) > length(a.f) AND contains(b.f, a.f)) GROUP BY 1""")
def evidence_survival(spark: SparkSession, root: str) -> DataFrame:
    """Fragments and characters of each title that no longer fragment of it contains."""
    k = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}_]+", "")
    x = _sane(spark, root).select("source_title", "extract_id", k.alias("f"))
    return surviving(x, "source_title", "extract_id", "f").groupBy("source_title").agg(F.count("*").alias("fragments"), F.sum(F.length("text")).alias("chars"))


@query("""SELECT s.source_id, count(*) AS segments, max(CASE WHEN r.rights_status IN ('public_domain', 'licensed') THEN 1 ELSE 0 END) = 1 AS cleared, coalesce(any_value(r.rights_status), 'unlocated') AS rights
FROM segments s LEFT JOIN (SELECT source_id, max(rights_status) AS rights_status FROM source_registry GROUP BY 1) r ON s.source_id = r.source_id GROUP BY 1""")
def evidence_rights(spark: SparkSession, root: str) -> DataFrame:
    n = table(spark, root, "segments").groupBy("source_id").agg(F.count("*").alias("segments"))
    r = table(spark, root, "source_registry").groupBy("source_id").agg(F.max("rights_status").alias("rights_status"))
    return n.join(r, "source_id", "left").select("source_id", "segments", F.coalesce(F.col("rights_status").isin("public_domain", "licensed"), F.lit(False)).alias("cleared"), F.coalesce("rights_status", F.lit("unlocated")).alias("rights"))


@query("""SELECT source, count(*) AS docs, count(*) FILTER (genre = 'talk') AS talk, count(*) FILTER (genre = 'letter') AS letter, count(*) FILTER (genre = 'notes') AS notes, count(*) FILTER (genre = 'dialogue') AS dialogue, string_agg(DISTINCT lang, '|' ORDER BY lang) AS langs FROM documents WHERE source IS NOT NULL GROUP BY 1""")
def source_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Documents of each source by genre, and its labels."""
    d = table(spark, root, "documents").where("source is not null")
    n = {g: relational.count_where(F.col("genre") == g).alias(g) for g in ("talk", "letter", "notes", "dialogue")}
    return d.groupBy("source").agg(F.count("*").alias("docs"), *n.values(), F.when(F.count("lang") > 0, F.array_join(F.sort_array(F.collect_set("lang")), "|")).alias("langs"))


@query("""SELECT CASE WHEN grouping(classification) = 0 THEN 'classification' WHEN grouping(ocr_required) = 0 THEN 'ocr_required' ELSE 'page_number' END AS dimension, coalesce(classification, ocr_required::VARCHAR, pg::VARCHAR, 'null') AS value, count(*) AS pages, round(sum(quality_score * non_ws_chars) / sum(CASE WHEN quality_score IS NOT NULL THEN non_ws_chars END), 6) AS weighted_score
FROM (SELECT *, CASE WHEN page_number <= 5 THEN 0 ELSE 1 END AS pg FROM page_quality) GROUP BY GROUPING SETS ((classification), (ocr_required), (pg))""")
def weighted_grouping_sets(spark: SparkSession, root: str) -> DataFrame:
    """Quality weighted by characters along three dimensions at once."""
    table(spark, root, "page_quality").withColumn("pg", F.when(F.col("page_number") <= 5, 0).otherwise(1)).createOrReplaceTempView("__pages")
    return spark.sql("""SELECT CASE WHEN grouping(classification) = 0 THEN 'classification' WHEN grouping(ocr_required) = 0 THEN 'ocr_required' ELSE 'page_number' END AS dimension,
        coalesce(classification, cast(ocr_required AS string), cast(pg AS string), 'null') AS value, count(*) AS pages, round(sum(quality_score * non_ws_chars) / sum(CASE WHEN quality_score IS NOT NULL THEN non_ws_chars END), 6) AS weighted_score
        FROM __pages GROUP BY GROUPING SETS ((classification), (ocr_required), (pg))""")


_PAGE = "CASE WHEN sub > 0 AND NOT txt THEN 'image_only' WHEN sub > 0 THEN 'mixed' WHEN txt THEN 'text_only' ELSE 'empty' END"
_PAGES = f"(SELECT page_id, source_id, classification, ocr_required, lost, {_PAGE} AS kind FROM (SELECT *, coalesce(substantive_image_count, 0) AS sub, coalesce(non_ws_chars, 0) >= 20 AND coalesce(quality_score, 0) >= 0.25 AS txt, coalesce(replacement_chars, 0) AS lost FROM page_quality))"


def _pages(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "page_quality")
    image, text = F.coalesce("substantive_image_count", F.lit(0)) > 0, (F.coalesce("non_ws_chars", F.lit(0)) >= 20) & (F.coalesce("quality_score", F.lit(0.0)) >= 0.25)
    return p.select("page_id", "source_id", "classification", "ocr_required", F.coalesce("replacement_chars", F.lit(0)).alias("lost"), rules.ladder((image & ~text, "image_only"), (image, "mixed"), (text, "text_only"), default="empty").alias("kind"))


@query(f"SELECT page_id, kind, kind IN ('image_only', 'mixed') OR (kind = 'text_only' AND lost > 0) AS needs_ocr, coalesce(kind = classification, false) AS agrees FROM {_PAGES}")
def page_classify(spark: SparkSession, root: str) -> DataFrame:
    """Kind of every page from its counts, whether it needs recognition, and whether the stored kind agrees."""
    k = F.col("kind")
    return _pages(spark, root).select("page_id", "kind", (k.isin("image_only", "mixed") | ((k == "text_only") & (F.col("lost") > 0))).alias("needs_ocr"), F.coalesce(k == F.col("classification"), F.lit(False)).alias("agrees"))


@query(f"""SELECT source_id, CASE WHEN bool_and(kind = 'empty') THEN 'empty_or_unreadable_pdf' WHEN bool_and(kind = 'image_only' OR kind = 'empty') THEN 'pure_image_pdf' WHEN bool_or(kind IN ('mixed', 'image_only')) THEN 'mixed_text_image_pdf' ELSE 'pure_text_pdf' END AS kind, count(*) AS pages FROM {_PAGES} GROUP BY 1""")
def doc_type_rollup(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("kind")
    kind = rules.ladder((F.bool_and(k == "empty"), "empty_or_unreadable_pdf"), (F.bool_and(k.isin("image_only", "empty")), "pure_image_pdf"), (F.bool_or(k.isin("mixed", "image_only")), "mixed_text_image_pdf"), default="pure_text_pdf")
    return _pages(spark, root).groupBy("source_id").agg(kind.alias("kind"), F.count("*").alias("pages"))


@query("SELECT source_file, count(*) AS pages, count(*) FILTER (ocr_required) AS required, round(avg(quality_score), 6) AS mean_score, sum(coalesce(replacement_chars, 0))::BIGINT AS lost, round(count(*) FILTER (ocr_required)::DOUBLE / count(*) * 1.1, 6) AS minutes_share FROM page_quality GROUP BY 1")
def ocr_summary(spark: SparkSession, root: str) -> DataFrame:
    n = relational.count_where(F.col("ocr_required"))
    return table(spark, root, "page_quality").groupBy("source_file").agg(F.count("*").alias("pages"), n.alias("required"), F.round(F.avg("quality_score"), 6).alias("mean_score"), F.sum(F.coalesce("replacement_chars", F.lit(0))).alias("lost"), F.round(n / F.count("*") * 1.1, 6).alias("minutes_share"))


@query("""WITH x AS (SELECT source_file, page_number, page_number - lag(page_number) OVER (PARTITION BY source_file ORDER BY page_number, page_id) AS gap FROM page_quality WHERE source_file IS NOT NULL AND page_number IS NOT NULL),
m AS (SELECT source_file, list_sort(list(gap) FILTER (gap > 0)) AS gs FROM x GROUP BY 1)
SELECT source_file, gs[len(gs) // 2 + 1]::INTEGER AS pitch, list_sum(list_transform(list_filter(gs, lambda g: g >= 2.5 * gs[len(gs) // 2 + 1]), lambda g: round(g::DOUBLE / gs[len(gs) // 2 + 1]) - 1))::BIGINT AS missing FROM m WHERE len(gs) > 0""")
def gap_inference(spark: SparkSession, root: str) -> DataFrame:
    """Pages that are missing between neighbours: gaps of 2.5 usual steps (upper median) and more, counted in steps."""
    w = Window.partitionBy("source_file").orderBy("page_number", "page_id")
    x = table(spark, root, "page_quality").where("source_file is not null and page_number is not null").withColumn("gap", F.col("page_number") - F.lag("page_number").over(w))
    gaps = x.where("gap > 0").groupBy("source_file", "gap").agg(F.count("*").alias("n"))
    pitch = relational.upper_median(x.where("gap > 0"), "source_file", "gap").withColumnRenamed("upper_median", "pitch")
    wide = F.when(F.col("gap") >= 2.5 * F.col("pitch"), F.col("n") * (F.round(F.col("gap") / F.col("pitch")).cast("bigint") - 1))
    return gaps.join(pitch, "source_file").groupBy("source_file").agg(F.max("pitch").alias("pitch"), F.sum(wide).alias("missing"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY 1")
def latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    """The last event of each user."""
    e = table(spark, root, "events")
    last = F.struct("ts", "event_id")
    return e.groupBy("user_id").agg(F.max_by("event_type", last).alias("event_type"), F.max_by("value", last).alias("value"), F.max("ts").alias("ts"))


@query("SELECT user_id, event_id, (props->>'k')::BIGINT AS k FROM (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(props, (ts, event_id)) AS props FROM events WHERE event_type = 'purchase' GROUP BY 1)")
def last_event(spark: SparkSession, root: str) -> DataFrame:
    """The last purchase of each user with a value from its JSON."""
    e = table(spark, root, "events").where("event_type = 'purchase'")
    last = e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "props"), F.struct("ts", "event_id")).alias("e"))
    return last.select("user_id", "e.event_id", F.get_json_object("e.props", "$.k").cast("bigint").alias("k"))


@query("SELECT k, count(*) AS n, round(sum(value), 4) AS value FROM (SELECT (props->>'k')::BIGINT AS k, value FROM events) GROUP BY 1")
def jsonl_parse(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "events").select(F.from_json("props", "k bigint").alias("p"), "value")
    return e.groupBy(F.col("p.k").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("SELECT user_id, n AS failures, moment AS blocked_at FROM (SELECT user_id, ts AS moment, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'error') WHERE n = 3")
def blocked_units(spark: SparkSession, root: str) -> DataFrame:
    """When each user's third error came."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, root, "events").where("event_type = 'error'").withColumn("failures", F.row_number().over(w).cast("bigint"))
    return e.where("failures = 3").select("user_id", "failures", F.col("ts").alias("blocked_at"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def tumbling_counts(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return e.select(F.col("window.start").alias("window_start"), "event_type", "n", "value")


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), y AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM x)
SELECT user_id, min(ts) AS session_start, count(*) AS n FROM y GROUP BY user_id, s""")
def session_counts(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "events").groupBy(F.session_window("ts", "6 hours"), "user_id").agg(F.count("*").alias("n"))
    return e.select("user_id", F.col("session_window.start").alias("session_start"), "n")


@query("SELECT o_custkey, o_orderkey, rank::INTEGER AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(spark: SparkSession, root: str) -> DataFrame:
    return relational.top_per_group(table(spark, root, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("SELECT p_brand, arg_min(p_partkey, (p_name, p_partkey)) AS p_partkey FROM part GROUP BY 1")
def first_per_key(spark: SparkSession, root: str) -> DataFrame:
    return relational.first_per_key(table(spark, root, "part"), ["p_brand"], [F.col("p_name"), F.col("p_partkey")]).select("p_brand", "p_partkey")


@query("""WITH u AS (SELECT o_custkey AS k, max(o_orderpriority) AS priority, max(o_totalprice) AS total FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, k) AS c_custkey, coalesce(total, c_acctbal) AS c_acctbal, c_mktsegment FROM customer FULL OUTER JOIN u ON c_custkey = k""")
def index_upsert(spark: SparkSession, root: str) -> DataFrame:
    """Customers with their balance replaced by their largest order, where they have one."""
    c = table(spark, root, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    changes = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return upsert(c, changes, "c_custkey", ["c_acctbal"])


@query("SELECT text_key, min(origin) AS origin, count(*) AS n FROM (SELECT md5(text) AS text_key, 'documents' AS origin FROM documents UNION ALL SELECT md5(text) AS text_key, 'extracts' AS origin FROM extracts) WHERE text_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def corpus_union(spark: SparkSession, root: str) -> DataFrame:
    """Texts that two tables of the corpus hold more than once together."""
    u = table(spark, root, "documents").select(F.md5("text").alias("text_key"), F.lit("documents").alias("origin")).unionByName(table(spark, root, "extracts").select(F.md5("text").alias("text_key"), F.lit("extracts").alias("origin")))
    return u.where("text_key is not null").groupBy("text_key").agg(F.min("origin").alias("origin"), F.count("*").alias("n")).where("n > 1")


@query("SELECT source, side FROM ((SELECT DISTINCT source, 'documents' AS side FROM documents WHERE source NOT IN (SELECT source_id FROM decoded WHERE source_id IS NOT NULL)) UNION ALL (SELECT DISTINCT source_id AS source, 'decoded' AS side FROM decoded WHERE source_id NOT IN (SELECT source FROM documents WHERE source IS NOT NULL)))")
def except_both(spark: SparkSession, root: str) -> DataFrame:
    a = table(spark, root, "documents").select("source").where("source is not null")
    b = table(spark, root, "decoded").select(F.col("source_id").alias("source")).where("source is not null")
    return a.subtract(b).withColumn("side", F.lit("documents")).unionByName(b.subtract(a).withColumn("side", F.lit("decoded")))


@query("SELECT source FROM documents INTERSECT SELECT source_id FROM decoded")
def source_intersect(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("source").intersect(table(spark, root, "decoded").select(F.col("source_id").alias("source")))


@query("""WITH h AS (SELECT source, sha256(concat_ws(chr(10), doc_id::VARCHAR, coalesce(text, ''))) AS h FROM documents WHERE source IS NOT NULL), b AS (SELECT source, h[1:3] AS b, sha256(string_agg(h, '' ORDER BY h)) AS h, count(*) AS n FROM h GROUP BY 1, 2)
SELECT source, sha256(string_agg(h, '' ORDER BY b)) AS fingerprint, sum(n)::BIGINT AS files FROM b GROUP BY 1""")
def corpus_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    """Fingerprint of each source's documents, whatever their order."""
    return relational.ordered_hash(table(spark, root, "documents").where("source is not null"), [F.col("doc_id"), F.col("text")], "source")


@query("""SELECT 'orders' AS gate, 'INVALID_VALUE' AS code, 'error' AS severity, o_orderkey::VARCHAR AS subject, 'o_totalprice' AS detail FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000
UNION ALL SELECT 'extracts', 'UNKNOWN_VALUE', 'error', extract_id::VARCHAR, 'confidence=' || confidence FROM extracts WHERE confidence IS NOT NULL AND confidence NOT IN ('high', 'medium', 'low')
UNION ALL SELECT 'extracts', 'MISSING_FIELD', 'error', extract_id::VARCHAR, f FROM (SELECT extract_id, unnest(list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'text' END, CASE WHEN source_title IS NULL OR trim(source_title) = '' THEN 'source_title' END, CASE WHEN source_detail IS NULL OR trim(source_detail) = '' THEN 'source_detail' END], lambda x: x IS NOT NULL)) AS f FROM extracts)
UNION ALL SELECT 'registry', 'DUPLICATE_ID', 'warning', source_id, count(*)::VARCHAR FROM source_registry WHERE source_id IS NOT NULL GROUP BY source_id HAVING count(*) > 1
UNION ALL SELECT 'segments', 'DANGLING', 'error', source_id, 'source_id' FROM (SELECT DISTINCT source_id FROM segments WHERE source_id IS NOT NULL) s WHERE NOT EXISTS (SELECT 1 FROM source_registry r WHERE r.source_id = s.source_id)
UNION ALL SELECT 'sources', 'TOO_FEW', 'warning', source, count(*)::VARCHAR FROM documents GROUP BY source HAVING count(*) < 3""")
def gate_violations(spark: SparkSession, root: str) -> DataFrame:
    """Constraints over several tables, one row per violation."""
    e, r = table(spark, root, "extracts"), table(spark, root, "source_registry")
    return gates.union([
        gates.in_range(table(spark, root, "orders"), "orders", "o_orderkey", "o_totalprice", 1000, 400000), gates.one_of(e, "extracts", "extract_id", "confidence", ["high", "medium", "low"]),
        gates.required(e, "extracts", "extract_id", ["text", "source_title", "source_detail"]), gates.unique(r, "registry", "source_id", "warning"),
        gates.orphan(table(spark, root, "segments"), "segments", "source_id", r, "source_id"), gates.per_group(table(spark, root, "documents"), "sources", "source", 3, severity="warning"),
    ])


@query("""SELECT segment_id, CASE WHEN pts >= 5 THEN 'high' WHEN pts >= 3 THEN 'medium' ELSE 'low' END AS difficulty FROM (SELECT segment_id, CASE WHEN token_estimate >= 45000 THEN 3 WHEN token_estimate >= 30000 THEN 2 WHEN token_estimate >= 20000 THEN 1 ELSE 0 END
 + CASE WHEN coalesce(ocr_required, false) OR coalesce(extraction_quality_band IN ('poor', 'unreadable'), false) THEN 2 ELSE 0 END + CASE WHEN coalesce(language, 'other') IN ('en', 'zh') THEN 0 ELSE 1 END + CASE WHEN coalesce(imgs, 0) > 0 THEN 1 ELSE 0 END AS pts
 FROM segments LEFT JOIN (SELECT source_id, max(substantive_image_count) AS imgs FROM page_quality WHERE source_id IS NOT NULL GROUP BY 1) USING (source_id))""")
def dispatch_difficulty(spark: SparkSession, root: str) -> DataFrame:
    """How hard each segment is to work on, by size, scan, language and images."""
    s = table(spark, root, "segments").select("segment_id", "source_id", "token_estimate", "ocr_required", "extraction_quality_band", "language")
    p = table(spark, root, "page_quality").where("source_id is not null").groupBy("source_id").agg(F.max("substantive_image_count").alias("imgs"))
    d = rules.difficulty(F.col("token_estimate"), F.col("ocr_required"), F.col("extraction_quality_band"), F.col("language"), F.col("imgs"))
    return s.join(p, "source_id", "left").select("segment_id", d.alias("difficulty"))


@query("""WITH d AS (SELECT DISTINCT sha256(text) AS h, min(decoded_id) OVER (PARTITION BY text) AS first, decoded_id, text, encoding FROM decoded)
SELECT decoded_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'no_extractable_text' WHEN first <> decoded_id THEN 'duplicate' WHEN encoding IS NULL THEN 'unknown_encoding' ELSE 'indexed' END AS status FROM d""")
def file_status(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "decoded").select("decoded_id", "text", "encoding")
    dup = exact_duplicates(d, "decoded_id", "text")
    j = d.join(dup.select("decoded_id", "duplicate_of"), "decoded_id")
    return j.select("decoded_id", rules.ladder((F.col("text").isNull() | (F.trim("text") == ""), "no_extractable_text"), (F.col("duplicate_of").isNotNull(), "duplicate"), (F.col("encoding").isNull(), "unknown_encoding"), default="indexed").alias("status"))


@query("""WITH a AS (SELECT extract_id, list_filter(topic_tags, lambda x: x IS NOT NULL) AS t FROM extracts WHERE topic_tags IS NOT NULL)
SELECT extract_id, array_to_string(list_sort(list_filter([CASE WHEN len(t) = 0 THEN 'none' END, CASE WHEN len(t) > 3 THEN 'too_many' END, CASE WHEN len(list_distinct(t)) < len(t) THEN 'repeated' END, CASE WHEN len(list_filter(t, lambda x: x <> lower(trim(x)))) > 0 THEN 'untidy' END], lambda x: x IS NOT NULL)), '|') AS problems FROM a""")
def classification_check(spark: SparkSession, root: str) -> DataFrame:
    """What is wrong with each extract's topics."""
    t = F.array_compact("topic_tags")
    e = table(spark, root, "extracts").where("topic_tags is not null").withColumn("t", t)
    problems = rules.listed((F.size("t") == 0, "none"), (F.size("t") > 3, "too_many"), (F.size(F.array_distinct("t")) < F.size("t"), "repeated"), (F.exists("t", lambda x: x != F.lower(F.trim(x))), "untidy"))
    return e.select("extract_id", problems.alias("problems"))


@query("""SELECT source_id, arg_min(registry_id, (CASE WHEN rights_status = 'public_domain' THEN 0 WHEN rights_status = 'licensed' THEN 1 ELSE 2 END, CASE lower(extension) WHEN '.txt' THEN 0 WHEN '.epub' THEN 1 ELSE 2 END, registry_id)) AS registry_id FROM source_registry WHERE source_id IS NOT NULL GROUP BY 1""")
def ranked_pick(spark: SparkSession, root: str) -> DataFrame:
    """The registration of each source to use, by rights and then form."""
    r = table(spark, root, "source_registry").where("source_id is not null")
    rank = F.struct(rules.ladder((F.col("rights_status") == "public_domain", 0), (F.col("rights_status") == "licensed", 1), default=2), rules.ladder((F.lower("extension") == ".txt", 0), (F.lower("extension") == ".epub", 1), default=2), "registry_id")
    return r.groupBy("source_id").agg(F.min_by("registry_id", rank).alias("registry_id"))


@query("""WITH s AS (SELECT DISTINCT source_title, source_id FROM segments WHERE source_title IS NOT NULL AND source_id IS NOT NULL), r AS (SELECT source_id, max(rights_status) AS rights, min(filename) AS file FROM source_registry WHERE source_id IS NOT NULL GROUP BY 1)
SELECT e.extract_id, count(DISTINCT r.file) AS files, min(r.file) AS first_file, count(r.file) > 0 AS traced FROM extracts e LEFT JOIN s ON e.source_title = s.source_title LEFT JOIN r ON s.source_id = r.source_id GROUP BY 1""")
def claim_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every extract with the registered files behind its title."""
    s = table(spark, root, "segments").where("source_title is not null and source_id is not null").select("source_title", "source_id").distinct()
    r = table(spark, root, "source_registry").where("source_id is not null").groupBy("source_id").agg(F.min("filename").alias("file"))
    # files are gathered by title first, so that a title that a third of the extracts have is met once
    t = s.join(r, "source_id").groupBy("source_title").agg(F.countDistinct("file").alias("files"), F.min("file").alias("first_file"))
    e = table(spark, root, "extracts").select("extract_id", "source_title").join(t, "source_title", "left")
    return e.select("extract_id", F.coalesce("files", F.lit(0)).alias("files"), "first_file", (F.col("files").isNotNull()).alias("traced"))


@query("""SELECT content_type, count(*) AS total, count(*) FILTER (traced) AS traced, count(*) FILTER (NOT traced) AS untraced FROM (SELECT coalesce(e.content_type, 'none') AS content_type, EXISTS (SELECT 1 FROM segments s WHERE s.source_title = e.source_title AND s.source_id IS NOT NULL) AS traced FROM extracts e) GROUP BY 1""")
def traced_counts(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "segments").where("source_id is not null and source_title is not null").select("source_title").distinct().withColumn("hit", F.lit(True))
    e = table(spark, root, "extracts").select(F.coalesce("content_type", F.lit("none")).alias("content_type"), "source_title").join(s, "source_title", "left")
    return e.groupBy("content_type").agg(F.count("*").alias("total"), F.count("hit").alias("traced"), (F.count("*") - F.count("hit")).alias("untraced"))


@query("""SELECT coalesce(a.source_title, b.title) AS title, coalesce(a.n, 0) AS segments, coalesce(b.n, 0) AS documents, dense_rank() OVER (ORDER BY coalesce(a.first, b.first), coalesce(a.source_title, b.title)) AS no
FROM (SELECT source_title, count(*) AS n, min(segment_id) AS first FROM segments WHERE source_title IS NOT NULL GROUP BY 1) a FULL OUTER JOIN (SELECT title, count(*) AS n, min(doc_id) AS first FROM documents WHERE title IS NOT NULL GROUP BY 1) b ON a.source_title = b.title""")
def outer_merge(spark: SparkSession, root: str) -> DataFrame:
    """Titles of two tables merged, numbered by first appearance without one task for all."""
    a = table(spark, root, "segments").where("source_title is not null").groupBy(F.col("source_title").alias("title")).agg(F.count("*").alias("segments"), F.min("segment_id").alias("fa"))
    b = table(spark, root, "documents").where("title is not null").groupBy("title").agg(F.count("*").alias("documents"), F.min("doc_id").alias("fb"))
    m = a.join(b, "title", "full_outer").select("title", F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("fa", "fb").alias("first"))
    return relational.number_rows(m, ["first", "title"], "no").drop("first")
