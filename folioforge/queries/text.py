"""Queries on texts and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import rules
from folioforge.functions.text import estimate, non_space
from folioforge.operators import cleaning, style
from folioforge.queries.sqltext import SPACE, count_chars, lines, solid
from folioforge.queries.sqltext import estimate as sql_estimate
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


_CJK = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
_METRICS = f"""{solid('t')} AS chars, {count_chars('t', _CJK)} AS cjk_chars, {count_chars('t', chr(92) + 'x{FFFD}')} AS fffd,
    {count_chars('t', chr(92) + 'x{E000}-' + chr(92) + 'x{F8FF}')} AS pua, {count_chars('t', r'\x{00}-\x{08}\x{0B}\x{0E}-\x{1F}\x{7F}')} AS control,
    len(regexp_extract_all(t, '{cleaning.LATIN_GARBLE}')) AS latin_mojibake, {count_chars('t', cleaning.GBK_GARBLE)} AS gbk_mojibake"""
_METRIC_NAMES = ["chars", "cjk_chars", "fffd", "pua", "control", "latin_mojibake", "gbk_mojibake"]


def _ints(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


@query(f"SELECT decoded_id, chars::BIGINT AS chars, cjk_chars::BIGINT AS cjk_chars, fffd::BIGINT AS fffd, pua::BIGINT AS pua, control::BIGINT AS control, latin_mojibake::BIGINT AS latin_mojibake, gbk_mojibake::BIGINT AS gbk_mojibake FROM (SELECT decoded_id, {_METRICS} FROM (SELECT decoded_id, coalesce(text, '') AS t FROM decoded))")
def text_metrics(spark: SparkSession, root: str) -> DataFrame:
    d = cleaning.with_metrics(table(spark, root, "decoded").select("decoded_id", "text"))
    return _ints(d, *_METRIC_NAMES).drop("text")


_VERDICT = f"""
WITH m AS (SELECT decoded_id, greatest(1, chars)::DOUBLE AS n, greatest(1, cjk_chars)::DOUBLE AS c, * FROM (SELECT decoded_id, {_METRICS} FROM (SELECT decoded_id, coalesce(text, '') AS t FROM decoded))),
l AS (SELECT decoded_id, CASE WHEN chars = 0 THEN ['empty_after_cleaning'] ELSE list_filter([
    CASE WHEN fffd / n > 0.005 THEN 'replacement_chars' END, CASE WHEN pua / n > 0.05 THEN 'private_use_glyphs' END,
    CASE WHEN latin_mojibake >= 20 AND latin_mojibake / n > 0.002 THEN 'mojibake_utf8_as_latin' END,
    CASE WHEN gbk_mojibake >= 20 AND gbk_mojibake / c > 0.005 THEN 'mojibake_utf8_as_gbk' END], lambda x: x IS NOT NULL) END AS r,
  CASE WHEN chars = 0 THEN []::VARCHAR[] ELSE list_filter([
    CASE WHEN fffd / n > 0.0005 AND fffd / n <= 0.005 THEN 'replacement_chars' END, CASE WHEN pua / n > 0.001 AND pua / n <= 0.05 THEN 'private_use_glyphs' END,
    CASE WHEN control / n > 0.001 THEN 'control_chars' END, CASE WHEN chars < 200 THEN 'very_short' END], lambda x: x IS NOT NULL) END AS f FROM m)
SELECT decoded_id, array_to_string(list_sort(r), '|') AS reasons, array_to_string(list_sort(f), '|') AS flags,
  CASE WHEN len(r) > 0 THEN 'rejected' WHEN len(f) > 0 THEN 'flagged' ELSE 'accepted' END AS verdict FROM l"""


@query(_VERDICT)
def clean_verdict(spark: SparkSession, root: str) -> DataFrame:
    d = cleaning.with_verdict(cleaning.with_metrics(table(spark, root, "decoded").select("decoded_id", "text")))
    return d.select("decoded_id", "reasons", "flags", "verdict")


@query(f"SELECT verdict, reasons, flags, count(*) AS sources, min(decoded_id) AS first_id, max(decoded_id) AS last_id FROM ({_VERDICT}) GROUP BY ALL")
def cleaning_report(spark: SparkSession, root: str) -> DataFrame:
    """Buckets of the report with their sizes; clean_verdict is the membership table."""
    d = clean_verdict(spark, root)
    return d.groupBy("verdict", "reasons", "flags").agg(F.count("*").alias("sources"), F.min("decoded_id").alias("first_id"), F.max("decoded_id").alias("last_id"))


@query(f"SELECT doc_id, {sql_estimate('text')} AS tokens, {solid('text')} AS solid, CASE WHEN cjk > letters THEN 'zh' WHEN letters > 0 THEN 'en' ELSE 'other' END AS language FROM (SELECT doc_id, text, {count_chars('substr(text, 1, 4000)', chr(92) + 'x{4E00}-' + chr(92) + 'x{9FFF}')} AS cjk, {count_chars('lower(substr(text, 1, 4000))', 'a-z')} AS letters FROM documents)")
def language_tokens(spark: SparkSession, root: str) -> DataFrame:
    """Token estimate and the coarse language of every document."""
    d = table(spark, root, "documents")
    return d.select("doc_id", estimate(F.col("text")).alias("tokens"), non_space(F.col("text")).cast("bigint").alias("solid"), rules.detect_language(F.col("text")).alias("language"))


_CTRL = r"\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}"
_SCORE = f"""(SELECT segment_id, CASE WHEN n = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, 0.65::DOUBLE + CASE WHEN n >= 80 THEN 0.2::DOUBLE WHEN n < 20 THEN -0.25::DOUBLE ELSE 0.0::DOUBLE END - least(0.25::DOUBLE, lost / n * 2) - least(0.15::DOUBLE, ctl / n * 2))) END AS s
  FROM (SELECT segment_id, {solid("coalesce(text, '')")}::DOUBLE AS n, {count_chars("coalesce(text, '')", chr(92) + 'x{FFFD}')} AS lost, {count_chars("coalesce(text, '')", _CTRL)} AS ctl FROM segments))"""


@query(f"SELECT segment_id, round(s, 6) AS score, CASE WHEN s >= 0.75 THEN 'good' WHEN s >= 0.45 THEN 'review' WHEN s > 0 THEN 'poor' ELSE 'unreadable' END AS band FROM {_SCORE}")
def page_quality_score(spark: SparkSession, root: str) -> DataFrame:
    """Quality score and band of every segment's text."""
    s = rules.quality_score(F.coalesce("text", F.lit("")))
    d = table(spark, root, "segments").select("segment_id", s.alias("s"))
    return d.select("segment_id", F.round("s", 6).alias("score"), rules.quality_band(F.col("s")).alias("band"))


_MARKERS = ", ".join("'" + m.replace("'", "''") + "'" for m in (*cleaning.MARKERS, "旧本误作", "Q:", "A:"))


@query(f"SELECT doc_id, marker, n FROM (SELECT doc_id, marker, ((length(text) - length(replace(text, marker, ''))) // length(marker))::BIGINT AS n FROM documents, (SELECT unnest([{_MARKERS}]) AS marker)) WHERE n > 0")
def annotation_markers(spark: SparkSession, root: str) -> DataFrame:
    """How often each marker of notes and dialogue stands in each document."""
    return cleaning.marker_counts(table(spark, root, "documents"), "doc_id", "text", (*cleaning.MARKERS, "旧本误作", "Q:", "A:"))


_MARKED = rf"""
a AS (SELECT segment_id, line_no, line, trim(regexp_replace(line, '[{SPACE}]+', ' ', 'g')) AS solid, regexp_matches(line, '{cleaning.PAGE_MARKER}') AS marker, regexp_matches(line, '{cleaning.PAGE_NUMBER}') AS number,
   regexp_matches(line, '{cleaning.INDEX_LINE}') AS ix FROM {lines('segments', 'segment_id')}),
b AS (SELECT *, solid = '' AS blank, ix AND solid <> '' AS hit, sum(CASE WHEN solid = '' THEN 0 ELSE 1 END) OVER w AS nb FROM a WINDOW w AS (PARTITION BY segment_id ORDER BY line_no)),
c AS (SELECT *, last_value(CASE WHEN hit THEN nb END IGNORE NULLS) OVER (PARTITION BY segment_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ph FROM b),
d AS (SELECT *, sum(CASE WHEN hit AND (ph IS NULL OR nb - ph > 2) THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id ORDER BY line_no) AS run FROM c),
e AS (SELECT *, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id, run) AS rh, max(CASE WHEN hit THEN line_no END) OVER (PARTITION BY segment_id, run) AS rl FROM d),
f AS (SELECT *, run > 0 AND rh >= 3 AND line_no <= rl AS index_line FROM e),
g AS (SELECT *, NOT blank AND NOT index_line AS live, sum(CASE WHEN NOT blank AND NOT index_line THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id ORDER BY line_no) AS live_no FROM f),
h AS (SELECT *, max(CASE WHEN live AND (marker OR number) THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id ORDER BY live_no RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 1 AS near,
   live AND NOT marker AND NOT regexp_matches(line, '[0-9]') AND {solid('solid')} >= 4 AND length(solid) <= 40 AND NOT regexp_matches(solid, '[:：]$') AND regexp_matches(solid, '\p{{L}}') AS fit,
   sum(CASE WHEN live THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id) AS live_all, sum(CASE WHEN number AND NOT index_line THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id) AS numbers FROM g),
i AS (SELECT *, sum(CASE WHEN fit THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id, solid) AS same, sum(CASE WHEN fit AND near THEN 1 ELSE 0 END) OVER (PARTITION BY segment_id, solid) AS same_near FROM h),
j AS (SELECT segment_id, line_no, line, CASE WHEN index_line AND NOT blank THEN 'index_toc_lines' WHEN fit AND same >= greatest(2, 0.02 * live_all) AND same_near >= 0.6 * same THEN 'running_head_lines' WHEN marker THEN NULL
   WHEN number AND numbers >= 3 THEN 'page_number_lines' WHEN length(solid) <= 80 AND regexp_matches(solid, '{cleaning.AD_CUE}') AND regexp_matches(solid, '{cleaning.AD_VERB}') THEN 'site_ad_lines' END AS action FROM i)"""


def _marks(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.marked_lines(table(spark, root, "segments").select("segment_id", "text"), "segment_id", heads_least=2, run_least=3)


@query(f"WITH {_MARKED} SELECT segment_id, line_no::INTEGER AS line_no, action FROM j WHERE action IS NOT NULL")
def clean_lines(spark: SparkSession, root: str) -> DataFrame:
    """Every line that a cleaning rule deletes, with the rule (heads from two repeats, index runs from three lines, as
    the segments are short)."""
    return _marks(spark, root).where("action is not null").select("segment_id", "line_no", "action")


@query(f"WITH {_MARKED} SELECT action, count(*) AS lines, count(DISTINCT segment_id) AS segments FROM j WHERE action IS NOT NULL GROUP BY action")
def action_totals(spark: SparkSession, root: str) -> DataFrame:
    return _marks(spark, root).where("action is not null").groupBy("action").agg(F.count("*").alias("lines"), F.countDistinct("segment_id").alias("segments"))


@query(rf"WITH {_MARKED} SELECT segment_id, trim(regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '\n{{3,}}', chr(10) || chr(10), 'g')) || chr(10) AS text FROM j WHERE action IS NULL GROUP BY segment_id")
def cleaned_text(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.cleaned(_marks(spark, root), "segment_id")


@query(rf"""WITH x AS (SELECT segment_id, line_no, regexp_matches(line, '{cleaning.PAGE_MARKER}') OR regexp_matches(line, '{cleaning.PAGE_NUMBER}') AS edge FROM {lines('segments', 'segment_id')})
SELECT segment_id, line_no::INTEGER AS line_no, edge FROM (SELECT *, max(edge::INT) OVER (PARTITION BY segment_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 1 AS near FROM x) WHERE near""")
def near_boundary(spark: SparkSession, root: str) -> DataFrame:
    """Lines within two lines of a page's end."""
    x = cleaning.lines_of(table(spark, root, "segments"), "segment_id").withColumn("edge", F.col("line").rlike(cleaning.PAGE_MARKER) | F.col("line").rlike(cleaning.PAGE_NUMBER))
    w = Window.partitionBy("segment_id").orderBy("line_no").rowsBetween(-2, 2)
    return x.withColumn("near", F.max(F.col("edge").cast("int")).over(w) == 1).where("near").select("segment_id", "line_no", "edge")


@query(rf"""WITH x AS (SELECT source_id, segment_id, line_no, trim(line) AS line FROM {lines('segments', 'segment_id', ', source_id')} WHERE source_id IS NOT NULL AND trim(line) <> ''),
e AS (SELECT DISTINCT source_id, segment_id, CASE WHEN regexp_matches(line, '^[\s\-–—一_.·]*\d{{1,4}}[\s\-–—一_.·]*$') THEN '#page' ELSE regexp_replace(regexp_replace(line, '^[{SPACE}]+|[{SPACE}]+$', '', 'g'), '[0-9]+', '#', 'g') END AS head FROM (SELECT *, row_number() OVER (PARTITION BY source_id, segment_id ORDER BY line_no) AS a, row_number() OVER (PARTITION BY source_id, segment_id ORDER BY line_no DESC) AS b FROM x) WHERE a <= 2 OR b <= 2),
t AS (SELECT source_id, count(DISTINCT segment_id) AS total FROM x GROUP BY 1)
SELECT source_id, head, n AS pages FROM (SELECT source_id, head, count(*) AS n FROM e GROUP BY 1, 2) JOIN t USING (source_id) WHERE n >= greatest(3, 0.02 * total)""")
def page_heads(spark: SparkSession, root: str) -> DataFrame:
    """Lines that repeat at the edges of a source's segments."""
    s = table(spark, root, "segments").where("source_id is not null").select("source_id", "segment_id", "text")
    return cleaning.page_heads(s, "source_id", "segment_id", "text", 3, 0.02)


@query(rf"SELECT segment_id, line_no::INTEGER AS line_no, placeholder FROM (SELECT segment_id, line_no, unnest(regexp_extract_all(line, '(\{{[^{{}}\n]+\}})', 1)) AS placeholder FROM {lines('segments', 'segment_id')} WHERE contains(line, '{{'))")
def template_residue(spark: SparkSession, root: str) -> DataFrame:
    return markdown.template_residue(table(spark, root, "segments"), "segment_id")


@query(rf"""WITH x AS (SELECT doc_id, line_no, line, regexp_extract(line, '^(#{{1,6}})\s+\S', 1) AS h FROM {lines('documents', 'doc_id')}),
y AS (SELECT *, sum(CASE WHEN h <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM x)
SELECT doc_id, section::BIGINT AS section, max(CASE WHEN h <> '' THEN length(h) END)::INTEGER AS level, max(CASE WHEN h <> '' THEN trim(regexp_replace(line, '^#+\s+', '')) END) AS title,
 sum(CASE WHEN h <> '' THEN 0 ELSE 1 END)::BIGINT AS lines, sum(CASE WHEN h <> '' THEN 0 ELSE length(line) END)::BIGINT AS chars FROM y WHERE section > 0 GROUP BY doc_id, section""")
def md_sections(spark: SparkSession, root: str) -> DataFrame:
    """Headed sections of every document."""
    return _ints(markdown.sections(table(spark, root, "documents"), "doc_id"), "section", "lines", "chars")


_TURN = r"^\s*(?:\*\*)?([QA])[:：](?:\*\*)?\s*"
_TURNS = rf"""x AS (SELECT doc_id, line_no, line, regexp_extract(line, '{_TURN}', 1) AS mark FROM {lines('documents', 'doc_id')}),
y AS (SELECT *, sum(CASE WHEN mark <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS turn FROM x),
t AS (SELECT doc_id, turn, CASE WHEN max(mark) = 'Q' THEN 'user' ELSE 'assistant' END AS role, trim(string_agg(regexp_replace(line, '{_TURN}', ''), chr(10) ORDER BY line_no)) AS content FROM y WHERE turn > 0 GROUP BY 1, 2),
g AS (SELECT *, coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gr FROM t),
p AS (SELECT doc_id, turn, role, coalesce(last_value(CASE WHEN role = 'user' THEN content END IGNORE NULLS) OVER (PARTITION BY doc_id, gr ORDER BY turn ROWS UNBOUNDED PRECEDING), '') AS prompt, content AS response FROM g),
q AS (SELECT doc_id, turn::BIGINT AS turn, prompt, response FROM p WHERE role = 'assistant')"""


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    return _ints(markdown.pairs(markdown.dialogue_lines(table(spark, root, "documents"), "doc_id"), "doc_id"), "turn")


@query(f"WITH {_TURNS} SELECT * FROM q")
def dialogue_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Question and answer pairs of the documents written as dialogues."""
    return _pairs(spark, root)


@query(f"WITH {_TURNS} SELECT doc_id, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS transcript FROM t GROUP BY doc_id")
def transcript_concat(spark: SparkSession, root: str) -> DataFrame:
    t = markdown.dialogue_lines(table(spark, root, "documents"), "doc_id")
    g = t.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("ts"))
    return g.select("doc_id", F.array_join(F.transform("ts", lambda x: F.concat(x["role"], F.lit(": "), x["content"])), "\n").alias("transcript"))


def _sents(text: str) -> str:
    return rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({text}, '([。！？!?；;])', '\1' || chr(10), 'g'), '\n+'), lambda x: trim(x)), lambda x: length(x) > 1)"


_PLAIN = r"regexp_replace({}, '[\x{{C0}}-\x{{24F}}\x{{370}}-\x{{52F}}\x{{FF10}}-\x{{FF5A}}]', 'x', 'g')"
_FP = style.FIRST_PERSON.replace("'", "''")
_TURN_SQL = rf"""SELECT doc_id, turn, length(response)::BIGINT AS chars, len(regexp_extract_all({_PLAIN.format('response')}, '{_FP}'))::BIGINT AS first_person, len(regexp_extract_all(response, '{style.LECTURING}'))::BIGINT AS lecturing,
 (len(regexp_extract_all(response, '{style.LIST_LINE}')) >= 3 OR {' OR '.join(f"regexp_matches(response, '{x}')" for x in style.ORDINAL)}) AS ordinal,
 CASE WHEN len(s) >= 5 THEN round(sqrt(greatest(0.0, (len(s) * sq - su * su)::DOUBLE)) / su, 4) END AS sentence_cv,
 len(list_filter(regexp_split_to_array(response, '\n\s*\n'), lambda x: length(trim(x)) > 0))::BIGINT AS paragraphs,
 (length(prompt) > 0 AND length(prompt) < 30 AND length(response) > 1200) AS length_mismatch, coalesce(regexp_replace(s[-1], '[^\p{{L}}\p{{N}}]+', '', 'g'), '') AS closing
 FROM (SELECT *, list_sum(list_transform(s, lambda x: length(x)))::BIGINT AS su, list_sum(list_transform(s, lambda x: length(x) * length(x)))::BIGINT AS sq FROM (SELECT *, {_sents('response')} AS s FROM q))"""


def _turns(spark: SparkSession, root: str) -> DataFrame:
    return style.turn_figures(_pairs(spark, root), "doc_id")


@query(f"WITH {_TURNS} {_TURN_SQL}")
def dialogue_turn_metrics(spark: SparkSession, root: str) -> DataFrame:
    return _ints(_turns(spark, root), "turn", "chars", "first_person", "lecturing", "paragraphs")


@query(f"""WITH {_TURNS}, m AS ({_TURN_SQL}),
c AS (SELECT doc_id, count(*) AS repeated_closings FROM (SELECT doc_id, closing FROM m WHERE closing <> '' GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1),
g2 AS (SELECT doc_id, count(*) AS turns, round(count(*) FILTER (ordinal)::DOUBLE / count(*), 6) AS ordinal_rate, round(count(*) FILTER (lecturing > 0)::DOUBLE / count(*), 6) AS lecturing_rate, max(lecturing) AS ml, count(*) FILTER (sentence_cv < 0.3) AS low_cv, count(*) FILTER (length_mismatch) AS mismatches FROM m GROUP BY 1)
SELECT doc_id, turns, ordinal_rate, lecturing_rate, low_cv, mismatches, coalesce(repeated_closings, 0) AS repeated_closings, array_to_string(list_sort(list_filter([
 CASE WHEN ordinal_rate > 0.2 THEN 'ORDINAL_ENUMERATION' END, CASE WHEN coalesce(repeated_closings, 0) > 0 THEN 'CLOSING_REPETITION' END, CASE WHEN low_cv > 0 THEN 'UNIFORM_SENTENCE_LENGTH' END,
 CASE WHEN mismatches > 0 THEN 'LENGTH_MISMATCH' END, CASE WHEN lecturing_rate >= 0.25 OR ml >= 3 THEN 'SECOND_PERSON_LECTURING' END], lambda x: x IS NOT NULL)), '|') AS flags FROM g2 LEFT JOIN c USING (doc_id)""")
def dialogue_flags(spark: SparkSession, root: str) -> DataFrame:
    return style.drift_flags(_turns(spark, root), "doc_id")


_CONN = style.CONNECTIVE.replace("'", "''")
_STYLE = rf"""st AS (SELECT doc_id, text, source, n, CASE WHEN ok THEN round(su::DOUBLE / n, 4) END AS sentence_len_mean, CASE WHEN ok THEN round(sqrt(greatest(0.0, (n * sq - su * su)::DOUBLE)) / n / (su::DOUBLE / n), 4) END AS sentence_len_cv,
 CASE WHEN ok THEN round(len(list_filter(s, lambda x: regexp_matches(x, '[？?]$')))::DOUBLE / n, 4) END AS question_rate, CASE WHEN ok THEN round(len(list_filter(s, lambda x: regexp_matches(x, '[！!]$')))::DOUBLE / n, 4) END AS exclaim_rate,
 CASE WHEN ok THEN round(len(regexp_extract_all({_PLAIN.format('text')}, '{_FP}')) * (1000.0::DOUBLE / ch), 4) END AS first_person_per_k, CASE WHEN ok THEN round({count_chars('text', style.CLASSICAL)} * (1000.0::DOUBLE / ch), 4) END AS classical_per_k,
 CASE WHEN ok THEN round(len(regexp_extract_all({_PLAIN.format('text')}, '{_CONN}')) * (1000.0::DOUBLE / ch), 4) END AS connective_per_k, CASE WHEN ok THEN round({count_chars('text', '，,、')}::DOUBLE / n, 4) END AS commas_per_sentence
 FROM (SELECT *, n >= 3 AND ch >= 40 AS ok FROM (SELECT *, len(s) AS n, list_sum(list_transform(s, lambda x: length(x)))::BIGINT AS su, list_sum(list_transform(s, lambda x: length(x) * length(x)))::BIGINT AS sq FROM (SELECT doc_id, source, coalesce(text, '') AS text, {_sents("coalesce(text, '')")} AS s, {solid("coalesce(text, '')")} AS ch FROM documents))))"""
_FEATS = ", ".join(style.FEATURES)


@query(f"WITH {_STYLE} SELECT doc_id, n::BIGINT AS sentences_n, {_FEATS} FROM st")
def stylometry(spark: SparkSession, root: str) -> DataFrame:
    """Eight style figures of every document."""
    return _ints(style.features(table(spark, root, "documents").select("doc_id", "text")), "sentences_n").drop("text")


_AVGS = ", ".join(f"avg({f}) AS {f}" for f in style.FEATURES)
_DIST = " + ".join(f"CASE WHEN greatest(abs(a.{f}), abs(b.{f})) > 1e-9 THEN abs(a.{f} - b.{f}) / greatest(abs(a.{f}), abs(b.{f})) ELSE 0.0 END" for f in style.FEATURES)


@query(f"WITH {_STYLE}, a AS (SELECT source, {_AVGS} FROM st WHERE source IS NOT NULL AND sentence_len_mean IS NOT NULL GROUP BY 1), b AS (SELECT {_AVGS} FROM st WHERE sentence_len_mean IS NOT NULL) SELECT source, round(({_DIST}) / 8, 4) AS distance FROM a, b")
def style_distance(spark: SparkSession, root: str) -> DataFrame:
    """Distance of each source's mean style from that of the whole corpus."""
    x = style.features(table(spark, root, "documents").select("source", "text")).where("sentence_len_mean is not null")
    own = x.where("source is not null").groupBy("source").agg(*[F.avg(f).alias(f) for f in style.FEATURES])
    every = x.agg(*[F.avg(f).alias("b_" + f) for f in style.FEATURES])
    both = own.join(F.broadcast(every))  # one row
    return both.select("source", F.round(style.distance({f: F.col(f) for f in style.FEATURES}, {f: F.col("b_" + f) for f in style.FEATURES}), 4).alias("distance"))


_GRAMS = r"list_distinct(list_concat(CASE WHEN length(c) > 1 THEN list_transform(range(1, length(c)), lambda i: substr(c, i, 2)) ELSE [] END, regexp_extract_all(lower(t), '([a-z]{4,})', 1)))"


@query(rf"""WITH x AS (SELECT doc_id, text AS t, regexp_replace(text, '[^\x{{3400}}-\x{{9FFF}}]+', '', 'g') AS c FROM documents), y AS (SELECT doc_id, title AS t, regexp_replace(title, '[^\x{{3400}}-\x{{9FFF}}]+', '', 'g') AS c FROM documents)
SELECT doc_id, array_to_string(list_sort(list_intersect(a, b)), '|') AS terms FROM (SELECT doc_id, {_GRAMS} AS a FROM x) JOIN (SELECT doc_id, {_GRAMS} AS b FROM y WHERE t IS NOT NULL) USING (doc_id)""")
def anchor_terms(spark: SparkSession, root: str) -> DataFrame:
    """Terms that a document's title and text share."""
    d = table(spark, root, "documents").where("title is not null and text is not null")
    return d.select("doc_id", F.array_join(style.anchor_terms(F.col("text"), F.col("title")), "|").alias("terms"))


TOPICS = {"patience": ["patien", "小债"], "trust": ["trust", "信任"], "silence": ["silence", "沉默"], "error": ["error", "差错", "Fehler"], "custom": ["custom", "风俗"], "maps": ["map of", "地图", "Karte"], "debt": ["debt", "许诺"], "fear": ["fear", "恐惧"]}
_TAGS = "[" + ", ".join("CASE WHEN " + " OR ".join(f"contains(text, '{w}')" for w in ws) + f" THEN '{k}' END" for k, ws in TOPICS.items()) + "]"


@query(f"SELECT doc_id, array_to_string(tags[1:5], '|') AS tags, CASE WHEN length(text) < 100 AND regexp_matches(text, '[。！？.!?]') THEN 'quote' WHEN regexp_matches(text, 'must|should|必须|应当|muss') THEN 'principle' ELSE 'passage' END AS kind FROM (SELECT doc_id, text, list_filter({_TAGS}, lambda x: x IS NOT NULL) AS tags FROM documents WHERE length(text) >= 50) WHERE len(tags) > 0")
def topic_tags(spark: SparkSession, root: str) -> DataFrame:
    """Up to five keyword topics of each document of 50 characters or more, and its kind."""
    t = F.col("text")

    def hit(words):
        out = F.lit(False)
        for w in words:
            out = out | t.contains(w)
        return out

    d = table(spark, root, "documents").where(F.length("text") >= 50).withColumn("tags", F.array_compact(F.array(*[F.when(hit(ws), F.lit(k)) for k, ws in TOPICS.items()])))
    kind = rules.ladder(((F.length(t) < 100) & t.rlike("[。！？.!?]"), "quote"), (t.rlike("must|should|必须|应当|muss"), "principle"), default="passage")
    return d.where(F.size("tags") > 0).select("doc_id", F.array_join(F.slice("tags", 1, 5), "|").alias("tags"), kind.alias("kind"))


@query("SELECT doc_id, instr(text, 'granary')::INTEGER AS at, regexp_replace(substr(text, greatest(1, instr(text, 'granary') - 80), least(80, instr(text, 'granary') - 1) + 300), '\\[[0-9.]+\\]', '', 'g') AS passage FROM documents WHERE contains(text, 'granary')")
def keyword_context(spark: SparkSession, root: str) -> DataFrame:
    """The passage round the first ``granary``: 80 characters before, 300 from there on, without reference numbers."""
    at = F.instr("text", F.lit("granary"))
    d = table(spark, root, "documents").where(F.col("text").contains("granary"))
    cut = F.substring(F.col("text"), F.greatest(F.lit(1), at - 80), F.least(F.lit(80), at - 1) + 300)
    return d.select("doc_id", at.cast("int").alias("at"), F.regexp_replace(cut, r"\[[0-9.]+\]", "").alias("passage"))


_FACTS = {"has_heading": r"(?m)^#{1,6} ", "has_list": r"(?m)^[-*•] ", "has_dialogue": r"(?m)^(?:\*\*)?[QA][:：]", "has_numbered": r"(?m)^\d+[.)] ", "has_reference": r"\[\d+\.\d+\]", "has_quote": r"[“”«»「」„\"]", "has_url": r"(?i)\b[a-z0-9.-]+\.(?:invalid|example)\b", "has_year": r"\b1\d{3}\b"}


@query("SELECT doc_id, " + ", ".join(f"regexp_matches(text, '{rx}') AS {k}" for k, rx in _FACTS.items()) + " FROM documents WHERE text IS NOT NULL")
def regex_fact_panel(spark: SparkSession, root: str) -> DataFrame:
    """Facts of each document's form, one pattern each."""
    return table(spark, root, "documents").where("text is not null").select("doc_id", *[F.col("text").rlike(rx).alias(k) for k, rx in _FACTS.items()])


_BANNED = {"salt": ["salt market", "price of salt"], "canal": ["map of the canal", "运河的图样"], "mill": ["ledger of the mill", "磨坊的账簿"]}
_BANNED_SQL = " UNION ALL ".join(f"SELECT '{k}' AS class, '{t}' AS term, doc_id, ((length(text) - length(replace(text, '{t}', ''))) // length('{t}'))::BIGINT AS n FROM documents" for k, ts in _BANNED.items() for t in ts)


@query(f"WITH x AS (SELECT * FROM ({_BANNED_SQL}) WHERE n > 0) SELECT class, total, string_agg(doc_id::VARCHAR, ',' ORDER BY rk) AS top_docs FROM (SELECT class, doc_id, sum(d) OVER (PARTITION BY class)::BIGINT AS total, row_number() OVER (PARTITION BY class ORDER BY d DESC, doc_id) AS rk FROM (SELECT class, doc_id, sum(n) AS d FROM x GROUP BY 1, 2)) WHERE rk <= 3 AND total >= 3 GROUP BY 1, 2")
def banned_terms(spark: SparkSession, root: str) -> DataFrame:
    """Classes of terms with their number in the corpus (from three on) and the three documents with most of them."""
    counts = F.array(*[F.struct(F.lit(k).alias("class"), sum(((F.length("text") - F.length(F.replace(F.col("text"), F.lit(t), F.lit("")))) / len(t)).cast("bigint") for t in ts).alias("n")) for k, ts in _BANNED.items()])
    x = table(spark, root, "documents").select("doc_id", F.explode(counts).alias("x")).select("doc_id", "x.class", "x.n").where("n > 0")
    total = x.groupBy("class").agg(F.sum("n").alias("total")).where("total >= 3")
    top = x.withColumn("rk", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("n"), "doc_id"))).where("rk <= 3")
    g = top.groupBy("class").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rk", "doc_id"))), lambda s: s["doc_id"].cast("string")), ",").alias("top_docs"))
    return total.join(g, "class").select("class", "total", "top_docs")
