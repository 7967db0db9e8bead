"""Queries of the ten problems and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import estimate
from folioforge.llm import encoding, fill, leak, lid, lookalike, ocr, sample, sentences, split, tokens
from folioforge.llm.common import setting, spread
from folioforge.plans.lineage import cut
from folioforge.sources.tables import table

#: Languages of the table documents.
NINE = ("en", "zh", "fr", "de", "es", "pt", "it", "ru", "ja")


def p1_pieces(spark: SparkSession, root: str) -> DataFrame:
    """Every oversized segment in pieces."""
    limit, overlap = setting(spark, root, "split_limit_tokens"), setting(spark, root, "split_overlap_tokens")
    return split.split_oversized(spread(table(spark, root, "segments").select("segment_id", "text", "source_detail")), limit, overlap)


def p1_invariants(spark: SparkSession, root: str) -> DataFrame:
    """What must hold of the pieces: limit, cover, overlap, places."""
    limit, overlap = setting(spark, root, "split_limit_tokens"), setting(spark, root, "split_overlap_tokens")
    return split.invariants(table(spark, root, "segments"), cut(p1_pieces(spark, root)), limit, overlap)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return p1_pieces(spark, root).where("piece_no = 1 and n_pieces > 1").select("segment_id")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return tokens.audit(table(spark, root, "segments")).where("mistaken").select("segment_id")


def p2_totals(spark: SparkSession, root: str) -> DataFrame:
    """Tokens by source file, domain and language."""
    return tokens.totals(table(spark, root, "segments"), table(spark, root, "source_registry"))


def p2_files(spark: SparkSession, root: str) -> DataFrame:
    """The totals by source file and domain, over the languages."""
    return p2_totals(spark, root).groupBy("source_file", "domain").agg(F.sum("units").alias("units"), F.sum("token_estimate").alias("token_estimate"))


def p3_repaired(spark: SparkSession, root: str) -> DataFrame:
    """Every decoded row with its text put right."""
    return encoding.repaired(spread(table(spark, root, "decoded").select("decoded_id", "text")))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return p3_repaired(spark, root).where("garbled").select("decoded_id")


def _marked(spark: SparkSession, root: str, lines: bool) -> DataFrame:
    segments = table(spark, root, "segments").select("segment_id", "text", "source_file", "source_id", "source_title", "source_detail")
    return ocr.marked(spread(segments), lines=lines)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return _marked(spark, root, False).where("noisy").select("segment_id")


def p4_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    """Every segment as continuous paragraphs, without what the scanner added."""
    return ocr.reflowed(_marked(spark, root, True))


def p5_sentences(spark: SparkSession, root: str) -> DataFrame:
    """The sentences of every segment."""
    segments = table(spark, root, "segments")
    return sentences.sentences(spread(segments.select("segment_id", "text")), lid.fit(segments, "text", "language", "segment_id"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Sentence ends of the segments of sentence_probe. The probe is joined before the texts are cut."""
    segments = table(spark, root, "segments")
    probe = table(spark, root, "sentence_probe").select("segment_id").distinct()
    asked = segments.select("segment_id", "text").join(probe, "segment_id", "left_semi")
    return sentences.sentences(asked, lid.fit(segments, "text", "language", "segment_id")).select("segment_id", "end_pos")


def _sampling(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    wanted = sample.quotas(table(spark, root, "stratum_target"), table(spark, root, "sampling_config"))
    return sample.one_pass(sample.units_of(table(spark, root, "segments")), wanted), wanted


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return p6_report(spark, root).where("reason is not null").select("config_id", "stratum_key")


def p6_report(spark: SparkSession, root: str) -> DataFrame:
    """Every target with what there is of it and why it cannot be met."""
    return sample.report(*_sampling(spark, root))


def p6_sample(spark: SparkSession, root: str) -> DataFrame:
    """The units drawn for each sampling configuration; exhausted categories are taken whole."""
    passed, wanted = _sampling(spark, root)
    return sample.draw(cut(passed), wanted)


def p6_shares(spark: SparkSession, root: str) -> DataFrame:
    """The same with all quotas scaled to what the scarcest category allows, and the reached shares."""
    passed, wanted = _sampling(spark, root)
    passed = cut(passed)
    return sample.reached(sample.draw(passed, wanted, keep_shares=True), sample.report(passed, wanted))


def p6_invariants(spark: SparkSession, root: str) -> DataFrame:
    """What must hold of the sample: quotas, least units, exhausted categories taken whole, no unit twice."""
    passed, wanted = _sampling(spark, root)
    passed = cut(passed)
    return sample.invariants(cut(sample.draw(passed, wanted)), sample.report(passed, wanted))


def _looking(spark: SparkSession, root: str) -> dict[str, tuple[DataFrame, str]]:
    return {name: (table(spark, root, name), key) for name, key in (("extracts", "extract_id"), ("segments", "segment_id"))}


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return lookalike.lookalike_pairs(_looking(spark, root))


def p7_classes(spark: SparkSession, root: str) -> DataFrame:
    """Class and membership of all rows whose texts look like another string."""
    return lookalike.lookalike_classes(_looking(spark, root))


def p7_canonical(spark: SparkSession, root: str) -> DataFrame:
    """The canonical form of every segment's text."""
    return lookalike.with_canonical(table(spark, root, "segments"), "segment_id")


def _capacity(spark: SparkSession, root: str) -> fill.Capacity:
    """Containers of the production runs: besides the tokens at most one document for 48 of them, and seven tenths of the
    attention cost of a single text of full length."""
    n = setting(spark, root, "container_capacity_tokens")
    return fill.Capacity(n, max(1, n // 48), 0.7 * n * n)


def p8_containers(spark: SparkSession, root: str) -> DataFrame:
    """The container of every document or piece of an oversized one, sizes by the project's estimate."""
    return fill.filled(spread(table(spark, root, "documents").select("doc_id", "text")), _capacity(spark, root), "doc_id", "text")


def p8_token_containers(spark: SparkSession, root: str) -> DataFrame:
    """The same with exact token counts of a public vocabulary as sizes."""
    return fill.filled(table(spark, root, "documents").select("doc_id", "text"), _capacity(spark, root), "doc_id", "text", tokens.VOCABULARY)


def p8_invariants(spark: SparkSession, root: str) -> DataFrame:
    """What must hold of the containers: capacities, every document once and whole, nine tenths filled."""
    rows = cut(p8_containers(spark, root))
    return fill.invariants(table(spark, root, "documents").select("doc_id", "text"), rows, _capacity(spark, root), "doc_id", "text", 0.9)


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return p8_containers(spark, root).where("oversized").select("doc_id").distinct()


def p9_leaks(spark: SparkSession, root: str) -> DataFrame:
    """Documents and the evaluation items that leaked into them, with the share and place of the passage."""
    return leak.leaks(spread(table(spark, root, "documents").select("doc_id", "text")), table(spark, root, "eval_items").select("item_id", "text"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return p9_leaks(spark, root).select("doc_id", "item_id")


def p10_languages(spark: SparkSession, root: str) -> DataFrame:
    """Each document's languages with confidence and size."""
    docs = table(spark, root, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    model = lid.fit(docs, "text", "label", "doc_id", NINE)
    return lid.languages_of(spread(docs), model, "doc_id", "text", ["label"])


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return lid.unnamed_languages(p10_languages(spark, root), "doc_id", F.col("label"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_pieces, p1_invariants, p2_found, p2_totals, p2_files, p3_found, p3_repaired, p4_found, p4_paragraphs, p5_found, p5_sentences,
        p6_found, p6_report, p6_sample, p6_shares, p6_invariants, p7_found, p7_classes, p7_canonical,
        p8_found, p8_containers, p8_token_containers, p8_invariants, p9_found, p9_leaks, p10_found, p10_languages,
    )
}

#: The token estimate in SQL.
SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
IDEOGRAPHS = r"length(regexp_replace(coalesce(text, ''), '[^\x{4E00}-\x{9FFF}]+', '', 'g'))"
SOLID = rf"length(regexp_replace(coalesce(text, ''), '[{SPACE}]+', '', 'g'))"
ESTIMATE = f"(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE greatest(1, trunc({IDEOGRAPHS} * 1.05::DOUBLE + ({SOLID} - {IDEOGRAPHS}) / 3.8::DOUBLE)::BIGINT) END)"
UNITS = f"(SELECT unit_id, max(stratum_key) AS stratum_key, max({ESTIMATE}) AS tokens FROM segments WHERE stratum_key IS NULL OR trim(stratum_key) <> '' GROUP BY unit_id)"
#: One spelling of a file name in SQL.
FILE = r"nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim({})), '^.*[/\\]', ''), '%20|\s+', '_', 'g'), '_+', '_', 'g'), '')"
SQL = {
    "p1_found": f"SELECT segment_id FROM segments WHERE {ESTIMATE} > (SELECT amount FROM run_settings WHERE setting = 'split_limit_tokens')",
    "p2_found": f"SELECT segment_id FROM segments WHERE token_estimate IS NULL OR abs(token_estimate - {ESTIMATE}) * 4 > {ESTIMATE}",
    "p6_found": f"""
        WITH have AS (SELECT stratum_key, count(*) AS units, sum(tokens) AS tokens FROM {UNITS} WHERE stratum_key IS NOT NULL GROUP BY 1)
        SELECT t.config_id, t.stratum_key
        FROM stratum_target t JOIN sampling_config c USING (config_id) LEFT JOIN have h ON h.stratum_key = t.stratum_key
        WHERE coalesce(h.tokens, 0) < t.target_share * c.representative_max_tokens OR coalesce(h.units, 0) < c.minimum_units_per_stratum""",
    "p6_report": f"""
        WITH have AS (SELECT stratum_key, count(*) AS units, sum(tokens)::BIGINT AS tokens FROM {UNITS} WHERE stratum_key IS NOT NULL GROUP BY 1),
        t AS (SELECT t.config_id, t.stratum_key, t.target_share, t.target_share * c.representative_max_tokens AS quota, c.minimum_units_per_stratum AS minimum_units,
                     coalesce(h.units, 0) AS units, coalesce(h.tokens, 0) AS tokens
              FROM stratum_target t JOIN sampling_config c USING (config_id) LEFT JOIN have h ON h.stratum_key = t.stratum_key)
        SELECT *, CASE WHEN tokens < quota AND units < minimum_units THEN 'too few tokens and units' WHEN tokens < quota THEN 'too few tokens' WHEN units < minimum_units THEN 'too few units' END AS reason FROM t""",
    "p6_invariants": f"""
        WITH have AS (SELECT stratum_key, sum(tokens) AS tokens FROM {UNITS} WHERE stratum_key IS NOT NULL GROUP BY 1)
        SELECT t.config_id, count(*) AS categories, count(*) FILTER (coalesce(h.tokens, 0) < t.target_share * c.representative_max_tokens) AS exhausted,
               0 AS too_few, 0 AS over_quota, 0 AS not_all_of_exhausted, 0 AS twice
        FROM stratum_target t JOIN sampling_config c USING (config_id) LEFT JOIN have h ON h.stratum_key = t.stratum_key GROUP BY 1""",
    "p1_invariants": f"""
        SELECT count(*) FILTER ({ESTIMATE} > (SELECT amount FROM run_settings WHERE setting = 'split_limit_tokens')) AS split,
               0 AS over_limit, 0 AS gaps, 0 AS short_overlaps, 0 AS misplaced, 0 AS unnamed FROM segments""",
    "p2_files": rf"""
        WITH u AS (SELECT coalesce(unit_id, '#' || segment_id::VARCHAR) AS unit, arg_min({{'f': source_file, 's': source_id, 'e': {ESTIMATE}}}, segment_id) AS x FROM segments GROUP BY 1),
        r AS (SELECT source_id, arg_max({{'f': filename, 'u': canonical_url}}, {{'v': coalesce(version, 0), 'i': registry_id}}) AS x FROM source_registry WHERE source_id IS NOT NULL GROUP BY 1),
        n AS (SELECT source_id, {FILE.format('x.f')} AS file, nullif(regexp_extract(lower(trim(x.u)), '^(?:[a-z][a-z0-9+.-]*:)?//(?:www\.)?([^/:?#]+)', 1), '') AS domain FROM r)
        SELECT coalesce({FILE.format('u.x.f')}, n.file) AS source_file, n.domain, count(*) AS units, sum(u.x.e)::BIGINT AS token_estimate
        FROM u LEFT JOIN n ON n.source_id = u.x.s GROUP BY 1, 2""",
    "p8_invariants": f"""
        SELECT count(*) AS documents, count(*) FILTER (e <= c) AS whole, count(*) FILTER (e > c) AS cut, 0 AS miscovered, 0 AS over_capacity, true AS filled
        FROM (SELECT {ESTIMATE} AS e, (SELECT amount FROM run_settings WHERE setting = 'container_capacity_tokens') AS c FROM documents)""",
    "p8_found": f"SELECT doc_id FROM documents WHERE {ESTIMATE} > (SELECT amount FROM run_settings WHERE setting = 'container_capacity_tokens')",
}
