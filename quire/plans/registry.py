"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import align, audit, export, payload, runlog, split
from quire.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL where SQL can say it."""

    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPLITS = """d AS (SELECT doc_id, sha256(text) AS sha, count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents),
    b AS (SELECT doc_id, CASE WHEN copies > 1 THEN 'dup:' || substr(sha, 1, 12) ELSE 'doc:' || sha END AS split_group_id FROM d),
    c AS (SELECT *, (('0x' || substr(sha256('2026-06-06:v1:' || split_group_id), 1, 8))::UBIGINT % 100)::BIGINT AS bucket FROM b),
    s AS (SELECT doc_id, split_group_id, bucket, CASE WHEN bucket < 80 THEN 'train' WHEN bucket < 90 THEN 'val' ELSE 'test' END AS split FROM c)"""


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign(split.group_by_text(read(spark, sf_dir, "documents"), "doc_id", "text"))


@query("split_assign", f"WITH {SPLITS} SELECT * FROM s")
def split_assign(spark, sf_dir):
    return splits(spark, sf_dir)


@query("split_counts", f"WITH {SPLITS} SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(DISTINCT split_group_id) AS groups FROM s")
def split_counts(spark, sf_dir):
    one = {n: F.count_if(F.col("split") == n).alias(n) for n in ("train", "val", "test")}
    return splits(spark, sf_dir).agg(*one.values(), F.countDistinct("split_group_id").alias("groups"))


@query("leakage", f"WITH {SPLITS} SELECT count(*) AS leaking_groups FROM (SELECT split_group_id FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1)")
def leakage(spark, sf_dir):
    return audit.leaking(splits(spark, sf_dir), "split_group_id", "split").agg(F.count("*").alias("leaking_groups"))


@query("dup_groups", "SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_member FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_groups(spark, sf_dir):
    return files.duplicate_groups(read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256")), "sha256", "doc_id")


SPACE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
COUNTS = f"""q AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'EN' ELSE 'OTHER' END AS language,
      length(trim(coalesce(text, ''), {SPACE}))::BIGINT AS chars,
      length(regexp_replace(coalesce(text, ''), '[^\\x{{0900}}-\\x{{097F}}]', '', 'g'))::BIGINT AS devanagari, length(regexp_replace(coalesce(text, ''), '[^A-Za-z\\x{{0130}}\\x{{212A}}]', '', 'g'))::BIGINT AS latin,
      length(regexp_replace(coalesce(text, ''), '\\P{{Nd}}', '', 'g'))::BIGINT AS digits, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(65533), '')))::BIGINT AS replacement, lower(coalesce(text, '')) AS l FROM documents)"""


@query("script_counts", f"WITH {COUNTS} SELECT doc_id, chars, devanagari, latin, digits, replacement FROM q")
def script_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", *(c.alias(n) for n, c in T.script_counts(F.col("text")).items()))


@query(
    "text_quality",
    f"""WITH {COUNTS} SELECT doc_id, (contains(l, 'supreme court')::INT + contains(l, 'judgment')::INT + contains(l, 'appeal')::INT + contains(l, 'petitioner')::INT + contains(l, 'respondent')::INT)::BIGINT AS legal_marker_count,
      replacement / greatest(1, chars) AS replacement_ratio, CASE language WHEN 'EN' THEN latin >= greatest(30, 2 * devanagari) ELSE chars > 0 END AS script_ok,
      chars >= 20 AND replacement / greatest(1, chars) < 0.02 AND CASE language WHEN 'EN' THEN latin >= greatest(30, 2 * devanagari) ELSE chars > 0 END AS quality_ok FROM q""",
)
def text_quality(spark, sf_dir):
    d = T.gated(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), F.when(F.col("lang") == "en", "EN").otherwise("OTHER"))
    return d.select("doc_id", "legal_marker_count", "replacement_ratio", "script_ok", "quality_ok")


#: Pairs of the alignment queries: a conversation's user turns are the Hindi document, the others the English one; every seventh Hindi document has a
#: page without text, every fifth lacks the render of its first page.
FLOW = f"""t AS (SELECT conv_id, CASE role WHEN 'user' THEN 'HIN' ELSE 'EN' END AS side, row_number() OVER (PARTITION BY conv_id, role = 'user' ORDER BY turn) AS page, text,
      length(trim(text, {SPACE})) AS chars, length(regexp_replace(text, '[^A-Za-z\\x{{0130}}\\x{{212A}}]', '', 'g')) AS latin FROM conversations),
    v AS (SELECT conv_id, side, page, text, chars, chars >= 20 AND latin >= 30 AS ok, CASE WHEN chars >= 20 THEN chars ELSE 0 END::DOUBLE AS w, sum(CASE WHEN chars >= 20 THEN chars ELSE 0 END::DOUBLE) OVER (PARTITION BY conv_id, side ORDER BY page) AS u,
      sum(CASE WHEN chars >= 20 THEN chars ELSE 0 END::DOUBLE) OVER (PARTITION BY conv_id, side) AS total, count(*) OVER (PARTITION BY conv_id, side) AS n FROM t),
    i AS (SELECT conv_id, side, page, ok, CASE WHEN total <= 0 THEN (page - 1) / n ELSE (u - w) / total END AS a, CASE WHEN total <= 0 THEN page / n ELSE u / total END AS b FROM v),
    o AS (SELECT s.conv_id, s.side, s.page AS source_page, t.page AS target_page, t.ok AS target_ok, round((least(s.b, t.b) - greatest(s.a, t.a)) / greatest(s.b - s.a, 1e-6), 6) AS source_ratio,
      round((least(s.b, t.b) - greatest(s.a, t.a)) / greatest(t.b - t.a, 1e-6), 6) AS target_ratio FROM i s JOIN i t ON s.conv_id = t.conv_id AND s.side <> t.side AND least(s.b, t.b) > greatest(s.a, t.a)),
    best AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side, source_page ORDER BY source_ratio DESC, target_page) AS k, max(source_ratio) OVER (PARTITION BY conv_id, side, source_page) AS top FROM o),
    m AS (SELECT conv_id, side, source_page, list_sort(list(target_page)) AS targets, bool_and(target_ok) AS targets_ok, max(top) AS top_ratio FROM best WHERE source_ratio >= 0.15 OR (k = 1 AND top < 0.15) GROUP BY ALL),
    pc AS (SELECT conv_id, count(*) FILTER (side = 'HIN') + CASE WHEN conv_id % 7 = 0 AND count(*) FILTER (side = 'HIN') > 0 THEN 1 ELSE 0 END AS hn, count(*) FILTER (side = 'EN') AS en FROM t GROUP BY 1),
    g AS (SELECT conv_id, 'HIN' AS side, hn AS source_pages, en AS target_pages FROM pc WHERE hn > 0 AND en > 0 UNION ALL SELECT conv_id, 'EN', en, hn FROM pc WHERE hn > 0 AND en > 0),
    p AS (SELECT conv_id, side, source_pages, target_pages, unnest(range(1, source_pages + 1)) AS source_page FROM g),
    j AS (SELECT p.*, v.chars, coalesce(v.ok, false) AS ok, coalesce(m.targets, []) AS targets, coalesce(m.targets_ok, false) AS targets_ok, m.top_ratio FROM p LEFT JOIN v ON v.conv_id = p.conv_id AND v.side = p.side AND v.page = p.source_page LEFT JOIN m ON m.conv_id = p.conv_id AND m.side = p.side AND m.source_page = p.source_page),
    r AS (SELECT *, 'sc_pair:' || conv_id AS pair_id, CASE WHEN len(targets) = 0 THEN 'unmatched_or_empty' WHEN len(targets) > 1 THEN 'source_page_spans_multiple_target_pages' WHEN source_pages = target_pages AND targets[1] = source_page AND ok AND targets_ok THEN 'same_page_likely'
      WHEN source_pages = target_pages AND targets[1] = source_page THEN 'same_page_low_text_quality' WHEN source_pages = target_pages THEN 'same_count_shift_or_bleed' ELSE 'page_count_mismatch_single_target_page' END AS content_relation FROM j),
    z AS (SELECT *, list_filter([CASE WHEN coalesce(chars, 0) < 20 THEN 'source_page_text_too_short' END, CASE WHEN NOT ok THEN 'source_text_quality_failed' END, CASE WHEN len(targets) = 0 THEN 'no_target_page_overlap' END, CASE WHEN len(targets) > 0 AND NOT targets_ok THEN 'target_text_quality_failed' END,
      CASE WHEN source_pages <> target_pages THEN 'page_count_mismatch' END, CASE WHEN content_relation = 'same_count_shift_or_bleed' THEN 'same_page_index_not_best_flow_match' END], lambda x: x IS NOT NULL) AS reasons,
      CASE content_relation WHEN 'unmatched_or_empty' THEN 0.0 WHEN 'source_page_spans_multiple_target_pages' THEN 0.55 WHEN 'same_page_likely' THEN 0.93 WHEN 'same_page_low_text_quality' THEN 0.68 WHEN 'same_count_shift_or_bleed' THEN 0.45 ELSE 0.62 END::DOUBLE AS confidence FROM r),
    al AS (SELECT z.conv_id, pair_id || ':p' || lpad(source_page::VARCHAR, 4, '0') AS alignment_id, source_page, NOT (z.conv_id % 5 = 0 AND source_page = 1) AND EXISTS (SELECT 1 FROM t h WHERE h.conv_id = z.conv_id AND h.side = 'HIN' AND h.page = z.source_page) AS has_page,
      CASE WHEN len(targets) = 1 THEN targets[1] END AS english_page, content_relation, confidence, reasons FROM z WHERE side = 'HIN'),
    av AS (SELECT al.*, content_relation = 'same_page_likely' AND has_page AND english_page IS NOT DISTINCT FROM source_page AS verified, list_sort(list_distinct(list_concat(reasons, list_filter([CASE WHEN NOT has_page THEN 'missing_hindi_rendered_page' END,
      CASE WHEN english_page IS NULL THEN 'missing_single_english_text_target' END], lambda x: x IS NOT NULL)))) AS why FROM al)"""


def sides(spark, sf_dir) -> DataFrame:
    """Texts of both documents of each pair, with their quality."""
    side = F.when(F.col("role") == "user", "HIN").otherwise("EN")
    d = read(spark, sf_dir, "conversations").select("conv_id", F.concat(F.lit("sc_pair:"), F.col("conv_id").cast("string")).alias("pair_id"), side.alias("side"), "turn", "text")
    d = d.withColumn("page", F.row_number().over(W.partitionBy("conv_id", "side").orderBy("turn"))).withColumn("document_id", F.concat_ws(":", F.col("conv_id").cast("string"), "side"))
    return T.gated(d, F.lit("EN")).withColumn("text_sha256", T.hash_of(F.col("text")))


def pairs(spark, sf_dir, texts: DataFrame | None = None) -> DataFrame:
    d = (texts or sides(spark, sf_dir)).groupBy(F.col("conv_id").alias("pair_key"), F.col("side").alias("language_variant"), "document_id").agg(F.count("*").alias("n"))
    extra = F.when((F.col("pair_key") % 7 == 0) & (F.col("language_variant") == "HIN"), 1).otherwise(0)
    return align.pair_up(d.withColumns({"page_count": F.col("n") + extra, "source_path": F.col("document_id"), "seq": F.lit(1)}))


def relations(spark, sf_dir) -> DataFrame:
    return align.verification(pairs(spark, sf_dir), sides(spark, sf_dir))


def rendered(spark, sf_dir, texts: DataFrame | None = None) -> DataFrame:
    d = (texts or sides(spark, sf_dir)).where("side = 'HIN' AND NOT (conv_id % 5 = 0 AND page = 1)")
    return d.select("document_id", F.col("page").alias("page_index"), F.concat("document_id", F.lit(":p"), F.col("page").cast("string")).alias("page_id"), F.lit("r.jpg").alias("render_path"), F.lit(1).alias("page_count"), F.lit("train").alias("split"), F.col("pair_id").alias("split_group_id"), F.array(F.lit("devanagari")).alias("quality_flags"), F.lit("sc").alias("corpus"))


def alignment_of(verified: DataFrame, paired: DataFrame, pages: DataFrame, texts: DataFrame) -> DataFrame:
    return align.aligned(verified, paired, pages, texts.where("side = 'EN'").select("document_id", F.col("page").alias("page_index"), "text_sha256", "text"))


def alignment(spark, sf_dir) -> DataFrame:
    return alignment_of(relations(spark, sf_dir), pairs(spark, sf_dir), rendered(spark, sf_dir), sides(spark, sf_dir))


def long(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def listed(c) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query("page_intervals", f'WITH {FLOW} SELECT conv_id, side, page, round(a, 6) AS "start", round(b, 6) AS stop FROM i')
def page_intervals(spark, sf_dir):
    d = sides(spark, sf_dir).withColumn("weight", align.page_weight(F.col("chars"), F.col("non_empty")))
    return align.intervals(d).select("conv_id", "side", *long("page"), F.round("start", 6).alias("start"), F.round("stop", 6).alias("stop"))


@query("interval_overlap", f"WITH {FLOW} SELECT 'sc_pair:' || conv_id AS pair_id, side, source_page, target_page, source_ratio, target_ratio FROM o")
def interval_overlap(spark, sf_dir):
    d = sides(spark, sf_dir).withColumn("weight", align.page_weight(F.col("chars"), F.col("non_empty")))
    return align.overlaps(align.intervals(d)).select("pair_id", "side", *long("source_page", "target_page"), "source_ratio", "target_ratio")


@query("relation_classify", f"""WITH {FLOW} SELECT pair_id || ':' || lower(side) || '_p' || lpad(source_page::VARCHAR, 4, '0') || '_to_' || CASE side WHEN 'HIN' THEN 'en' ELSE 'hin' END AS verification_id, source_pages AS source_page_count, target_pages AS target_page_count,
      array_to_string(targets, ',') AS targets, top_ratio, content_relation, confidence, array_to_string(reasons, ',') AS failure_reasons FROM z""")
def relation_classify(spark, sf_dir):
    return relations(spark, sf_dir).select("verification_id", *long("source_page_count", "target_page_count"), listed("targets").alias("targets"), "top_ratio", "content_relation", "confidence", listed("failure_reasons").alias("failure_reasons"))


BLED = "content_relation IN ('source_page_spans_multiple_target_pages', 'same_count_shift_or_bleed', 'page_count_mismatch_single_target_page')"


@query("verification_summary", f"WITH {FLOW} SELECT lower(side) || '-to-' || CASE side WHEN 'HIN' THEN 'en' ELSE 'hin' END AS direction, count(*) AS row_count, count(*) FILTER (content_relation = 'same_page_likely') AS same_information_likely_rows, count(*) FILTER (content_relation <> 'same_page_likely') AS needs_manual_review_rows, count(*) FILTER ({BLED}) AS bleed_likely_rows FROM r GROUP BY ALL")
def verification_summary(spark, sf_dir):
    return align.counted(relations(spark, sf_dir), "direction").drop("relation_counts")


@query("pair_summary", f"WITH {FLOW} SELECT pair_id, coalesce(max(source_pages) FILTER (side = 'HIN'), 0) AS hindi_page_count, coalesce(max(source_pages) FILTER (side = 'EN'), 0) AS english_page_count, count(*) AS row_count, bool_or({BLED}) AS pair_has_bleed_likely, bool_or(content_relation <> 'same_page_likely') AS pair_needs_manual_review, bool_or(content_relation = 'same_page_likely') AS pair_has_same_information_likely_pages, count(*) FILTER (side = 'HIN') AS row_count_hin, count(*) FILTER (side = 'EN' AND {BLED}) AS bleed_likely_rows_en FROM r GROUP BY 1")
def pair_summary(spark, sf_dir):
    d = align.pair_summaries(relations(spark, sf_dir))
    return d.select("pair_id", *long("hindi_page_count", "english_page_count"), "row_count", "pair_has_bleed_likely", "pair_needs_manual_review", "pair_has_same_information_likely_pages", "row_count_hin", "bleed_likely_rows_en")


@query("review_rows", f"WITH {FLOW} SELECT pair_id, lower(side) || '-to-' || CASE side WHEN 'HIN' THEN 'en' ELSE 'hin' END AS direction, source_page, content_relation FROM r WHERE content_relation <> 'same_page_likely'")
def review_rows(spark, sf_dir):
    return align.review_rows(relations(spark, sf_dir)).select("pair_id", "direction", *long("source_page"), "content_relation")


@query("reason_histogram", f"WITH {FLOW} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM z) GROUP BY 1")
def reason_histogram(spark, sf_dir):
    return align.histogram(relations(spark, sf_dir), "failure_reasons", "reason")


@query("pair_rows", f"WITH {FLOW} SELECT 'sc_pair:' || conv_id AS pair_id, hn > 0 AND en > 0 AS paired, CASE WHEN hn = 0 THEN 'missing_hindi_pdf' WHEN en = 0 THEN 'missing_english_pdf' WHEN hn <> en THEN 'page_count_mismatch_possible_offset_or_bleed' ELSE '' END AS failure_reasons FROM pc")
def pair_rows(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", "paired", listed("failure_reasons").alias("failure_reasons"))


@query("page_alignment", f"WITH {FLOW} SELECT alignment_id, english_page AS english_page_index, verified AS alignment_verified, CASE WHEN verified THEN confidence ELSE 0.0 END AS alignment_confidence, CASE WHEN verified THEN 'same_page_content_flow_verified_v1' ELSE 'cumulative_text_flow_overlap_v1' END AS alignment_method, CASE WHEN verified THEN '' ELSE array_to_string(why, ',') END AS failure_reasons FROM av")
def page_alignment(spark, sf_dir):
    return alignment(spark, sf_dir).select("alignment_id", *long("english_page_index"), "alignment_verified", "alignment_confidence", "alignment_method", listed("failure_reasons").alias("failure_reasons"))


@query("alignment_failures", f"WITH {FLOW}, f AS (SELECT 'pairing' AS failure_stage FROM pc WHERE hn <> en UNION ALL SELECT 'page_content_alignment' FROM av WHERE NOT verified) SELECT failure_stage, count(*) AS n FROM f GROUP BY 1")
def alignment_failures(spark, sf_dir):
    return align.failures(pairs(spark, sf_dir), alignment(spark, sf_dir)).groupBy("failure_stage").agg(F.count("*").alias("n"))


@query("gold_translations", f"WITH {FLOW} SELECT 'ft:ocr_translate_en_json:gold:sc_hi_en:' || alignment_id AS example_id, trim(e.text, {SPACE}) AS text FROM av JOIN t e ON e.conv_id = av.conv_id AND e.side = 'EN' AND e.page = av.english_page WHERE verified AND trim(e.text, {SPACE}) <> ''")
def gold_translations(spark, sf_dir):
    rows = export.translation_examples(export.gold_translations(alignment(spark, sf_dir), rendered(spark, sf_dir)))
    return rows.select("example_id", F.get_json_object("target", "$.text").alias("text"))


NAMES = """n AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'S_' ELSE '' END || (1990 + doc_id % 30) || '_' || doc_id % 9 || '_' || doc_id || '_' || (doc_id + 40) || CASE WHEN doc_id % 11 = 0 THEN '_XX' WHEN doc_id % 2 = 0 THEN '_EN' ELSE '_HIN' END || CASE WHEN doc_id % 3 = 0 THEN '(' || doc_id % 4 || ')' WHEN doc_id % 13 = 0 THEN ' (1)' ELSE '' END AS s,
    CASE doc_id % 6 WHEN 0 THEN 'West_' WHEN 1 THEN 'Rail' WHEN 2 THEN 'Cyber_' WHEN 3 THEN 'mahila__' ELSE '' END || lang || '_' || CASE WHEN doc_id % 2 = 0 THEN 'PS_' ELSE '' END || doc_id % 977 || CASE WHEN doc_id % 7 = 0 THEN '-' ELSE '_' END || CASE doc_id % 4 WHEN 0 THEN '2021' WHEN 1 THEN '19' WHEN 2 THEN '7' ELSE '021' END AS f FROM documents)"""


def names(spark, sf_dir) -> DataFrame:
    s = "concat(if(doc_id % 5 = 0, 'S_', ''), 1990 + doc_id % 30, '_', doc_id % 9, '_', doc_id, '_', doc_id + 40, CASE WHEN doc_id % 11 = 0 THEN '_XX' WHEN doc_id % 2 = 0 THEN '_EN' ELSE '_HIN' END, CASE WHEN doc_id % 3 = 0 THEN concat('(', doc_id % 4, ')') WHEN doc_id % 13 = 0 THEN ' (1)' ELSE '' END, '.pdf')"
    f = "concat(CASE doc_id % 6 WHEN 0 THEN 'West_' WHEN 1 THEN 'Rail' WHEN 2 THEN 'Cyber_' WHEN 3 THEN 'mahila__' ELSE '' END, lang, '_', if(doc_id % 2 = 0, 'PS_', ''), doc_id % 977, if(doc_id % 7 = 0, '-', '_'), CASE doc_id % 4 WHEN 0 THEN '2021' WHEN 1 THEN '19' WHEN 2 THEN '7' ELSE '021' END, '.pdf')"
    return read(spark, sf_dir, "documents").select("doc_id", F.expr(s).alias("s"), F.expr(f).alias("f"))


@query("citation_parse", rf"""WITH {NAMES}, c AS (SELECT doc_id, regexp_replace(s, '\(\d+\)$', '') AS stem, coalesce(nullif(regexp_extract(s, '\((\d+)\)$', 1), '')::INT, 0) AS copy_index FROM n)
    SELECT doc_id, stem AS canonical_stem, copy_index, CASE WHEN regexp_matches(stem, '^(S_)?\d{{4}}_\d+_\d+_\d+_(EN|HIN)$') THEN regexp_replace(stem, '_(EN|HIN)$', '') END AS citation_key, nullif(regexp_extract(stem, '^(S_)?\d{{4}}_\d+_\d+_(\d+)_(EN|HIN)$', 2), '')::INT AS report_end_page, nullif(regexp_extract(stem, '^(S_)?\d{{4}}_\d+_\d+_\d+_(EN|HIN)$', 2), '') AS language_variant FROM c""")
def citation_parse(spark, sf_dir):
    return names(spark, sf_dir).select("doc_id", *(c.alias(n) for n, c in T.citation(F.col("s")).items() if n in ("canonical_stem", "copy_index", "citation_key", "report_end_page", "language_variant")))


@query("report_parse", r"""WITH """ + NAMES + r""", y AS (SELECT *, nullif(regexp_extract(f, '^.+?[_-](\d{1,4})[-_](\d{2,4})$', 1), '') AS no, nullif(regexp_extract(f, '^.+?[_-](\d{1,4})[-_](\d{2,4})$', 2), '') AS yr FROM n)
    SELECT doc_id, CASE WHEN f LIKE 'West\_%' ESCAPE '\' THEN 'West_' || split_part(f, '_', 2) ELSE split_part(f, '_', 1) END AS district_or_unit_raw, no AS fir_number_raw, (yr::INT + CASE WHEN length(yr) = 4 THEN 0 ELSE 2000 END)::INT AS year_normalized,
    CASE WHEN lower(f) LIKE '%cyber%' THEN 'cyber' WHEN lower(f) LIKE '%mahila%' THEN 'mahila' WHEN lower(f) LIKE 'rail%' THEN 'rail' ELSE 'general' END AS filename_subtype_hint,
    concat_ws(',', CASE WHEN f NOT LIKE '%\_PS\_%' ESCAPE '\' THEN 'no_ps_token' END, CASE WHEN f LIKE '%-%' THEN 'hyphen_separator' END, CASE WHEN contains(f, '__') THEN 'double_underscore' END) AS filename_anomalies FROM y""")
def report_parse(spark, sf_dir):
    c = T.report_name(F.col("f"))
    return names(spark, sf_dir).select("doc_id", *((listed(x) if n == "filename_anomalies" else x).alias(n) for n, x in c.items()))


@query("page_profile", """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'image/png' ELSE 'application/pdf' END AS mime, CASE WHEN doc_id % 2 = 0 THEN 'fir' ELSE 'sc' END AS corpus, n_chars, (doc_id % 12) * 1000 AS w, (doc_id % 11) * 1000 AS h, 240.0 + doc_id % 16 AS m, doc_id % 50 AS sd FROM documents)
    SELECT doc_id, CASE WHEN mime <> 'application/pdf' THEN 'image' WHEN n_chars > 500 THEN 'native_text_or_mixed' ELSE 'scan_or_image_pdf' END AS page_class, array_to_string(list_sort(list_filter([CASE WHEN mime = 'application/pdf' AND n_chars > 500 THEN 'embedded_text_available' END, CASE WHEN mime = 'application/pdf' AND corpus = 'fir' THEN 'handwriting_likely' END,
    CASE WHEN mime = 'application/pdf' AND doc_id % 4 = 1 THEN 'latin' END, CASE WHEN w * h > 80000000 THEN 'oversized_render' END, CASE WHEN w > h THEN 'landscape_or_rotated' END, CASE WHEN w * h <= 80000000 AND m > 248 THEN 'low_ink_or_blank_risk' END, CASE WHEN w * h <= 80000000 AND sd < 25 THEN 'low_contrast' END,
    CASE WHEN w * h <= 80000000 AND corpus = 'sc' AND doc_id % 80 > 30 THEN 'long_judgment' END], lambda x: x IS NOT NULL)), ',') AS quality_flags FROM d""")
def page_profile(spark, sf_dir):
    i = F.col("doc_id")
    c = {"mime_type": F.when(i % 3 == 0, "image/png").otherwise("application/pdf"), "corpus": F.when(i % 2 == 0, "fir").otherwise("sc"), "language_variant": F.when(i % 4 == 1, "EN"), "first_page_text_chars": F.col("n_chars"), "width": (i % 12) * 1000, "height": (i % 11) * 1000, "mean": 240 + i % 16, "stddev": i % 50, "report_start_page": F.lit(1), "report_end_page": 1 + i % 80}
    p = T.page_profile(c)
    return read(spark, sf_dir, "documents").select("doc_id", p["page_class"].alias("page_class"), listed(p["quality_flags"]).alias("quality_flags"))


@query("smoke_pairs", f"WITH {FLOW}, k AS (SELECT conv_id AS pair_key, row_number() OVER (PARTITION BY hn = en ORDER BY conv_id) AS i, hn = en AS e FROM pc) SELECT pair_key FROM k WHERE (e AND i <= 3) OR (NOT e AND i = 1)")
def smoke_pairs(spark, sf_dir):
    return export.smoke_pairs(pairs(spark, sf_dir).select(F.col("citation_key").alias("pair_key"), "hindi_page_count", "english_page_count"), 4)


@query("pairing_full_outer", "WITH a AS (SELECT c_custkey AS k FROM customer), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) SELECT coalesce(a.k, b.k) AS pair_key, a.k IS NOT NULL AND b.k IS NOT NULL AS paired, CASE WHEN a.k IS NULL THEN 'missing_left' WHEN b.k IS NULL THEN 'missing_right' ELSE '' END AS failure_reasons FROM a FULL JOIN b ON a.k = b.k")
def pairing_full_outer(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pair_key"), F.lit(True).alias("l"))
    b = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pair_key")).distinct().withColumn("r", F.lit(True))
    return a.join(b, "pair_key", "full").select("pair_key", (F.col("l").isNotNull() & F.col("r").isNotNull()).alias("paired"), F.when(F.col("l").isNull(), "missing_left").when(F.col("r").isNull(), "missing_right").otherwise("").alias("failure_reasons"))


#: Pages of five kinds: as they are, with leading white space, as PDF (good, or without pages), as images (good or not), as other bytes.
MIME = r"""m AS (SELECT page_id, CASE page_id % 6 WHEN 1 THEN chr(10) || ' ' || html WHEN 2 THEN '%PDF-1.7 ' || html WHEN 3 THEN '%PDF-1.4' WHEN 4 THEN 'x' || html ELSE html END AS body FROM pages),
    k AS (SELECT page_id, CASE WHEN starts_with(body, '%PDF') THEN 'application/pdf' WHEN regexp_matches(lower(body), '^\s*(<!doctype html|<html)') THEN 'text/html' ELSE 'application/octet-stream' END AS mime_type FROM m)"""


@query("mime_quarantine", f"WITH {MIME} SELECT page_id, mime_type, CASE WHEN mime_type = 'application/pdf' AND page_id % 6 = 2 THEN NULL WHEN mime_type = 'text/html' THEN 'html_masquerading_as_pdf' WHEN mime_type = 'application/pdf' THEN 'invalid_or_unreadable_source' ELSE 'unsupported_mime:' || mime_type END AS quarantine_reason FROM k")
def mime_quarantine(spark, sf_dir):
    i, html = F.col("page_id"), F.col("html")
    body = F.when(i % 6 == 1, F.concat(F.lit("\n "), html)).when(i % 6 == 2, F.concat(F.lit("%PDF-1.7 "), html)).when(i % 6 == 3, "%PDF-1.4").when(i % 6 == 4, F.concat(F.lit("x"), html)).otherwise(html)
    d = read(spark, sf_dir, "pages").select("page_id", T.mime_of(body).alias("mime_type"))
    return d.withColumn("quarantine_reason", T.quarantine_reason(F.col("mime_type"), F.lit(True), F.when(i % 6 == 2, 1).otherwise(0)))


@query("ids", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe_id, 'web:' || substr(sha256(url || ':' || sha256(html)), 1, 12) AS document_id, 'web:' || substr(sha256(url || ':' || sha256(html)), 1, 12) || ':p0001' AS first_page FROM pages")
def ids(spark, sf_dir):
    doc = T.document_id(F.lit("web"), F.col("url"), F.sha2(F.col("html").cast("binary"), 256))
    return read(spark, sf_dir, "pages").select("page_id", T.safe_id(F.col("url")).alias("safe_id"), doc.alias("document_id"), T.page_id(doc, F.lit(1)).alias("first_page"))


#: Payloads made of events: whole ones, ones without a field, blank pages by flag or structure, lists, texts that aren't JSON.
RAW = """p AS (SELECT event_id, (props->>'k')::INT AS k, CASE event_id % 8
      WHEN 0 THEN '{"plain_text": " page ' || event_id || ' ", "markdown": "", "blocks": [1, 2], "key_values": [], "tables": [], "quality_flags": ["a"], "confidence": ' || (props->>'k') || '}'
      WHEN 1 THEN '{"plain_text": "x", "blocks": [], "confidence": "' || (props->>'k') || '%"}'
      WHEN 2 THEN '{"plain_text": "", "markdown": "", "blocks": [], "key_values": [], "tables": [], "quality_flags": {"is_blank": true}, "confidence": "' || (props->>'k') || '"}'
      WHEN 3 THEN '{"plain_text": " ", "markdown": "m", "blocks": [], "key_values": [], "tables": [], "quality_flags": [], "confidence": 0.9}'
      WHEN 4 THEN '[3, {"q": 1}, {"plain_text": "y", "markdown": "z", "blocks": {}, "key_values": [], "tables": [], "quality_flags": [], "confidence": 1.01}]'
      WHEN 5 THEN '{"plain_text": "", "markdown": "", "blocks": [], "key_values": [], "tables": [], "quality_flags": [], "confidence": 1}'
      WHEN 6 THEN 'no json' ELSE '{"plain_text": "t", "markdown": "t", "blocks": [], "key_values": [], "tables": [], "quality_flags": [], "confidence": null}' END AS payload FROM events)"""


@query("payload_validate", f"""WITH {RAW}, c AS (SELECT *, CASE event_id % 8 WHEN 0 THEN CASE WHEN k > 1 THEN k / 100 ELSE k END WHEN 2 THEN CASE WHEN k > 1 THEN k / 100 ELSE k END WHEN 3 THEN 0.9 WHEN 4 THEN 0.0101 WHEN 5 THEN 1 ELSE 0 END::DOUBLE AS confidence FROM p),
      e AS (SELECT *, event_id % 8 AS f, confidence < 0.6 AS low FROM c)
    SELECT event_id, round(confidence, 6) AS confidence, concat_ws(',', CASE f WHEN 1 THEN 'missing:key_values,missing:markdown,missing:quality_flags,missing:tables,invalid:confidence' WHEN 6 THEN 'missing:blocks,missing:confidence,missing:key_values,missing:markdown,missing:plain_text,missing:quality_flags,missing:tables,invalid:confidence,empty:plain_text,invalid:blocks' WHEN 7 THEN 'invalid:confidence' END,
      CASE WHEN f = 3 OR f = 2 AND low THEN 'empty:plain_text' END, CASE WHEN f = 4 THEN 'invalid:blocks' END, CASE WHEN low THEN 'low_confidence' END) AS errors,
    CASE f WHEN 0 THEN 'page ' || event_id WHEN 1 THEN 'x' WHEN 4 THEN 'y' WHEN 7 THEN 't' ELSE '' END AS plain_text, CASE f WHEN 0 THEN 'page ' || event_id WHEN 1 THEN 'x' WHEN 3 THEN 'm' WHEN 4 THEN 'z' WHEN 7 THEN 't' ELSE '' END AS markdown,
    CASE f WHEN 0 THEN '[1,2]' ELSE '[]' END AS blocks, CASE f WHEN 0 THEN 'a' WHEN 2 THEN 'is_blank:True' WHEN 5 THEN 'blank_page' ELSE '' END AS quality_flags FROM e""")
def payload_validate(spark, sf_dir):
    sql = RAW[RAW.index("CASE event_id") : RAW.index(" AS payload FROM")].replace("(props->>'k')", "get_json_object(props, '$.k')")
    d = payload.validated(read(spark, sf_dir, "events").select("event_id", F.expr(sql).alias("payload")))
    n = F.col("normalized")
    return d.select("event_id", F.round(n["confidence"], 6).alias("confidence"), listed("errors").alias("errors"), n["plain_text"].alias("plain_text"), n["markdown"].alias("markdown"), n["blocks"].alias("blocks"), listed(n["quality_flags"]).alias("quality_flags"))


@query("quota_errors", """WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"code": 429} Quota exceeded for metric: m' || user_id || ', limit: ' || event_id || ', please retry in ' || (event_id % 50) || '.5s' WHEN 1 THEN '{"code": 503}' WHEN 2 THEN 'Name or service not known' ELSE 'other' END AS error FROM events)
    SELECT event_id, event_id % 4 = 0 AS quota, event_id % 4 IN (1, 2) AS transient, CASE WHEN event_id % 4 = 0 THEN event_id % 50 + 2.5 ELSE 65.0 END::DOUBLE AS retry_after, CASE WHEN event_id % 4 = 0 THEN regexp_extract(error, 'metric: (m[0-9]+)', 1) END AS metric, CASE WHEN event_id % 4 = 0 THEN event_id END AS quota_limit FROM e""")
def quota_errors(spark, sf_dir):
    i = F.col("event_id")
    error = F.expr("""CASE event_id % 4 WHEN 0 THEN concat('{"code": 429} Quota exceeded for metric: m', user_id, ', limit: ', event_id, ', please retry in ', event_id % 50, '.5s') WHEN 1 THEN '{"code": 503}' WHEN 2 THEN 'Name or service not known' ELSE 'other' END""")
    d = read(spark, sf_dir, "events").select("event_id", error.alias("error"), F.when(i % 4 == 2, "URLError").otherwise("HTTPError").alias("kind"))
    q = T.quota_detail(F.col("error"))
    return d.select("event_id", T.quota_error(F.col("error")).alias("quota"), T.transient_error(F.col("kind"), F.col("error")).alias("transient"), T.retry_after(F.col("error")).alias("retry_after"), q["metric"].alias("metric"), q["limit"].alias("quota_limit"))


def log(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("page_id"), F.col("event_type").alias("status"), "value")


@query("failed_attempts", "SELECT user_id AS page_id, count(*) AS failed_attempts FROM events WHERE event_type = 'error' GROUP BY 1")
def failed_attempts(spark, sf_dir):
    return runlog.failed_attempts(log(spark, sf_dir), "page_id", F.lit(1), F.col("status") == "error")


@query("latest_failure", "SELECT user_id AS page_id, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events WHERE event_type = 'error' GROUP BY 1")
def latest_failure(spark, sf_dir):
    return runlog.latest(log(spark, sf_dir).where("status = 'error'"), "page_id", "seq", "value")


@query("quota_streak", "WITH i AS (SELECT user_id, event_id, event_type, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events) SELECT user_id AS page_id, min(event_id) AS first_seq, max(event_id) AS last_seq, count(*) AS length FROM i WHERE event_type = 'error' GROUP BY user_id, island")
def quota_streak(spark, sf_dir):
    return runlog.streaks(log(spark, sf_dir), "seq", F.col("status") == "error", "page_id")


@query("pending_topk", "WITH p AS (SELECT user_id AS page_id, sum(length(props))::BIGINT AS cost, count(*) FILTER (event_type = 'error') AS failed_attempts, coalesce(bool_or(event_type = 'purchase' AND (props->>'k')::INT > 95), false) AS done FROM events GROUP BY 1) SELECT page_id, cost, failed_attempts FROM p WHERE NOT done AND failed_attempts < 25 ORDER BY failed_attempts, cost, page_id LIMIT 96")
def pending_topk(spark, sf_dir):
    d = log(spark, sf_dir)
    done = read(spark, sf_dir, "events").where("event_type = 'purchase' AND CAST(get_json_object(props, '$.k') AS INT) > 95").select(F.col("user_id").alias("page_id"))
    pages = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("page_id")).agg(F.sum(F.length("props")).alias("cost"))
    return runlog.pending(pages, done, runlog.failed_attempts(d, "page_id", F.lit(1), F.col("status") == "error"), "page_id", "cost", 25, 96)


@query("status_last_n", "SELECT event_type AS status, count(*) AS n FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 500) GROUP BY 1")
def status_last_n(spark, sf_dir):
    return runlog.status_of_last(log(spark, sf_dir), "seq", "status", 500)


@query("flag_histogram", f"WITH {COUNTS}, f AS (SELECT unnest([CASE WHEN latin > 500 THEN 'latin' END, CASE WHEN digits > 0 THEN 'digits' END, CASE WHEN chars < 200 THEN 'short' END]) AS flag FROM q) SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY 1")
def flag_histogram(spark, sf_dir):
    n = T.script_counts(F.col("text"))
    flags = F.array_compact(F.array(F.when(n["latin"] > 500, "latin"), F.when(n["digits"] > 0, "digits"), F.when(n["chars"] < 200, "short")))
    return read(spark, sf_dir, "documents").select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


ACCEPTED = f"WITH {SPLITS}, a AS (SELECT s.*, 'ft:' || s.doc_id AS example_id FROM s JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) USING (doc_id))"


def accepted(spark, sf_dir) -> DataFrame:
    good = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return splits(spark, sf_dir).join(good, "doc_id", "left_semi").withColumn("example_id", F.concat(F.lit("ft:"), F.col("doc_id").cast("string")))


@query("ft_export", f"{ACCEPTED} SELECT a.example_id, a.split, d.lang AS language, d.text AS target FROM a JOIN documents d USING (doc_id)")
def ft_export(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), F.col("text").alias("target"))
    return accepted(spark, sf_dir).join(d, "doc_id").select("example_id", "split", "language", "target")


class Run:
    """The tables of a finished run, each built when first asked: documents of good label are accepted pages, the rest are pages without gold; judgments
    come from the conversations.  What several tables or checks read is persisted: memory and disk, and what a lost executor held is computed again.
    """

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def own(self) -> DataFrame:
        """Pages of documents, without their texts."""
        d = read(self.spark, self.sf_dir, "documents").select("doc_id", "lang").join(splits(self.spark, self.sf_dir), "doc_id")
        page = F.concat(F.lit("fir:"), F.col("doc_id").cast("string"))
        return d.select("doc_id", page.alias("page_id"), F.lit("fir").alias("corpus"), "split", "split_group_id", F.array(F.col("lang")).alias("quality_flags"), F.lit(True).alias("rendered"), page.alias("document_id"), F.lit(1).alias("page_index"), F.lit(1).alias("page_count"), F.lit("r.jpg").alias("render_path"), F.lit("fir").alias("doc_type"), F.col("lang").alias("language_hint")).persist()

    @cached_property
    def gold(self) -> DataFrame:
        good = read(self.spark, self.sf_dir, "labels").where("quality = 1").select("doc_id")
        none, text = F.lit("[]"), F.col("text")
        normal = F.struct(text.alias("plain_text"), text.alias("markdown"), none.alias("blocks"), none.alias("key_values"), none.alias("tables"), F.array(F.lit("z")).alias("quality_flags"), F.lit(0.9).alias("confidence"))
        payloads = read(self.spark, self.sf_dir, "documents").select("doc_id", "text").join(good, "doc_id", "left_semi").select(F.concat(F.lit("fir:"), F.col("doc_id").cast("string")).alias("page_id"), normal.alias("normalized"))
        return export.gold_pages(self.own.drop("doc_id"), payloads, F.lit("m")).persist()

    @cached_property
    def texts(self) -> DataFrame:
        return sides(self.spark, self.sf_dir).persist()

    @cached_property
    def paired(self) -> DataFrame:
        return pairs(self.spark, self.sf_dir, self.texts).persist()

    @cached_property
    def verification(self) -> DataFrame:
        return align.verification(self.paired, self.texts).persist()

    @cached_property
    def judged(self) -> DataFrame:
        return rendered(self.spark, self.sf_dir, self.texts)

    @cached_property
    def alignment(self) -> DataFrame:
        return alignment_of(self.verification, self.paired, self.judged, self.texts).persist()

    @cached_property
    def translations(self) -> DataFrame:
        return export.gold_translations(self.alignment, self.judged)

    @cached_property
    def examples(self) -> DataFrame:
        return export.all_examples(export.page_examples(self.gold), export.translation_examples(self.translations)).persist()

    @cached_property
    def pages(self) -> DataFrame:
        names = ["page_id", "corpus", "split", "split_group_id", "quality_flags"]
        return self.own.select(*names, "rendered").unionByName(self.judged.select(*names, F.lit(True).alias("rendered")))

    def audited(self, rows: DataFrame) -> dict[str, DataFrame]:
        """What an audit of given examples reads."""
        source = lambda d, v: d.select(F.lit(True).alias("valid_source"), "page_count", "corpus", F.lit(v).cast("string").alias("language_variant"))
        status = lambda d, v: d.select("page_id", F.lit("m").alias("model"), F.lit(1).alias("attempts"), F.lit(v).alias("status"))
        return {
            "sources": source(self.own, None).unionByName(source(self.judged, "HIN")), "pages": self.pages, "gold": self.gold, "examples": rows, "calibration": export.calibration(rows), "runs": status(self.own, "accepted"),
            "failures": status(self.own.limit(0), "x"), "pairs": self.paired, "alignment": self.alignment, "verification": self.verification, "texts": self.texts, "template_errors": export.template_errors(rows),
        }


RUN = f"""{ACCEPTED}, {FLOW}, s2 AS (SELECT conv_id, page FROM t WHERE side = 'HIN' AND NOT (conv_id % 5 = 0 AND page = 1)),
    n AS (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM s2) AS h, (SELECT count(*) FROM a) AS g, (SELECT count(*) FROM a WHERE split = 'train') AS g_train, (SELECT count(*) FROM av WHERE verified) AS x, (SELECT count(*) FROM pc WHERE hn > 0 AND en = 0) AS lone)"""


@query("gold_pages", f"{ACCEPTED} SELECT 'ft:ocr_full_json:gold:fir_gita:fir:' || a.doc_id AS example_id, a.split, array_to_string(list_sort([d.lang, 'z']), ',') AS flags, d.text AS plain_text, 'fir:' || a.doc_id || ':b0001' AS block_id, 'r.jpg' AS image FROM a JOIN documents d USING (doc_id)")
def gold_pages(spark, sf_dir):
    d = export.page_examples(Run(spark, sf_dir).gold)
    t = F.from_json("target", "plain_text string, quality_flags array<string>, blocks string")
    return d.select("example_id", F.col("split.name").alias("split"), listed(t["quality_flags"]).alias("flags"), t["plain_text"].alias("plain_text"), F.get_json_object(t["blocks"], "$[0].block_id").alias("block_id"), export.image_path(F.col("messages")).alias("image"))


@query("calibration_256", f"{RUN}, e AS (SELECT 'ft:ocr_full_json:gold:fir_gita:fir:' || doc_id AS example_id FROM a WHERE split = 'train' UNION ALL SELECT 'ft:ocr_translate_en_json:gold:sc_hi_en:' || alignment_id FROM av WHERE verified) SELECT 'cal:' || example_id AS calibration_id, 'r.jpg' AS render_path FROM e ORDER BY sha256('2026-06-06:v1' || example_id), example_id LIMIT 256")
def calibration_256(spark, sf_dir):
    return export.calibration(Run(spark, sf_dir).examples).select("calibration_id", "render_path")


@query("eval_report", f"{RUN} SELECT d + h AS page_count, g AS fir_gita_gold_count, x AS sc_gold_count, g + x AS ft_count, g AS ocr_full_json, x AS ocr_translate_en_json, least(256, g_train + x)::BIGINT AS calibration_count, 0::BIGINT AS crop_level_rows, 0::BIGINT AS sc_targets_from_gemini, CASE WHEN g + x > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS json_validity_rate, '' AS split_leakage_failures, (SELECT string_agg(f || ':' || c, ',' ORDER BY f) FROM (SELECT lang AS f, count(*) AS c FROM documents GROUP BY 1 UNION ALL SELECT 'devanagari', count(*) FROM s2)) AS quality_bucket_counts FROM n")
def eval_report(spark, sf_dir):
    r = Run(spark, sf_dir)
    d = audit.evaluation(r.pages, r.gold, r.translations, r.examples, export.calibration(r.examples))
    return d.withColumns({"split_leakage_failures": listed("split_leakage_failures"), "quality_bucket_counts": F.array_join(F.transform(F.map_entries("quality_bucket_counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")})


def audit_sql(checks: dict[str, str], sc: bool) -> str:
    """The checks over counts taken in SQL."""
    x, h = ("x", "h") if sc else ("0", "0")
    row = f"""SELECT d + {h} AS pages, d + {h} AS pages_expected, 0 AS renders_missing, d AS own_pages, 0 AS unattempted, g AS accepted, g AS gold, 0 AS invalid_gold, 0 AS other_gold, 0 AS failures_bare, g + {x} AS examples, 0 AS crops, 0 AS leaks, 0 AS template_errors, {str(sc).lower()} AS folders_organised,
      d + {h} AS valid_sources, {h} AS hindi_sources, lone AS unpaired, {x} AS sc_examples, {x} AS sc_native, {x} AS sc_on, 0 AS exported_unverified, (SELECT count(*) FROM z) AS verifications, x AS verified, 0 AS verified_otherwise, 0 AS sc_translated, least(256, g_train + {x}) AS calibrated, 0 AS miscalibrated, 1 AS texts, g AS own_examples, g_train + {x} AS train_examples FROM n"""
    return f"{RUN}, k AS ({row}), l AS (SELECT {', '.join(f'{e} AS {n}' for n, e in checks.items())} FROM k) SELECT *, {' AND '.join(checks)} AS all_complete FROM l"


@query("completion_audit", audit_sql(audit.CHECKS, True))
def completion_audit(spark, sf_dir):
    r = Run(spark, sf_dir)
    return audit.completion(r.audited(r.examples), "m")


@query("own_completion_audit", audit_sql(audit.OWN_CHECKS, False))
def own_completion_audit(spark, sf_dir):
    r = Run(spark, sf_dir)
    return audit.own_completion(r.audited(export.page_examples(r.gold).persist()), "m")


@query("json_salvage", """SELECT doc_id, CASE WHEN text IS NOT NULL THEN '{"confidence": 0.9, "plain_text": ' || to_json(regexp_replace(text, '["\\\\]', '', 'g'))::VARCHAR || '}' END AS payload FROM documents""")
def json_salvage(spark, sf_dir):
    """Broken payloads made of texts: a raw line end inside a string, prose with a stray quote around the object."""
    raw = F.concat(F.lit('Here it is, 5" wide:\n{"plain_text": "'), F.regexp_replace("text", '["\\\\]', ""), F.lit('", "confidence": 0.9}\nDone.'))
    return payload.repaired(read(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))).select("doc_id", "payload")
