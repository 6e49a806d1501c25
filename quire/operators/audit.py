"""Evaluation and completion audits.  Each table is summed up in one pass into one row; the checks are expressions over these rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.align import VERIFIED
from quire.operators.export import CALIBRATION, crop


def one_row(*rows: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), rows)


def leaking(rows: DataFrame, group: str, split: str) -> DataFrame:
    """Groups with more than one split; no split counts as one."""
    return rows.groupBy(group).agg(F.count_distinct(F.coalesce(split, F.lit("")), F.col(split).isNull()).alias("n")).where("n > 1").select(F.col(group).alias("split_group_id"))


def needed(pages, accepted, share: float = 0.95):
    """Accepted pages that are missing for a share of all."""
    whole = (pages * share).cast("bigint")
    return F.greatest(whole + F.when(whole / F.greatest(pages, F.lit(1)) < share, 1).otherwise(0) - accepted, F.lit(0)).cast("bigint")


def evaluation(pages: DataFrame, page_gold: DataFrame, translations: DataFrame, rows: DataFrame, calibration: DataFrame) -> DataFrame:
    """The eleven figures of an evaluation, in one row; quality_bucket_counts is a map by flag."""
    flags = pages.select(F.explode("quality_flags").alias("f")).groupBy("f").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("f", "n")))).alias("quality_bucket_counts"))
    gold = page_gold.select("valid", F.lit(1).alias("k")).unionByName(translations.select("valid", F.lit(0).alias("k"))).agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("fir_gita_gold_count"), F.count_if(F.col("k") == 0).alias("sc_gold_count"), (F.count_if("valid") / F.greatest(F.count("*"), F.lit(1))).alias("json_validity_rate"),
    )
    ft = rows.agg(
        F.count("*").alias("ft_count"), F.count_if(F.col("task") == "ocr_full_json").alias("ocr_full_json"), F.count_if(F.col("task") == "ocr_translate_en_json").alias("ocr_translate_en_json"), F.count_if(crop()).alias("crop_level_rows"),
        F.count_if((F.col("task") == "ocr_translate_en_json") & (F.get_json_object("target", "$.alignment.gemini_used_for_translation") == "true")).alias("sc_targets_from_gemini"),
    )
    leaks = leaking(pages, "split_group_id", "split").agg(F.array_sort(F.collect_list("split_group_id")).alias("split_leakage_failures"))
    return one_row(pages.agg(F.count("*").alias("page_count")), gold, ft, calibration.agg(F.count("*").alias("calibration_count")), leaks, flags)


def summed(t: dict[str, DataFrame], model: str) -> DataFrame:
    """What the checks ask of the tables: sources, pages, gold, runs, failures, pairs, alignment, verification, texts, examples, calibration, template_errors."""
    quoted = model.replace("\\", "\\\\").replace("'", "\\'")
    tracked, mine = "corpus IN ('fir', 'gita')", f"teacher_model = '{quoted}'"
    own = t["pages"].where(tracked)
    attempted = t["runs"].where(F.col("model") == model).groupBy("page_id").agg(F.max("attempts").alias("a")).where("a > 0").select("page_id")
    exported = t["examples"].where("task = 'ocr_translate_en_json'").select(F.explode("source_page_ids").alias("hindi_page_id")).distinct()
    al = lambda f: f"get_json_object(target, '$.alignment.{f}') = 'true'"
    sc, translated = "task = 'ocr_translate_en_json'", al("gemini_used_for_translation")
    on = f"coalesce({al('alignment_verified')}, false) AND NOT coalesce({translated}, false)"
    flowed = f"content_relation = 'same_page_likely' AND content_verification_id IS NOT NULL AND alignment_method = '{VERIFIED}'"
    train = "split.name = 'train' AND NOT coalesce(is_crop, false)"
    n = lambda c, name: F.expr(f"count_if(coalesce({c}, false)) AS {name}")
    rows = lambda name: F.expr(f"count(*) AS {name}")
    return one_row(
        t["sources"].agg(n("valid_source", "valid_sources"), F.expr("coalesce(sum(CASE WHEN valid_source THEN page_count END), 0) AS pages_expected"), n("valid_source AND corpus = 'sc' AND language_variant = 'HIN'", "hindi_sources")),
        t["pages"].agg(rows("pages"), n("NOT rendered", "renders_missing"), n(tracked, "own_pages")),
        own.join(attempted, "page_id", "left_anti").agg(rows("unattempted")),
        t["gold"].agg(
            n(f"valid AND NOT {mine}", "other_gold"), n(mine, "gold"), n(f"{mine} AND NOT valid", "invalid_gold"), F.expr(f"count(DISTINCT CASE WHEN valid AND {mine} THEN source_page_id END) AS accepted")),
        t["failures"].where(F.col("model") == model).agg(n("attempts IS NULL OR status IS NULL", "failures_bare")),
        t["pairs"].agg(n("hindi_source_path IS NOT NULL AND english_source_path IS NULL", "unpaired")),
        t["alignment"].agg(n("alignment_verified", "verified"), n(f"alignment_verified AND NOT ({flowed})", "verified_otherwise")),
        t["alignment"].join(exported, "hindi_page_id", "left_semi").agg(n("NOT alignment_verified", "exported_unverified")),
        t["verification"].agg(rows("verifications")), t["texts"].agg(rows("texts")),
        t["examples"].agg(
            rows("examples"), n(sc, "sc_examples"), n(f"NOT {sc}", "own_examples"), n(f"{sc} AND {on}", "sc_on"), n(f"{sc} AND {al('native_english_target')}", "sc_native"), n(f"{sc} AND {translated}", "sc_translated"),
            F.count_if(F.coalesce(crop(), F.lit(False))).alias("crops"), n(train, "train_examples"),
        ),
        leaking(t["examples"].select("split.group_id", "split.name"), "group_id", "name").agg(rows("leaks")),
        t["calibration"].agg(rows("calibrated"), n("split <> 'train' OR is_crop", "miscalibrated")), t["template_errors"].agg(rows("template_errors")),
    )


#: An empty table fails where the check speaks of rows that must exist, and passes where it speaks of none being wrong.
ACCEPTED = "own_pages > 0 AND accepted / greatest(1, own_pages) >= 0.95"
SHARED = {
    "valid_sources_have_manifest_and_renders": "pages = pages_expected AND renders_missing = 0",
    "every_valid_fir_gita_page_attempted_through_gemini": "own_pages > 0 AND unattempted = 0",
    "fir_gita_acceptance_rate_at_least_95_percent": ACCEPTED,
    "every_accepted_fir_gita_record_has_valid_json": "gold > 0 AND invalid_gold = 0",
    "fir_gita_gold_uses_active_teacher_model": "other_gold = 0",
    "gemini_failures_logged_with_retry_status": "failures_bare = 0",
    "no_crop_level_rows_exist": "examples > 0 AND crops = 0",
    "split_document_level_and_leakage_free": "examples > 0 AND leaks = 0",
    "gemma4_chat_template_validation_passes": "template_errors = 0",
}
CHECKS = SHARED | {
    "external_pdf_directories_organized": "folders_organised",
    "every_sc_hindi_pdf_has_paired_english_pdf": "hindi_sources > 0 AND unpaired = 0",
    "every_sc_english_target_from_native_pdf_extraction": "sc_examples > 0 AND sc_native = sc_examples",
    "every_sc_row_has_verified_alignment_metadata": "sc_examples > 0 AND sc_on = sc_examples",
    "no_sc_row_from_unverified_alignment": "exported_unverified = 0",
    "sc_page_content_verification_present": "verifications > 0",
    "sc_verified_alignment_rows_are_content_flow_verified": "verified > 0 AND verified_otherwise = 0",
    "no_sc_target_produced_by_gemini_translation": "sc_translated = 0",
    "calibration_pack_256_train_only_full_page_examples": f"calibrated = {CALIBRATION} AND miscalibrated = 0",
    "sc_text_extraction_manifest_present": "texts > 0",
    "required_named_exports_present": "examples > 0 AND examples = own_examples + sc_examples",
}
OWN_CHECKS = SHARED | {
    "fir_gita_sources_present": "valid_sources > 0 AND pages > 0",
    "fir_gita_export_matches_current_gold": "own_examples > 0 AND own_examples = gold",
    "standalone_exports_do_not_include_sc_rows": "sc_examples = 0",
    "calibration_pack_train_only_full_page_examples": f"examples > 0 AND calibrated = least({CALIBRATION}, train_examples) AND miscalibrated = 0",
    "required_named_exports_present": "examples = own_examples",
}


def completion(t: dict[str, DataFrame], model: str, folders_organised: bool = True) -> DataFrame:
    """The 20 checks, and all_complete."""
    return checked(summed(t, model).withColumn("folders_organised", F.lit(folders_organised)), CHECKS)


def own_completion(t: dict[str, DataFrame], model: str) -> DataFrame:
    """The 14 checks over the corpora that are annotated, and all_complete."""
    mine = F.col("corpus").isin("fir", "gita")
    return checked(summed(t | {k: t[k].where(mine) for k in ("sources", "pages")}, model), OWN_CHECKS)


def checked(row: DataFrame, checks: dict[str, str]) -> DataFrame:
    whole = " AND ".join(f"({x})" for x in checks.values())
    return row.selectExpr(*(f"{x} AS {k}" for k, x in checks.items()), f"{whole} AS all_complete")
