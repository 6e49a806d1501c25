"""Gold records, training examples, the calibration pack, and picks of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.text import hash_of, scripts_of_hint, strip

# Versions, the seed of splits, and the texts of training messages.
GOLD, EXAMPLE, SEED = "indic_ocr_gold_v1", "indic_ocr_ft_v1", "2026-06-06:v1"
SYSTEM = {"ocr_full_json": "You are an OCR expert for Indian legal and Indic documents. Return valid JSON only.", "ocr_translate_en_json": "You convert a Hindi Supreme Court page image into aligned English text from the paired official report. Return valid JSON only."}
USER = {"ocr_full_json": "Extract this full page as JSON. Do not translate.", "ocr_translate_en_json": "Read this Hindi page image and return the aligned English text target as JSON."}
CALIBRATION = 256


def gold_pages(pages: DataFrame, accepted: DataFrame, model: Column) -> DataFrame:
    """Gold records of pages with an accepted payload (page_id, normalized as payload.validated() gives it)."""
    d = pages.join(accepted.select("page_id", "normalized"), "page_id")
    n = F.col("normalized")
    language = F.coalesce("language_hint", F.lit("und"))
    block = F.to_json(F.array(F.struct(
        F.concat("page_id", F.lit(":b0001")).alias("block_id"), F.lit("text").alias("type"), F.lit(1).alias("order"), n["plain_text"].alias("text"), F.array(*map(F.lit, (0, 0, 1000, 1000))).alias("bbox"), language.alias("language"), n["confidence"].alias("confidence"),
    )))
    target = F.struct(
        n["plain_text"].alias("plain_text"), n["markdown"].alias("markdown"), F.when(n["blocks"] == "[]", block).otherwise(n["blocks"]).alias("blocks"), n["key_values"].alias("key_values"), n["tables"].alias("tables"),
        F.array_sort(F.array_union(F.coalesce("quality_flags", F.array().cast("array<string>")), n["quality_flags"])).alias("quality_flags"), n["confidence"].alias("confidence"),
    )
    return d.select(
        F.lit(GOLD).alias("schema_version"), F.concat(F.lit("gold:fir_gita:"), "page_id").alias("record_id"), F.col("page_id").alias("source_page_id"), F.col("document_id").alias("source_document_id"),
        F.struct(F.col("split").alias("name"), F.col("split_group_id").alias("group_id"), F.lit(SEED).alias("seed")).alias("split"), "corpus", "render_path", "page_index", "page_count", "doc_type",
        F.struct(language.alias("primary"), F.array(language).alias("all"), scripts_of_hint(language).alias("scripts"), F.contains(language, F.lit("+")).alias("code_mixed")).alias("language"),
        target.alias("target"), (F.col("corpus") == "fir").alias("contains_pii"), model.alias("teacher_model"), F.lit(True).alias("valid"),
    )


def gold_translations(alignment: DataFrame, pages: DataFrame) -> DataFrame:
    """Gold records of verified Hindi pages with their English text; pages or texts that are missing or blank are left out."""
    a = alignment.where("alignment_verified").withColumn("english_text", strip(F.col("english_text"))).where("english_text <> ''")
    d = a.join(pages.withColumnRenamed("page_id", "hindi_page_id"), "hindi_page_id")
    target = F.struct(F.lit("en-Latn").alias("language"), F.col("english_text").alias("text"), hash_of(F.col("english_text")).alias("text_sha256"), "english_source_path", "english_page_index", "alignment_id", "alignment_method", F.lit(True).alias("alignment_verified"), F.lit(False).alias("gemini_used_for_translation"))
    return d.select(
        F.lit(GOLD).alias("schema_version"), F.concat(F.lit("gold:sc_hi_en:"), "alignment_id").alias("record_id"), F.col("hindi_page_id").alias("source_page_id"), F.col("document_id").alias("source_document_id"),
        F.struct(F.col("split").alias("name"), F.col("split_group_id").alias("group_id"), F.lit(SEED).alias("seed")).alias("split"), F.lit("sc").alias("corpus"), "render_path", "page_index", "page_count", F.lit("supreme_court_report").alias("doc_type"), "citation_key",
        F.struct(F.lit("hi-Deva").alias("primary"), F.array(F.lit("hi-Deva"), F.lit("en-Latn")).alias("all"), F.array(F.lit("Deva"), F.lit("Latn")).alias("scripts"), F.lit(False).alias("code_mixed")).alias("language"),
        "quality_flags", F.col("alignment_confidence").alias("confidence"), F.array(target).alias("translation_targets"), F.lit(True).alias("contains_pii"), F.lit(True).alias("valid"),
    )


def messages(task: str, image: Column, answer: Column) -> Column:
    part = lambda kind, text=None, path=None: F.struct(F.lit(kind).alias("type"), (F.lit(None).cast("string") if text is None else text).alias("text"), (F.lit(None).cast("string") if path is None else path).alias("path"))
    said = lambda role, *parts: F.struct(F.lit(role).alias("role"), F.array(*parts).alias("content"))
    return F.array(said("system", part("text", F.lit(SYSTEM[task]))), said("user", part("image", None, image), part("text", F.lit(USER[task]))), said("assistant", part("text", answer)))


def examples(gold: DataFrame, task: str, target: Column) -> DataFrame:
    """Training examples of gold records, with the target as JSON."""
    d = gold.withColumn("_target", F.to_json(target))
    return d.select(
        F.lit(EXAMPLE).alias("schema_version"), F.concat(F.lit(f"ft:{task}:"), "record_id").alias("example_id"), F.col("record_id").alias("source_record_id"), F.array("source_page_id").alias("source_page_ids"), "split",
        F.lit(task).alias("task"), messages(task, F.col("render_path"), F.col("_target")).alias("messages"), F.struct("doc_type", "page_index", F.col("language.primary").alias("language_hint")).alias("document_context"),
        F.col("_target").alias("target"), F.lit(False).alias("is_crop"),
    )


def page_examples(gold: DataFrame) -> DataFrame:
    return examples(gold, "ocr_full_json", F.col("target"))


def translation_examples(gold: DataFrame) -> DataFrame:
    t = F.col("translation_targets")[0]
    how = F.struct(t["alignment_id"].alias("alignment_id"), t["alignment_method"].alias("alignment_method"), t["alignment_verified"].alias("alignment_verified"), F.lit(True).alias("native_english_target"), t["gemini_used_for_translation"].alias("gemini_used_for_translation"))
    return examples(gold, "ocr_translate_en_json", F.struct(t["language"].alias("language"), t["text"].alias("text"), how.alias("alignment"), F.col("quality_flags").alias("quality_flags")))


def all_examples(pages: DataFrame, translations: DataFrame | None = None) -> DataFrame:
    """Both kinds as one table, or the first alone."""
    return pages if translations is None else pages.unionByName(translations, allowMissingColumns=True)


def crop(rows: str = "is_crop", ids: str = "source_page_ids") -> Column:
    return F.coalesce(F.col(rows), F.lit(False)) | F.exists(ids, lambda x: F.contains(x, F.lit("crop")))


def image_path(said: Column) -> Column:
    """Path of the first image among messages."""
    return F.try_element_at(F.filter(F.flatten(F.transform(said, lambda m: m["content"])), lambda p: p["type"] == "image"), F.lit(1))["path"]


def calibration(rows: DataFrame, n: int = CALIBRATION) -> DataFrame:
    """The n train examples, no crops, of least hash: a top-k without a full sort."""
    d = rows.where("split.name = 'train' AND NOT coalesce(is_crop, false)").withColumn("_h", hash_of(F.concat(F.lit(SEED), "example_id"))).orderBy("_h", "example_id").limit(n)
    return d.select(F.concat(F.lit("cal:"), "example_id").alias("calibration_id"), "example_id", "source_page_ids", F.lit("train").alias("split"), "task", image_path(F.col("messages")).alias("render_path"), "is_crop")


def template_errors(rows: DataFrame) -> DataFrame:
    """Examples whose messages no chat template would take: roles in another order, or an empty part (a structural check; no processor is loaded)."""
    roles = F.transform("messages", lambda m: m["role"]) == F.array(*map(F.lit, ("system", "user", "assistant")))
    full = F.forall("messages", lambda m: (F.size(m["content"]) > 0) & F.forall(m["content"], lambda p: F.coalesce(p["text"], p["path"], F.lit("")) != ""))
    return rows.where(~(F.coalesce(roles, F.lit(False)) & F.coalesce(full, F.lit(False)))).select("example_id", F.lit("empty_template").alias("error"))


def first_pages(pages: DataFrame, n: int, *order: str) -> DataFrame:
    """The first page of each of n documents, in order."""
    one = W.partitionBy("document_id").orderBy(*order)
    return pages.where("page_index = 1").withColumn("_r", F.row_number().over(one)).where("_r = 1").drop("_r").orderBy(*order).limit(n)


def select_pages(pages: DataFrame, reports: int, images: int) -> DataFrame:
    """First pages of reports and single images, each with its kind; an error where there are too few."""
    a = first_pages(pages.where("corpus = 'fir'"), reports, "source_path", "page_id").withColumn("sample_kind", F.lit("fir_first_page"))
    b = pages.where("corpus = 'gita'").orderBy("source_path", "page_id").limit(images).withColumn("sample_kind", F.lit("gita_image"))
    out = a.unionByName(b)
    got = {r.sample_kind: r["count"] for r in out.groupBy("sample_kind").count().collect()}
    if got.get("fir_first_page", 0) < reports or got.get("gita_image", 0) < images:
        raise ValueError(f"too few rendered pages: {got}")
    return out


def smoke_pairs(pairs: DataFrame, n: int) -> DataFrame:
    """Keys of up to n pairs: of equal page counts up to n - 1 (one at least), one of unequal counts, as they come by key; then any others by key.

    pairs: pair_key, hindi_page_count, english_page_count (null: unreadable).  Only the first rows of each kind are looked at.
    """
    kind = F.when(F.col("hindi_page_count").isNull() | F.col("english_page_count").isNull(), 2).when(F.col("hindi_page_count") == F.col("english_page_count"), 0).otherwise(1)
    d = pairs.withColumn("_k", kind)
    equal = d.where("_k = 0").orderBy("pair_key").limit(max(1, n - 1))
    other = d.where("_k = 1").orderBy("pair_key").limit(1)
    first = equal.unionByName(other).orderBy("_k", "pair_key").limit(n)
    rest = d.orderBy("pair_key").limit(2 * n).join(first.select("pair_key"), "pair_key", "left_anti").withColumn("_k", F.lit(3))
    return first.unionByName(rest.select(*first.columns)).orderBy("_k", "pair_key").limit(n).select("pair_key")


def organised(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """What linking each incoming file (name, source_path, sha256) beside those that exist (name, target, sha256; a null sha256 is a broken link) would do."""
    e = existing.select("name", F.col("target").alias("_t"), F.col("sha256").alias("_s"), F.lit(True).alias("_e"))
    status = (
        F.when(F.col("_e").isNull(), "linked").when(F.col("_t") == F.col("source_path"), "already_linked").when(F.col("_s").isNull(), "relinked_broken_symlink")
        .when(F.col("_s") == F.col("sha256"), "duplicate_same_sha_kept_existing").otherwise("name_conflict")
    )
    return incoming.join(e, "name", "left").select("name", "source_path", status.alias("status"), (status != "name_conflict").alias("counted"))


def resolve_model(models: DataFrame, preferred: list[str]) -> DataFrame:
    """The first preferred flash model that is available, else the last by name of those that don't think, else the last of all: one row or none."""
    low = F.lower("model_name")
    d = models.where(F.col("is_available") & (F.contains(low, F.lit("flash")) | F.contains(F.lower("display_name"), F.lit("flash"))))
    rank = F.array_position(F.array(*map(F.lit, preferred)), F.col("model_name"))
    d = d.withColumns({"_rank": F.when(rank > 0, rank).otherwise(F.lit(1 << 30)), "_thinks": F.contains(low, F.lit("thinking"))})
    best = d.orderBy("_rank", "_thinks", F.desc("model_name")).limit(1)
    return best.select(F.col("model_name").alias("resolved"), "display_name", F.when(F.col("_rank") < (1 << 30), "dynamic_registry").otherwise("dynamic_registry_fallback").alias("source"))
