"""Page alignment of document pairs by cumulative text flow.

Pages carry (pair, side, page, weight).  A page covers the share of its document's weight that lies between the pages before and after; pages of
two sides overlap where their shares do.  Pairs are small, so the interval condition is a residual of the equi-join on the pair.  Both directions
of a pair come from one pass: every page is a source and a target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Confidence of each relation, those that mean that text bleeds over a page's edge, and names of methods.
CONFIDENCE = {"unmatched_or_empty": 0.0, "source_page_spans_multiple_target_pages": 0.55, "same_page_likely": 0.93, "same_page_low_text_quality": 0.68, "same_count_shift_or_bleed": 0.45, "page_count_mismatch_single_target_page": 0.62}
BLEED = ("source_page_spans_multiple_target_pages", "same_count_shift_or_bleed", "page_count_mismatch_single_target_page")
FLOW, VERIFIED = "cumulative_text_flow_overlap_v1", "same_page_content_flow_verified_v1"


def page_weight(chars: Column, non_empty: Column) -> Column:
    """Characters of a page that has 20 or more, else nothing."""
    return F.when((chars >= 20) & non_empty, chars).otherwise(0).cast("double")


def pair_up(sources: DataFrame) -> DataFrame:
    """Pairs of (pair_key, language_variant, source_path, document_id, page_count, seq): the last of each side counts, unpaired ones stay.

    One aggregation by key is the full outer join of both sides; sources without a key are left out.
    """
    side = lambda v: F.max_by(F.when(F.col("language_variant") == v, F.struct("source_path", "document_id", "page_count")), F.when(F.col("language_variant") == v, F.col("seq")))
    d = sources.where("pair_key IS NOT NULL").groupBy("pair_key").agg(side("HIN").alias("h"), side("EN").alias("e"))
    both = F.col("h").isNotNull() & F.col("e").isNotNull()
    reasons = F.array_compact(F.array(
        F.when(F.col("h").isNull(), "missing_hindi_pdf"), F.when(F.col("e").isNull(), "missing_english_pdf"),
        F.when(both & (F.col("h.page_count") != F.col("e.page_count")), "page_count_mismatch_possible_offset_or_bleed"),
    ))
    name = F.concat(F.lit("sc_pair:"), F.col("pair_key").cast("string"))
    each = [F.col(f"{s}.{c}").alias(f"{l}_{c}") for c in ("source_path", "document_id", "page_count") for s, l in (("h", "hindi"), ("e", "english"))]
    return d.select(name.alias("pair_id"), F.col("pair_key").alias("citation_key"), *each, both.alias("paired"), reasons.alias("failure_reasons"), name.alias("split_group_id"))


def intervals(pages: DataFrame, pair: str = "pair_id", side: str = "side", page: str = "page", weight: str = "weight") -> DataFrame:
    """start, stop and weight of each page in [0, 1], with any other columns; documents without weight are cut evenly."""
    doc = W.partitionBy(pair, side)
    running = doc.orderBy(page).rowsBetween(W.unboundedPreceding, W.currentRow)
    w = F.col(weight).cast("double")
    d = pages.withColumns({"_w": w, "_upto": F.sum(w).over(running), "_total": F.sum(w).over(doc), "_i": F.row_number().over(doc.orderBy(page)), "n": F.count("*").over(doc)})
    flat = F.col("_total") <= 0
    return d.withColumns({
        "start": F.when(flat, (F.col("_i") - 1) / F.col("n")).otherwise((F.col("_upto") - F.col("_w")) / F.col("_total")),
        "stop": F.when(flat, F.col("_i") / F.col("n")).otherwise(F.col("_upto") / F.col("_total")),
        "share": F.when(flat, 1 / F.col("n")).otherwise(F.col("_w")),
    }).drop("_w", "_upto", "_total", "_i")


def overlaps(cut: DataFrame, pair: str = "pair_id") -> DataFrame:
    """Pages of both sides of a pair whose intervals overlap: (pair, side of the source, pages, ratios of each, overlap, weights, target_ok)."""
    ok = F.col("quality_ok") if "quality_ok" in cut.columns else F.lit(True)
    s = cut.select(pair, "side", F.col("page").alias("source_page"), F.col("start").alias("a"), F.col("stop").alias("b"), F.round("share", 3).alias("source_weight"))
    t = cut.select(F.col(pair).alias("_p"), F.col("side").alias("_s"), F.col("page").alias("target_page"), F.col("start").alias("c"), F.col("stop").alias("d"), F.round("share", 3).alias("target_weight"), ok.alias("target_ok"))
    shared = F.least("b", "d") - F.greatest("a", "c")
    both = s.join(t, (s[pair] == t["_p"]) & (F.col("side") != F.col("_s")) & (F.least("b", "d") > F.greatest("a", "c")))
    return both.select(
        pair, "side", "source_page", "target_page", F.round(shared / F.greatest(F.col("b") - F.col("a"), F.lit(1e-6)), 6).alias("source_ratio"),
        F.round(shared / F.greatest(F.col("d") - F.col("c"), F.lit(1e-6)), 6).alias("target_ratio"), F.round(shared, 6).alias("normalized_overlap"), "target_weight", "source_weight", "target_ok",
    )


def matched(found: DataFrame, least: float = 0.15, pair: str = "pair_id") -> DataFrame:
    """For each source page: its target pages of a ratio of at least `least`, or else the best; whether all of these are of quality; the best five."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("source_ratio")).alias("r"), F.col("target_page").alias("page_index"), "source_ratio", "target_ratio", "normalized_overlap", "target_weight", "source_weight", "target_ok")))
    g = found.groupBy(pair, "side", "source_page").agg(ranked.alias("all"))
    g = g.withColumn("good", F.filter("all", lambda x: x["source_ratio"] >= least))
    g = g.withColumn("good", F.when(F.size("good") > 0, F.col("good")).otherwise(F.slice("all", 1, 1)))
    return g.select(
        pair, "side", "source_page", F.array_sort(F.transform("good", lambda x: x["page_index"])).alias("targets"), F.forall("good", lambda x: x["target_ok"]).alias("targets_ok"),
        F.col("all")[0]["page_index"].alias("top_target"), F.col("all")[0]["source_ratio"].alias("top_ratio"), F.col("all")[0]["target_ratio"].alias("top_target_ratio"),
        F.transform(F.slice("all", 1, 5), lambda x: x.dropFields("r", "target_ok")).alias("overlap_candidates"),
    )


def verification(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """One row for each page of each side of each paired document, text or not: its relation to the other side, and why.

    pairs as pair_up() gives them; texts: pair_id, side (HIN or EN), page, chars, non_empty, quality_ok, text_sha256.
    """
    cut = intervals(texts.withColumn("weight", page_weight(F.col("chars"), F.col("non_empty"))))
    both = pairs.where("paired AND hindi_page_count > 0 AND english_page_count > 0")
    way = lambda s, a, b: F.struct(F.lit(s).alias("side"), F.col(f"{a}_document_id").alias("source_document_id"), F.col(f"{b}_document_id").alias("target_document_id"), F.col(f"{a}_page_count").alias("source_page_count"), F.col(f"{b}_page_count").alias("target_page_count"))
    ways = both.select("pair_id", "citation_key", F.explode(F.array(way("HIN", "hindi", "english"), way("EN", "english", "hindi"))).alias("w")).select("pair_id", "citation_key", "w.*")
    pages = ways.withColumn("source_page", F.explode(F.sequence(F.lit(1), F.col("source_page_count").cast("int"))))
    own = cut.select("pair_id", "side", F.col("page").alias("source_page"), "chars", "quality_ok", "text_sha256")
    d = pages.join(own, ["pair_id", "side", "source_page"], "left").join(matched(overlaps(cut)), ["pair_id", "side", "source_page"], "left")
    return classified(d)


def classified(d: DataFrame) -> DataFrame:
    """Relation, reasons, confidence and flags of rows (source_page, page counts, chars, quality_ok, targets, targets_ok, …)."""
    d = d.withColumns({"targets": F.coalesce("targets", F.array().cast("array<int>")), "_ok": F.coalesce("quality_ok", F.lit(False)), "_to": F.coalesce("targets_ok", F.lit(False))})
    n, equal = F.size("targets"), F.col("source_page_count") == F.col("target_page_count")
    same = equal & (n == 1) & (F.try_element_at("targets", F.lit(1)) == F.col("source_page"))
    relation = (
        F.when(n == 0, "unmatched_or_empty").when(n > 1, "source_page_spans_multiple_target_pages").when(same & F.col("_ok") & F.col("_to"), "same_page_likely")
        .when(same, "same_page_low_text_quality").when(equal, "same_count_shift_or_bleed").otherwise("page_count_mismatch_single_target_page")
    )
    d = d.withColumn("content_relation", relation)
    r = F.col("content_relation")
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("chars", F.lit(0)) < 20, "source_page_text_too_short"), F.when(~F.col("_ok"), "source_text_quality_failed"), F.when(n == 0, "no_target_page_overlap"),
        F.when((n > 0) & ~F.col("_to"), "target_text_quality_failed"), F.when(~equal, "page_count_mismatch"), F.when(r == "same_count_shift_or_bleed", "same_page_index_not_best_flow_match"),
    ))
    same_info = r == "same_page_likely"
    other = F.when(F.col("side") == "HIN", "EN").otherwise("HIN")
    out = d.withColumns({
        "target_language_variant": other, "failure_reasons": reasons, "confidence": F.coalesce(*(F.when(r == k, F.lit(v)) for k, v in CONFIDENCE.items())),
        "same_information_likely": same_info, "bleed_likely": r.isin(*BLEED), "needs_manual_review": ~same_info, "verification_method": F.lit(FLOW),
        "direction": F.concat_ws("-to-", F.lower("side"), F.lower(other)),
        "verification_id": F.concat("pair_id", F.lit(":"), F.lower("side"), F.lit("_p"), F.lpad(F.col("source_page").cast("string"), 4, "0"), F.lit("_to_"), F.lower(other)),
    })
    return out.withColumnRenamed("side", "source_language_variant").drop("_ok", "_to", "targets_ok")


def aligned(verified: DataFrame, pairs: DataFrame, pages: DataFrame, texts: DataFrame) -> DataFrame:
    """One row for each Hindi page: whether the English page of the same number is its translation, and which.

    pages: document_id, page_index, page_id, render_path; texts: document_id, page_index, text_sha256, text.
    """
    v = verified.where("source_language_variant = 'HIN'").withColumn("english_page_index", F.when(F.size("targets") == 1, F.col("targets")[0]))
    p = pairs.select("pair_id", "hindi_document_id", "english_document_id", "english_source_path")
    h = pages.select(F.col("document_id").alias("hindi_document_id"), F.col("page_index").alias("source_page"), F.col("page_id").alias("hindi_page_id"), F.col("render_path").alias("hindi_render_path"))
    e = texts.select(F.col("document_id").alias("english_document_id"), F.col("page_index").alias("english_page_index"), F.col("text_sha256").alias("english_text_sha256"), F.col("text").alias("english_text"))
    d = v.drop("text_sha256").join(p, "pair_id").join(h, ["hindi_document_id", "source_page"], "left").join(e, ["english_document_id", "english_page_index"], "left")
    page, text = F.col("hindi_page_id").isNotNull(), F.col("english_text_sha256").isNotNull()
    d = d.withColumn("alignment_verified", F.col("same_information_likely") & page & text & F.coalesce(F.col("english_page_index") == F.col("source_page"), F.lit(False)))
    ok = F.col("alignment_verified")
    more = F.array_compact(F.array(F.when(~page, "missing_hindi_rendered_page"), F.when(~text, "missing_single_english_text_target")))
    return d.select(
        F.concat("pair_id", F.lit(":p"), F.lpad(F.col("source_page").cast("string"), 4, "0")).alias("alignment_id"), "pair_id", "citation_key", "hindi_page_id", "hindi_render_path", F.col("source_page").alias("hindi_page_index"),
        "english_document_id", "english_source_path", "english_page_index", "english_text_sha256", "english_text", F.when(ok, VERIFIED).otherwise(F.col("verification_method")).alias("alignment_method"), "alignment_verified",
        F.when(ok, F.col("confidence")).otherwise(0.0).alias("alignment_confidence"), "content_relation", F.col("targets").alias("predicted_english_page_indices"), "bleed_likely",
        F.when(ok, F.array().cast("array<string>")).otherwise(F.array_sort(F.array_union("failure_reasons", more))).alias("failure_reasons"),
        F.lit(True).alias("native_english_target"), F.lit(False).alias("gemini_used_for_translation"), F.col("verification_id").alias("content_verification_id"),
    )


def failures(pairs: DataFrame, alignment: DataFrame) -> DataFrame:
    """Pairs with reasons and pages that aren't verified, each with the stage at which they failed."""
    a = pairs.where(F.size("failure_reasons") > 0).withColumn("failure_stage", F.lit("pairing"))
    return a.unionByName(alignment.where("NOT alignment_verified").withColumn("failure_stage", F.lit("page_content_alignment")), allowMissingColumns=True)


COUNTS = {"row_count": "count(*)", "same_information_likely_rows": "count_if(same_information_likely)", "needs_manual_review_rows": "count_if(needs_manual_review)", "bleed_likely_rows": "count_if(bleed_likely)"}


def counted(rows: DataFrame, *by: str) -> DataFrame:
    """COUNTS and the histogram of relations by any columns; without any, one row."""
    inner = rows.groupBy(*by, "content_relation").agg(*(F.expr(x).alias(k) for k, x in COUNTS.items()))
    return inner.groupBy(*by).agg(*(F.coalesce(F.sum(k), F.lit(0)).cast("bigint").alias(k) for k in COUNTS), F.map_from_entries(F.array_sort(F.collect_list(F.struct("content_relation", "row_count")))).alias("relation_counts"))


def pair_summaries(rows: DataFrame) -> DataFrame:
    """One row for each pair, overall and by direction, ordered by citation or pair."""
    ways = {"hindi": "HIN", "english": "EN"}
    one = lambda v: [F.expr(x.replace("count(*)", "count_if(true)")[:-1] + f" AND source_language_variant = '{v}')").alias(f"{k}_{v.lower()}") for k, x in COUNTS.items()]
    pages = [F.coalesce(F.max(F.when(F.col("source_language_variant") == v, F.col("source_page_count"))), F.lit(0)).alias(f"{k}_page_count") for k, v in ways.items()]
    flags = [F.bool_or(c).alias(n) for n, c in (("pair_has_bleed_likely", "bleed_likely"), ("pair_needs_manual_review", "needs_manual_review"), ("pair_has_same_information_likely_pages", "same_information_likely"))]
    out = rows.groupBy("pair_id").agg(F.first("citation_key").alias("citation_key"), *pages, *(F.expr(x).alias(k) for k, x in COUNTS.items()), *flags, *one("HIN"), *one("EN"))
    return out.orderBy(F.coalesce(F.col("citation_key").cast("string"), F.col("pair_id")))


def review_rows(rows: DataFrame) -> DataFrame:
    """What a reviewer needs of the rows that need review, by citation, direction and page."""
    columns = [
        "verification_id", "pair_id", "citation_key", "direction", "source_language_variant", "target_language_variant", "source_page", "source_page_count", "target_page_count", "targets", "content_relation",
        "same_information_likely", "bleed_likely", "needs_manual_review", "confidence", "top_target", "top_ratio", "top_target_ratio", "failure_reasons", "text_sha256",
    ]
    return rows.where("needs_manual_review").select(*columns).orderBy(F.coalesce(F.col("citation_key").cast("string"), F.lit("")), F.coalesce("direction", F.lit("")), F.coalesce("source_page", F.lit(0)))


def histogram(rows: DataFrame, column: str, name: str) -> DataFrame:
    """How often each member of an array column occurs, most frequent first, ties by name."""
    return rows.select(F.explode(column).alias(name)).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


# What each relation means.
MEANING = {
    "same_page_likely": "same page index, same page count, and both extracted texts passed quality checks",
    "source_page_spans_multiple_target_pages": "source page overlaps more than one target page by cumulative text flow",
    "page_count_mismatch_single_target_page": "best target is one page, but PDF page counts differ",
}


def report(rows: DataFrame, examples: int = 50) -> str:
    """A report in Markdown, of aggregates and the first rows to review."""
    total, ways = counted(rows).first(), counted(rows, "direction").orderBy("direction").collect()
    out = ["# Page content verification", ""]
    out += [f"- {k}: {total[k] if total else 0}" for k in COUNTS]
    out += ["", "## Directions", "", "| Direction | " + " | ".join(COUNTS) + " |", "|---|" + "---:|" * len(COUNTS)]
    out += [f"| `{r.direction}` | " + " | ".join(str(r[k]) for k in COUNTS) + " |" for r in ways]
    out += ["", "## Relations", "", "| Relation | Rows | Meaning |", "|---|---:|---|"]
    out += [f"| `{k}` | {v} | {MEANING.get(k, '')} |" for k, v in sorted((total.relation_counts if total else {}).items())]
    out += ["", "## Reasons", ""] + [f"- `{r.reason}`: {r.n}" for r in histogram(rows, "failure_reasons", "reason").collect()]
    out += ["", "## Review", "", "| Citation | Direction | Page | Predicted | Relation | Top | Source overlap | Target overlap | Reasons |", "|---|---|---:|---|---|---:|---:|---:|---|"]
    number = lambda x: "" if x is None else f"{x:.3f}"
    for r in review_rows(rows).limit(examples).collect():
        out.append(f"| `{r.citation_key}` | `{r.direction}` | {r.source_page} | {', '.join(map(str, r.targets))} | `{r.content_relation}` | {r.top_target or ''} | {number(r.top_ratio)} | {number(r.top_target_ratio)} | {', '.join(r.failure_reasons)} |")
    return "\n".join(out) + "\n"
