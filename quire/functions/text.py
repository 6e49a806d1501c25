"""Column expressions for texts: strip, script profile, quality gate, identifiers and parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that is stripped, the letters counted as Latin, and the markers of a judgment.
STRIPPED = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LATIN, DEVANAGARI, DIGITS = "[A-Za-z\u0130\u212a]", "[\u0900-\u097f]", r"\p{Nd}"
MARKERS = ("supreme court", "judgment", "appeal", "petitioner", "respondent", "न्यायालय", "अपील", "याचिक", "प्रतिवादी")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(STRIPPED))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("bigint")


def script_counts(text: Column) -> dict[str, Column]:
    """chars (stripped), devanagari, latin, digits (decimal digits of any script), replacement."""
    t = F.coalesce(text, F.lit(""))
    return {
        "chars": F.length(strip(t)).cast("bigint"),
        "devanagari": count_of(t, DEVANAGARI),
        "latin": count_of(t, LATIN),
        "digits": count_of(t, DIGITS),
        "replacement": (F.length(t) - F.length(F.replace(t, F.lit("�"), F.lit("")))).cast("bigint"),
    }


def gated(df: DataFrame, language: Column, text: str = "text") -> DataFrame:
    """df with script_counts() and the gate: 20 characters, under 2 % replacement characters, and the language's script.

    Counts are projected once, and what follows from them after that, so no text is searched twice.
    """
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    markers = sum((F.contains(F.col("_lower"), F.lit(m)).cast("bigint") for m in MARKERS), F.lit(0).cast("bigint"))
    counted = df.withColumns(script_counts(F.col(text)) | {"expected_language": language, "_lower": lower}).withColumn("legal_marker_count", markers).drop("_lower")
    n = {c: F.col(c) for c in ("chars", "devanagari", "latin", "replacement")}
    script = (
        F.when(F.col("expected_language") == "EN", n["latin"] >= F.greatest(F.lit(30), 2 * n["devanagari"]))
        .when(F.col("expected_language") == "HIN", n["devanagari"] >= F.greatest(F.lit(20), F.floor(n["latin"] / 2)))
        .otherwise(n["chars"] > 0)
    )
    judged = counted.withColumns({"replacement_ratio": n["replacement"] / F.greatest(n["chars"], F.lit(1)), "script_ok": script, "non_empty": n["chars"] > 0})
    return judged.withColumn("quality_ok", (F.col("chars") >= 20) & (F.col("replacement_ratio") < 0.02) & F.col("script_ok"))


def scripts_of_hint(hint: Column) -> Column:
    """Scripts that a language hint names, in fixed order; [Unknown] where none."""
    found = F.array_compact(F.array(F.when(F.contains(hint, F.lit("Deva")), "Deva"), F.when(F.contains(hint, F.lit("Latn")) | F.contains(hint, F.lit("en")), "Latn"), F.when(F.contains(hint, F.lit("Taml")), "Taml")))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Unknown")))


def safe_id(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_")


def document_id(corpus: Column, path: Column, sha: Column) -> Column:
    return F.concat(corpus, F.lit(":"), F.substring(F.sha2(F.concat(path, F.lit(":"), sha), 256), 1, 12))


def page_id(document: Column, index: Column) -> Column:
    return F.concat(document, F.lit(":p"), F.lpad(index.cast("string"), 4, "0"))


def direction(source: Column, target: Column) -> Column:
    return F.concat_ws("-to-", F.lower(source), F.lower(target))


def mime_of(head: Column) -> Column:
    """Type by leading bytes of a file or text; any white space may stand before a page's first tag."""
    lead = F.lower(F.substring(F.ltrim(head.cast("string"), F.lit(STRIPPED)), 1, 14))
    raw = F.hex(F.substring(head.cast("binary"), 1, 8))
    return (
        F.when(F.startswith(raw, F.lit("25504446")), "application/pdf")
        .when(F.startswith(raw, F.lit("FFD8FF")), "image/jpeg")
        .when(F.startswith(raw, F.lit("89504E470D0A1A0A")), "image/png")
        .when(F.startswith(lead, F.lit("<!doctype html")) | F.startswith(lead, F.lit("<html")), "text/html")
        .otherwise("application/octet-stream")
    )


def quarantine_reason(mime: Column, opens: Column, pages: Column, failure: Column | None = None) -> Column:
    """Null for valid sources; failure names the error with which an image didn't open."""
    image = mime.isin("image/jpeg", "image/png")
    opened = F.coalesce(opens, F.lit(False))
    return (
        F.when((mime == "application/pdf") & opened & (F.coalesce(pages, F.lit(0)) != 0), None)
        .when(image & opened, None)
        .when(image, F.concat(F.lit("image_open_failed:"), F.coalesce(F.lit(None).cast("string") if failure is None else failure, F.lit("OSError"))))
        .when(mime == "text/html", "html_masquerading_as_pdf")
        .when(mime == "application/pdf", "invalid_or_unreadable_source")
        .otherwise(F.concat(F.lit("unsupported_mime:"), mime))
    )


def stem_of(name: Column) -> Column:
    """A file name without its last extension; a leading dot begins no extension."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^./]+$", "")


def group(text: Column, pattern: str, n: int) -> Column:
    """A group of a pattern, null where the pattern or the group is absent."""
    return F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))


# The patterns of judgments' and reports' file names.
JUDGMENT, COPY, REPORT = r"^(S_)?(\d{4})_(\d+)_(\d+)_(\d+)_(EN|HIN)$", r"\((\d+)\)$", r"^.+?[_-](\d{1,4})[-_](\d{2,4})$"


def citation(name: Column, language: Column | None = None) -> dict[str, Column]:
    """Parts of a judgment's file name; a given language overrides the name's.  Where the name doesn't parse, all but the first two and a given language are null."""
    stem = stem_of(name)
    plain = F.regexp_replace(stem, COPY, "")
    part = lambda n: group(plain, JUDGMENT, n)
    parsed = part(2).isNotNull()
    prefix = F.coalesce(part(1), F.lit(""))
    given = F.lit(None).cast("string") if language is None else language
    return {
        "canonical_stem": plain,
        "copy_index": F.coalesce(group(stem, COPY, 1).cast("int"), F.lit(0)),
        "sc_prefix": F.when(parsed, prefix != ""),
        "citation_key": F.when(parsed, F.concat(prefix, F.concat_ws("_", *(part(i) for i in range(2, 6))))),
        "year": part(2).cast("int"),
        "volume": part(3).cast("int"),
        "report_start_page": part(4).cast("int"),
        "report_end_page": part(5).cast("int"),
        "language_variant": F.coalesce(given, part(6)),
    }


def report_name(name: Column) -> dict[str, Column]:
    """Parts of a police report's file name: unit, number, year, kind and what is odd about it."""
    stem = stem_of(name)
    low, parts, year = F.lower(stem), F.split(stem, "_"), group(stem, REPORT, 2)
    kind = F.when(F.startswith(low, F.lit("rail")), "rail").otherwise("general")
    for word in ("mahila", "sc_st", "traffic", "cyber"):  # the last has precedence
        kind = F.when(F.contains(low, F.lit(word)), word).otherwise(kind)
    odd = {"no_ps_token": ~F.contains(stem, F.lit("_PS_")) & ~F.contains(stem, F.lit("_Ps_")), "hyphen_separator": F.contains(stem, F.lit("-")), "double_underscore": F.contains(stem, F.lit("__"))}
    return {
        "district_or_unit_raw": F.when(parts[0].isin("West", "East", "Rail") & (F.size(parts) > 1), F.concat_ws("_", parts[0], F.try_element_at(parts, F.lit(2)))).otherwise(parts[0]),
        "fir_number_raw": group(stem, REPORT, 1),
        "year_normalized": year.cast("int") + F.when(F.length(year) == 4, 0).otherwise(2000),
        "filename_subtype_hint": kind,
        "filename_anomalies": F.array_compact(F.array(*(F.when(c, k) for k, c in odd.items()))),
    }


def rendered_page_number(name: Column) -> Column:
    return F.coalesce(group(name, r"-(\d+)\.jpg$", 1).cast("int"), F.lit(0))


def relative_path(path: Column, root: Column) -> Column:
    """A path below the root without it; others as they are."""
    base = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, base), F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)


def pdf_info(text: Column) -> Column:
    """Lines `Key: value` of a description of a PDF as a map with snake-case keys; the last of equal keys counts."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(F.replace(F.lower(strip(F.substring_index(x, ":", 1))), F.lit(" "), F.lit("_")).alias("k"), strip(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))
    seen = F.aggregate(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.map_from_arrays(F.array(p["k"]), F.array(p["v"]))))
    return seen


def info_pages(info: Column) -> Column:
    """Page count of pdf_info(), null where it isn't a number."""
    return F.when(F.rlike(F.try_element_at(info, F.lit("pages")), F.lit(r"^\p{Nd}+$")), F.try_element_at(info, F.lit("pages")).try_cast("int"))


def page_profile(c: dict[str, Column]) -> dict[str, Column]:
    """page_class and quality_flags of a rendered page, from columns mime_type, corpus, language_variant, first_page_text_chars, width, height, mean, stddev
    (null: the image's statistics failed), report_start_page and report_end_page.  An oversized image is looked at no further."""
    pdf, chars = c["mime_type"] == "application/pdf", F.coalesce(c["first_page_text_chars"], F.lit(0))
    size = c["width"].cast("bigint") * c["height"]
    read, big, wide = size.isNotNull(), F.coalesce(size > 80_000_000, F.lit(False)), F.coalesce(c["width"] > c["height"], F.lit(False))
    stats = read & ~big & c["mean"].isNotNull() & c["stddev"].isNotNull()
    long = (c["corpus"] == "sc") & (F.coalesce(c["report_end_page"], F.lit(0)) != 0) & (F.coalesce(c["report_start_page"], F.lit(0)) != 0) & (c["report_end_page"] - c["report_start_page"] > 30)
    flags = {
        "embedded_text_available": pdf & (chars > 500), "handwriting_likely": pdf & (c["corpus"] == "fir"),
        "devanagari": pdf & (c["language_variant"] == "HIN"), "latin": pdf & (c["language_variant"] == "EN"),
        "oversized_render": big, "landscape_or_rotated": wide & (big | stats), "low_ink_or_blank_risk": stats & (c["mean"] > 248), "low_contrast": stats & (c["stddev"] < 25),
        "image_stats_failed": ~big & ~stats, "long_judgment": ~big & long,
    }
    kind = F.when(pdf & (chars > 500), "native_text_or_mixed").when(pdf, "scan_or_image_pdf").otherwise("image")
    found = F.array_sort(F.array_compact(F.array(*(F.when(F.coalesce(x, F.lit(False)), k) for k, x in flags.items()))))
    return {"page_class": kind, "quality_flags": found}


# Fixed values below: the texts of a remote model's errors.
def quota_error(error: Column) -> Column:
    e = F.coalesce(error, F.lit(""))
    return F.contains(e, F.lit("RESOURCE_EXHAUSTED")) | F.contains(e, F.lit("Quota exceeded")) | F.contains(e, F.lit('code": 429'))


def transient_error(kind: Column, error: Column) -> Column:
    e = F.lower(F.coalesce(error, F.lit("")))
    has = lambda *xs: F.coalesce(F.greatest(*(F.contains(e, F.lit(x)) for x in xs)), F.lit(False))
    dns = has("temporary failure in name resolution", "name or service not known")
    server = has('"code": 500', '"code": 503', '"status": "internal"', '"status": "unavailable"', "currently experiencing high demand")
    return ((F.coalesce(kind, F.lit("")) == "URLError") & dns) | ((F.coalesce(kind, F.lit("")) == "HTTPError") & server)


def retry_after(error: Column, default: float = 65.0) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(F.coalesce(error, F.lit("")), r"(?i)retry in ([0-9.]+)s", 1), F.lit("")).try_cast("double") + 2.0, F.lit(default))


def quota_detail(error: Column) -> dict[str, Column]:
    """The metric and the limit that a quota error names."""
    e = F.coalesce(error, F.lit(""))
    return {"metric": F.nullif(strip(F.regexp_extract(e, r"Quota exceeded for metric:\s*([^,\n]+)", 1)), F.lit("")), "limit": group(e, r"\blimit:\s*([0-9]+)", 1).cast("bigint")}


def hash_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def iso_time(text: Column) -> Column:
    """An ISO-8601 text as a timestamp; null where it can't be read."""
    return text.try_cast("timestamp")
