"""Expressions and operators on literal rows, and the streaming counter."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import align, annotate, export, payload, runlog
from quire.sources import files
from quire.streaming import quota


def one(spark, value, *exprs, kind="string"):
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*(e.alias(f"c{i}") for i, e in enumerate(exprs))).first())


def test_strip_and_counts(spark):
    for s in ("  a b　", "\x1c\x85x ", "", " ", "é", None):
        assert one(spark, s, F.length(T.strip(F.coalesce(F.col("x"), F.lit("")))))[0] == len((s or "").strip())
    texts = ["न्यायालय अपील " * 4 + "१२", "a" * 30, "a" * 29, "a" * 99 + "�", "a" * 98 + "��", None]
    got = T.gated(spark.createDataFrame([(t, "HIN" if i == 0 else "EN") for i, t in enumerate(texts)], "text string, l string"), F.col("l")).collect()
    assert got[0].devanagari > 20 and (got[0].digits, got[0].legal_marker_count, got[0].quality_ok) == (2, 2, True)
    assert [r.script_ok for r in got] == [True, True, False, True, True, False] and [r.quality_ok for r in got[3:]] == [True, False, False]


def test_parsers(spark):
    c = T.citation(F.col("x"))
    assert one(spark, "S_2020_3_10_45_HIN(1).pdf", c["citation_key"], c["language_variant"], c["report_end_page"], c["copy_index"], c["sc_prefix"]) == ("S_2020_3_10_45", "HIN", 45, 1, True)
    assert one(spark, "2020_3_10_45_HIN.pdf", c["citation_key"], c["sc_prefix"]) == ("2020_3_10_45", False)
    assert one(spark, "2020_3_10_45_HIN (1).pdf", c["citation_key"], c["canonical_stem"]) == (None, "2020_3_10_45_HIN ")
    assert one(spark, "odd.pdf", c["citation_key"], T.citation(F.col("x"), F.lit("EN"))["language_variant"]) == (None, "EN")
    f = T.report_name(F.col("x"))
    assert one(spark, "West_Delhi_PS_12_23.pdf", f["district_or_unit_raw"], f["fir_number_raw"], f["year_normalized"], f["filename_subtype_hint"]) == ("West_Delhi", "12", 2023, "general")
    assert one(spark, "Rail.pdf", f["district_or_unit_raw"], f["year_normalized"], f["filename_subtype_hint"], F.array_join(f["filename_anomalies"], ",")) == ("Rail", None, "rail", "no_ps_token")
    assert one(spark, "\n" + " " * 90 + "<!DOCTYPE html>", T.mime_of(F.col("x"))) == ("text/html",)
    assert one(spark, "page-12.jpg", T.rendered_page_number(F.col("x"))) == (12,) and one(spark, "/a/b/c", T.relative_path(F.col("x"), F.lit("/a"))) == ("b/c",)
    info = T.pdf_info(F.col("x"))
    assert one(spark, "Page size: 1 x 2\nPages:   7\nodd", info["page_size"], T.info_pages(info)) == ("1 x 2", 7)
    q = T.quota_detail(F.col("x"))
    assert one(spark, "Quota exceeded for metric: a/b , limit: 20", q["metric"], q["limit"]) == ("a/b", 20)
    assert one(spark, "%PDF-1.7", T.mime_of(F.col("x"))) == ("application/pdf",)
    assert one(spark, "please Retry in 12.5s", T.retry_after(F.col("x"))) == (14.5,) and one(spark, None, T.retry_after(F.col("x"))) == (65.0,)
    assert one(spark, '{"code": 429}', T.quota_error(F.col("x")), T.transient_error(F.lit("HTTPError"), F.col("x"))) == (True, False)
    assert one(spark, "hi-Deva+en", F.array_join(T.scripts_of_hint(F.col("x")), ",")) == ("Deva,Latn",)


def test_payload(spark):
    full = '{"plain_text": "a\nb", "markdown": "", "blocks": [], "key_values": [], "tables": [], "quality_flags": [], "confidence": 0.9}'
    assert payload.salvage(f"x {{}} [1] {full} y")["plain_text"] == "a\nb"
    assert payload.salvage(f'5" page: {full}')["plain_text"] == "a\nb"
    assert payload.salvage('x [{"confidence": 1}, {"confidence": 1, "tables": []}]') == {"confidence": 1, "tables": []}
    assert payload.salvage('{"a": {"b": [1, {"confidence": 2}], ') == {"confidence": 2} and payload.salvage(f"x [1, {full}]")[0] == 1
    for junk in ("[" * 20000, "{" * 20000, '{"a":' * 5000, "[{" * 5000):
        assert payload.salvage("x" + junk) is None
    assert payload.salvage("nothing {") is None and payload.salvage(None) is None
    for raw, want in (('"0.9"', 0.9), ("85", 0.85), ("1.0", 1.0), ("1.01", 0.0101), ("100.1", 100.1), ('"85%"', 0.0), ('"NaN"', 0.0), ("null", 0.0)):
        got = payload.validated(spark.createDataFrame([(f'{{"plain_text": "t", "confidence": {raw}}}',)], "payload string")).first()
        assert abs(got.normalized.confidence - want) < 1e-9 and ("invalid:confidence" in got.errors) == (raw in ('"85%"', '"NaN"', "null")), raw
    r = payload.assembled(F.col("x"))
    raw = '{"candidates": [{"finishReason": "STOP", "content": {"parts": [{"thought": true, "text": "no"}, {"text": "a"}, {"text": "b"}]}}]}'
    assert one(spark, raw, r["text"], F.array_join(r["finish_reasons"], ","), r["thought_part_count"]) == ("ab", "STOP", 1)


def test_log(spark):
    d = spark.createDataFrame([(i, "p", i in (2, 3, 4, 6)) for i in range(8)], "seq long, page_id string, quota boolean")
    assert sorted((r.first_seq, r.length) for r in runlog.streaks(d, "seq", F.col("quota"), "page_id").collect()) == [(2, 3), (6, 1)]
    assert sorted((r.first_seq, r.length) for r in runlog.streaks(d.repartition(3), "seq", F.col("quota")).collect()) == [(2, 3), (6, 1)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "c.pdf").write_bytes(b"<html>")
    d = files.discover(spark, [(str(tmp_path), "fir", "set", None), (f"{tmp_path}/none", "sc", "set", "EN")])
    assert files.discover(spark, []).count() == 0
    j = files.judged(files.dispatched(d).withColumns({"opens": F.lit(True), "page_count": F.lit(1), "failure": F.lit(None).cast("string")})).collect()
    assert sorted((r.basename, r.quarantine_reason, r.split_group_id.split(":")[0], r.doc_type) for r in j) == [("a.pdf", None, "sha256", "fir"), ("b.pdf", None, "sha256", "fir"), ("c.pdf", "html_masquerading_as_pdf", "fir", "fir")]
    assert files.image_size(b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + (7).to_bytes(4, "big") + (9).to_bytes(4, "big")) == (7, 9)
    assert files.image_size(bytes.fromhex("ffd8ffe00004aaaaffc0000b0800050006030000")) == (6, 5) and files.image_size(b"x") is None
    assert sorted(r.mime_type for r in d.collect()) == ["application/pdf", "application/pdf", "text/html"]
    assert [r.copies for r in files.duplicate_groups(d).collect()] == [2]
    assert files.read_jsonl(spark, f"{tmp_path}/none", "a int").count() == 0
    files.write_jsonl(spark.range(3).withColumn("a", F.lit(None).cast("int")), f"{tmp_path}/t")
    assert files.read_jsonl(spark, f"{tmp_path}/t", "id long, a int").count() == 3


def test_stream(spark, tmp_path):
    rows = [(i, "p", i in (1, 2, 3)) for i in range(5)]
    spark.createDataFrame(rows, "seq long, page_id string, quota boolean").coalesce(1).write.json(f"{tmp_path}/log")
    s = files.read_log(spark, f"{tmp_path}/log", "seq long, page_id string, quota boolean")
    q = quota.quota_streaks(s, "page_id", "seq", "quota").writeStream.format("memory").queryName("hits").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("hits").collect()] == [("p", 3)]


def test_annotate(spark):
    def make():
        return lambda page, n: {"ok": page != "q", "text": "good" if page == "a" and n == 2 else "bad", "error": "RESOURCE_EXHAUSTED"}

    d = spark.createDataFrame([("a",), ("b",), ("q",)], "page_id string")
    got = {r.page_id: (r.attempts, r.status, r.ok) for r in annotate.annotate(d, make, lambda t: [] if t == "good" else ["low_confidence"], lambda e: 0.0 if "EXHAUSTED" in e else None).collect()}
    assert got == {"a": (2, "accepted", True), "b": (3, "invalid_json_or_quality", False), "q": (12, "quota_backoff", False)}
    assert annotate.disabled(d, "m", True).first().status == "not_attempted_gemini_disabled"


def test_picks(spark):
    new = spark.createDataFrame([("a", "/x/a", "1"), ("b", "/x/b", "2"), ("c", "/x/c", "3"), ("d", "/x/d", "4"), ("e", "/x/e", "5")], "name string, source_path string, sha256 string")
    old = spark.createDataFrame([("b", "/x/b", "2"), ("c", "/y/c", "3"), ("d", "/y/d", "9"), ("e", "/y/e", None)], "name string, target string, sha256 string")
    assert [r.status for r in export.organised(new, old).orderBy("name").collect()] == ["linked", "already_linked", "duplicate_same_sha_kept_existing", "name_conflict", "relinked_broken_symlink"]
    models = spark.createDataFrame([("a-flash", "", True), ("z-flash-thinking", "", True), ("b-flash", "", True), ("c-pro", "", True), ("best-flash", "", False)], "model_name string, display_name string, is_available boolean")
    assert tuple(export.resolve_model(models, ["best-flash"]).first())[::2] == ("b-flash", "dynamic_registry_fallback") and export.resolve_model(models, ["x", "a-flash"]).first().source == "dynamic_registry"
    pairs = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", 1, 2), ("d", None, 3), ("e", 4, 4)], "pair_key string, hindi_page_count int, english_page_count int")
    assert [r.pair_key for r in export.smoke_pairs(pairs, 2).collect()] == ["a", "c"] and [r.pair_key for r in export.smoke_pairs(pairs, 4).collect()] == ["a", "b", "e", "c"]


def test_relations_by_hand(spark):
    """Each relation, and Hindi quality, from literal rows."""
    rows = [(1, 2, 2, [1], True, True), (1, 2, 2, [1], False, True), (1, 2, 2, [2], True, True), (1, 2, 3, [1], True, True), (1, 2, 2, [1, 2], True, True), (1, 2, 2, None, None, None)]
    d = spark.createDataFrame([("p", "HIN", *r[:4], 50, *r[4:]) for r in rows], "pair_id string, side string, source_page int, source_page_count int, target_page_count int, targets array<int>, chars int, quality_ok boolean, targets_ok boolean")
    got = [(r.content_relation, r.confidence) for r in align.classified(d).collect()]
    assert got == [("same_page_likely", 0.93), ("same_page_low_text_quality", 0.68), ("same_count_shift_or_bleed", 0.45), ("page_count_mismatch_single_target_page", 0.62), ("source_page_spans_multiple_target_pages", 0.55), ("unmatched_or_empty", 0.0)]
    assert "| `same_page_likely` | 1 |" in align.report(align.classified(d).withColumns({"citation_key": F.lit("c"), "top_target": F.lit(1), "top_ratio": F.lit(0.5), "top_target_ratio": F.lit(0.5), "text_sha256": F.lit("x")}))
