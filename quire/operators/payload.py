"""Annotation payloads: salvage of broken JSON, then coercion, validation and normalisation in Spark expressions over VARIANT."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import strip

# The fields a payload must have, and what a flag says of a blank page.
FIELDS = ("blocks", "confidence", "key_values", "markdown", "plain_text", "quality_flags", "tables")
BLANK = ("blank_page", "is_blank:true", "is_blank: true", "no_text_found:true", "no_text_found: true")
#: Raw line ends and tabs inside strings are let through; other control characters are not.
DECODER, BAD = json.JSONDecoder(strict=False), re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")
#: Brackets that what follows them allows to begin a value.
OPEN, TOKEN, DEPTH = re.compile(r"\{(?=\s*[\"}])|\[(?=\s*[\[{\]\"0-9tfnNI-])"), re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', re.DOTALL), 200


def decoded(text: str, at: int):
    """(value, end) of the JSON that begins at a place, or (None, place of the error)."""
    try:
        value, end = DECODER.raw_decode(text, at)
    except json.JSONDecodeError as e:
        return None, max(e.pos, at + 1)
    except RecursionError:  # brackets nested deeper than any payload: go on near the innermost
        opened = []
        for m in TOKEN.finditer(text, at):
            if m[0] in "]}":
                break
            if m[0] in "[{":
                opened.append(m.start())
        return None, max(at + 1, opened[-DEPTH] if len(opened) >= DEPTH else at + 1)
    bad = BAD.search(text, at, end)
    return (None, bad.start()) if bad else (value, end)


def closed(text: str, a: int, z: int) -> list[int]:
    """Where the outermost brackets within (a, z) that close there begin; what is open at z can't be decoded either."""
    stack, out = [], []
    for m in TOKEN.finditer(text, a, z):
        if m[0] in "[{":
            stack.append(m.start())
        elif m[0] in "]}" and stack:
            begin = stack.pop()
            out = [x for x in out[-64:] if x < begin] + [begin] if out and out[-1] > begin else [*out, begin]
    return out


def inner(value):
    """A value and the dicts and lists in it, in the order of their beginnings."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, (dict, list)):
            yield v
            todo += reversed(list(v.values()) if isinstance(v, dict) else v)


def whole(x) -> bool:
    return isinstance(x, dict) and x.keys() >= set(FIELDS)


def salvage(text: str | None):
    """The payload in a text: all of it if it is JSON; else the first object with all fields, or list that holds one; else the object with most of
    them.  Every bracket is a beginning; those in strings are not.  Linear: what an attempt has read isn't tried again."""
    text = (text or "").strip()
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        pass
    best, most, at = None, 0, 0
    while m := OPEN.search(text, at):
        value, at = decoded(text, m.start())
        for v in [value] if value is not None else [x for b in closed(text, m.start(), at) for x, _ in [decoded(text, b)]]:
            for x in inner(v):
                if whole(x) or isinstance(x, list) and any(map(whole, x)):
                    return x
                n = len(set(FIELDS) & x.keys()) if isinstance(x, dict) else 0
                if n > most:
                    best, most = x, n
    return best


def salvaged_text(s: pd.Series) -> pd.Series:
    return s.map(lambda t: json.dumps(x, ensure_ascii=False, sort_keys=True) if t is not None and (x := salvage(t)) is not None else None)


def repaired(df: DataFrame, raw: str = "raw", out: str = "payload") -> DataFrame:
    """df with well-formed payloads as they are; the others alone go through Python, in batches."""
    d = df.withColumn("_good", F.try_parse_json(F.col(raw)).isNotNull())
    fixed = F.pandas_udf(salvaged_text, "string")(F.when(~F.col("_good"), F.col(raw)))
    return d.withColumn(out, F.when(F.col("_good"), F.col(raw)).otherwise(fixed)).drop("_good")


def get(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def shown(v: Column) -> Column:
    """A value as a text: true, false and null have capitals, as they do in flags."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "BOOLEAN", F.initcap(get(v, "string"))).when(kind == "VOID", "None").otherwise(get(v, "string"))


def validated(df: DataFrame, raw: str = "payload", least: float = 0.6) -> DataFrame:
    """df with ok, errors and the normalised payload: plain_text, markdown, blocks, key_values, tables (JSON texts), quality_flags and confidence.

    A list counts as its first object with any field, other values as an empty object.  A null or malformed payload lacks every field.  A confidence in
    (1, 100] is a percentage, what can't be read is 0, NaN is rejected.  Flags given as an object become key:value, by key.
    """
    empty = F.array().cast("array<variant>")
    d = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    as_map = lambda v: get(v, "map<string,variant>")
    useful = F.filter(F.transform(F.coalesce(get(F.col("_v"), "array<variant>"), empty), as_map), lambda m: F.coalesce(F.arrays_overlap(F.map_keys(m), F.array(*map(F.lit, FIELDS))), F.lit(False)))
    d = d.withColumn("_m", F.coalesce(as_map(F.col("_v")), F.try_element_at(useful, F.lit(1))))
    field = lambda f: F.try_element_at(F.col("_m"), F.lit(f))
    text = lambda f: strip(F.coalesce(get(field(f), "string"), F.lit("")))
    rows = lambda f: get(field(f), "array<variant>")
    flags = F.coalesce(
        F.transform(rows("quality_flags"), shown),
        F.transform(F.map_entries(as_map(field("quality_flags"))), lambda e: F.concat(e["key"], F.lit(":"), shown(e["value"]))),
        F.array().cast("array<string>"),
    )
    d = d.withColumns({f"_{f}": rows(f) for f in ("blocks", "key_values", "tables")} | {"_text": text("plain_text"), "_mark": text("markdown"), "_flags": flags, "_number": get(field("confidence"), "double")})
    number = F.when(F.isnan("_number"), None).otherwise(F.col("_number"))
    d = d.withColumns({"_bad": number.isNull(), "_conf": F.when((number > 1) & (number <= 100), number / 100).otherwise(F.coalesce(number, F.lit(0.0))), "_mark": F.when(F.col("_mark") == "", F.col("_text")).otherwise(F.col("_mark"))})
    none = lambda f: F.size(F.coalesce(F.col(f), empty)) == 0
    said = F.lower(F.array_join("_flags", " "))
    is_blank = (F.col("_text") == "") & (F.col("_conf") >= least) & (F.greatest(*(F.contains(said, F.lit(b)) for b in BLANK)) | (F.col("_mark") == "") & none("_blocks") & none("_key_values") & none("_tables"))
    d = d.withColumn("_blank", is_blank)
    named_blank = F.exists("_flags", lambda x: F.contains(F.lower(x), F.lit("blank")))
    has = lambda f: F.coalesce(F.map_contains_key("_m", F.lit(f)), F.lit(False))
    errors = F.array_compact(F.array(
        *(F.when(~has(f), f"missing:{f}") for f in FIELDS), F.when(F.col("_bad"), "invalid:confidence"), F.when((F.col("_text") == "") & ~F.col("_blank"), "empty:plain_text"),
        F.when(F.col("_blocks").isNull(), "invalid:blocks"), F.when(F.col("_conf") < least, "low_confidence"),
    ))
    listed = lambda f: F.to_json(F.coalesce(F.col(f), empty))
    normal = F.struct(
        F.col("_text").alias("plain_text"), F.col("_mark").alias("markdown"), listed("_blocks").alias("blocks"), listed("_key_values").alias("key_values"), listed("_tables").alias("tables"),
        F.when(F.col("_blank") & ~named_blank, F.concat("_flags", F.array(F.lit("blank_page")))).otherwise(F.col("_flags")).alias("quality_flags"), F.col("_conf").alias("confidence"),
    )
    out = d.withColumns({"errors": errors, "normalized": normal})
    return out.withColumn("ok", F.size("errors") == 0).select(*df.columns, "ok", "errors", "normalized")


def assembled(response: Column) -> dict[str, Column]:
    """text, finish_reasons and thought_part_count of a model's raw response; parts that are thoughts don't count as text."""
    c = F.from_json(response, "candidates array<struct<finishReason:string,content:struct<parts:array<struct<thought:boolean,text:string>>>>>")["candidates"]
    c = F.coalesce(c, F.from_json(F.lit("[]"), "array<struct<finishReason:string,content:struct<parts:array<struct<thought:boolean,text:string>>>>>"))
    parts = F.flatten(F.filter(F.transform(c, lambda x: x["content"]["parts"]), lambda p: p.isNotNull()))
    thought = lambda p: F.coalesce(p["thought"], F.lit(False))
    return {
        "text": F.array_join(F.transform(F.filter(parts, lambda p: ~thought(p)), lambda p: F.coalesce(p["text"], F.lit(""))), ""),
        "finish_reasons": F.filter(F.transform(c, lambda x: x["finishReason"]), lambda r: F.coalesce(r, F.lit("")) != ""),
        "thought_part_count": F.size(F.filter(parts, thought)),
    }
